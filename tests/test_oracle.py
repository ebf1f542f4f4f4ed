"""A representative query per workload against its DuckDB oracle at sf0.001
(the full suite runs with ``python tests/oracle_check.py``)."""

import pytest

from oracle_check import compare, duck

SF001 = "/root/testdata/sf0.001"
SAMPLE = ["o02_best_named", "ag06_risk_profile", "s01_positional_scan", "s18_load_history",
          "m05_cdc_transactions", "m07_at", "n02_shred", "t05_person_flow", "l05_global_metrics",
          "j06_metered_usage", "r01_layers", "g03_transactions"]


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__ as e
    return e


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, entry, name):
    status, _, _, info = compare(spark, con, SF001, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert status == "ok", info


def test_entry_smoke(spark, entry):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns


def test_every_query_has_a_name_and_oracle_for_sql_expressible(entry):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    from quarry.plans import registry
    assert set(registry.QUERIES) <= set(q)
    assert len(registry.ORACLE) >= len(registry.QUERIES) - 10
