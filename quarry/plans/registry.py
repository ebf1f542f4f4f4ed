"""Named queries: (spark, sf_dir) -> DataFrame, each with an optional oracle.

A query body receives a ``Catalog`` over the test tables. Its result goes
through ``present``: dates and timestamps become their canonical string
form, which is what the oracle SQL emits as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.fixtures import Catalog

QUERIES: dict[str, Callable[[Catalog], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[Catalog], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            # 'yyyy-MM-dd HH:mm:ss' + always six fraction digits, zone-free
            s = c.cast("string")
            cols.append(F.when(s.contains("."), F.rpad(s, 26, "0"))
                        .otherwise(F.concat(s, F.lit(".000000"))).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(c.cast("string").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(Catalog(spark, sf_dir)))

    run.__name__ = name
    return run


def load_all() -> None:
    """Import every workload module so its queries register."""
    import importlib
    for mod in WORKLOADS:
        importlib.import_module(f"quarry.plans.{mod}")


WORKLOADS = ["w_players", "w_banking", "w_files", "w_history", "w_person", "w_streaming", "w_ml", "w_generate"]
