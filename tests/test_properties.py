"""Property tests of the merge, history, load and provenance operators."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import cdc, generate, history
from quarry.plans import w_history
from quarry.schemas import SCHEMAS
from quarry.sources import load, scan, sinks
from quarry.sources.scan import CsvFormat


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_apply_changes_of_diff_reproduces_new(cat):
    old = w_history.old_snapshot(cat, w_history.FEEDS["transactions"])
    new = w_history.new_snapshot(cat)
    ch = cdc.changes(old, new, "transaction_id")
    got = cdc.apply_changes(old, ch, "transaction_id", guard_deletes=True).table
    assert rows(got.select(*new.columns)) == rows(new)


def test_upsert_rejects_duplicate_keys(cat):
    t = cat.b_transactions
    dup = t.unionByName(t.limit(1))
    try:
        cdc.upsert(t, dup, "transaction_id")
    except cdc.DuplicateKeyError:
        return
    raise AssertionError("duplicate keys accepted")


def test_delete_insert_pair_is_update(spark):
    target = spark.createDataFrame([("a", 1.0)], "k string, v double")
    ch = spark.createDataFrame([("a", 1.0, "DELETE", 1), ("a", 5.0, "INSERT", 2)],
                               "k string, v double, _action string, _seq long")
    res = cdc.apply_changes(target, ch, "k")
    assert rows(res.table) == [("a", 5.0)]
    assert tuple(res.counts.first()) == (0, 1, 0)


def test_prune_keeps_state(cat):
    log = cat.change_log
    ts = [r.ts for r in log.select("ts").orderBy("ts").collect()]
    horizon = ts[len(ts) // 2]
    pruned = history.prune_history(log, horizon)
    assert pruned.count() < log.count()
    for t in (horizon, ts[3 * len(ts) // 4], ts[-1]):
        assert rows(history.state_at(pruned, F.lit(t))) == rows(history.state_at(log, F.lit(t)))


def test_at_includes_before_excludes(cat):
    log = cat.change_log
    t = log.orderBy("ts").select("ts").collect()[100].ts
    at, before = history.state_at(log, F.lit(t)), history.state_before(log, F.lit(t))
    assert at.filter(F.col("ts") == F.lit(t)).count() == 1
    assert before.filter(F.col("ts") == F.lit(t)).count() == 0


def test_literal_format_rejects_header_and_quoted_commas(spark, cat):
    """The banking CSV has a header and quoted commas but the reference's
    format sets neither SKIP_HEADER nor an enclosure: CONTINUE must count
    the header row (and any row with a quoted comma) as errors."""
    root = tempfile.mkdtemp(dir="/tmp")
    src = cat.b_customers.withColumn("address", F.concat_ws(", ", "address", "city"))
    path = sinks.unload_csv(src, f"{root}/customers", CsvFormat(enclosure='"'))
    literal = CsvFormat()                      # type='csv' and nothing else
    res = load.copy_into(spark, path, literal, SCHEMAS["customers"], f"{root}/t", f"{root}/s", "continue")
    audit = res.audit.agg(F.sum("rows_parsed"), F.sum("errors_seen"), F.sum("rows_loaded")).first()
    n = src.count()
    assert audit[0] == n + res.audit.count()          # every file's header line was parsed as a row
    assert audit[1] >= res.audit.count()             # ... and rejected
    assert audit[0] == audit[1] + audit[2]


def test_row_numbers_across_splits(spark):
    """A file read as several splits is numbered 1..n in file order."""
    root = tempfile.mkdtemp(dir="/tmp")
    p = os.path.join(root, "lines.txt")
    with open(p, "w") as fh:
        for i in range(30000):
            fh.write(f"line-{i:06d}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        df = spark.read.text(p)
        assert df.rdd.getNumPartitions() > 4
        n = scan.number_rows(scan.tag_rows(df))
        bad = n.filter(F.col("file_row_number") != F.substring("value", 6, 6).cast("long") + 1).count()
        assert bad == 0 and n.count() == 30000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_generator_independent_of_partitioning(cat):
    src = cat.table("customer")
    a = generate.customers(src.repartition(2))
    b = generate.customers(src.repartition(7))
    assert rows(a) == rows(b)


def test_null_keys_are_keys(spark):
    old = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    new = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    ch = cdc.changes(old, new, "k", with_before=True).collect()
    assert [(r.k, r.v, r._action, r._before.v) for r in ch] == [("a", 2, "UPDATE", 1)]
    more = cdc.upsert(old, new.withColumn("v", new.v + 5), "k").table
    assert {tuple(r) for r in more.collect()} == {(None, 6), ("a", 7)} and more.count() == 2
    change = spark.createDataFrame([(None, 9, "UPDATE", 1)], "k string, v int, _action string, _seq long")
    assert {tuple(r) for r in cdc.apply_changes(old, change, "k").table.collect()} == {(None, 9), ("a", 1)}
