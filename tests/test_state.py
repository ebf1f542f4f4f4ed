"""State that follows from changes: summaries, snapshots, the load ledger and audit, metrics of odd scores."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import cdc, history, ml, summary

ROWS = "id int, g string, h int, v double"


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_extremes_follow_deletes_in_null_groups(spark):
    rng = random.Random(2)
    make = lambda n: [(i, rng.choice(["x", "y", None]), rng.choice([1, None]),
                       rng.choice([None, *[k / 4 for k in range(12)]])) for i in range(n)]
    old_rows = make(150)
    new_rows = [r if rng.random() < 0.5 else (r[0], *make(1)[0][1:]) for r in old_rows if rng.random() < 0.7]
    new_rows = [r for r in new_rows if r[1] is not None or (r[3] or 0) < 2] + [(900, "new", 1, 5.0)]
    old, new = (spark.createDataFrame(r, ROWS) for r in (old_rows, new_rows))
    ch = cdc.changes(old, new, "id", with_before=True)
    groups = ["g", "h"]
    values = summary.build_values(old, groups, "v")
    got, after = summary.refresh_extremes(summary.summarise(values, groups), values, ch, groups, "v")
    want = new.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("v").cast(summary.MONEY)).alias("total"),
        F.min("v").alias("lowest"), F.max("v").alias("highest"), F.avg("v").alias("average"))
    cols = [*groups, "row_count", "total", "lowest", "highest", "average"]
    assert rows_of(got, *cols) == rows_of(want, *cols)
    assert rows_of(after, *after.columns) == rows_of(summary.build_values(new, groups, "v"), *after.columns)
    counts = summary.refresh_summary(summary.build_summary(old, groups, "v"), ch, groups, "v")
    assert rows_of(counts, *groups, "row_count") == rows_of(want, *groups, "row_count")


def test_null_group_is_one_group(spark):
    old = spark.createDataFrame([(1, None, 1, 5.0), (2, "x", 1, 1.0)], ROWS)
    new = spark.createDataFrame([(1, None, 1, 5.0), (3, None, 1, 4.0)], ROWS)
    ch = cdc.changes(old, new, "id", with_before=True)
    got = summary.refresh_summary(summary.build_summary(old, ["g"], "v"), ch, ["g"], "v")
    assert [(r.g, r.row_count, float(r.total)) for r in got.collect()] == [(None, 2, 9.0)]


def test_a_row_that_was_never_there_cannot_go(spark):
    old, new = (spark.createDataFrame([(i, "x", 1, 1.0)], ROWS) for i in (1, 2))
    ch = cdc.changes(old, new, "id", with_before=True)
    nothing = summary.build_values(old.limit(0), ["g"], "v")
    with pytest.raises(Exception, match="never held"):
        summary.refresh_values(nothing, ch.filter("_action = 'DELETE'"), ["g"], "v").collect()


def test_snapshots_give_the_state_and_open_one_period(spark, cat, tmp_path):
    log = cat.change_log
    lo, hi = log.agg(F.min("ts"), F.max("ts")).first()
    at = [lo + (hi - lo) * i / 5 for i in range(1, 5)]
    event = log.orderBy("ts").collect()[500].ts        # a cut at the very time of a change
    store = history.SnapshotLog(spark, str(tmp_path / "log"))
    store.write(log, [*at, event])
    for t in [lo, event, at[0], at[2], hi, hi + dt.timedelta(days=9), lo - dt.timedelta(days=1)]:
        for inclusive, plain in ((True, history.state_at), (False, history.state_before)):
            want = plain(log, F.lit(t))
            got = store.state_at(t, inclusive)
            assert rows_of(got, *want.columns) == rows_of(want, *want.columns), (t, inclusive)
    late = store.state_at(hi)
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"period={store.period_of(hi)[0]}" in str(late.inputFiles())
    late.collect()
    scanned = {f.split("/changes/")[1].split("/")[0] for f in
               store._changes(log.schema, 5, 5).filter("true").select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert scanned == {"period=5"}


def test_states_of_variant_payloads(spark):
    log = spark.sql("""SELECT * FROM VALUES (1, 1, 1, 'INSERT', '{"a": 1}'), (1, 2, 2, 'UPDATE', '{"a": 2}')
                       AS t(key, ts, seq, action, j)""").select("key", "ts", "seq", "action", F.parse_json("j").alias("v"))
    assert [r.s for r in history.state_at(log, 2).select(
        F.to_json("v").alias("s")).collect()] == ['{"a":2}']


# -- loads -----------------------------------------------------------------------
@pytest.fixture
def stage(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    from quarry.sources import load
    from quarry.sources.scan import CsvFormat
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    files = tmp_path / "files"
    files.mkdir()

    def copy(fmt=CsvFormat(skip_header=1), **more):
        args = {"on_error": "continue", "ledger": f"{tmp_path}/ledger", "audit_path": f"{tmp_path}/audit", "table": "t"}
        r = load.copy_into(spark, str(files), fmt, schema, f"{tmp_path}/target", f"{tmp_path}/stage", **{**args, **more})
        return sorted(((x.a, x.b) for x in r.loaded.collect()), key=str), r
    return files, copy


def test_files_load_once(spark, stage, tmp_path):
    files, copy = stage
    (files / "one.csv").write_text("a,b\n1,x\n")
    (files / "bad.csv").write_text("a,b\nq,x\n")
    (files / "head.csv").write_text("a,b\n")
    assert copy()[0] == [(1, "x")]
    assert copy()[0] == [(1, "x")]                     # one.csv is known; bad.csv loaded nothing and is tried again
    (files / "bad.csv").write_text("a,b\n2,mended\n3,more\n")
    (files / "with space+.csv").write_text("a,b\n4,y\n")
    assert copy()[0] == [(1, "x"), (2, "mended"), (3, "more"), (4, "y")]
    (files / "one.csv").write_text("a,b\n1,x\n9,grown\n")  # another length: another file
    got, r = copy()
    assert got == [(1, "x"), (1, "x"), (2, "mended"), (3, "more"), (4, "y"), (9, "grown")]
    assert [x.rows_loaded for x in r.audit.collect()] == [2]
    assert len(copy(force=True, pattern="one")[0]) == 8
    assert len(copy()[0]) == 8


def test_a_load_that_crashed_before_its_ledger_entry(spark, stage, monkeypatch):
    from quarry.sources import load
    files, copy = stage
    (files / "one.csv").write_text("a,b\n1,x\n2,y\n")

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(load, "record_audit", crash)         # the rows are written by then
        with pytest.raises(RuntimeError):
            copy()
    assert copy()[0] == [(1, "x"), (2, "y")]


def test_audit_of_a_window(spark, stage, tmp_path):
    from quarry.sources import load
    files, copy = stage
    t0 = dt.datetime(2024, 5, 1, 12)
    for k, text in enumerate(["1,x\nq,x\n2,y\nr,x\n", "3,z\n", "s,z\n"]):
        (files / f"{k}.csv").write_text("a,b\n" + text)
        copy(load_time=t0 + dt.timedelta(hours=k))
    see = lambda **w: sorted((r.file.rsplit("/", 1)[1], r.rows_parsed, r.errors_seen, r.first_error_line, r.rows_loaded,
                              r.status) for r in load.load_history(f"{tmp_path}/audit", spark, **w).collect())
    assert see(until=t0) == [("0.csv", 4, 2, 2, 2, "PARTIALLY_LOADED")]
    assert see(since=t0 + dt.timedelta(hours=1)) == [("1.csv", 1, 0, None, 1, "LOADED"), ("2.csv", 1, 1, 1, 0, "LOAD_FAILED")]
    assert len(see(table="t")) == 3 and see(table="other") == []


def test_copy_with_two_header_lines_and_null_tokens(spark, stage):
    from quarry.sources.scan import CsvFormat
    files, copy = stage
    (files / "a.csv").write_text("h\nh2\n1,x\nNULL,na\nq,x\n3\n5,6,7\n")
    for tokens in ((), ("NULL",), ("NULL", "na")):
        (files / "a.csv").write_text((files / "a.csv").read_text() + "8,x\n")
        got, r = copy(CsvFormat(skip_header=2, null_if=tokens), ledger=None, audit_path=None, mode="overwrite")
        good = [g for g in got if g[0] is not None]
        assert [g for g in good if g != (8, "x")] == [(1, "x")]
        bad = {x.file_row_number for x in r.rejected.collect()}
        assert {3, 4, 5} <= bad and (2 in bad) == (not tokens)


def test_missing_and_extra_fields_are_bad_whatever_the_tokens(spark, stage):
    from quarry.sources.scan import CsvFormat
    files, copy = stage
    (files / "a.csv").write_text("a,b\n1,x\n3\n5,6,7\nNULL,na\n")
    for tokens in (("NULL",), ("NULL", "na")):
        _, r = copy(CsvFormat(skip_header=1, null_if=tokens), ledger=None, audit_path=None, mode="overwrite")
        assert sorted(x.file_row_number for x in r.rejected.collect()) == [2, 3]


# -- metrics -----------------------------------------------------------------------
def test_auc_leaves_out_what_cannot_be_ranked(spark):
    shape = "label boolean, prediction boolean, score double"
    rows = [(True, True, 0.9), (False, False, 0.1), (True, False, 0.1), (False, False, None), (True, True, math.nan),
            (None, True, 0.7), (False, True, math.inf), (True, True, -math.inf)]
    df = spark.createDataFrame(rows, shape)
    known = [(y, s) for y, _, s in rows if y is not None and s is not None and not math.isnan(s)]
    pairs = [(s > t) + 0.5 * (s == t) for y, s in known if y for z, t in known if not z]
    got = ml.auc(df, "label", "score").first()
    assert got.auc == pytest.approx(sum(pairs) / len(pairs)) and (got.p, got.n) == (3, 2)
    assert ml.auc(df.limit(0), "label", "score").first().auc is None
    assert ml.auc(df.filter("score IS NULL"), "label", "score").first().auc is None
    one = ml.auc(spark.createDataFrame([(True, True, 0.5), (False, True, 0.5)], shape), "label", "score").first()
    assert one.auc == 0.5
    assert 0 < ml.global_metrics(df.filter("label IS NOT NULL")).first().auc < 1


# -- layout and screening --------------------------------------------------------------
def test_files_are_skipped_on_either_cluster_key(spark, tmp_path):
    import glob
    import pyarrow.parquet as pq
    from quarry.sources import sinks
    rng = random.Random(4)
    day = dt.datetime(2024, 1, 1)
    rows = [(rng.choice("ABCDEFGHIJKLMNOP") + rng.choice("xyz"), day + dt.timedelta(hours=rng.randrange(9000)), i)
            for i in range(6000)] + [(None, day, -1), ("A", None, -2)]
    df = spark.createDataFrame(rows, "c string, t timestamp_ntz, i int").repartition(4)
    got = sinks.write_clustered(df, str(tmp_path / "z"), ["c", "t"], files=16)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    hits = {"c": 0, "t": 0}
    want = {"c": "Hy", "t": day + dt.timedelta(hours=4000)}
    files = glob.glob(f"{tmp_path}/z/*.parquet")
    assert 12 <= len(files) <= 16
    for f in files:
        group = pq.ParquetFile(f).metadata.row_group(0)
        for k in range(group.num_columns):
            column = group.column(k)
            if column.path_in_schema in want and column.statistics.has_min_max:
                lo, hi = column.statistics.min, column.statistics.max
                hits[column.path_in_schema] += lo <= want[column.path_in_schema] <= hi
    assert 0 < hits["c"] <= len(files) // 2 and 0 < hits["t"] <= len(files) // 2
    assert sinks.write_clustered(df.limit(0), str(tmp_path / "none"), ["c", "t"]).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_similar_names_against_all_pairs(spark, distance):
    from quarry.operators import screening
    rng = random.Random(distance)

    def edit(s):
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(s) + 1)
            s = rng.choice([s[:k] + rng.choice("abé ") + s[k:], s[:k] + s[k + 1:], s[:k] + "b" + s[k + 1:]])
        return s
    base = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 14))) for _ in range(60)]
    left, right = base + [edit(s) for s in base] + [None, "", "aaaaaaa", "aaaaaaaa"], [edit(s) for s in base] + ["a", "", None]

    def far(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, line[0] = line[0], i
            for j, y in enumerate(b, 1):
                last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
        return line[-1]
    want = {(a, b, far(a, b)) for a in set(left) for b in set(right)
            if a is not None and b is not None and far(a, b) <= distance}
    one = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    got = screening.similar_names(one(left), one(right), distance)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_names_meet_by_what_they_share_not_by_frequent_grams(spark):
    """Numbered names share all their grams: the keys of a name must not grow common with the names."""
    from quarry.operators import screening
    held = {}
    for n in (1000, 8000):
        names = spark.range(n).selectExpr("concat('customer ', lpad(cast(id * 7 as string), 9, '0')) AS name")
        keys = screening._keys(names, 1).groupBy("key").count()
        held[n] = keys.selectExpr("sum(count * count)").first()[0] / n
    assert held[8000] < 2 * held[1000]
