"""Stream-level properties: each file once, replays are no-ops."""

from pyspark.sql import functions as F

from quarry.plans import w_streaming
from quarry.streaming import ingest


def test_versioned_table_replay_is_noop(spark, cat):
    root = __import__("tempfile").mkdtemp(dir="/tmp")
    t = ingest.VersionedTable(spark, f"{root}/t")
    df = cat.b_transactions.select("transaction_id", "amount")
    assert t.commit(df, 0)
    assert not t.commit(df.limit(1), 0)           # same batch id again: ignored
    assert t.read().count() == df.count()
    assert t.commit(df.limit(5), 1) and t.read().count() == 5


def test_refresh_loads_each_file_once(cat):
    pipe = w_streaming.CsvPipe(cat)
    t = cat.b_transactions
    w_streaming.land_csv(t, pipe.landing)
    pipe.refresh()
    pipe.refresh()                                 # nothing new
    got = pipe.table()
    assert got.count() == t.count()
    assert got.select(F.max("run_id")).first()[0] == 1


def test_person_flow_second_wave_updates(cat):
    flow = w_streaming.PersonFlow(cat)
    flow.land(1)
    flow.refresh()
    first = flow.master.read().count()
    flow.land(2)
    flow.refresh()
    m = flow.master.read()
    assert m.count() == first                      # updates, no duplicates
    moved = m.filter(F.col("location").endswith("(moved)")).count()
    assert moved == cat.persons.filter(F.col("c_custkey") % 3 == 0).count()


def test_replayed_batch_adds_no_rows(cat):
    pipe = w_streaming.CsvPipe(cat)
    pipe.run_id = 1
    rows = cat.b_transactions.withColumns({w_streaming.CORRUPT: F.lit(None).cast("string"), "_file": F.lit("f")})
    pipe._batch(rows, 0)
    pipe._batch(rows, 0)                           # written, but the offset was not committed
    assert pipe.table().count() == cat.b_transactions.count()


def test_marts_follow_a_crash_after_the_master(spark, cat):
    flow = w_streaming.PersonFlow(cat)
    flow.land(1)
    docs = spark.read.option("singleVariantColumn", "person").option("recursiveFileLookup", "true") \
        .json(flow.landing).withColumns({"_file": F.lit("f"), "_file_time": F.lit(1), "_file_start": F.lit(0)})
    whole = flow.loc_mart.commit

    def crash(*_):
        raise RuntimeError("lost")
    flow.loc_mart.commit = crash
    try:
        flow._batch(docs, 0)
    except RuntimeError:
        pass
    flow.loc_mart.commit = whole
    assert flow.loc_mart.state()[1] is None
    flow._batch(docs, 0)
    assert flow.loc_mart.read().count() == flow.master.read().count() == cat.persons.count()


def test_broken_changes_are_rejected_not_merged(spark, cat):
    flow = w_streaming.banking_flow(cat, "customers")
    updates = cat.b_customers.filter("CAST(customer_id AS BIGINT) % 10 = 1").count()
    assert ingest.appended(spark, flow.rejects).count() == updates
    assert flow.target.read().filter("customer_id LIKE 'bad%'").count() == 0


def test_run_history_keeps_every_batch(spark, cat):
    """More batches than a query's progress buffer holds."""
    pipe = w_streaming.CsvPipe(cat)
    w_streaming.land_csv(cat.b_transactions.limit(6).repartition(6), pipe.landing)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        pipe.run_id = 1
        s = ingest.file_stream(spark, pipe.landing, "csv", pipe.schema, {
            **w_streaming.LANDING.reader_options(), "columnNameOfCorruptRecord": w_streaming.CORRUPT,
            "maxFilesPerTrigger": "1"})
        q = ingest.run(s, pipe._batch, pipe.checkpoint)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    log = ingest.run_log(spark, pipe.log).collect()
    assert len(q.recentProgress) <= 2 < len(log)
    assert sorted(r.batch_id for r in log) == list(range(len(log)))
    assert sum(r.num_input_rows for r in log) == 6 and {r.run_id for r in log} == {1}
    ingest.log_batch(cat.b_transactions.limit(1), pipe.log, 0, 1)  # a replay replaces its row
    assert ingest.run_log(spark, pipe.log).count() == len(log)


def test_run_history_has_both_runs(cat):
    rows = w_streaming.t04_run_history(cat)
    assert rows.columns == ["run_id", "batch_id", "num_input_rows", "started"]
    got = rows.collect()
    assert {r.run_id for r in got} == {1, 2}
    assert sum(r.num_input_rows for r in got) == cat.b_transactions.count()


def folders(table):
    import glob
    return {f.split("/data/")[1] for f in glob.glob(f"{table.path}/data/*/bucket=*")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    from quarry.operators import cdc
    from quarry.streaming.buckets import BucketedTable
    t = BucketedTable(spark, str(tmp_path / "t"), "id", "id string, v int", buckets=8)
    assert t.read().count() == 0
    rows = [(f"k{i}", i) for i in range(200)]
    merge = lambda old, new: cdc.upsert(old, new, "id").table
    assert t.commit(spark.createDataFrame(rows, "id string, v int"), 0, merge)
    first, (live, _) = folders(t), t.state()
    assert len(live) == 8 and set(live.values()) == {0}
    one = spark.createDataFrame([("k7", -7), ("new", 1)], "id string, v int")
    touched = {r[0] for r in one.select(t.bucket()).collect()}
    assert t.commit(one, 1, merge)
    assert not t.commit(one, 1, merge)                 # a replay
    live, last = t.state()
    assert last == 1 and {b for b, v in live.items() if v == 1} == touched and len(live) == 8
    assert folders(t) - first == {f"version=000000002/bucket={b}" for b in touched}
    assert {tuple(r) for r in t.read().collect()} == {*rows, ("new", 1), ("k7", -7)} - {("k7", 7)}
    # the merge of two keys reads the files of their buckets only
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in t.read(touched).inputFiles()} == touched


def test_a_bucket_may_run_empty_and_a_crash_is_repaired(spark, tmp_path):
    from quarry.streaming.buckets import BucketedTable
    t = BucketedTable(spark, str(tmp_path / "t"), "id", "id string, v int", buckets=2)
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "id string, v int")
    t.commit(df, -1)
    gone = lambda old, new: old.join(new.select("id"), "id", "left_anti")
    assert t.commit(df.filter("id IS NOT NULL"), 0, gone)
    assert [tuple(r) for r in t.read().collect()] == [(None, 4)]
    # files of a batch whose manifest was never written are not seen, and written over
    df.limit(1).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(t._folder(1))
    assert t.read().count() == 1
    assert t.commit(df.limit(0), 1, gone) and t.read().count() == 1 and t.state()[1] == 1


def test_changes_out_of_order_across_batches(spark, tmp_path):
    from quarry.operators import cdc
    from quarry.streaming.buckets import BucketedTable
    t = BucketedTable(spark, str(tmp_path / "t"), "k", "k string, v int, _seq long, _deleted boolean", buckets=4)
    t.commit(cdc.with_order(spark.createDataFrame([("a", 0), ("b", 0), ("c", 0), (None, 0)], "k string, v int")), -1)
    batches = [[("a", 10, "UPDATE", 10), ("b", 0, "DELETE", 10), ("n", 1, "INSERT", 10)],
               [("a", 5, "UPDATE", 5), ("b", 5, "UPDATE", 5), ("n", 2, "UPDATE", 9), (None, 7, "UPDATE", 3)],
               [("b", 12, "INSERT", 12), ("a", 10, "UPDATE", 10), ("c", 4, "INSERT", 4), ("c", 3, "UPDATE", 3)],
               [("b", 11, "DELETE", 11), ("c", 2, "UPDATE", 2)]]
    late = []
    for i, rows in enumerate(batches):
        ch = spark.createDataFrame(rows, "k string, v int, _action string, _seq long")
        late.append(cdc.apply_ordered(t.read(), ch, "k").counts.first().rows_late)
        t.commit(ch, i, lambda old, new: cdc.apply_ordered(old, new, "k").table)
    got = {(r.k, r.v) for r in cdc.live_rows(t.read()).collect()}
    # c: the last change of its batch is an INSERT of a key that exists; the late UPDATE 2 is the first that counts
    assert got == {("a", 10), ("b", 12), ("n", 1), (None, 7), ("c", 2)}
    assert late == [0, 3, 1, 1]


def test_split_into_batches_does_not_matter_when_in_order(spark):
    """Deletes that come twice and re-inserted keys: one batch or one a change."""
    from quarry.operators import cdc
    rows = [("a", 1, "UPDATE", 1), ("a", 1, "DELETE", 2), ("a", 1, "DELETE", 3), ("b", 1, "DELETE", 1),
            ("b", 5, "INSERT", 4), ("b", 6, "UPDATE", 6)]
    start = cdc.with_order(spark.createDataFrame([("a", 0), ("b", 0)], "k string, v int"))
    shape = "k string, v int, _action string, _seq long"
    whole = cdc.apply_ordered(start, spark.createDataFrame(rows, shape), "k").table
    step = start
    for r in sorted(rows, key=lambda r: r[3]):
        step = cdc.apply_ordered(step, spark.createDataFrame([r], shape), "k").table
    assert {tuple(r) for r in cdc.live_rows(whole).collect()} == {tuple(r) for r in cdc.live_rows(step).collect()} == {("b", 6)}


def test_a_backlog_with_a_person_twice(spark, cat, tmp_path):
    flow = w_streaming.PersonFlow(cat)
    docs = [('[{"id": "1", "name": "a", "age": 3}, {"id": "1", "name": "b", "age": 4}]', "f1", 1),
            ('[{"id": "1", "name": "c", "age": 5}]', "f0", 2), ('[{"id": "2", "name": "d", "age": 6}]', "f1", 1)]
    df = spark.createDataFrame(docs, "j string, _file string, _file_time int").select(
        F.parse_json("j").alias("person"), "_file", "_file_time", F.lit(0).alias("_file_start"))
    flow._batch(df, 0)
    assert {(r.id, r.name, r.age) for r in flow.master.read().collect()} == {("1", "c", 5), ("2", "d", 6)}
    assert {(r.id, r.name) for r in flow.age_mart.read().collect()} == {("1", "c"), ("2", "d")}
