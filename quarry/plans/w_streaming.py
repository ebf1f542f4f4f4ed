"""Streaming workload (T01-T06, M02, M06, S19, S20): files arrive in two
waves into a landing folder; pipes/tasks are file streams run with
availableNow (refresh) or a processing-time trigger (scheduled task).

Waves are derived from the tables: a row's key parity decides whether it
lands in the first or the second wave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from quarry.functions import nested
from quarry.operators import cdc
from quarry.plans import w_history, w_person
from quarry.plans.oracle_views import with_views
from quarry.plans.registry import query
from quarry.schemas import SCHEMAS
from quarry.session import scratch
from quarry.sources import scan, sinks
from quarry.sources.scan import CsvFormat
from quarry.streaming import ingest
from quarry.streaming.buckets import BucketedTable
from quarry.streaming.pipes import JsonPipe

LANDING = CsvFormat(enclosure='"', skip_header=1)
CORRUPT = "_corrupt_record"


def wave_of(key_col: str) -> F.Column:
    return (F.col(key_col).cast("long") % 2 + 1).cast("int")


def land_csv(df: DataFrame, landing: str) -> None:
    df.write.mode("append").options(**LANDING.writer_options(header=True)).csv(landing)


# -- T01/T02/M02: a CSV pipe into a raw table ------------------------------------
class CsvPipe:
    """COPY INTO raw.transactions FROM @stage ON_ERROR=CONTINUE, as a
    stream: good rows append, bad rows go to a reject table; every row
    records the run that loaded it."""

    def __init__(self, cat, table: str = "transactions"):
        self.spark = cat.spark
        root = scratch(cat.spark, f"pipe-{table}")
        self.landing, self.target = f"{root}/landing", f"{root}/raw"
        self.rejects, self.checkpoint = f"{root}/rejects", f"{root}/_checkpoint"
        self.log = f"{root}/run_log"
        self.schema = StructType(SCHEMAS[table].fields + [StructField(CORRUPT, StringType())])
        self.run_id = 0

    def _batch(self, df: DataFrame, batch_id: int) -> None:
        df = df.cache()
        good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file", "_file_time", "_file_start")
        ingest.append_batch(good.withColumn("run_id", F.lit(self.run_id)), self.target, batch_id)
        ingest.append_batch(df.filter(F.col(CORRUPT).isNotNull()), self.rejects, batch_id)
        ingest.log_batch(df, self.log, batch_id, self.run_id)
        df.unpersist()

    def refresh(self) -> None:
        """ALTER PIPE ... REFRESH: load every staged file not loaded yet."""
        self.run_id += 1
        s = ingest.file_stream(self.spark, self.landing, "csv", self.schema,
                               {**LANDING.reader_options(), "columnNameOfCorruptRecord": CORRUPT})
        ingest.run(s, self._batch, self.checkpoint)

    def table(self) -> DataFrame:
        return ingest.appended(self.spark, self.target)


@query("t01_ingest", with_views("SELECT * FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def t01_ingest(cat):
    """Auto-ingest: each wave is loaded once, on arrival."""
    pipe = CsvPipe(cat)
    t = cat.b_transactions.withColumn("_wave", wave_of("transaction_id"))
    for w in (1, 2):
        land_csv(t.filter(F.col("_wave") == w).drop("_wave"), pipe.landing)
        pipe.refresh()
    return pipe.table().drop("run_id")


@query("t02_backlog", with_views("SELECT transaction_id, 1 AS run_id FROM b_transactions", "b_transactions"))
def t02_backlog(cat):
    """Both waves staged before the first refresh: run 1 loads all of it,
    run 2 finds nothing new."""
    pipe = CsvPipe(cat)
    land_csv(cat.b_transactions, pipe.landing)
    pipe.refresh()
    pipe.refresh()
    return pipe.table().select("transaction_id", "run_id")


@query("m02_offset", with_views(
    "SELECT transaction_id, CAST(CAST(transaction_id AS BIGINT) % 2 + 1 AS INTEGER) AS run_id "
    "FROM b_transactions", "b_transactions"))
def m02_offset(cat):
    """A plain read of the stage consumes nothing; a refresh consumes what
    it loads, so run 2 sees only the second wave."""
    pipe = CsvPipe(cat)
    t = cat.b_transactions.withColumn("_wave", wave_of("transaction_id"))
    land_csv(t.filter(F.col("_wave") == 1).drop("_wave"), pipe.landing)
    # SELECT over the stage: reads the files, moves no offset
    cat.spark.read.options(**LANDING.reader_options()).csv(pipe.landing).limit(1).collect()
    pipe.refresh()
    land_csv(t.filter(F.col("_wave") == 2).drop("_wave"), pipe.landing)
    pipe.refresh()
    return pipe.table().select("transaction_id", "run_id")


@query("t04_run_history")
def t04_run_history(cat):
    """Run log of a pipe: micro-batches and input rows per refresh."""
    pipe = CsvPipe(cat)
    t = cat.b_transactions.withColumn("_wave", wave_of("transaction_id"))
    for w in (1, 2):
        land_csv(t.filter(F.col("_wave") == w).drop("_wave"), pipe.landing)
        pipe.refresh()
    return ingest.run_log(cat.spark, pipe.log)


@query("t01_ingest_json", with_views("SELECT username, is_live FROM c_list", "c_list"))
def t01_ingest_json(cat):
    """A JSON pipe (STRIP_OUTER_ARRAY) into list_table."""
    root = scratch(cat.spark, "pipe-list")
    scan.unload_json_arrays(cat.c_list, f"{root}/landing")
    s = ingest.file_stream(cat.spark, f"{root}/landing", "json", SCHEMAS["list_table"])

    def batch(df, batch_id):
        ingest.append_batch(df.drop("_file", "_file_time", "_file_start"), f"{root}/list_table", batch_id)

    ingest.run(s, batch, f"{root}/_checkpoint")
    return ingest.appended(cat.spark, f"{root}/list_table")


#: the staged documents spell this field in capitals
STATS_NAMES = {"fide": "FIDE"}
#: every 13th player is staged a second time with a number that is none
BAD_INFO = "primary_key % 13 = 0"


def json_pipe(cat, table: str, docs: DataFrame, names: dict[str, str] | None = None) -> JsonPipe:
    """Documents of ``docs`` landed in two waves, the pipe refreshed after each."""
    pipe = JsonPipe(cat.spark, scratch(cat.spark, f"pipe-{table}"), SCHEMAS[table], names)
    waved = docs.withColumn("_wave", wave_of("primary_key"))
    for w in (1, 2):
        scan.unload_json_arrays(waved.filter(F.col("_wave") == w).drop("_wave"), f"{pipe.landing}/wave{w}")
        pipe.refresh()
    return pipe


def info_pipe(cat) -> JsonPipe:
    info = cat.c_info.withColumns({"followers": F.col("followers").cast("string"),
                                   "joined": F.col("joined").cast("string")})
    bad = info.filter(BAD_INFO).withColumn("followers", F.lit("many"))
    return json_pipe(cat, "info_table", info.unionByName(bad))


@query("t01_info_json", with_views(
    "SELECT *, CAST(primary_key % 2 + 1 AS INTEGER) AS run_id FROM c_info", "c_info", dates=("joined",)))
def t01_info_json(cat):
    """The info pipe: numbers, dates and strings out of JSON elements, each
    wave loaded by the run after its arrival."""
    return info_pipe(cat).table()


@query("t01_info_rejects", with_views(
    f"SELECT primary_key, 'followers' AS rejected_fields FROM c_info WHERE {BAD_INFO}", "c_info"))
def t01_info_rejects(cat):
    """Elements the info pipe could not load, with the fields that did not cast."""
    bad = info_pipe(cat).rejected()
    return bad.select(F.get_json_object("record", "$.primary_key").cast("long").alias("primary_key"),
                      F.concat_ws(",", "rejected_fields").alias("rejected_fields"))


@query("t01_stats_json", with_views(
    "SELECT *, CAST(primary_key % 2 + 1 AS INTEGER) AS run_id FROM c_stats", "c_stats"))
def t01_stats_json(cat):
    """The stats pipe: fourteen numbers per player, FIDE staged in capitals."""
    return json_pipe(cat, "stats_table", cat.c_stats.withColumnRenamed("fide", "FIDE"), STATS_NAMES).table()


# -- T05/T03/M06: person documents -> shred -> upsert -> marts --------------------
def person_wave(cat, wave: int) -> DataFrame:
    """Wave 1: every person. Wave 2: every third person again, one year
    older and moved."""
    p = cat.persons
    if wave == 1:
        return p
    moved = p.filter(F.col("c_custkey") % 3 == 0)
    return moved.withColumn("age", F.col("age") + 1) \
        .withColumn("location", F.concat(F.col("location"), F.lit(" (moved)")))


class PersonFlow:
    """Pipe → PERSON_NESTED stream → task: FLATTEN, shred, MERGE into
    PERSON_MASTER, refresh PERSON_AGE / PERSON_LOCATION. All three rewrite the
    buckets of the batch's persons only; the marts keep the id beside their columns."""

    MASTER = ("id string, name string, age int, location string, zip string, filename string, "
              "file_row_number long, ingestedtimestamp timestamp_ntz")

    def __init__(self, cat):
        self.cat, self.spark = cat, cat.spark
        root = scratch(cat.spark, "person-flow")
        self.landing, self.checkpoint, self.log = f"{root}/landing", f"{root}/_checkpoint", f"{root}/log"
        self.run_id = 0
        self.master = BucketedTable(cat.spark, f"{root}/person_master", "id", self.MASTER)
        self.age_mart = BucketedTable(cat.spark, f"{root}/person_age", "id", "id string, name string, age int")
        self.loc_mart = BucketedTable(cat.spark, f"{root}/person_location", "id",
                                      "id string, name string, location string")

    def land(self, wave: int) -> None:
        w_person.stage_person_docs(self.cat, person_wave(self.cat, wave), self.landing, mode="append")

    def _batch(self, docs: DataFrame, batch_id: int) -> None:
        tagged = docs.withColumns({scan.FILE: F.col("_file"), scan.BLOCK: F.col("_file_start"),
                                   scan.ROW_ID: F.monotonically_increasing_id()})
        numbered = scan.number_rows(tagged).withColumn("_order", F.struct("_file_time", "_file", "file_row_number"))
        rows = nested.shred_persons(numbered.withColumnRenamed("_file", "filename"), "person") \
            .select("id", "name", "age", "location", "zip", "filename", "file_row_number", "_order", "pos") \
            .withColumn("ingestedtimestamp", F.localtimestamp())
        # a backlog may hold a person twice: the later file, then the later document, wins
        own = [f.name for f in self.master.schema]
        last = rows.groupBy(F.col("id")).agg(F.max_by(F.struct(*own), F.struct("_order", "pos")).alias("_p")) \
            .select("_p.*").persist()

        def upsert(old, new):
            return cdc.upsert(old, new, "id", check_duplicates=False).table

        # after a crash in between, the replay skips what was committed and does the rest
        self.master.commit(last, batch_id, upsert)
        self.age_mart.commit(last.select("id", "name", "age"), batch_id, upsert)
        self.loc_mart.commit(last.select("id", "name", "location"), batch_id, upsert)
        ingest.log_batch(last, self.log, batch_id, self.run_id)
        last.unpersist()

    def stream(self) -> DataFrame:
        return ingest.file_stream(self.spark, self.landing, "json", "person variant",
                                  {"singleVariantColumn": "person", "recursiveFileLookup": "true"})

    def refresh(self) -> None:
        """One tick of the task: a batch only if files arrived since the last."""
        self.run_id += 1
        ingest.run(self.stream(), self._batch, self.checkpoint)


PERSON_FINAL_SQL = ("SELECT id, name, CASE WHEN c_custkey % 3 = 0 THEN age + 1 ELSE age END AS age, "
                    "CASE WHEN c_custkey % 3 = 0 THEN location || ' (moved)' ELSE location END AS location, "
                    "CASE WHEN zip = '' OR zip IS NULL THEN '00000' ELSE zip END AS zip FROM persons")


#: the row in its file a person's last version came from: the second wave has files of its own
PERSON_PLACE_SQL = ("SELECT id, file_key AS filename, CAST(CASE WHEN c_custkey % 3 = 0 THEN moved ELSE filerownumber END "
                    "AS BIGINT) AS file_row_number FROM (SELECT *, dense_rank() OVER "
                    "(PARTITION BY c_custkey % 3 = 0, file_key ORDER BY doc_no) AS moved FROM person_docs)")


@query("t05_provenance", with_views(PERSON_PLACE_SQL, "person_docs"))
def t05_provenance(cat):
    """File and row in the file of every person in the master, after both waves."""
    flow = PersonFlow(cat)
    for w in (1, 2):
        flow.land(w)
        flow.refresh()
    return flow.master.read().select("id", w_person.file_key().alias("filename"), "file_row_number")


@query("t03_idle", with_views(
    "SELECT * FROM (SELECT 1 AS tick, 1 AS batches, count(*) AS persons FROM persons UNION ALL SELECT 2, 0, 0 "
    "UNION ALL SELECT 3, CAST(count(*) > 0 AS INT), count(*) FROM persons WHERE c_custkey % 3 = 0)", "persons"))
def t03_idle(cat):
    """Three ticks of the task, the second while its stream is empty: it runs no batch."""
    flow = PersonFlow(cat)
    flow.land(1)
    flow.refresh()
    flow.refresh()
    flow.land(2)
    flow.refresh()
    log = ingest.run_log(cat.spark, flow.log).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("num_input_rows").alias("rows"))
    ticks = cat.spark.range(1, flow.run_id + 1).select(F.col("id").cast("int").alias("tick"))
    return ticks.join(log, ticks.tick == log.run_id, "left").select(
        "tick", F.coalesce("n", F.lit(0)).cast("int").alias("batches"), F.coalesce("rows", F.lit(0)).alias("persons"))


@query("t05_person_flow", with_views(PERSON_FINAL_SQL, "persons"))
def t05_person_flow(cat):
    flow = PersonFlow(cat)
    for w in (1, 2):
        flow.land(w)
        flow.refresh()
    flow.refresh()                                     # nothing new: no batch, no change
    return flow.master.read().select("id", "name", "age", "location", "zip")


@query("m06_marts", with_views(
    f"SELECT 'location' AS mart, name, location AS value FROM ({PERSON_FINAL_SQL}) "
    f"UNION ALL SELECT 'age', name, CAST(age AS VARCHAR) FROM ({PERSON_FINAL_SQL})", "persons"))
def m06_marts(cat):
    """Both marts after two merges: recomputed, never appended twice."""
    flow = PersonFlow(cat)
    for w in (1, 2):
        flow.land(w)
        flow.refresh()
    loc = flow.loc_mart.read().select(F.lit("location").alias("mart"), "name", F.col("location").alias("value"))
    age = flow.age_mart.read().select(F.lit("age").alias("mart"), "name", F.col("age").cast("string").alias("value"))
    return loc.unionByName(age)


@query("t03_task", with_views(PERSON_FINAL_SQL, "persons"))
def t03_task(cat):
    """The same task on a schedule (processing-time trigger): it runs a
    batch only when files arrived since the last one."""
    flow = PersonFlow(cat)
    flow.land(1)
    q = ingest.run(flow.stream(), flow._batch, flow.checkpoint, trigger="2 seconds")
    try:
        q.processAllAvailable()
        flow.land(2)
        q.processAllAvailable()
    finally:
        q.stop()
    return flow.master.read().select("id", "name", "age", "location", "zip")


# -- T06: five banking change streams merged into CLEANSED tables ---------------------
class BankingFlow:
    """RAW change files of one table → stream → CDC MERGE into the CLEANSED
    table (source and target kept apart, D4). Rows that do not parse go to a
    reject table (ON_ERROR=CONTINUE)."""

    def __init__(self, cat, table: str):
        self.spark, self.key = cat.spark, w_history.FEEDS[table].key
        root = scratch(cat.spark, f"banking-{table}")
        self.landing, self.checkpoint, self.rejects = f"{root}/raw", f"{root}/_checkpoint", f"{root}/rejects"
        self.target = BucketedTable(cat.spark, f"{root}/cleansed", self.key, StructType(
            SCHEMAS[table].fields + [StructField(cdc.SEQ, LongType()), StructField(cdc.DELETED, BooleanType())]))
        self.schema = StructType(SCHEMAS[table].fields + [
            StructField(cdc.ACTION, StringType()), StructField(cdc.SEQ, LongType()),
            StructField(CORRUPT, StringType())])

    def _batch(self, df: DataFrame, batch_id: int) -> None:
        df = df.cache()
        ingest.append_batch(df.filter(F.col(CORRUPT).isNotNull()), self.rejects, batch_id)
        good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file", "_file_time", "_file_start")
        self.target.commit(good, batch_id, lambda old, new: cdc.apply_ordered(old, new, self.key).table)
        df.unpersist()

    def cleansed(self) -> DataFrame:
        return cdc.live_rows(self.target.read())

    def refresh(self) -> None:
        s = ingest.file_stream(self.spark, self.landing, "csv", self.schema,
                               {**LANDING.reader_options(), "columnNameOfCorruptRecord": CORRUPT})
        ingest.run(s, self._batch, self.checkpoint)


def banking_flow(cat, table: str) -> BankingFlow:
    """Two waves of changes, dealt by key; every update comes once more as an
    INSERT of a new key whose sequence number does not parse. A third wave is
    late: updates of lower sequence numbers for keys that were updated or deleted."""
    feed = w_history.FEEDS[table]
    flow = BankingFlow(cat, table)
    flow.target.commit(cdc.with_order(w_history.old_snapshot(cat, feed)), -1)
    good = w_history.change_feed(cat, feed)
    broken = good.filter(F.col(cdc.ACTION) == "UPDATE").withColumns({
        feed.key: F.concat(F.lit("bad"), feed.key), cdc.ACTION: F.lit("INSERT"), cdc.SEQ: F.lit("n/a")})
    both = good.withColumn(cdc.SEQ, F.col(cdc.SEQ).cast("string")).unionByName(broken)
    for wave in (0, 1):
        land_csv(both.filter(F.pmod(F.xxhash64(feed.key), F.lit(2)) == wave), flow.landing)
        flow.refresh()
    late = (good.filter(F.expr(f"{feed.k_spark} % 10 IN (0, 1, 5)"))
            .withColumns({cdc.ACTION: F.lit("UPDATE"), cdc.SEQ: (F.col(cdc.SEQ) - 2).cast("string"),
                          feed.column: F.lit(None).cast(good.schema[feed.column].dataType)}))
    land_csv(late, flow.landing)
    flow.refresh()
    return flow


T06_NAMES = {"transactions": "t06_banking_flow", "customers": "t06_banking_customers",
             "accounts": "t06_banking_accounts", "credit_data": "t06_banking_credit",
             "watchlist": "t06_banking_watchlist"}


def _register_flow(table: str) -> None:
    feed = w_history.FEEDS[table]

    def run(cat):
        return banking_flow(cat, table).cleansed()

    run.__doc__ = f"The CLEANSED {table} after two waves of its change stream (T06)."
    query(T06_NAMES[table], with_views(w_history.merged_sql(feed), feed.view, **w_history.TEMPORAL[table]))(run)


for _t in T06_NAMES:
    _register_flow(_t)


# -- S19/S20: queue envelopes and compressed payload files ------------------------------
TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

ENVELOPE = ("topic string, partition int, offset long, ts timestamp_ntz, value string")
EVENT_VALUE = "event_id long, user_id long, event_type string, value double"


@query("s19_envelopes", with_views(
    "SELECT event_id, user_id, event_type, value, CAST(user_id % 4 AS INTEGER) AS partition, ts FROM events",
    ts=("ts",)))
def s19_envelopes(cat):
    """Message-queue envelopes landed as JSON files, read as a stream and
    decoded from the envelope's value."""
    root = scratch(cat.spark, "envelopes")
    e = cat.table("events")
    env = e.select(F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
                   F.col("event_id").alias("offset"), "ts",
                   F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"))
    env.write.option("timestampNTZFormat", TS_MICROS).json(f"{root}/landing")

    def batch(df, batch_id):
        v = F.from_json("value", EVENT_VALUE)
        ingest.append_batch(df.select(v.alias("v"), "partition", "ts").select("v.*", "partition", "ts"),
                            f"{root}/events", batch_id)

    ingest.run(ingest.file_stream(cat.spark, f"{root}/landing", "json", ENVELOPE,
                                  {"timestampNTZFormat": TS_MICROS}), batch,
               f"{root}/_checkpoint")
    return ingest.appended(cat.spark, f"{root}/events")


@query("s20_decode", "SELECT event_id, user_id, event_type, value FROM events")
def s20_decode(cat):
    """Compressed payload files → decompress + decode → a new folder.

    Spark's text reader inflates the gzip files as it streams their lines,
    which ``from_json`` parses: no file is ever held whole."""
    root = scratch(cat.spark, "decode")
    e = cat.table("events")
    e.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value")) \
        .write.option("compression", "gzip").text(f"{root}/landing")

    lines = cat.spark.read.option("pathGlobFilter", "*.gz").text(f"{root}/landing")
    decoded = lines.select(F.from_json("value", EVENT_VALUE).alias("v")).select("v.*")
    sinks.unload_parquet(decoded, f"{root}/decoded")
    return cat.spark.read.parquet(f"{root}/decoded")
