"""Change capture, MERGE, history and summaries.

Change feeds are derived from the banking views: the last digit ``r`` of a
row's integer key decides what happens to it in the batch —

    0 DELETE   1 UPDATE   2 INSERT of a new key   3 DELETE of an unknown key
    4 INSERT of an existing key   5 DELETE+INSERT pair (an update as a
    stream shows it)   6-9 untouched

so every branch of the banking MERGE is exercised on every table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators import cdc, history, summary
from quarry.plans.oracle_views import with_views
from quarry.plans.registry import query
from quarry.schemas import DDL
from quarry.session import scratch
from quarry.sources import sinks


def cols_of(table: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in DDL[table].split(",")]


@dataclass(frozen=True)
class Feed:
    """How a change batch is derived for one table. Spark-side key integers
    use try_cast: Catalyst infers the target's key filter onto the change
    side of the semi-join, where the unknown 'X…' keys live."""
    table: str          # schema name
    view: str           # fixture view
    key: str
    k_spark: str        # integer of the key (Spark SQL expression)
    k_sql: str          # same in DuckDB
    column: str         # the column an update changes
    new_spark: str      # its new value (Spark SQL)
    new_sql: str        # its new value (DuckDB)
    bump_spark: str     # value for the INSERT half of a DELETE+INSERT pair
    bump_sql: str


FEEDS = {
    "transactions": Feed("transactions", "b_transactions", "transaction_id",
                         "try_cast(transaction_id AS BIGINT)", "CAST(transaction_id AS BIGINT)",
                         "amount", "amount * 2", "amount * 2", "amount + 5", "amount + 5"),
    "customers": Feed("customers", "b_customers", "customer_id",
                      "try_cast(customer_id AS BIGINT)", "CAST(customer_id AS BIGINT)",
                      "city", "concat(city, ' (moved)')", "city || ' (moved)'",
                      "concat(city, ' (back)')", "city || ' (back)'"),
    "accounts": Feed("accounts", "b_accounts", "account_id",
                     "try_cast(split_part(account_id, '-', 1) AS BIGINT) * 3 + try_cast(split_part(account_id, '-', 2) AS BIGINT)",
                     "CAST(split_part(account_id, '-', 1) AS BIGINT) * 3 + CAST(split_part(account_id, '-', 2) AS BIGINT)",
                     "current_balance", "current_balance + 100", "current_balance + 100",
                     "current_balance + 5", "current_balance + 5"),
    "credit_data": Feed("credit_data", "b_credit", "customer_id",
                        "try_cast(customer_id AS BIGINT)", "CAST(customer_id AS BIGINT)",
                        "credit_score", "credit_score + 1", "credit_score + 1",
                        "credit_score + 2", "credit_score + 2"),
    "watchlist": Feed("watchlist", "b_watchlist", "entity_id",
                      "try_cast(substr(entity_id, 2) AS BIGINT)", "CAST(substr(entity_id, 2) AS BIGINT)",
                      "risk_category", "'High'", "'High'", "'Medium'", "'Medium'"),
}


def view_of(cat, f: Feed) -> DataFrame:
    return getattr(cat, f.view)


def old_snapshot(cat, f: Feed) -> DataFrame:
    """The target before the batch: every row except the new keys (r = 2)."""
    return view_of(cat, f).filter(F.expr(f"{f.k_spark} % 10 != 2"))


def change_feed(cat, f: Feed) -> DataFrame:
    """The batch, one pass over the view; r = 5 rows explode into a pair."""
    df = view_of(cat, f)
    cols = cols_of(f.table)
    k = F.expr(f.k_spark)
    r = k % 10
    key = F.col(f.key)

    def change(action: str, key_c: Column, col_val: Column, seq: Column) -> Column:
        vals = [key_c.alias(f.key)] + [
            (col_val if c == f.column else F.col(c)).alias(c) for c in cols if c != f.key]
        return F.struct(*vals, F.lit(action).alias(cdc.ACTION), seq.alias(cdc.SEQ))

    same, new, bump = F.col(f.column), F.expr(f.new_spark), F.expr(f.bump_spark)
    seq = k * 2
    arr = (F.when(r == 0, F.array(change("DELETE", key, same, seq)))
           .when(r == 1, F.array(change("UPDATE", key, new, seq)))
           .when(r == 2, F.array(change("INSERT", key, same, seq)))
           .when(r == 3, F.array(change("DELETE", F.concat(F.lit("X"), key), same, seq)))
           .when(r == 4, F.array(change("INSERT", key, new, seq)))
           .when(r == 5, F.array(change("DELETE", key, same, seq), change("INSERT", key, bump, seq + 1))))
    return df.filter(r <= 5).select(F.explode(arr).alias("c")).select("c.*")


def merged_sql(f: Feed) -> str:
    """The expected table after the literal MERGE, as plain SQL."""
    cols = cols_of(f.table)
    others = ", ".join(c for c in cols if c != f.key)

    def sel(key_sql: str, replace: str | None = None) -> str:
        parts = [f"{key_sql} AS {f.key}"] + [
            (f"{replace} AS {c}" if (replace and c == f.column) else c) for c in cols if c != f.key]
        return ", ".join(parts)

    r = f"({f.k_sql}) % 10"
    assert others
    return (f"SELECT {sel(f.key)} FROM {f.view} WHERE {r} IN (3, 4, 6, 7, 8, 9) "
            f"UNION ALL SELECT {sel(f.key, f.new_sql)} FROM {f.view} WHERE {r} = 1 "
            f"UNION ALL SELECT {sel(f.key, f.bump_sql)} FROM {f.view} WHERE {r} = 5 "
            f"UNION ALL SELECT {sel(f.key)} FROM {f.view} WHERE {r} = 2 "
            f"UNION ALL SELECT {sel(repr_x(f.key))} FROM {f.view} WHERE {r} = 3")


def repr_x(key: str) -> str:
    return f"'X' || {key}"


TEMPORAL = {"transactions": {"ts": ("transaction_date",)},
            "customers": {"dates": ("date_of_birth", "customer_since")},
            "accounts": {"dates": ("open_date",)},
            "credit_data": {},
            "watchlist": {"dates": ("listed_date",)}}

CDC_NAMES = {"transactions": "m05_cdc_transactions", "customers": "m05_cdc_customers",
             "accounts": "m05_cdc_accounts", "credit_data": "m05_cdc_credit",
             "watchlist": "m05_cdc_watchlist"}


def apply_feed(cat, f: Feed) -> cdc.MergeResult:
    return cdc.apply_changes(old_snapshot(cat, f), change_feed(cat, f), f.key)


def _register_cdc(table: str) -> None:
    f = FEEDS[table]

    def run(cat):
        return apply_feed(cat, f).table

    run.__doc__ = f"CDC MERGE of the {table} change batch into its target (M05)."
    query(CDC_NAMES[table], with_views(merged_sql(f), f.view, **TEMPORAL[table]))(run)


for _t in FEEDS:
    _register_cdc(_t)


@query("u03_procedure", with_views(
    "SELECT count_if(r IN (2, 3)) AS rows_inserted, count_if(r IN (1, 5)) AS rows_updated, "
    "count_if(r = 0) AS rows_deleted FROM (SELECT CAST(transaction_id AS BIGINT) % 10 AS r FROM b_transactions)",
    "b_transactions"))
def u03_procedure(cat):
    """The merge procedure's outcome: inserted/updated/deleted row counts."""
    return apply_feed(cat, FEEDS["transactions"]).counts


@query("m03_change_meta", with_views(
    "SELECT transaction_id, _action, md5(transaction_id) AS _row_id FROM ("
    " SELECT CASE WHEN r = 3 THEN 'X' || transaction_id ELSE transaction_id END AS transaction_id,"
    "  CASE WHEN r IN (0, 3) THEN 'DELETE' WHEN r = 1 THEN 'UPDATE' ELSE 'INSERT' END AS _action"
    " FROM (SELECT transaction_id, CAST(transaction_id AS BIGINT) % 10 AS r FROM b_transactions) WHERE r <= 5"
    " UNION ALL SELECT transaction_id, 'DELETE' FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 10 = 5)",
    "b_transactions"))
def m03_change_meta(cat):
    """The change batch with METADATA$ACTION and METADATA$ROW_ID."""
    ch = change_feed(cat, FEEDS["transactions"])
    return ch.select("transaction_id", cdc.ACTION, cdc.row_id(F.col("transaction_id")).alias(cdc.ROW_ID))


def new_snapshot(cat) -> DataFrame:
    t = cat.b_transactions
    r = F.col("transaction_id").cast("long") % 10
    return t.filter(r != 0).withColumn("amount", F.when(r == 1, F.col("amount") * 2).otherwise(F.col("amount")))


@query("m01_changes", with_views(
    "SELECT *, md5(transaction_id) AS _row_id FROM ("
    " SELECT *, 'DELETE' AS _action FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 10 = 0"
    " UNION ALL SELECT * REPLACE (amount * 2 AS amount), 'UPDATE' FROM b_transactions"
    "  WHERE CAST(transaction_id AS BIGINT) % 10 = 1"
    " UNION ALL SELECT *, 'INSERT' FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 10 = 2)",
    "b_transactions", ts=("transaction_date",)))
def m01_changes(cat):
    """Change stream between two snapshots of the transactions table."""
    return cdc.changes(old_snapshot(cat, FEEDS["transactions"]), new_snapshot(cat), "transaction_id")


@query("m04_upsert", with_views(
    "SELECT * FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 10 NOT IN (1, 2) "
    "UNION ALL SELECT * REPLACE (amount * 2 AS amount) FROM b_transactions "
    "WHERE CAST(transaction_id AS BIGINT) % 10 = 1 "
    "UNION ALL SELECT * FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 10 = 2",
    "b_transactions", ts=("transaction_date",)))
def m04_upsert(cat):
    """MERGE upsert: matched rows take every source column, new keys insert."""
    t = cat.b_transactions
    r = F.col("transaction_id").cast("long") % 10
    source = t.filter(r.isin(1, 2)).withColumn(
        "amount", F.when(r == 1, F.col("amount") * 2).otherwise(F.col("amount")))
    return cdc.upsert(old_snapshot(cat, FEEDS["transactions"]), source, "transaction_id").table


@query("m09_summary", with_views(
    "SELECT location_country, channel, count(*) AS row_count, "
    "CAST(sum(CAST(amount AS DECIMAL(22,2))) AS DOUBLE) AS total FROM ("
    " SELECT * FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 10 NOT IN (0, 1)"
    " UNION ALL SELECT * REPLACE (amount * 2 AS amount) FROM b_transactions"
    "  WHERE CAST(transaction_id AS BIGINT) % 10 = 1) GROUP BY ALL", "b_transactions"))
def m09_summary(cat):
    """Summary per (country, channel) refreshed from the change stream by
    signed deltas; equals a recompute over the new snapshot."""
    old = old_snapshot(cat, FEEDS["transactions"])
    groups = ["location_country", "channel"]
    base = summary.build_summary(old, groups, "amount")
    ch = cdc.changes(old, new_snapshot(cat), "transaction_id", with_before=True)
    s = summary.refresh_summary(base, ch, groups, "amount")
    return s.withColumn("total", F.col("total").cast("double"))


def emptied_groups(df: DataFrame) -> DataFrame:
    """Transactions whose channel is NULL for every seventh row."""
    return df.withColumn("channel", F.when(F.expr("CAST(transaction_id AS BIGINT) % 7 = 0"), None).otherwise(F.col("channel")))


def without_extremes(cat) -> DataFrame:
    """The new snapshot less the largest and smallest amounts of every group."""
    return emptied_groups(new_snapshot(cat)).filter("amount BETWEEN 500 AND 9000")


@query("m09_extremes", with_views(
    "SELECT location_country, channel, count(*) AS row_count, CAST(sum(CAST(amount AS DECIMAL(22,2))) AS DOUBLE) AS total, "
    "min(amount) AS lowest, max(amount) AS highest, "
    "floor(CAST(sum(CAST(amount AS DECIMAL(22,2))) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS average FROM ("
    " SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN NULL ELSE channel END AS channel,"
    "  CASE WHEN CAST(transaction_id AS BIGINT) % 10 = 1 THEN amount * 2 ELSE amount END AS amount) FROM b_transactions"
    " WHERE CAST(transaction_id AS BIGINT) % 10 != 0) WHERE amount BETWEEN 500 AND 9000 GROUP BY ALL", "b_transactions"))
def m09_extremes(cat):
    """Summary with MIN, MAX and AVG after a batch that deletes the extremes of
    every group, the NULL group included; equals a recompute."""
    groups = ["location_country", "channel"]
    old = emptied_groups(old_snapshot(cat, FEEDS["transactions"]))
    values = summary.build_values(old, groups, "amount")
    ch = cdc.changes(old, without_extremes(cat), "transaction_id", with_before=True)
    out, _ = summary.refresh_extremes(summary.summarise(values, groups), values, ch, groups, "amount")
    return out.withColumns({"total": F.col("total").cast("double"),
                            "average": F.floor(F.col("average") * 10000 + 0.5) / 10000})


@query("m10_clustered", with_views("SELECT * FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def m10_clustered(cat):
    """Cluster-key layout by (country, date): range-partitioned, sorted files."""
    path = f"{scratch(cat.spark, 'clustered')}/transactions"
    return sinks.write_clustered(cat.b_transactions, path, ["location_country", "transaction_date"])


# -- history over the events change log ------------------------------------------
BOUNDARY_SQL = "(SELECT ts FROM events WHERE event_id = (SELECT max(event_id) // 2 FROM events))"
STATE_COLS = "key, ts, seq, event_type, value, batch_id"


def boundary(cat) -> Column:
    """The event time of the middle event: an actual change time, so AT and
    BEFORE differ exactly by the changes stamped at it."""
    e = cat.table("events")
    mid = e.select(F.floor(F.max("event_id") / 2)).scalar()
    return e.filter(F.col("event_id") == mid).select("ts").scalar()


def boundary_value(cat):
    """``boundary`` as a value, which picks the files to read."""
    return cat.spark.range(1).select(boundary(cat)).first()[0]


def state_sql(cond: str) -> str:
    return (f"SELECT {STATE_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) AS rn "
            f"FROM change_log WHERE {cond}) WHERE rn = 1 AND action != 'DELETE'")


@query("m07_at", with_views(state_sql(f"ts <= {BOUNDARY_SQL}"), "change_log", ts=("ts",)))
def m07_at(cat):
    return history.state_at(cat.change_log, boundary(cat))


@query("m07_before", with_views(state_sql(f"ts < {BOUNDARY_SQL}"), "change_log", ts=("ts",)))
def m07_before(cat):
    return history.state_before(cat.change_log, boundary(cat))


@query("m07_before_batch", with_views(state_sql("batch_id < 15"), "change_log", ts=("ts",)))
def m07_before_batch(cat):
    return history.state_before_batch(cat.change_log, 15)


def snapshot_log(cat) -> history.SnapshotLog:
    """The change log with base snapshots at eight times, evenly spaced over its batches."""
    log = history.SnapshotLog(cat.spark, f"{scratch(cat.spark, 'snapshot-log')}/log")
    spans = cat.change_log.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    log.write(cat.change_log, [spans.a + (spans.b - spans.a) * i / 8 for i in range(1, 8)])
    return log


@query("m07_snapshot_at", with_views(state_sql(f"ts <= {BOUNDARY_SQL}"), "change_log", ts=("ts",)))
def m07_snapshot_at(cat):
    """AT a time from the nearest base snapshot and the changes after it."""
    return snapshot_log(cat).state_at(boundary_value(cat))


@query("m07_snapshot_before", with_views(state_sql(f"ts < {BOUNDARY_SQL}"), "change_log", ts=("ts",)))
def m07_snapshot_before(cat):
    """BEFORE a time from the nearest base snapshot."""
    return snapshot_log(cat).state_at(boundary_value(cat), inclusive=False)


@query("m08_retention", with_views(
    f"SELECT key, ts, seq, action, event_type, value, batch_id FROM ("
    f" SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) AS rn"
    f" FROM change_log WHERE ts <= {BOUNDARY_SQL}) WHERE rn = 1 AND action != 'DELETE' "
    f"UNION ALL SELECT key, ts, seq, action, event_type, value, batch_id FROM change_log WHERE ts > {BOUNDARY_SQL}",
    "change_log", ts=("ts",)))
def m08_retention(cat):
    """History compacted at the horizon: one base row per live key, then
    every later change."""
    return history.prune_history(cat.change_log, boundary(cat))


@query("m07_at_equals_pruned", with_views(state_sql("true"), "change_log", ts=("ts",)))
def m07_at_equals_pruned(cat):
    """The current state read from the pruned history (retention keeps it)."""
    pruned = history.prune_history(cat.change_log, boundary(cat))
    return history.state_where(pruned, F.lit(True))

