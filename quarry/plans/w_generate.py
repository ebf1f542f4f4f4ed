"""Generator invariants (G01-G06), metered usage (J06) and the RAW →
CLEANSED → REPORT layers (R01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import generate as gen
from quarry.operators import intervals, layers
from quarry.plans.oracle_views import with_views
from quarry.plans.registry import query
from quarry.schemas import SCHEMAS
from quarry.session import scratch
from quarry.sources import sinks


def generated(cat):
    custs = gen.customers(cat.table("customer"))
    accts = gen.accounts(custs)
    return custs, accts


def bad_city(country, city):
    ok = None
    for c, (_, cities) in gen.COUNTRIES.items():
        cond = (country == c) & city.isin(*cities)
        ok = cond if ok is None else ok | cond
    return ~ok


@query("g01_customers", "SELECT count(*) AS customers, count(*) AS distinct_ids, "
                        "CAST(0 AS BIGINT) AS bad_city FROM customer")
def g01_customers(cat):
    c, _ = generated(cat)
    return c.agg(F.count(F.lit(1)).alias("customers"), F.count_distinct("customer_id").alias("distinct_ids"),
                 F.count(F.when(bad_city(F.col("country"), F.col("city")), 1)).alias("bad_city"))


@query("g02_accounts", "SELECT count(*) AS customers, 1 AS min_accounts, 3 AS max_accounts, "
                       "CAST(0 AS BIGINT) AS bad_limit FROM customer")
def g02_accounts(cat):
    _, a = generated(cat)
    per = a.groupBy("customer_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        F.count(F.when((F.col("account_type") != "credit card") & (F.col("credit_limit") != 0), 1)).alias("bad"))
    return per.agg(F.count(F.lit(1)).alias("customers"), F.min("n").alias("min_accounts"),
                   F.max("n").alias("max_accounts"), F.sum("bad").alias("bad_limit"))


@query("g03_transactions", "SELECT count(*) AS transactions, CAST(0 AS BIGINT) AS bad_country, "
                           "CAST(0 AS BIGINT) AS bad_currency, CAST(0 AS BIGINT) AS bad_city, "
                           "true AS flag_rate_ok FROM orders")
def g03_transactions(cat):
    c, a = generated(cat)
    t = gen.transactions(cat.table("orders"), c, a)
    j = t.join(c.select("customer_id", F.col("country").alias("home")), "customer_id")
    agg = j.agg(F.count(F.lit(1)).alias("transactions"),
                F.count(F.when(F.col("location_country") != F.col("home"), 1)).alias("bad_country"),
                F.count(F.when(F.col("currency") != gen.currency_of(F.col("home")), 1)).alias("bad_currency"),
                F.count(F.when(bad_city(F.col("location_country"), F.col("location_city")), 1)).alias("bad_city"),
                F.avg(F.col("is_flagged").cast("double")).alias("_rate"))
    return agg.select("transactions", "bad_country", "bad_currency", "bad_city",
                      F.col("_rate").between(0.03, 0.07).alias("flag_rate_ok"))


@query("g04_credit", "SELECT count(*) AS customers, CAST(0 AS BIGINT) AS used_over_limit, "
                     "CAST(0 AS BIGINT) AS score_out_of_range FROM customer")
def g04_credit(cat):
    c, _ = generated(cat)
    cr = gen.credit_data(c)
    return cr.agg(F.count(F.lit(1)).alias("customers"),
                  F.count(F.when(F.col("total_credit_used") > F.col("total_credit_limit"), 1)).alias("used_over_limit"),
                  F.count(F.when(~F.col("credit_score").between(300, 850), 1)).alias("score_out_of_range"))


@query("g05_watchlist", "SELECT count(*) AS entities, count(*) AS distinct_ids FROM supplier")
def g05_watchlist(cat):
    w = gen.watchlist(cat.table("supplier"))
    return w.agg(F.count(F.lit(1)).alias("entities"), F.count_distinct("entity_id").alias("distinct_ids"))


def content(df):
    """Rows, and the sum of their hashes over all columns (whatever their order)."""
    row = F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(20,0)")).alias("hash"))


@query("g06_csv", """
SELECT 'customers' AS table_name, count(*) AS rows_read FROM customer
UNION ALL SELECT 'credit_data', count(*) FROM customer
UNION ALL SELECT 'transactions', count(*) FROM orders
UNION ALL SELECT 'watchlist', count(*) FROM supplier""")
def g06_csv(cat):
    """Generated tables written as CSV with a header, read back typed. Every column
    read is compared with the one generated; accounts too, which have no row here."""
    c, a = generated(cat)
    tables = {"customers": c.drop("_src"), "accounts": a, "credit_data": gen.credit_data(c),
              "transactions": gen.transactions(cat.table("orders"), c, a).drop("account_id"),
              "watchlist": gen.watchlist(cat.table("supplier"))}
    root = scratch(cat.spark, "generated")
    out = None
    for name, df in tables.items():
        df = df.select([F.col(f.name).cast(f.dataType) for f in SCHEMAS[name]])
        path = sinks.unload_csv(df, f"{root}/{name}")
        back = cat.spark.read.options(header="true", quote='"', escape='"', multiLine="true").schema(SCHEMAS[name]).csv(path)
        if content(df).first() != content(back).first():
            raise ValueError(f"{name}: the rows read differ from the rows written")
        if name == "accounts":
            continue
        r = back.agg(F.count(F.lit(1)).alias("rows_read")).select(F.lit(name).alias("table_name"), "rows_read")
        out = r if out is None else out.unionByName(r)
    return out


# -- J06 ---------------------------------------------------------------------------
METERED_SQL = """
WITH usage AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS us, CAST(max(l_shipdate) AS DATE) AS ue
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate
  HAVING CAST(max(l_shipdate) AS DATE) > CAST(o_orderdate AS DATE)),
rates AS (
  SELECT CAST(q AS DATE) AS rs, CAST(q + INTERVAL 3 MONTH AS DATE) AS re,
         CASE WHEN quarter(q) IN (3, 4) THEN 8 ELSE 4 END AS rate
  FROM generate_series((SELECT date_trunc('quarter', min(o_orderdate)) FROM orders),
                       (SELECT max(l_shipdate) FROM lineitem), INTERVAL 3 MONTH) g(q))
SELECT o_custkey, CAST(sum(date_diff('day', greatest(us, rs), least(ue, re)) * rate) AS BIGINT) AS credits
FROM usage JOIN rates ON us < re AND rs < ue GROUP BY o_custkey"""


@query("j06_metered_usage", f"SELECT * FROM ({METERED_SQL})")
def j06_metered_usage(cat):
    """Credits per customer: each order runs from its order date to its
    last ship date; the rate per day changes every quarter (4, or 8 in the
    second half-year)."""
    o, li = cat.table("orders"), cat.table("lineitem")
    last = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last"))
    usage = (o.join(last, o.o_orderkey == last.l_orderkey)
             .select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("start"),
                     F.to_date("_last").alias("end"))
             .filter(F.col("end") > F.col("start")))
    lo = o.select(F.trunc(F.to_date(F.min("o_orderdate")), "quarter")).scalar()
    hi = li.select(F.to_date(F.max("l_shipdate"))).scalar()
    rates = (cat.spark.range(1)
             .select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 3 MONTH"))).alias("rate_start"))
             .select("rate_start", F.add_months("rate_start", 3).alias("rate_end"),
                     F.when(F.quarter("rate_start").isin(3, 4), 8).otherwise(4).alias("rate")))
    per_order = intervals.metered(usage, rates)
    return per_order.groupBy("o_custkey").agg(F.sum("credits").cast("long").alias("credits"))


# -- R01 ---------------------------------------------------------------------------
def raw_transactions(cat):
    """Strings, padded, some keys in two versions, every 97th newest amount unparsable."""
    t = cat.b_transactions
    k = F.col("transaction_id").cast("long")
    raw_cols = [F.col(c).cast("string").alias(c) for c in t.columns if c not in ("amount", "channel")]
    newest = t.select(*raw_cols,
                      F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string")).alias("amount"),
                      F.concat(F.lit("  "), F.upper("channel"), F.lit(" ")).alias("channel"),
                      F.lit(2).alias("_ingest_seq"))
    older = t.filter(k % 7 == 0).select(*raw_cols, (F.col("amount") - 1).cast("string").alias("amount"),
                                        F.col("channel"), F.lit(1).alias("_ingest_seq"))
    return newest.unionByName(older)


def channel_report(cleansed):
    c = cleansed.withColumn("channel", F.lower("channel"))
    return c.groupBy("location_country", "channel").agg(
        F.count(F.lit(1)).alias("transactions"),
        (F.floor(F.sum("amount") * 100 + F.lit(0.5)) / 100).alias("total_amount"))


def written_layers(cat) -> layers.Warehouse:
    return layers.write_layers(raw_transactions(cat), SCHEMAS["transactions"], "transaction_id", "_ingest_seq",
                               scratch(cat.spark, "layers"), {"by_channel": channel_report})


CLEANSED_SQL = """
SELECT transaction_id, location_country, channel, amount FROM (
  SELECT transaction_id, location_country, upper(channel) AS channel, amount FROM b_transactions
  WHERE CAST(transaction_id AS BIGINT) % 97 != 0
  UNION ALL
  SELECT transaction_id, location_country, channel, amount - 1 FROM b_transactions
  WHERE CAST(transaction_id AS BIGINT) % 97 = 0 AND CAST(transaction_id AS BIGINT) % 7 = 0)"""


@query("r01_layers", with_views(f"""
SELECT location_country, lower(channel) AS channel, count(*) AS transactions,
       floor(sum(amount) * 100 + 0.5) / 100 AS total_amount
FROM ({CLEANSED_SQL}) GROUP BY ALL""", "b_transactions"))
def r01_layers(cat):
    """RAW, CLEANSED and REPORT as written tables; the report is returned."""
    return cat.spark.read.parquet(written_layers(cat).report("by_channel"))


@query("r01_cleansed", with_views(CLEANSED_SQL, "b_transactions"))
def r01_cleansed(cat):
    """The CLEANSED table: typed, trimmed, the latest good version per key."""
    return cat.spark.read.parquet(written_layers(cat).cleansed).select(
        "transaction_id", "location_country", "channel", "amount")


@query("r01_rejects", with_views("""
SELECT transaction_id, 'n/a' AS amount, '  ' || upper(channel) || ' ' AS channel, 'amount' AS rejected_columns
FROM b_transactions WHERE CAST(transaction_id AS BIGINT) % 97 = 0""", "b_transactions"))
def r01_rejects(cat):
    """The reject table: raw values and the columns that did not cast."""
    r = cat.spark.read.parquet(written_layers(cat).rejects)
    return r.select("transaction_id", "amount", "channel", F.concat_ws(",", layers.REASON).alias(layers.REASON))
