"""Banking workload (W4): risk rules, location shift, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalars import round_half_up

from quarry.functions import scalars
from quarry.operators import relational as rel, screening
from quarry.plans.oracle_views import view, with_views
from quarry.plans.registry import query

RISK_SQL = ("CASE WHEN amount > 500 THEN 'High' WHEN amount BETWEEN 100 AND 200 THEN 'Medium' "
            "ELSE 'Low' END")


@query("u01_risk_level", with_views(
    f"SELECT transaction_id, amount, {RISK_SQL} AS risk_level FROM b_transactions", "b_transactions"))
def u01_risk_level(cat):
    return rel.with_risk_level(cat.b_transactions).select("transaction_id", "amount", "risk_level")


@query("u01_risk_level_sql_function", with_views(
    f"SELECT transaction_id, {RISK_SQL} AS risk_level FROM b_transactions", "b_transactions"))
def u01_risk_level_sql_function(cat):
    """The same rule registered as a SQL scalar function and called from SQL."""
    scalars.register_sql_functions(cat.spark)
    cat.b_transactions.createOrReplaceTempView("transactions")
    return cat.spark.sql("SELECT transaction_id, trans_func(amount) AS risk_level FROM transactions")


@query("p04_star_plus", with_views(
    f"SELECT *, {RISK_SQL} AS risk_level FROM b_transactions", "b_transactions", ts=("transaction_date",)))
def p04_star_plus(cat):
    return rel.with_risk_level(cat.b_transactions)


#: a transaction beside its customer's home city
view("places", ("b_transactions", "b_customers"), """
SELECT transaction_id, customer_id, location_city, city, location_city <> city AS away
FROM b_transactions JOIN b_customers USING (customer_id)""")
FLAG_SQL = "if(away, 'shift_in_location', 'no_shift') AS location_flag"


@query("j04_location_shift", with_views(f"SELECT * EXCLUDE (away), {FLAG_SQL} FROM places", "places"))
def j04_location_shift(cat):
    return rel.location_shift(cat.b_transactions, cat.b_customers)


@query("u02_location", with_views(f"SELECT {FLAG_SQL}, count(*) AS transactions FROM places GROUP BY ALL", "places"))
def u02_location(cat):
    return rel.location_shift(cat.b_transactions, cat.b_customers).groupBy("location_flag").agg(
        F.count(F.lit(1)).alias("transactions"))


@query("p11_inequality", with_views("SELECT transaction_id, location_city, city FROM places WHERE away", "places"))
def p11_inequality(cat):
    j = cat.b_transactions.join(cat.b_customers.select("customer_id", "city"), "customer_id")
    return j.filter(F.col("location_city") != F.col("city")).select("transaction_id", "location_city", "city")


@query("p10_ranges", with_views(
    "SELECT transaction_id, amount FROM b_transactions WHERE amount > 500 OR amount BETWEEN 100 AND 200",
    "b_transactions"))
def p10_ranges(cat):
    a = F.col("amount")
    return cat.b_transactions.filter((a > 500) | a.between(100, 200)).select("transaction_id", "amount")


@query("c03_case", with_views(
    f"SELECT {RISK_SQL} AS risk_level, count(*) AS transactions, floor((sum(amount)) * 100 + 0.5) / 100 AS amount "
    "FROM b_transactions GROUP BY 1", "b_transactions"))
def c03_case(cat):
    t = rel.with_risk_level(cat.b_transactions)
    return t.groupBy("risk_level").agg(F.count(F.lit(1)).alias("transactions"),
                                      round_half_up(F.sum("amount"), 2).alias("amount"))


@query("p03_star_except", with_views(
    "SELECT * EXCLUDE (merchant_name, merchant_category) FROM b_transactions", "b_transactions",
    ts=("transaction_date",)))
def p03_star_except(cat):
    return cat.b_transactions.drop("merchant_name", "merchant_category")


@query("p09_lateral_alias", with_views(
    "SELECT transaction_id, amount * 1.1 AS gross, floor(amount * 1.1 * 100 + 0.5) / 100 AS gross_rounded "
    "FROM b_transactions",
    "b_transactions"))
def p09_lateral_alias(cat):
    cat.b_transactions.createOrReplaceTempView("transactions")
    return cat.spark.sql(
        "SELECT transaction_id, amount * 1.1 AS gross, floor(gross * 100 + 0.5) / 100 AS gross_rounded "
        "FROM transactions")


@query("c05_round", with_views(
    "SELECT transaction_id, round(amount / 7, 3) AS amount_per_day FROM b_transactions", "b_transactions"))
def c05_round(cat):
    return cat.b_transactions.select("transaction_id", F.round(F.col("amount") / 7, 3).alias("amount_per_day"))


@query("c04_concat", with_views(
    "SELECT customer_id, concat('%', occupation, '%') AS occupation_with_percent FROM b_customers",
    "b_customers"))
def c04_concat(cat):
    return cat.b_customers.select("customer_id", scalars.wrap(F.col("occupation")).alias("occupation_with_percent"))


@query("p01_preview", with_views(
    "SELECT * FROM b_transactions ORDER BY transaction_id LIMIT 10", "b_transactions", ts=("transaction_date",)))
def p01_preview(cat):
    return cat.b_transactions.orderBy("transaction_id").limit(10)


@query("ag05_trend", with_views(
    "SELECT date_trunc('month', transaction_date) AS period, channel, transaction_type, "
    "count(*) AS tx_count, floor((sum(amount)) * 100 + 0.5) / 100 AS total_amount, floor((avg(amount)) * 10000 + 0.5) / 10000 AS avg_amount "
    "FROM b_transactions GROUP BY ALL", "b_transactions", ts=("period",)))
def ag05_trend(cat):
    t = rel.transaction_trend(cat.b_transactions, "month")
    return t.select("period", "channel", "transaction_type", "tx_count",
                    round_half_up("total_amount", 2).alias("total_amount"),
                    round_half_up("avg_amount", 4).alias("avg_amount"))


@query("ag06_risk_profile", with_views(
    f"""SELECT c.country, c.income_bracket, count(*) AS customers,
           floor((avg(cr.credit_score)) * 10000 + 0.5) / 10000 AS avg_credit_score,
           floor((avg(cr.total_credit_used / cr.total_credit_limit)) * 1000000 + 0.5) / 1000000 AS avg_utilisation,
           CAST(sum(coalesce(a.tx_count, 0)) AS BIGINT) AS transactions,
           CAST(sum(coalesce(a.high_risk_tx, 0)) AS BIGINT) AS high_risk_transactions,
           CAST(sum(coalesce(a.flagged_tx, 0)) AS BIGINT) AS flagged_transactions,
           floor((sum(a.tx_amount)) * 100 + 0.5) / 100 AS total_amount
    FROM b_customers c JOIN b_credit cr ON c.customer_id = cr.customer_id
    LEFT JOIN (SELECT customer_id, count(*) AS tx_count, sum(amount) AS tx_amount,
                      count_if({RISK_SQL} = 'High') AS high_risk_tx, count_if(is_flagged) AS flagged_tx
               FROM b_transactions GROUP BY customer_id) a ON c.customer_id = a.customer_id
    GROUP BY c.country, c.income_bracket""",
    "b_customers", "b_credit", "b_transactions"))
def ag06_risk_profile(cat):
    p = rel.risk_profile(cat.b_customers, cat.b_credit, cat.b_transactions)
    return p.select("country", "income_bracket", "customers",
                    round_half_up("avg_credit_score", 4).alias("avg_credit_score"),
                    round_half_up("avg_utilisation", 6).alias("avg_utilisation"),
                    "transactions", "high_risk_transactions", "flagged_transactions",
                    round_half_up("total_amount", 2).alias("total_amount"))


@query("r02_customer_360", with_views(
    """SELECT c.customer_id, c.country, c.income_bracket, a.n_accounts,
       floor((a.checking_balance) * 100 + 0.5) / 100 AS checking_balance, floor((a.savings_balance) * 100 + 0.5) / 100 AS savings_balance,
       floor((a.credit_card_balance) * 100 + 0.5) / 100 AS credit_card_balance, floor((a.loan_balance) * 100 + 0.5) / 100 AS loan_balance,
       floor((a.credit_card_limit) * 100 + 0.5) / 100 AS credit_card_limit,
       cr.credit_score, t.tx_count, floor((t.tx_amount) * 100 + 0.5) / 100 AS tx_amount
    FROM b_customers c
    LEFT JOIN (SELECT customer_id, count(*) AS n_accounts,
                      sum(CASE WHEN account_type = 'checking' THEN current_balance END) AS checking_balance,
                      sum(CASE WHEN account_type = 'savings' THEN current_balance END) AS savings_balance,
                      sum(CASE WHEN account_type = 'credit card' THEN current_balance END) AS credit_card_balance,
                      sum(CASE WHEN account_type = 'loan' THEN current_balance END) AS loan_balance,
                      sum(credit_limit) AS credit_card_limit
               FROM b_accounts GROUP BY customer_id) a ON c.customer_id = a.customer_id
    LEFT JOIN b_credit cr ON c.customer_id = cr.customer_id
    LEFT JOIN (SELECT customer_id, count(*) AS tx_count, sum(amount) AS tx_amount
               FROM b_transactions GROUP BY customer_id) t ON c.customer_id = t.customer_id""",
    "b_customers", "b_accounts", "b_credit", "b_transactions"))
def r02_customer_360(cat):
    df = rel.customer_360(cat.b_customers, cat.b_accounts, cat.b_credit, cat.b_transactions)
    money = ["checking_balance", "savings_balance", "credit_card_balance", "loan_balance",
             "credit_card_limit", "tx_amount"]
    return df.select(*[round_half_up(c, 2).alias(c) if c in money else F.col(c) for c in df.columns])


@query("j07_watchlist", with_views(
    """SELECT c.customer_id, w.entity_id, w.source, w.risk_category,
       trim(regexp_replace(lower(regexp_replace(c.first_name || ' ' || c.last_name, '[^A-Za-z0-9 ]', ' ', 'g')), '\\s+', ' ', 'g')) AS norm_name
    FROM b_customers c JOIN b_watchlist w
      ON trim(regexp_replace(lower(regexp_replace(c.first_name || ' ' || c.last_name, '[^A-Za-z0-9 ]', ' ', 'g')), '\\s+', ' ', 'g'))
       = trim(regexp_replace(lower(regexp_replace(w.entity_name, '[^A-Za-z0-9 ]', ' ', 'g')), '\\s+', ' ', 'g'))""",
    "b_customers", "b_watchlist"))
def j07_watchlist(cat):
    return rel.screen(cat.b_customers, cat.b_watchlist)


def _norm_sql(name: str) -> str:
    return f"trim(regexp_replace(lower(regexp_replace({name}, '[^A-Za-z0-9 ]', ' ', 'g')), '\\s+', ' ', 'g'))"


@query("j07_fuzzy", with_views(f"""
    SELECT party_kind, party_id, p.name, entity_id, source, risk_category, CAST(levenshtein(p.name, w.name) AS INT) AS distance
    FROM (SELECT 'customer' AS party_kind, customer_id AS party_id, {_norm_sql("first_name || ' ' || last_name")} AS name
          FROM b_customers
          UNION ALL SELECT DISTINCT 'counterparty', merchant_name, {_norm_sql("merchant_name")} FROM b_transactions) p
    JOIN (SELECT *, {_norm_sql("entity_name")} AS name FROM b_watchlist) w ON levenshtein(p.name, w.name) <= 1""",
    "b_customers", "b_transactions", "b_watchlist"))
def j07_fuzzy(cat):
    """Customers and counterparties within one edit of a listed name."""
    return screening.screen_fuzzy(screening.parties(cat.b_customers, cat.b_transactions), cat.b_watchlist, 1)


@query("c08_dateadd", with_views("""
SELECT event_id, ts - INTERVAL 1 HOUR AS ts_minus_1h FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""", ts=("ts_minus_1h",)))
def c08_dateadd(cat):
    """Rows of the last 24 hours before the newest event, and each time
    shifted back one hour: DATEADD(hour, -n, ts)."""
    e = cat.table("events")
    newest = e.select(F.max("ts")).scalar()
    return (e.filter(F.col("ts") >= scalars.hours_before(newest, 24))
            .select("event_id", scalars.hours_before(F.col("ts"), 1).alias("ts_minus_1h")))


@query("c07_now")
def c07_now(cat):
    """TO_TIMESTAMP_NTZ(CURRENT_TIMESTAMP) stamped on every row (rows-only)."""
    return cat.b_transactions.select("transaction_id", scalars.now_ntz().alias("ingestedtimestamp"))
