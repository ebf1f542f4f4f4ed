"""Joins, aggregates and top-k of the player-statistics and banking workloads.

All operators are plain DataFrame -> DataFrame compositions. Physical choices
are left to Catalyst + AQE:

* top-1 is ``orderBy(...).limit(1)`` which plans as TakeOrderedAndProject:
  every task keeps its own best row, the driver merges one row per task;
* equi-joins get a broadcast only when AQE sees a small runtime side,
  otherwise sort-merge with skew-split (``spark.sql.adaptive.skewJoin``);
* aggregations are partial (map-side) + final, so a key holding a third of
  the rows is pre-reduced in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalars import risk_level


# ---------------------------------------------------------------- top-k ----
def top_by(df: DataFrame, metric: str, *tiebreak: str, n: int = 1) -> DataFrame:
    """Rows with the largest ``metric``; NULL ratings never win (D12), ties
    fall to ``tiebreak`` ascending so the answer is deterministic."""
    order = [F.col(metric).desc_nulls_last()] + [F.col(t).asc_nulls_last() for t in tiebreak]
    return df.orderBy(*order).limit(n)


def players(info: DataFrame, stats: DataFrame) -> DataFrame:
    """info ⋈ stats on primary_key."""
    return info.join(stats, "primary_key")


def best_player(info: DataFrame, stats: DataFrame, metric: str) -> DataFrame:
    """Username of the best player by a rating column."""
    return top_by(players(info, stats), metric, "username").select("username")


def best_named(info: DataFrame, stats: DataFrame) -> DataFrame:
    """Full name, or username when the name is NULL, of the best FIDE."""
    j = players(info, stats)
    return top_by(j, "fide", "username").select(
        F.coalesce("name", "username").alias("player_name"), F.col("fide"))


def best_live(lst: DataFrame, info: DataFrame, stats: DataFrame) -> DataFrame:
    """Best FIDE among players currently live (O03): three-way chain."""
    j = (lst.filter(F.col("is_live"))
         .join(info, "username")
         .join(stats, "primary_key"))
    return top_by(j, "fide", "username").select("username", "fide")


def status_averages(info: DataFrame, stats: DataFrame,
                    statuses=("premium", "staff", "basic")) -> DataFrame:
    """Average ratings of premium, staff and basic players (AG02)."""
    j = players(info.filter(F.col("status").isin(*statuses)), stats)
    return j.groupBy("status").agg(
        F.avg("last_blitz").alias("avg_blitz_elo"),
        F.avg("last_bullet").alias("avg_bullet_elo"),
        F.avg("last_rapid").alias("avg_rapid_elo"),
        F.avg("fide").alias("avg_fide_elo"))


def titled_summary(info: DataFrame, stats: DataFrame) -> DataFrame:
    """Number of titled players and their average FIDE (AG03)."""
    j = players(info.filter(F.col("title").isNotNull()), stats)
    return j.agg(F.count(F.lit(1)).alias("num_pro_players"),
                 F.avg("fide").alias("avg_pro_elo"))


def title_averages(info: DataFrame, stats: DataFrame) -> DataFrame:
    """Average FIDE by title; untitled players form the NULL group (AG04)."""
    return players(info, stats).groupBy("title").agg(F.avg("fide").alias("avg_fide_elo"))


# ------------------------------------------------------------- banking -----
def with_risk_level(tx: DataFrame, amount: str = "amount") -> DataFrame:
    """``SELECT *, trans_func(amount) AS risk_level`` (U01 as a model)."""
    return tx.withColumn("risk_level", risk_level(F.col(amount)))


def location_shift(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per transaction: did it happen outside the customer's home
    city (J04/U02)? A NULL city compares as not-different → no_shift."""
    c = customers.select("customer_id", "city")
    j = tx.join(c, "customer_id")
    flag = F.when(F.col("location_city") != F.col("city"), "shift_in_location").otherwise("no_shift")
    return j.select("transaction_id", "customer_id", "location_city", "city",
                    flag.alias("location_flag"))


def transaction_trend(tx: DataFrame, grain: str = "month") -> DataFrame:
    """Count/sum/avg of amounts by period, channel and type (AG05)."""
    return (tx.groupBy(F.date_trunc(grain, "transaction_date").alias("period"),
                       "channel", "transaction_type")
            .agg(F.count(F.lit(1)).alias("tx_count"),
                 F.sum("amount").alias("total_amount"),
                 F.avg("amount").alias("avg_amount")))


def per_customer_activity(tx: DataFrame) -> DataFrame:
    """Transactions pre-aggregated per customer before any join."""
    t = with_risk_level(tx)
    return t.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount").alias("tx_amount"),
        F.count(F.when(F.col("risk_level") == "High", 1)).alias("high_risk_tx"),
        F.count(F.when(F.col("is_flagged"), 1)).alias("flagged_tx"))


def risk_profile(customers: DataFrame, credit: DataFrame, tx: DataFrame) -> DataFrame:
    """Segment / risk profile by country and income bracket (AG06)."""
    act = per_customer_activity(tx)
    j = (customers.select("customer_id", "country", "income_bracket")
         .join(credit.select("customer_id", "credit_score", "total_credit_used", "total_credit_limit"),
               "customer_id")
         .join(act, "customer_id", "left"))
    return j.groupBy("country", "income_bracket").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("credit_score").alias("avg_credit_score"),
        F.avg(F.col("total_credit_used") / F.col("total_credit_limit")).alias("avg_utilisation"),
        F.sum(F.coalesce("tx_count", F.lit(0))).alias("transactions"),
        F.sum(F.coalesce("high_risk_tx", F.lit(0))).alias("high_risk_transactions"),
        F.sum(F.coalesce("flagged_tx", F.lit(0))).alias("flagged_transactions"),
        F.sum("tx_amount").alias("total_amount"))


def customer_360(customers: DataFrame, accounts: DataFrame, credit: DataFrame,
                 tx: DataFrame) -> DataFrame:
    """Retail, card, savings and loan data combined per customer.

    Accounts and transactions are reduced to one row per customer first, so
    the joins are one-to-one and never fan out."""
    def bal(t: str) -> Column:
        return F.sum(F.when(F.col("account_type") == t, F.col("current_balance")))

    acc = accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_accounts"),
        bal("checking").alias("checking_balance"),
        bal("savings").alias("savings_balance"),
        bal("credit card").alias("credit_card_balance"),
        bal("loan").alias("loan_balance"),
        F.sum("credit_limit").alias("credit_card_limit"))
    act = per_customer_activity(tx)
    return (customers.select("customer_id", "country", "income_bracket")
            .join(acc, "customer_id", "left")
            .join(credit.select("customer_id", "credit_score"), "customer_id", "left")
            .join(act.select("customer_id", "tx_count", "tx_amount"), "customer_id", "left"))


def normalise_name(c: Column) -> Column:
    """lower-case, punctuation to blanks, blanks collapsed, trimmed."""
    s = F.regexp_replace(c, r"[^A-Za-z0-9 ]", " ")
    return F.trim(F.regexp_replace(F.lower(s), r"\s+", " "))


def screen(customers: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Customers whose normalised full name is on the watchlist.

    An equi-join on the normalised name: no pairwise comparison, and the
    list side is broadcast only if AQE measures it under the threshold."""
    c = customers.select("customer_id",
                         normalise_name(F.concat_ws(" ", "first_name", "last_name")).alias("norm_name"))
    w = watchlist.select("entity_id", "source", "risk_category",
                         normalise_name(F.col("entity_name")).alias("norm_name"))
    return c.join(w, "norm_name")
