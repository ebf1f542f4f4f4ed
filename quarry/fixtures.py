"""Workload tables derived from the driver's TPC-H-style test tables.

The reference's workloads (banking, player statistics, person documents,
files in place) come with no data. Every view below is a pure DataFrame
derivation of the given tables, so its size grows with them. The same
rules are restated in SQL in ``quarry.plans.oracle_views`` for the DuckDB
oracle.

Only ``nation`` and ``region`` are broadcast: they are the fixed 25- and
5-row TPC-H dimensions. Everything else is left to Catalyst/AQE, which
broadcasts a side only when its runtime size is under the threshold.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (vocabularies of the banking generator and the derived views)
# ---------------------------------------------------------------------------
CURRENCY_BY_COUNTRY = {
    "AFRICA": "ZAR",
    "AMERICA": "USD",
    "ASIA": "JPY",
    "EUROPE": "EUR",
    "MIDDLE EAST": "AED",
}
TRANSACTION_TYPES = ["purchase", "transfer", "withdrawal", "deposit"]
CHANNELS = ["online", "mobile", "ATM", "in-branch"]
MERCHANTS = ["Amazon", "Walmart", "Target", "Best Buy", "Costco"]
CATEGORIES = ["Retail", "Grocery", "Electronics", "Clothing", "Miscellaneous"]
ACCOUNT_TYPES = ["checking", "savings", "credit card", "loan"]
ACCOUNT_STATUSES = ["active", "dormant", "closed"]
ENTITY_TYPES = ["Individual", "Organization"]
WATCHLIST_SOURCES = ["OFAC", "UN", "EU", "Interpol"]
PLAYER_STATUS_BY_SEGMENT = {
    "AUTOMOBILE": "premium",
    "BUILDING": "staff",
    "FURNITURE": "basic",
    "HOUSEHOLD": "closed",
    "MACHINERY": "basic",
}
SALUTATIONS = ["Mr.", "Mrs.", "Ms.", "Dr.", "Sir", "Miss"]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def pick(values: list[str], index: Column) -> Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def lookup(mapping: dict[str, str], key: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == k, v) if expr is None else expr.when(key == k, v))
    return expr


def cents_over(money: Column, divisor: int) -> Column:
    """money / divisor rounded half-up to cents, in exact integer cents."""
    cents = F.round(money * 100)
    return F.floor((cents + divisor // 2) / divisor) / 100


def days_after(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int"))


class Catalog:
    """Lazily opened test tables plus the derived workload views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    # -- geography: 25 nations x 5 regions, a fixed-size dimension ---------
    @cached_property
    def geo(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        g = n.join(r, n.n_regionkey == r.r_regionkey).select(
            "n_nationkey", "n_name", F.col("r_name").alias("country"))
        return F.broadcast(g)

    # -- banking (W4) ------------------------------------------------------
    @cached_property
    def b_customers(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        return (c.join(self.geo, c.c_nationkey == F.col("n_nationkey"))
                .select(
                    k.cast("string").alias("customer_id"),
                    F.substring_index("c_name", "#", 1).alias("first_name"),
                    F.substring_index("c_name", "#", -1).alias("last_name"),
                    days_after("1940-01-01", (k * 37) % 20000).alias("date_of_birth"),
                    F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"),
                    F.concat(F.lit("customer"), k, F.lit("@example.com")).alias("email"),
                    F.concat(F.lit("+1-555-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone_number"),
                    F.concat((k % 999 + 1).cast("string"), F.lit(" Main Street")).alias("address"),
                    F.col("n_name").alias("city"),
                    F.col("country"),
                    F.lower("c_mktsegment").alias("occupation"),
                    F.when(F.col("c_acctbal") < 2000, "Low")
                     .when(F.col("c_acctbal") < 6000, "Medium")
                     .otherwise("High").alias("income_bracket"),
                    days_after("2014-01-01", (k * 13) % 3650).alias("customer_since"),
                ))

    @cached_property
    def b_transactions(self) -> DataFrame:
        o, c = self.table("orders"), self.table("customer")
        oc = o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey)
        loc = self.geo.select(F.col("n_nationkey").alias("loc_key"),
                              F.col("n_name").alias("location_city"),
                              F.col("country").alias("location_country"))
        k = F.col("o_orderkey")
        shifted = (F.col("c_nationkey") + F.lit(5) * (k % 5)) % 25
        return (oc.join(loc, shifted == loc.loc_key)
                .select(
                    k.cast("string").alias("transaction_id"),
                    F.col("o_custkey").cast("string").alias("customer_id"),
                    F.col("o_orderdate").alias("transaction_date"),
                    cents_over(F.col("o_totalprice"), 50).alias("amount"),
                    lookup(CURRENCY_BY_COUNTRY, F.col("location_country")).alias("currency"),
                    pick(TRANSACTION_TYPES, k % 4).alias("transaction_type"),
                    pick(CHANNELS, F.floor(k / 4) % 4).alias("channel"),
                    pick(MERCHANTS, F.col("o_custkey") % 5).alias("merchant_name"),
                    pick(CATEGORIES, k % 5).alias("merchant_category"),
                    "location_country",
                    "location_city",
                    ((F.col("o_totalprice") > 450000) & (F.col("o_orderstatus") == "F")).alias("is_flagged"),
                ))

    @cached_property
    def b_accounts(self) -> DataFrame:
        c = self.table("customer")
        base = c.join(self.geo, c.c_nationkey == F.col("n_nationkey")).select(
            "c_custkey", "c_acctbal", "country",
            F.explode(F.sequence(F.lit(1), (F.col("c_custkey") % 3 + 1).cast("int"))).alias("seq"))
        k, s = F.col("c_custkey"), F.col("seq")
        atype = pick(ACCOUNT_TYPES, (k + s) % 4)
        return base.select(
            F.concat(k.cast("string"), F.lit("-"), s.cast("string")).alias("account_id"),
            k.cast("string").alias("customer_id"),
            atype.alias("account_type"),
            pick(ACCOUNT_STATUSES, (k * s) % 3).alias("account_status"),
            days_after("2015-01-01", (k * 7 + s * 101) % 3000).alias("open_date"),
            F.round(F.abs(F.col("c_acctbal")) * s + 100, 2).alias("current_balance"),
            lookup(CURRENCY_BY_COUNTRY, F.col("country")).alias("currency"),
            F.when(atype == "credit card", (F.lit(1000) + (k * s * 97) % 49000).cast("double"))
             .otherwise(F.lit(0.0)).alias("credit_limit"),
        )

    @cached_property
    def b_credit(self) -> DataFrame:
        k = F.col("c_custkey")
        limit = (F.lit(1000) + (k * 131) % 49000).cast("double")
        return self.table("customer").select(
            k.cast("string").alias("customer_id"),
            (F.lit(300) + (k * 37) % 551).cast("int").alias("credit_score"),
            (k % 10 + 1).cast("int").alias("number_of_credit_accounts"),
            limit.alias("total_credit_limit"),
            F.round(limit * ((k * 17) % 100) / 100, 2).alias("total_credit_used"),
            (k % 6).cast("int").alias("number_of_late_payments"),
            F.when(k % 7 == 0, 1).otherwise(0).cast("int").alias("bankruptcies"),
        )

    @cached_property
    def b_watchlist(self) -> DataFrame:
        """Suppliers as listed organisations plus every customer whose key is
        a multiple of 50 as a listed individual, written the way lists spell
        names (upper case, stray punctuation and spaces)."""
        s = self.table("supplier")
        k = F.col("s_suppkey")
        orgs = s.select(
            F.concat(F.lit("S"), k.cast("string")).alias("entity_id"),
            F.col("s_name").alias("entity_name"),
            F.lit("Organization").alias("entity_type"),
            F.when(F.col("s_acctbal") < 3000, "Low").when(F.col("s_acctbal") < 7000, "Medium")
             .otherwise("High").alias("risk_category"),
            days_after("2012-01-01", (k * 29) % 3650).alias("listed_date"),
            pick(WATCHLIST_SOURCES, k % 4).alias("source"),
        )
        c = self.table("customer").filter(F.col("c_custkey") % 50 == 0)
        ck = F.col("c_custkey")
        people = c.select(
            F.concat(F.lit("C"), ck.cast("string")).alias("entity_id"),
            F.concat(F.lit("  "), F.upper(F.substring_index("c_name", "#", 1)), F.lit(". "),
                     F.substring_index("c_name", "#", -1), F.lit(" ")).alias("entity_name"),
            F.lit("Individual").alias("entity_type"),
            F.when(F.col("c_acctbal") < 3000, "Low").when(F.col("c_acctbal") < 7000, "Medium")
             .otherwise("High").alias("risk_category"),
            days_after("2012-01-01", (ck * 29) % 3650).alias("listed_date"),
            pick(WATCHLIST_SOURCES, ck % 4).alias("source"),
        )
        return orgs.unionByName(people)

    # -- player statistics (W3) -------------------------------------------
    @cached_property
    def c_info(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        return (c.join(self.geo, c.c_nationkey == F.col("n_nationkey"))
                .select(
                    F.col("c_name").alias("username"),
                    ((k * 7) % 1000).cast("long").alias("followers"),
                    F.col("n_name").alias("country"),
                    days_after("2010-01-01", (k * 11) % 4000).alias("joined"),
                    F.concat(F.col("n_name"), F.lit(" city")).alias("location"),
                    F.when(k % 3 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("Player "), k.cast("string"))).alias("name"),
                    F.concat(F.lit("p"), k.cast("string")).alias("player_id"),
                    lookup(PLAYER_STATUS_BY_SEGMENT, F.col("c_mktsegment")).alias("status"),
                    F.when(k % 11 == 0, "GM").when(k % 7 == 0, "IM").alias("title"),
                    k.alias("primary_key"),
                ))

    @cached_property
    def c_stats(self) -> DataFrame:
        o = self.table("orders")
        p, st, pr = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")

        def rating(x: Column) -> Column:
            return F.floor(x / 100).cast("long")

        def n(cond: Column) -> Column:
            return F.count(F.when(cond, 1)).cast("long")

        agg = o.groupBy("o_custkey").agg(
            rating(F.max(p)).alias("last_blitz"),
            n(st == "P").alias("draw_blitz"),
            n(st == "O").alias("loss_blitz"),
            n(st == "F").alias("win_blitz"),
            rating(F.min(p)).alias("last_bullet"),
            n(pr == "3-MEDIUM").alias("draw_bullet"),
            n(pr.isin("4-NOT SPECIFIED", "5-LOW")).alias("loss_bullet"),
            n(pr.isin("1-URGENT", "2-HIGH")).alias("win_bullet"),
            rating(F.max(F.when(st == "F", p))).alias("last_rapid"),
            n(p == 250000).alias("draw_rapid"),
            n(p < 250000).alias("loss_rapid"),
            n(p > 250000).alias("win_rapid"),
            F.max(F.floor(p / 200)).cast("long").alias("fide_raw"),
        )
        return agg.select(
            "last_blitz", "draw_blitz", "loss_blitz", "win_blitz",
            "last_bullet", "draw_bullet", "loss_bullet", "win_bullet",
            "last_rapid", "draw_rapid", "loss_rapid", "win_rapid",
            F.when(F.col("o_custkey") % 5 == 0, F.lit(None).cast("long"))
             .otherwise(F.col("fide_raw")).alias("fide"),
            F.col("o_custkey").alias("primary_key"),
        )

    @cached_property
    def c_list(self) -> DataFrame:
        seen = self.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        c = self.table("customer")
        return c.join(seen, c.c_custkey == seen.user_id).select(
            F.col("c_name").alias("username"),
            (F.col("c_custkey") % 2 == 0).alias("is_live"))

    # -- files in place (W1): an 18-column TPC-DS-style customer file ---------
    @cached_property
    def file_customer(self) -> DataFrame:
        c = self.table("customer")
        k = F.col("c_custkey")
        return (c.join(self.geo, c.c_nationkey == F.col("n_nationkey"))
                .select(
                    k.alias("c_customer_sk"),
                    F.concat(F.lit("AAAAAAAA"), F.lpad(k.cast("string"), 8, "0")).alias("c_customer_id"),
                    ((k * 7) % 1920800).alias("c_current_cdemo_sk"),
                    (k % 7200).alias("c_current_hdemo_sk"),
                    ((k * 3) % 50000).alias("c_current_addr_sk"),
                    (k % 3000 + 2449000).alias("c_first_shipto_date_sk"),
                    (k % 3000 + 2448970).alias("c_first_sales_date_sk"),
                    pick(SALUTATIONS, k % 6).alias("c_salutation"),
                    F.initcap("c_mktsegment").alias("c_first_name"),
                    F.col("n_name").alias("c_last_name"),
                    F.when(k % 2 == 0, "Y").otherwise("N").alias("c_preferred_cust_flag"),
                    (k % 28 + 1).alias("c_birth_day"),
                    (k % 12 + 1).alias("c_birth_month"),
                    (k % 70 + 1930).alias("c_birth_year"),
                    F.col("country").alias("c_birth_country"),
                    F.lit(None).cast("string").alias("c_login"),
                    F.concat(F.lower(F.substring_index("c_name", "#", -1)), F.lit("@example.org")).alias("c_email_address"),
                    (k % 500 + 2452000).alias("c_last_review_date_sk"),
                ))

    # -- person documents (W2) ---------------------------------------------
    @cached_property
    def persons(self) -> DataFrame:
        """One person per customer, with the fields the shredder reads."""
        c = self.table("customer")
        k = F.col("c_custkey")
        return (c.join(self.geo, c.c_nationkey == F.col("n_nationkey"))
                .select(
                    k.alias("c_custkey"),
                    F.col("c_nationkey"),
                    k.cast("string").alias("id"),
                    F.col("c_name").alias("name"),
                    (k % 60 + 18).cast("int").alias("age"),
                    F.col("n_name").alias("location"),
                    F.when(k % 4 == 0, F.lit(""))
                     .when(k % 4 == 1, F.lit(None).cast("string"))
                     .otherwise(F.lpad(((k * 7) % 100000).cast("string"), 5, "0")).alias("zip"),
                    (k % 2 == 0).alias("member"),
                    F.date_format(days_after("2015-01-01", (k * 3) % 2000), "yyyy-MM-dd").alias("since"),
                    F.round(F.col("c_acctbal"), 2).alias("balance"),
                ))

    # -- event change log for history operators ---------------------------
    @cached_property
    def change_log(self) -> DataFrame:
        """events as changes to the state of key ``user_id``; an ``error``
        event deletes the key, any other event upserts it."""
        e = self.table("events")
        return e.select(
            F.col("user_id").alias("key"),
            F.col("ts"),
            F.col("event_id").alias("seq"),
            F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT").alias("action"),
            F.col("event_type"),
            F.col("value"),
            (F.dayofmonth("ts")).cast("long").alias("batch_id"),
        )
