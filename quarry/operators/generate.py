"""Seeded banking data generator.

One generated row per source row (customers per ``customer`` row,
transactions per ``orders`` row, watchlist entries per ``supplier`` row),
so volume follows the input. Every random choice is ``xxhash64(id, salt)``:
the same input gives the same rows under any partitioning, unlike
``rand()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Country -> currency and cities, as the generator defines them
# ---------------------------------------------------------------------------
COUNTRIES = {
    "United States": ("USD", ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix"]),
    "India": ("INR", ["Delhi", "Mumbai", "Hyderabad", "Chennai", "Bangalore"]),
    "United Kingdom": ("GBP", ["London", "Birmingham", "Manchester", "Glasgow", "Liverpool"]),
    "Japan": ("JPY", ["Tokyo", "Osaka", "Nagoya", "Sapporo", "Fukuoka"]),
    "Germany": ("EUR", ["Berlin", "Hamburg", "Munich", "Cologne", "Frankfurt"]),
}
CHANNELS = ["online", "mobile", "ATM", "in-branch"]
TRANSACTION_TYPES = ["purchase", "transfer", "withdrawal", "deposit"]
MERCHANTS = ["Amazon", "Walmart", "Target", "Best Buy", "Costco"]
CATEGORIES = ["Retail", "Grocery", "Electronics", "Clothing", "Miscellaneous"]
ACCOUNT_TYPES = ["checking", "savings", "credit card", "loan"]
ACCOUNT_STATUSES = ["active", "dormant", "closed"]
INCOME = ["Low", "Medium", "High"]
GENDERS = ["Male", "Female"]
ENTITY_TYPES = ["Individual", "Organization"]
RISK = ["Low", "Medium", "High"]
SOURCES = ["OFAC", "UN", "EU", "Interpol"]

COUNTRY_NAMES = list(COUNTRIES)


def h(seed: Column, salt: str) -> Column:
    """A non-negative 63-bit hash of (seed, salt)."""
    return F.abs(F.xxhash64(seed, F.lit(salt))) % F.lit(1 << 62)


def choose(values: list[str], seed: Column, salt: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (h(seed, salt) % len(values) + 1).cast("int"))


def uniform(seed: Column, salt: str, lo: float, hi: float, digits: int = 2) -> Column:
    u = (h(seed, salt) % 1_000_000) / 1_000_000.0
    return F.round(F.lit(lo) + u * (hi - lo), digits)


def between_days(seed: Column, salt: str, start: str, days: int) -> Column:
    return F.date_add(F.lit(start).cast("date"), (h(seed, salt) % days).cast("int"))


def uuid_of(seed: Column, salt: str) -> Column:
    """A UUID-shaped id from two hashes (stable, partition-independent)."""
    hexs = F.lpad(F.hex(h(seed, salt + "a")), 16, "0")
    hexs2 = F.lpad(F.hex(h(seed, salt + "b")), 16, "0")
    s = F.lower(F.concat(hexs, hexs2))
    return F.concat_ws("-", F.substring(s, 1, 8), F.substring(s, 9, 4), F.substring(s, 13, 4),
                       F.substring(s, 17, 4), F.substring(s, 21, 12))


def country_city(seed: Column, salt: str) -> tuple[Column, Column]:
    country = choose(COUNTRY_NAMES, seed, salt)
    cities = F.create_map(*[x for c, (_, cs) in COUNTRIES.items()
                            for x in (F.lit(c), F.array(*[F.lit(v) for v in cs]))])
    city = F.element_at(cities[country], (h(seed, salt + "city") % 5 + 1).cast("int"))
    return country, city


def currency_of(country: Column) -> Column:
    m = F.create_map(*[x for c, (cur, _) in COUNTRIES.items() for x in (F.lit(c), F.lit(cur))])
    return F.coalesce(m[country], F.lit("USD"))


def customers(source: DataFrame, id_col: str = "c_custkey") -> DataFrame:
    """One customer per source row."""
    s = F.col(id_col)
    country, city = country_city(s, "country")
    return source.select(
        s.alias("_src"),
        uuid_of(s, "customer").alias("customer_id"),
        F.concat(F.lit("First"), (h(s, "fn") % 500).cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), (h(s, "ln") % 900).cast("string")).alias("last_name"),
        between_days(s, "dob", "1934-01-01", 72 * 365).alias("date_of_birth"),
        choose(GENDERS, s, "gender").alias("gender"),
        F.concat(F.lit("user"), (h(s, "mail") % 1_000_000).cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad((h(s, "ph") % 10000).cast("string"), 4, "0")).alias("phone_number"),
        F.concat((h(s, "addr") % 9999 + 1).cast("string"), F.lit(" Market Street")).alias("address"),
        city.alias("city"), country.alias("country"),
        F.concat(F.lit("Occupation "), (h(s, "job") % 50).cast("string")).alias("occupation"),
        choose(INCOME, s, "income").alias("income_bracket"),
        between_days(s, "since", "2014-06-01", 3650).alias("customer_since"),
    )


#: the generator's present day: every run makes the same rows; all customers are older
TODAY = "2024-06-01"


def accounts(custs: DataFrame) -> DataFrame:
    """1-3 accounts per customer; a credit limit only for cards."""
    c = F.col("customer_id")
    n = (h(c, "n_acc") % 3 + 1).cast("int")
    base = custs.select("customer_id", "country", "customer_since",
                        F.explode(F.sequence(F.lit(1), n)).alias("k"))
    seed = F.concat_ws(":", c, F.col("k").cast("string"))
    atype = choose(ACCOUNT_TYPES, seed, "type")
    return base.select(
        uuid_of(seed, "account").alias("account_id"), "customer_id", F.col("k").alias("account_no"),
        atype.alias("account_type"), choose(ACCOUNT_STATUSES, seed, "status").alias("account_status"),
        F.date_add("customer_since", (h(seed, "open") % (F.datediff(F.lit(TODAY).cast("date"), "customer_since") + 1))
                   .cast("int")).alias("open_date"),
        uniform(seed, "bal", 0.0, 100000.0).alias("current_balance"),
        currency_of(F.col("country")).alias("currency"),
        F.when(atype == "credit card", uniform(seed, "limit", 1000.0, 50000.0)).otherwise(F.lit(0.0))
         .alias("credit_limit"))


def transactions(source: DataFrame, custs: DataFrame, accts: DataFrame,
                 id_col: str = "o_orderkey", cust_col: str = "o_custkey") -> DataFrame:
    """One transaction per source row, for the source's customer and
    one of that customer's accounts; currency and country follow the
    customer, the city is one of the country's cities; 5% flagged."""
    s = F.col(id_col)
    n_acc = accts.groupBy("customer_id").agg(F.max("account_no").alias("n_acc"))
    c = custs.select("_src", "customer_id", "country").join(n_acc, "customer_id")
    t = source.select(s.alias("_id"), F.col(cust_col).alias("_src")).join(c, "_src")
    t = t.withColumn("account_no", (h(F.col("_id"), "acc") % F.col("n_acc") + 1).cast("int"))
    t = t.join(accts.select("customer_id", "account_no", "account_id"), ["customer_id", "account_no"])
    cities = F.create_map(*[x for cn, (_, cs) in COUNTRIES.items()
                            for x in (F.lit(cn), F.array(*[F.lit(v) for v in cs]))])
    i = F.col("_id")
    return t.select(
        uuid_of(i, "tx").alias("transaction_id"), "customer_id", "account_id",
        F.timestamp_seconds(F.lit(1_640_995_200) + h(i, "when") % (2 * 365 * 86400))
         .cast("timestamp_ntz").alias("transaction_date"),
        uniform(i, "amt", 1.0, 10000.0).alias("amount"),
        currency_of(F.col("country")).alias("currency"),
        choose(TRANSACTION_TYPES, i, "ttype").alias("transaction_type"),
        choose(CHANNELS, i, "chan").alias("channel"),
        choose(MERCHANTS, i, "merch").alias("merchant_name"),
        choose(CATEGORIES, i, "cat").alias("merchant_category"),
        F.col("country").alias("location_country"),
        F.element_at(cities[F.col("country")], (h(i, "city") % 5 + 1).cast("int")).alias("location_city"),
        (h(i, "flag") % 100 < 5).alias("is_flagged"))


def credit_data(custs: DataFrame) -> DataFrame:
    """Per customer; credit used never exceeds the limit."""
    c = F.col("customer_id")
    limit = uniform(c, "lim", 1000.0, 50000.0)
    return custs.select("customer_id", limit.alias("total_credit_limit")).select(
        "customer_id",
        (h(c, "score") % 551 + 300).cast("int").alias("credit_score"),
        (h(c, "nacc") % 10 + 1).cast("int").alias("number_of_credit_accounts"),
        "total_credit_limit",
        F.round(F.col("total_credit_limit") * (h(c, "used") % 10001) / 10000, 2).alias("total_credit_used"),
        (h(c, "late") % 6).cast("int").alias("number_of_late_payments"),
        (h(c, "bk") % 2).cast("int").alias("bankruptcies"))


def watchlist(source: DataFrame, id_col: str = "s_suppkey") -> DataFrame:
    """One listed entity per source row."""
    s = F.col(id_col)
    etype = choose(ENTITY_TYPES, s, "etype")
    return source.select(
        uuid_of(s, "entity").alias("entity_id"),
        F.when(etype == "Individual", F.concat(F.lit("Person "), (h(s, "pn") % 100000).cast("string")))
         .otherwise(F.concat(F.lit("Company "), (h(s, "cn") % 100000).cast("string"))).alias("entity_name"),
        etype.alias("entity_type"), choose(RISK, s, "risk").alias("risk_category"),
        between_days(s, "listed", "2014-06-01", 3650).alias("listed_date"),
        choose(SOURCES, s, "src").alias("source"))
