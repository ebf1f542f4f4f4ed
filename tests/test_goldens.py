"""Worked answers stated in the reference, reproduced through the library."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions import nested
from quarry.operators import intervals

# Supplier, dealership, make and extras are what the worked answers name; the rest is filler
VEHICLE = """{"supplier_name": "Hillside Honda", "vehicle": [{"make": "Honda", "doors": 5}], "lot": 7}"""
CAR_SALES = """{"dealership": "Valley View Auto Sales", "invoice": "A-1",
 "vehicle": [{"extras": ["ext warranty", "paint protection"], "make": "Honda"}]}"""


def test_supplier_name_from_variant(spark):
    df = spark.createDataFrame([(VEHICLE,)], "j string").select(nested.parse(F.col("j"), strict=True).alias("v"))
    row = df.select(nested.path(F.col("v"), "supplier_name").alias("s"),
                    nested.path(F.col("v"), "$.vehicle[0].make").alias("make")).first()
    assert row.s == "Hillside Honda" and row.make == "Honda"


def test_dealership_and_nested_array(spark):
    df = spark.createDataFrame([(CAR_SALES,)], "j string").select(nested.parse(F.col("j")).alias("v"))
    row = df.select(nested.path(F.col("v"), "dealership").alias("d"),
                    nested.path(F.col("v"), "$.vehicle[0].extras[1]").alias("x")).first()
    assert row.d == "Valley View Auto Sales" and row.x == "paint protection"


def test_flatten_array_and_object(spark):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (2, '{"x":5,"y":6}'), (3, None)], "id int, j string") \
        .select("id", F.parse_json("j").alias("v"))
    inner = nested.flatten(df, "v").select("id", "pos", "key").collect()
    assert sorted((r.id, r.pos) for r in inner) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    assert sorted(r.key for r in inner if r.id == 2) == ["x", "y"]
    outer = nested.flatten(df, "v", outer=True).filter("id = 3").count()
    assert outer == 1


def test_metered_credits_34(spark):
    """Usage c1 0-180, c2 60-180, c3 120-135 minutes; rates 0-90 at 4 an hour, 90-180 at 8."""
    def at(minutes):
        return dt.datetime(2024, 1, 31, 22, 0) + dt.timedelta(minutes=minutes)

    usage = spark.createDataFrame([("c1", at(0), at(180)), ("c2", at(60), at(180)), ("c3", at(120), at(135))],
                                  "cluster string, start timestamp_ntz, end timestamp_ntz")
    rates = spark.createDataFrame([(at(0), at(90), 4), (at(90), at(180), 8)],
                                  "rate_start timestamp_ntz, rate_end timestamp_ntz, rate int")
    for unit in ("hour", "day", "month", "quarter", "year"):
        got = {r.cluster: r.credits for r in intervals.metered(usage, rates, unit=unit, per="hour").collect()}
        assert {k: round(v, 9) for k, v in got.items()} == {"c1": 18, "c2": 14, "c3": 2} and round(sum(got.values()), 9) == 34


def test_metered_keeps_every_usage_row(spark):
    """Equal, empty, backward, unpriced and open usage rows; long spans; rates that overlap or are empty."""
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    usage = spark.createDataFrame([("a", d(0), d(2)), ("a", d(0), d(2)), ("b", d(5), d(5)), ("c", d(9), d(3)),
                                   ("d", d(-900), d(-800)), ("e", None, d(3)), ("f", d(-4000), d(4000)), (None, d(1), d(3))],
                                  "id string, start date, end date")
    rates = spark.createDataFrame([(d(0), d(10), 4), (d(1), d(2), 1), (d(7), d(7), 100), (None, d(9), 100)],
                                  "rate_start date, rate_end date, rate int")
    got = sorted(((r.id or "", r.credits) for r in intervals.metered(usage, rates).collect()))
    assert got == [("", 9), ("a", 9), ("a", 9), ("b", 0), ("c", 0), ("d", 0), ("e", 0), ("f", 41)]
    assert all(r.credits == 0 for r in intervals.metered(usage, rates.limit(0)).collect())
