"""Interval-overlap join (J06): metered usage × rate schedule.

A theta join ``u.start < r.end AND r.start < u.end`` has no equi-key, so
Catalyst would plan a nested loop. Both sides are cut at calendar-bucket
boundaries instead (a usage interval spans only a few buckets), joined on
the bucket, and the overlap is measured inside the bucket — so a pair
that shares several buckets is counted piecewise, never twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
_ROWS, _BUCKET = "_rows", "_bucket"


def _pieces(df: DataFrame, start: Column, end: Column, unit: str) -> DataFrame:
    """A row per calendar bucket that [start, end) meets; one with NULL if it meets none."""
    last = end - F.expr("INTERVAL 1 MICROSECOND")
    buckets = F.when(start < end, F.sequence(F.date_trunc(unit, start).cast("timestamp_ntz"),
                                             F.date_trunc(unit, last).cast("timestamp_ntz"), _step(unit)))
    return df.withColumn(_BUCKET, F.explode_outer(buckets))


def _step(unit: str) -> Column:
    return F.expr(f"INTERVAL {3 if unit == 'quarter' else 1} {'MONTH' if unit == 'quarter' else unit}")


def overlap_seconds(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length of the common part in seconds, microseconds included; 0 if there is none."""
    span = F.timestamp_diff("MICROSECOND", F.greatest(a_start, b_start), F.least(a_end, b_end))
    return F.greatest(span, F.lit(0)) / F.lit(1_000_000)


def metered(usage: DataFrame, rates: DataFrame, unit: str = "month", per: str = "day") -> DataFrame:
    """usage(..., start, end) × rates(rate_start, rate_end, rate) → every usage row
    with ``credits`` = Σ overlap × rate, the rate being for one ``per`` (second,
    minute, hour or day).

    Dates or timestamps, half-open [start, end). ``unit`` (hour, day, month,
    quarter, year) is the bucket both sides are cut at: intervals should span few.
    Equal usage rows each have their credits; usage that is empty, has a NULL
    bound, or meets no rate has 0. Empty rate intervals charge nothing, rates
    that overlap add up.
    """
    ntz = lambda c: F.col(c).cast("timestamp_ntz")
    u = _pieces(usage.groupBy(*usage.columns).agg(F.count(F.lit(1)).alias(_ROWS)), ntz("start"), ntz("end"), unit)
    r = _pieces(rates.select("rate_start", "rate_end", "rate"), ntz("rate_start"), ntz("rate_end"), unit)
    j = u.join(r.filter(F.col(_BUCKET).isNotNull()), _BUCKET, "left")
    spent = overlap_seconds(F.greatest(ntz("start"), F.col(_BUCKET)), F.least(ntz("end"), F.col(_BUCKET) + _step(unit)),
                            ntz("rate_start"), ntz("rate_end")) / F.lit(SECONDS[per])
    sums = j.groupBy(*usage.columns, _ROWS).agg(F.coalesce(F.sum(spent * F.col("rate")), F.lit(0.0)).alias("credits"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(_ROWS)))
    return sums.withColumn(_ROWS, copies).drop(_ROWS)
