"""Incrementally maintained summary tables.

A change batch becomes signed deltas, +1 for a row that came and -1 for one
that went, taken from the change stream alone (``cdc.changes(...,
with_before=True)`` carries the old row of an update or delete). Deltas and the
stored rows go through one ``groupBy``, which treats NULL as a group like any
other and is reduced inside every task before the shuffle.

* Count and sum per group need no more than their own deltas. Sums are DECIMAL,
  so refreshes never drift from a recompute.
* MIN, MAX and AVG must survive the deletion of the present extreme. They come
  from a counted multiset, one row per (group, value) with the number of rows
  that hold it; only groups that a batch touches are summed up again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.cdc import ACTION, BEFORE

MONEY = "decimal(22,2)"


def build_summary(df: DataFrame, groups: list[str], measure: str) -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("row_count"),
                                   F.sum(F.col(measure).cast(MONEY)).alias("total"))


def signed_deltas(changes_df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``_sign`` of every row that a change brings (+1) or takes (-1)."""
    side = lambda row, sign: F.struct(*[row(c).alias(c) for c in columns], F.lit(sign).alias("_sign"))
    new, old = side(F.col, 1), side(lambda c: F.col(BEFORE)[c], -1)
    pair = (F.when(F.col(ACTION) == "INSERT", F.array(new)).when(F.col(ACTION) == "DELETE", F.array(old))
            .otherwise(F.array(new, old)))
    return changes_df.select(F.explode(pair).alias("_d")).select("_d.*")


def refresh_summary(summary: DataFrame, changes_df: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """``build_summary`` of the new snapshot, from that of the old one and the changes."""
    value = F.col(measure).cast(MONEY)
    deltas = signed_deltas(changes_df, [*groups, measure]).select(
        *groups, F.col("_sign").cast("long").alias("row_count"),
        (F.col("_sign").cast("decimal(1,0)") * value).cast(MONEY).alias("total"))
    both = summary.select(*groups, "row_count", F.col("total").cast(MONEY).alias("total")).unionByName(deltas)
    return (both.groupBy(*groups).agg(F.sum("row_count").alias("row_count"), F.sum("total").cast(MONEY).alias("total"))
            .filter(F.col("row_count") > 0))


def build_values(df: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """The counted multiset: (groups, value, n). NULL is a value that only counts rows."""
    return df.groupBy(*groups, F.col(measure).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def refresh_values(values: DataFrame, changes_df: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """The multiset after a batch. More rows gone than were there raises an error."""
    deltas = (signed_deltas(changes_df, [*groups, measure])
              .select(*groups, F.col(measure).alias("value"), F.col("_sign").cast("long").alias("n")))
    n = F.sum("n")
    return (values.select(*groups, "value", "n").unionByName(deltas).groupBy(*groups, "value")
            .agg(F.when(n < 0, F.raise_error(F.lit("a change takes a row that the summary never held")).cast("long"))
                 .otherwise(n).alias("n")).filter("n > 0"))


def summarise(values: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: row_count, total, lowest, highest, average (NULL where every value is NULL)."""
    held = F.when(F.col("value").isNotNull(), F.col("n"))
    total = F.sum(F.col("value").cast(MONEY) * F.col("n").cast("decimal(16,0)"))
    return values.groupBy(*groups).agg(
        F.sum("n").alias("row_count"), total.cast(MONEY).alias("total"), F.min("value").alias("lowest"),
        F.max("value").alias("highest"), (total.cast("double") / F.sum(held)).alias("average"))


def _same(groups: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}")) for g in groups])


def refresh_extremes(stored: DataFrame, values: DataFrame, changes_df: DataFrame, groups: list[str],
                     measure: str) -> tuple[DataFrame, DataFrame]:
    """(summary, multiset) after a batch; ``stored`` is ``summarise`` of ``values``.
    Groups the batch does not touch keep their stored row and are not summed again."""
    touched = signed_deltas(changes_df, [*groups, measure]).select(*groups).distinct().alias("t")
    after = refresh_values(values, changes_df, groups, measure)
    kept = stored.alias("s").join(touched, _same(groups, "s", "t"), "left_anti")
    again = after.alias("v").join(touched, _same(groups, "v", "t"), "left_semi")
    return kept.unionByName(summarise(again, groups)), after
