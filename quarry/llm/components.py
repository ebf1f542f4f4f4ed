"""Connected components of a link table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links``: (a, b) pairs of ids. Returns (id, component) for every linked
    id, the component being its smallest id.

    Each round is two shuffles of the shrinking edge table, staged so that no
    lineage builds up; the number of rounds grows with the logarithm of the
    largest component. Repeated and reversed links and self-links are fine.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter(F.col("u") != F.col("v")).distinct(), "edges")
    seen = _print(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least.select("u", F.col("m").alias("v")))
                       .filter(F.col("u") != F.col("v")).distinct(), "edges")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
