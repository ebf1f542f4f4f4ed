"""Fuzzy watchlist screening (J07): names within an edit distance of listed names.

Comparing every party with every entity would be a cross join. Two names within
distance d become equal once up to d characters are deleted from each, so the
strings that deletions leave (hashed) are the join keys. Such a string is a whole
name but for d characters: it joins only names that lie within 2 d edits of each
other, however common their words or letters are. Candidates are then checked by
their exact distance, in the stage of the join. Equal names are screened once.

A name of n characters has about n^d / d! keys; they are made one by one, never
as a list of a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.relational import normalise_name


def _keys(names: DataFrame, distance: int) -> DataFrame:
    """(name, key) of distinct names: a key of what is left for each choice of up to
    ``distance`` deletions. Of equal neighbours only the first ones are deleted, and
    cuts go from left to right, so a choice is made once."""
    rest, at, cut = F.col("rest"), F.col("at"), F.col("cut")
    rows = names.select("name", F.col("name").alias("rest"), F.lit(1).alias("at"))
    starts = F.filter(F.sequence(at, F.length(rest)), lambda i: (i == at) | (
        F.substr(rest, i, F.lit(1)) != F.substr(rest, i - 1, F.lit(1))))
    # 0 ends the cuts; behind the last character no cut is left
    cuts = F.when(at <= F.length(rest), F.concat(F.array(F.lit(0)), starts)).otherwise(F.array(F.lit(0)))
    for _ in range(distance):
        rows = rows.select("name", "rest", "at", F.explode(cuts).alias("cut")).select(
            "name",
            F.when(cut == 0, rest).otherwise(F.concat(F.substr(rest, F.lit(1), cut - 1), F.substr(rest, cut + 1)))
            .alias("rest"),
            F.when(cut == 0, F.length(rest) + 1).otherwise(cut).alias("at"))
    return rows.select("name", F.xxhash64("rest").alias("key"))


def similar_names(left: DataFrame, right: DataFrame, distance: int) -> DataFrame:
    """(name_a, name_b, distance) of all pairs of the distinct names in column
    ``name`` that lie within ``distance`` edits. NULL names have no partner."""
    if distance < 0:
        raise ValueError("distance must not be negative")
    a, b = (df.select("name").filter("name IS NOT NULL").distinct() for df in (left, right))
    x = _keys(a, distance).withColumnRenamed("name", "name_a")
    y = _keys(b, distance).withColumnRenamed("name", "name_b")
    apart = F.levenshtein("name_a", "name_b", distance)  # -1 if more than distance
    near = (F.abs(F.length("name_a") - F.length("name_b")) <= distance) & (apart >= 0)
    pairs = x.join(y, "key").filter(near).select("name_a", "name_b").distinct()
    return pairs.withColumn("distance", apart)


def parties(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """(party_kind, party_id, name): customers and the merchants they pay, normalised."""
    people = customers.select(F.lit("customer").alias("party_kind"), F.col("customer_id").alias("party_id"),
                              normalise_name(F.concat_ws(" ", "first_name", "last_name")).alias("name"))
    paid = (transactions.select("merchant_name").filter("merchant_name IS NOT NULL").distinct()
            .select(F.lit("counterparty").alias("party_kind"), F.col("merchant_name").alias("party_id"),
                    normalise_name(F.col("merchant_name")).alias("name")))
    return people.unionByName(paid)


def screen_fuzzy(who: DataFrame, watchlist: DataFrame, distance: int = 1) -> DataFrame:
    """Parties whose name lies within ``distance`` edits of a listed name: the
    columns of ``who``, entity_id, source, risk_category, distance."""
    listed = watchlist.select("entity_id", "source", "risk_category", normalise_name(F.col("entity_name")).alias("name_b"))
    hits = similar_names(who, listed.select(F.col("name_b").alias("name")), distance)
    return (who.join(hits.withColumnRenamed("name_a", "name"), "name").join(listed, "name_b")
            .select(*who.columns, "entity_id", "source", "risk_category", "distance"))

