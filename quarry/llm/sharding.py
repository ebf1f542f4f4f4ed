"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0..N-1 in ascending id order. A Feistel network with
modular addition over the grid [0, a) x [0, b), a*b >= N, permutes the
numbers; results that fall outside [0, N) walk on along their cycle until
they fall inside. Place p of the shuffle is slot ``p div shards`` of shard
``p mod shards``, so both are computable from the row number alone and
shard sizes differ by at most one. Only SQL functions are used.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import before, by_range, require_columns, staged

ROUNDS = 6
#: Of a*b - N < a outside numbers a walk of ``a`` steps must leave; from 64 up
#: the share of outside numbers is under 1/64, and 64 steps in a row miss never.
WALK = 64


def row_numbers(df: DataFrame, *order: str) -> DataFrame:
    """Add ``row_number`` (0-based, dense) by ``order``; one range shuffle and a
    count per part. Rows equal in every order column are interchangeable."""
    part = F.spark_partition_id()
    tagged = by_range(df, *order).withColumn("_part", part).withColumn(
        "_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    t = staged(tagged, "rows")
    base = before(t.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), "_part", "_n", "_base")
    return (t.join(base.select("_part", "_base"), "_part")
            .withColumn("row_number", F.col("_base") + F.col("_local")).drop("_part", "_local", "_base"))


def _round(x: Column, key: int, n: int) -> Column:
    return F.pmod(F.xxhash64(x, F.lit(key).cast("long")), F.lit(n))


def _step(k: int, key: int, a: int, b: int):
    """Round ``k`` of the network, of one argument: transform() would pass a second one the index."""
    if k % 2 == 0:
        return lambda s: F.struct(F.pmod(s["l"] + _round(s["r"], key, a), F.lit(a)).alias("l"), s["r"].alias("r"))
    return lambda s: F.struct(s["l"].alias("l"), F.pmod(s["r"] + _round(s["l"], key, b), F.lit(b)).alias("r"))


def feistel(x: Column, n: int, seed: int) -> Column:
    """One pass of the network over [0, a*b); a bijection for every seed."""
    a, b = grid(n)
    left, right = (x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b))
    state = F.struct(left.alias("l"), right.alias("r"))
    for k in range(ROUNDS):
        # bind each round's state once: an array of one element and transform
        state = F.transform(F.array(state), _step(k, seed * 1000 + k, a, b))[0]
    done = F.transform(F.array(state), lambda s: s["l"] * F.lit(b) + s["r"])
    return done[0]


def grid(n: int) -> tuple[int, int]:
    a = max(1, isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def permuted(x: Column, n: int, seed: int) -> Column:
    """Feistel with cycle walking: a permutation of [0, n)."""
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), feistel(x, n, seed),
                       lambda p, _: F.when(p >= F.lit(n), feistel(p, n, seed)).otherwise(p))
    # aggregate() merges into the type of its start: both are long
    return F.when(walk < F.lit(n), walk).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def shard(df: DataFrame, order: list[str], shards: int = 8, seed: int = 20) -> DataFrame:
    """Add ``shard`` and ``slot`` to every row.

    NULL order values sort first; an empty table gives an empty result; rows
    equal in all order columns get distinct places in either order. The input
    columns ``shard`` and ``slot`` must not exist yet (ValueError).
    """
    require_columns(df, *order)
    clash = {"shard", "slot", "row_number", "_part", "_local", "_base"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result")
    numbered = row_numbers(df, *order)
    n = df.count()
    place = permuted(F.col("row_number"), n, seed)
    return (numbered.withColumn("_p", place)
            .withColumn("shard", F.pmod(F.col("_p"), F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("_p") / F.lit(shards)).cast("long"))
            .drop("_p", "row_number"))


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 20) -> DataFrame:
    """Per document: size, text_crc32, law ``rows``, shard, slot, grown_shard NULL.

    A NULL text counts as empty (size 1, crc 0). Repeated ids keep a place each.
    """
    require_columns(docs, "doc_id", "text")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    return shard(slim, ["doc_id", "text_crc32", "size"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
