"""What several operators share: staged tables, ordered parts, shape checks."""

from __future__ import annotations

import ctypes
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch

#: The white space the text contracts name: space and tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it again.

    Cuts the lineage: a later loss of an executor re-reads files instead of
    recomputing, and rows whose content depends on how they were dealt
    (partition numbers) stay as they were written.
    """
    spark = df.sparkSession
    path = scratch(spark, f"llm-{name}")
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is planned and run inside: a
    batch of whole texts is held several times over, by the JVM and by the worker."""
    held = spark.conf.get(BATCH_ROWS)
    small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, held)


def small_batches(spark: SparkSession, rows: int) -> None:
    """Lower the session's rows in an Arrow batch to ``rows``."""
    held = int(spark.conf.get(BATCH_ROWS))
    if held <= 0 or held > rows:
        spark.conf.set(BATCH_ROWS, rows)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_range(df: DataFrame, *order) -> DataFrame:
    """Deal rows by range of the first column and sort each part by all of
    ``order``: part k holds the rows just below those of part k + 1."""
    return (df.repartitionByRange(shuffle_parts(df.sparkSession), order[0])
            .sortWithinPartitions(*order))


def before(totals: DataFrame, part: str, size: str, out: str, *group: str) -> DataFrame:
    """``totals`` has one row per part (and group); add the sum of ``size`` over
    smaller parts. A self-join on blocks of 1,024 parts keeps every window
    bounded, so no task sees all parts of a large table at once."""
    from pyspark.sql import Window
    blk = (F.col(part) / 1024).cast("long")
    t = totals.withColumn("_blk", blk)
    coarse = t.groupBy("_blk", *group).agg(F.sum(size).alias("_s"))
    w_c = Window.partitionBy(*group).orderBy("_blk") if group else Window.partitionBy(F.lit(0)).orderBy("_blk")
    coarse = coarse.select("_blk", *group, (F.sum("_s").over(w_c) - F.col("_s")).alias("_base"))
    w_f = Window.partitionBy("_blk", *group).orderBy(part)
    fine = t.withColumn("_in", F.sum(size).over(w_f) - F.col(size))
    on = reduce(lambda a, b: a & b, [F.col(f"f.{g}").eqNullSafe(F.col(f"c.{g}")) for g in ("_blk", *group)])
    return (fine.alias("f").join(coarse.alias("c"), on)
            .select(*[F.col(f"f.{c}") for c in totals.columns], (F.col("_in") + F.col("_base")).alias(out)))


def require_columns(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a table that must be small by its nature; fail loudly, never cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows")
    return rows


#: what operators keep in a Python worker from task to task
_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """The dict that ``owner`` keeps in this Python worker. Workers outlive stages:
    a task that asks for its own drops what other operators left."""
    others = [o for o in _KEPT if o != owner]
    for other in others:
        del _KEPT[other]
    if others:
        return_memory()
    return _KEPT.setdefault(owner, {})


def return_memory() -> None:
    """Freed memory of this Python worker goes back to the system, or it keeps its peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def task_of(owner: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a task of ``owner``: it begins without other operators' caches and
    ends by returning freed memory, as the worker waits beside the JVM and later stages."""
    def task(batches: Iterator) -> Iterator:
        worker_cache(owner)
        try:
            yield from run(batches)
        finally:
            return_memory()
    return task


def dump_json(value) -> str:
    return json.dumps(value, sort_keys=True)


def small(df: DataFrame, limit: int = 200_000) -> DataFrame:
    """Hint a broadcast only if ``df`` has at most ``limit`` (narrow) rows; a
    larger table joins by a shuffle, with the same result."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
