"""Unload and table writes.

Unloading is write-bound (the reference measured 93.5% of its time in the
unload step), so file count is controlled by the data's own partitioning:
every task writes its own files in parallel; nothing funnels through one
writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType

from quarry.sources.scan import CsvFormat

GZIP_CSV = CsvFormat(compression="gzip", enclosure='"', escape='"', skip_header=1, multi_line=True)


def unload_csv(df: DataFrame, path: str, fmt: CsvFormat = GZIP_CSV, header: bool = True,
               prefix: str | None = None, mode: str = "overwrite") -> str:
    """COPY INTO @stage/prefix FROM (query) (S10/S11). A prefix becomes a
    sub-folder. The header is written so a SKIP_HEADER=1 reader loses no
    row (D10)."""
    target = f"{path}/{prefix}" if prefix else path
    df.write.mode(mode).options(**fmt.writer_options(header=header)).csv(target)
    return target


def unload_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """FILE_FORMAT=(TYPE='PARQUET' SNAPPY_COMPRESSION=TRUE)."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def ctas(df: DataFrame, path: str) -> DataFrame:
    """CREATE TABLE ... AS SELECT (S13): materialise, then read back. The
    returned frame's lineage starts at the written files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """INSERT INTO table SELECT ...."""
    df.write.mode("append").parquet(path)


def view_over(df: DataFrame, name: str) -> DataFrame:
    """CREATE VIEW over files (S14): only the plan is stored; every query
    of the view re-reads the files (and prunes columns/filters)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


FILE_BYTES = 128 << 20  # of rows of the schema's default size, for each file of a clustered table
RANK_BITS = 6  # a key's values fall into 2^6 quantile ranks


def _measure(df: DataFrame, key: str) -> Column:
    """A number in the order of the key: dates and times as seconds, strings by their first six bytes."""
    kind = df.schema[key].dataType
    if isinstance(kind, StringType):
        first = F.rpad(F.hex(F.substring(F.col(key).cast("binary"), 1, 6)), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(F.col(key)).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(key)).cast("double")
    return F.col(key).cast("double")


def _cuts_below(value: Column, bars: Column, steps: Column) -> Column:
    """Number of sorted ``bars`` at or below the value, by halving; NULL has none."""
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(bars, at + step - 1) <= value, F.lit(False)), at + step).otherwise(at))


def z_order(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Add ``out``: the bits of every key's quantile rank in turn, so rows that are
    near in all keys get near numbers. NULL ranks first. The cuts (at most 63 a
    key) are approximate quantiles; only the balance depends on them."""
    ranks = []
    measured = df.withColumns({f"_m{i}": _measure(df, k) for i, k in enumerate(keys)})
    cuts = measured.approxQuantile([f"_m{i}" for i in range(len(keys))],
                                   [j / (1 << RANK_BITS) for j in range(1, 1 << RANK_BITS)], 0.002)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(RANK_BITS))])
    for i, own in enumerate(cuts):
        bars = F.array(*[F.lit(float(x)) for x in sorted(set(own))] or [F.lit(None).cast("double")])
        ranks.append(_cuts_below(F.col(f"_m{i}"), bars, steps))
    bits = F.lit(0).cast("long")
    held = measured.withColumns({f"_r{i}": r for i, r in enumerate(ranks)})
    for b in range(RANK_BITS):
        for i in range(len(keys)):
            one = F.shiftright(F.col(f"_r{i}"), b).bitwiseAND(F.lit(1)).cast("long")
            bits = bits + F.shiftleft(one, b * len(keys) + (len(keys) - 1 - i))
    return held.withColumn(out, bits).drop(*[f"_{x}{i}" for i in range(len(keys)) for x in "mr"])


def write_clustered(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None,
                    files: int | None = None) -> DataFrame:
    """Cluster-key layout (M10): rows near in the keys share files, so per-file
    min/max statistics are tight and later filters skip files. One key is a plain
    sort; several are laid out along their z-order, so a filter on any of them skips.
    At most ten keys. Without ``files`` there is one for each FILE_BYTES of rows."""
    if not 1 <= len(keys) <= 10:
        raise ValueError("one to ten cluster keys")
    n = files or max(1, -(-df.count() * df._jdf.schema().defaultSize() // FILE_BYTES))
    order = keys
    if len(keys) > 1:
        df, order = z_order(df, keys, "_z"), ["_z", *keys]
    laid = df.repartitionByRange(int(n), *order).sortWithinPartitions(*order).drop("_z")
    w = laid.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
