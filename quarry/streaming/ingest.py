"""Continuous file ingest with Structured Streaming.

* a pipe = a file-source ``readStream`` plus a checkpoint: each file is
  processed once, across restarts (the checkpoint is the stream offset);
* ALTER PIPE ... REFRESH = ``trigger(availableNow=True)``: drain the
  backlog, stop; a second run picks up only files that arrived since;
* a task every minute WHEN stream has data = ``trigger(processingTime=
  '1 minute')``: a micro-batch runs only when new files exist;
* the stored procedure = a ``foreachBatch`` function, made idempotent by
  recording the batch id it committed.

Tables written by merges are versioned folders plus one pointer row per
commit, appended and never overwritten, so readers never see a half-written
table and a replayed batch is a no-op. Plain inserts have a folder per batch.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

RUN_LOG = "run_id int, batch_id long, num_input_rows long, started string"


def file_stream(spark: SparkSession, path: str, fmt: str, schema: StructType | str,
                options: dict[str, str] | None = None) -> DataFrame:
    """A pipe's source: new files under ``path`` as a streaming frame,
    with the file name of every row (METADATA$FILENAME), the file's time and the
    start of the split the row came from (for row numbers, ``scan.number_rows``)."""
    r = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(path)
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_file_time": F.col("_metadata.file_modification_time"),
                           "_file_start": F.col("_metadata.file_block_start")})


def run(df: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
        trigger: str = "availableNow", name: str | None = None) -> StreamingQuery:
    """Start a foreachBatch stream. ``availableNow`` drains and returns after
    termination; a processing-time trigger ("1 minute") keeps running."""
    w = df.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger == "availableNow":
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    else:
        q = w.trigger(processingTime=trigger).start()
    return q


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """INSERT of one micro-batch: its rows have a folder of their own, so a
    batch that is run again after a failure replaces its rows."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id:09d}")


def appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that ``append_batch`` wrote."""
    return spark.read.parquet(path).drop("batch_id")


def log_batch(df: DataFrame, path: str, batch_id: int, run_id: int) -> None:
    """TASK_HISTORY / pipe status: one row per micro-batch of a run, kept with
    ``append_batch``, so no batch leaves the log and a replay replaces its row."""
    started = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
    row = df.sparkSession.createDataFrame([(run_id, batch_id, df.count(), started)], RUN_LOG)
    append_batch(row.withColumnRenamed("batch_id", "_batch"), path, batch_id)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``log_batch``."""
    return appended(spark, path).withColumnRenamed("_batch", "batch_id")


class VersionedTable:
    """A table folder of immutable versions plus a pointer row naming the
    live one and the last batch id that produced it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def _pointer(self) -> str:
        return f"{self.path}/_pointer"

    def state(self) -> tuple[str | None, int | None]:
        try:
            rows = self.spark.read.schema("version string, batch_id long").json(self._pointer)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None, None
        row = rows.orderBy(F.desc("batch_id")).first()
        return (row["version"], int(row["batch_id"])) if row else (None, None)

    def read(self) -> DataFrame:
        version, _ = self.state()
        if version is None:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(version)

    def commit(self, df: DataFrame, batch_id: int) -> bool:
        """Write a new version and move the pointer; False when this batch id
        was already committed (replay)."""
        _, last = self.state()
        if last is not None and batch_id <= last:
            return False
        version = f"{self.path}/v{batch_id + 1:09d}"
        df.write.mode("overwrite").parquet(version)
        (self.spark.createDataFrame([(version, batch_id)], "version string, batch_id long")
         .coalesce(1).write.mode("append").json(self._pointer))
        return True
