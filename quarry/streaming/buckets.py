"""Merged tables whose rewrites touch changed hash buckets only.

Rows live in folders ``version=<v>/bucket=<b>`` (Spark partition columns); a
bucket is the hash of the key, so a batch names the buckets it may change before
any of the target is read. A commit reads, merges and writes those buckets
into a folder of its own version and then appends one small manifest that
names them. The live version of a bucket is the highest one a manifest names,
all other buckets keep their files. A batch that runs again after a crash
overwrites its own version folder; one that was committed is a no-op.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

MANIFEST = "batch_id long, bucket int, has_rows boolean"


class BucketedTable:
    """``schema`` is the table's, ``key`` the column whose hash deals the rows."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType | str, buckets: int = 32):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = spark.createDataFrame([], schema).schema

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def state(self) -> tuple[dict[int, int], int | None]:
        """Live version of every bucket that holds rows (at most ``buckets`` entries), and the last batch."""
        try:
            manifest = self.spark.read.schema(MANIFEST).json(f"{self.path}/_manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}, None
        rows = manifest.groupBy("bucket").agg(F.max("batch_id").alias("batch_id"),
                                              F.max_by("has_rows", "batch_id").alias("has_rows")).collect()
        if not rows:
            return {}, None
        return ({r.bucket: r.batch_id for r in rows if r.has_rows}, max(r.batch_id for r in rows))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/data/version={batch_id + 1:09d}"

    def read(self, only: set[int] | None = None) -> DataFrame:
        """The live rows, of the buckets ``only`` where given."""
        live, _ = self.state()
        paths = [f"{self._folder(v)}/bucket={b}" for b, v in sorted(live.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def commit(self, batch: DataFrame, batch_id: int,
               merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> bool:
        """Merge ``batch`` (rows with the key column) into the table: ``merge(old, batch)``
        gets the rows of the buckets that the batch touches and returns their new
        content; without it the batch replaces the whole table. False if this
        batch id was committed before."""
        live, last = self.state()
        if last is not None and batch_id <= last:
            return False
        batch = batch.persist()
        try:
            touched = ({r[0] for r in batch.select(self.bucket()).distinct().collect()} if merge
                       else set(range(self.buckets)))
            rows = merge(self.read(touched), batch) if merge else batch
            folder = self._folder(batch_id)
            own = [f.name for f in self.schema]
            # one file a bucket, not one a task and bucket
            (rows.select(*own).withColumn("bucket", self.bucket()).repartition(max(1, len(touched)), "bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(folder))
        finally:
            batch.unpersist()
        written = self.spark.read.schema(StructType([StructField("bucket", IntegerType())])).parquet(folder)
        filled = {r[0] for r in written.distinct().collect()}
        # a batch without rows is recorded as well, under no bucket
        manifest = [(batch_id, b, b in filled) for b in sorted(touched)] or [(batch_id, -1, False)]
        self.spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.mode("append").json(f"{self.path}/_manifest")
        return True
