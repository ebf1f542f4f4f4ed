"""Auto-ingest pipes of JSON documents into declared tables.

``COPY INTO table FROM (SELECT $1:field::type, ... FROM @stage)`` with
STRIP_OUTER_ARRAY and ON_ERROR = CONTINUE: every document line is parsed to
VARIANT, its elements become rows, and an element that does not fit the
declared schema goes to the reject table with the names of its bad fields.
Everything is a built-in expression inside the scan of a micro-batch; no
shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions import nested
from quarry.streaming import ingest

REASON = "rejected_fields"


class JsonPipe:
    """One pipe: landing folder (nested folders included), raw table, reject
    table, run log and stream offset, all below ``root``.

    Documents are lines; ``whole_files`` reads a file as one document, for
    arrays printed over several lines.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType,
                 names: dict[str, str] | None = None, whole_files: bool = False):
        self.spark, self.schema, self.names = spark, schema, names
        self.landing, self.target = f"{root}/landing", f"{root}/raw"
        self.rejects, self.checkpoint, self.log = f"{root}/rejects", f"{root}/_checkpoint", f"{root}/run_log"
        self.options = {"recursiveFileLookup": "true", "wholetext": str(whole_files).lower()}
        self.run_id = 0

    def split(self, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Typed rows and rejects of document lines (column ``value``)."""
        elements = nested.strip_outer_array(lines, "value")
        cols, reasons = nested.typed_fields("element", self.schema, self.names)
        good = elements.filter(F.size(reasons) == 0).select(*cols)
        bad = elements.filter(F.size(reasons) > 0).select(
            F.coalesce(F.to_json("element"), F.col("value")).alias("record"), reasons.alias(REASON),
            F.col("_file").alias("filename"))
        return good, bad

    def _batch(self, lines: DataFrame, batch_id: int) -> None:
        good, bad = self.split(lines)
        ingest.append_batch(good.withColumn("run_id", F.lit(self.run_id)), self.target, batch_id)
        ingest.append_batch(bad, self.rejects, batch_id)
        ingest.log_batch(lines, self.log, batch_id, self.run_id)

    def refresh(self) -> None:
        """ALTER PIPE ... REFRESH: load every landed file not loaded yet."""
        self.run_id += 1
        s = ingest.file_stream(self.spark, self.landing, "text", "value string", self.options)
        ingest.run(s, self._batch, self.checkpoint)

    def table(self) -> DataFrame:
        return ingest.appended(self.spark, self.target)

    def rejected(self) -> DataFrame:
        return ingest.appended(self.spark, self.rejects)
