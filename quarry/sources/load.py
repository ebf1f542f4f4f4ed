"""COPY INTO with error policies, a load ledger and a load audit.

Source files are parsed exactly once, into a staging parquet table that
keeps every row (good or bad) with its file, split and position. The
error policy, the target load and the per-file audit are then cheap
columnar reads of that stage; only bad rows get their row number.

* CONTINUE   – good rows load, bad rows are reported;
* SKIP_FILE  – files with any bad row load nothing (left-anti join on the
               set of bad files, one row per file);
* ABORT      – any bad row fails the statement before the target is touched.

With a ledger a file is loaded once: files are told apart by path, length and
modification time, files that the ledger holds are left out before anything is
read, and files of which no row loaded are not entered. The rows of a load
have a folder of their own, named after its files, so a load that is run again
after a crash before its ledger entry replaces its rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.sources import scan
from quarry.sources.scan import CsvFormat

CORRUPT = "_corrupt_record"


@dataclass
class LoadResult:
    loaded: DataFrame      # rows now in the target
    audit: DataFrame       # one row per source file
    rejected: DataFrame    # bad rows with file and row number


class LoadError(RuntimeError):
    pass


def stage_csv(spark: SparkSession, source: str | list[str], fmt: CsvFormat, schema: StructType,
              stage_path: str, pattern: str | None = None) -> DataFrame:
    """Parse once; persist rows + provenance + error text to parquet."""
    df = scan.read_csv(spark, source, fmt, schema=schema, corrupt_col=CORRUPT)
    if pattern:
        df = scan.select_files(df, pattern)
    scan.tag_rows(df).write.mode("overwrite").parquet(stage_path)
    return spark.read.parquet(stage_path)


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


LEDGER = ("file", "length", "modified")


def files_to_load(spark: SparkSession, source: str, ledger: str, pattern: str | None = None,
                  force: bool = False) -> DataFrame:
    """Files under ``source`` that the ledger does not hold: path and LEDGER columns.
    Only the listing is read, never the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"))
    if pattern:
        files = files.filter(F.col("file").rlike(pattern))
    known = None if force else _read_or_none(spark, ledger)
    return files if known is None else files.join(known.select(*LEDGER), list(LEDGER), "left_anti")


def loaded_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows of all loads into a target that has a ledger."""
    rows = _read_or_none(spark, target)
    return spark.createDataFrame([], schema) if rows is None else rows.drop("load_id")


def _audited(tagged: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """Per-file audit and the numbered bad rows."""
    bad = F.col(CORRUPT).isNotNull()
    rejected = scan.number_rows(tagged, only=tagged.filter(bad)).select(
        F.col(scan.FILE).alias("file"), "file_row_number", F.col(CORRUPT).alias("error_record"))
    first = rejected.groupBy("file").agg(F.min("file_row_number").alias("first_error_line"),
                                         F.min_by("error_record", "file_row_number").alias("first_error"))
    counts = tagged.groupBy(F.col(scan.FILE).alias("file")).agg(
        F.count(F.lit(1)).alias("rows_parsed"), F.count(F.when(bad, 1)).alias("errors_seen"))
    loaded = F.col("rows_parsed") - F.col("errors_seen")
    if policy == "skip_file":
        loaded = F.when(F.col("errors_seen") > 0, F.lit(0)).otherwise(F.col("rows_parsed"))
    audit = counts.join(first, "file", "left").withColumn("rows_loaded", loaded).withColumn(
        "status", F.when(F.col("errors_seen") == 0, "LOADED")
        .when(F.col("rows_loaded") > 0, "PARTIALLY_LOADED").otherwise("LOAD_FAILED"))
    return audit.select("file", "rows_parsed", "errors_seen", "first_error_line", "first_error", "rows_loaded",
                        "status"), rejected


def copy_into(spark: SparkSession, source: str, fmt: CsvFormat, schema: StructType,
              target: str, stage_path: str, on_error: str = "abort_statement",
              pattern: str | None = None, mode: str = "append", ledger: str | None = None,
              force: bool = False, audit_path: str | None = None, table: str = "",
              load_time: datetime | None = None) -> LoadResult:
    """COPY INTO ``target``. With ``ledger`` (a folder) files load once, unless
    ``force``; with ``audit_path`` the audit is appended there as well, for ``table``
    at ``load_time`` (now)."""
    policy = {"abort": "abort_statement"}.get(on_error.lower(), on_error.lower())
    if policy not in ("continue", "skip_file", "abort_statement"):
        raise ValueError(on_error)
    where, files = target, None
    if ledger:
        files = files_to_load(spark, source, ledger, pattern, force)
        # the driver lists a source's files in any case
        listed = sorted((r.path, r.file, r.length, r.modified) for r in files.collect())
        files = spark.createDataFrame([x[1:] for x in listed], files.select(*LEDGER).schema)
        load_id = hashlib.md5(repr([x[1:] for x in listed]).encode()).hexdigest()
        if force:
            load_id += datetime.now().strftime("-%Y%m%d%H%M%S%f")
        source, pattern, mode = [x[0] for x in listed], None, "overwrite"
        where, stage_path = f"{target}/load_id={load_id}", f"{stage_path}/{load_id}"
    if source:
        tagged = stage_csv(spark, source, fmt, schema, stage_path, pattern)
    else:
        tagged = spark.createDataFrame([], StructType(schema.fields)).withColumns(
            {CORRUPT: F.lit(None).cast("string"), scan.FILE: F.lit(""), scan.BLOCK: F.lit(0).cast("long"),
             scan.ROW_ID: F.lit(0).cast("long")})
    bad = F.col(CORRUPT).isNotNull()
    if policy == "abort_statement" and tagged.filter(bad).limit(1).count():
        raise LoadError("bad rows in source; ON_ERROR=ABORT_STATEMENT")
    good = tagged.filter(~bad)
    if policy == "skip_file":
        good = tagged.join(tagged.filter(bad).select(scan.FILE).distinct(), scan.FILE, "left_anti")
    audit, rejected = _audited(tagged, policy)
    if source:
        good.select(*[f.name for f in schema.fields]).write.mode(mode).parquet(where)
    if audit_path:
        record_audit(audit, audit_path, table, load_time)
    if ledger and source:
        failed = audit.filter("status = 'LOAD_FAILED'").select("file")
        (files.join(failed, "file", "left_anti").withColumn("load_id", F.lit(load_id))
         .coalesce(1).write.mode("append").parquet(ledger))
    return LoadResult(loaded_rows(spark, target, schema) if ledger else spark.read.parquet(target), audit, rejected)


def load_history(audit_path: str, spark: SparkSession, since=None, until=None, table: str | None = None) -> DataFrame:
    """COPY_HISTORY(table, start_time, end_time): audit rows of the loads in the
    window, both ends included."""
    h = spark.read.parquet(audit_path)
    for cond in ((F.col("load_time") >= F.lit(since)) if since is not None else None,
                 (F.col("load_time") <= F.lit(until)) if until is not None else None,
                 (F.col("table_name") == table) if table is not None else None):
        h = h if cond is None else h.filter(cond)
    return h


def record_audit(audit: DataFrame, audit_path: str, table: str, load_time: datetime | None = None) -> None:
    at = F.localtimestamp() if load_time is None else F.lit(load_time).cast("timestamp_ntz")
    (audit.withColumn("table_name", F.lit(table)).withColumn("load_time", at)
     .coalesce(1).write.mode("append").parquet(audit_path))
