"""RAW → CLEANSED → REPORT layering.

CLEANSED: strings trimmed, values cast with ``try_cast`` (a row whose
value does not cast goes to the reject table instead of failing the job),
one row per key — the latest version by ingest sequence, chosen with a
partial ``max_by`` aggregate so a hot key never lands whole in one task.
REPORT: aggregates of the cleansed table. ``write_layers`` keeps every layer
as a table of its own; each is computed from the one written before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType, VariantType

#: columns the reject table adds: the columns that did not cast
REASON = "rejected_columns"


@dataclass
class Layers:
    cleansed: DataFrame
    rejects: DataFrame


def cleanse(raw: DataFrame, schema: StructType, key: str, seq: str) -> Layers:
    """Both outputs of the cleansing. ``raw`` holds text (or VARIANT) columns.

    A row is rejected if a column that is not NULL does not cast; it keeps its
    raw columns and names the failing ones in ``rejected_columns``. Of the
    rows of a key (NULL is one key) the highest ``seq`` stays; equal ones are
    decided by the columns, so the choice is the same in every run. A rejected
    version does not hide an older good one.
    """
    typed_cols, bad = [], []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            typed_cols.append(F.trim(c).alias(f.name))
        elif isinstance(f.dataType, VariantType):
            typed_cols.append(c)
        else:
            t = F.expr(f"try_cast(trim(`{f.name}`) AS {f.dataType.simpleString()})")
            bad.append(F.when(c.isNotNull() & t.isNull(), F.lit(f.name)))
            typed_cols.append(t.alias(f.name))
    reasons = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    good = raw.filter(F.size(reasons) == 0).select(*typed_cols, F.col(seq).alias("_seq"))
    others = [f for f in schema.fields if f.name != key]
    ranked = [F.col(f"`{f.name}`") for f in others if not isinstance(f.dataType, (VariantType, MapType))]
    latest = good.groupBy(f"`{key}`").agg(F.max_by(
        F.struct(*[F.col(f"`{f.name}`") for f in others]), F.struct(F.col("_seq"), *ranked)).alias("_l"))
    cleansed = latest.select(*[F.col(f"`{key}`") if f.name == key else F.col(f"_l.`{f.name}`").alias(f.name)
                               for f in schema.fields])
    return Layers(cleansed, raw.filter(F.size(reasons) > 0).withColumn(REASON, reasons))


@dataclass
class Warehouse:
    """Folders of the written layers under one root."""
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def cleansed(self) -> str:
        return f"{self.root}/cleansed"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    def report(self, name: str) -> str:
        return f"{self.root}/report/{name}"


def write_layers(raw: DataFrame, schema: StructType, key: str, seq: str, root: str,
                 reports: dict[str, Callable[[DataFrame], DataFrame]]) -> Warehouse:
    """Write RAW, CLEANSED, rejects and one table per report.

    The source is read once, into RAW; the later layers read what was written.
    Each table replaces its earlier state, so a run that died half way is
    simply run again.
    """
    spark = raw.sparkSession
    wh = Warehouse(root.rstrip("/"))
    raw.write.mode("overwrite").parquet(wh.raw)
    lay = cleanse(spark.read.parquet(wh.raw), schema, key, seq)
    lay.rejects.write.mode("overwrite").parquet(wh.rejects)
    lay.cleansed.write.mode("overwrite").parquet(wh.cleansed)
    cleansed = spark.read.parquet(wh.cleansed)
    for name, report in reports.items():
        report(cleansed).write.mode("overwrite").parquet(wh.report(name))
    return wh
