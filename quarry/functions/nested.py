"""Semi-structured helpers: VARIANT paths, casts, flatten, shredding (C06,
C09-C13, N01-N03).

Everything is a built-in expression or generator (``variant_get``,
``try_variant_get``, ``variant_explode``), evaluated per row inside the scan
stage — no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.scalars import default_zip


def path(v: Column, p: str, type_: str = "string", strict: bool = False) -> Column:
    """``v:p::type``. Load paths use the lenient form: a value that does not
    cast becomes NULL instead of failing the load."""
    jp = p if p.startswith("$") else f"$.{p}"
    fn = F.variant_get if strict else F.try_variant_get
    return fn(v, jp, type_)


def parse(text: Column, strict: bool = False) -> Column:
    """PARSE_JSON (C09); ``strict=False`` turns malformed text into NULL."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def flatten(df: DataFrame, v: str, outer: bool = False) -> DataFrame:
    """LATERAL FLATTEN(input => v) (N01/J05): one row per array element or
    object field, with ``pos``, ``key`` and ``value`` columns. The inner
    form drops rows whose input is NULL or empty."""
    spark = df.sparkSession
    tvf = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    return df.alias("_doc").lateralJoin(tvf(F.col(f"_doc.`{v}`").outer()))


def object_of_row(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """OBJECT_CONSTRUCT(*) (C12): the whole row as one VARIANT object."""
    cols = [F.col(f"`{c}`") for c in df.columns if c not in exclude]
    return F.to_variant_object(F.struct(*cols))


PERSON_FIELDS = {"id": "string", "name": "string", "age": "int", "location": "string"}


def shred_persons(docs: DataFrame, v: str = "v") -> DataFrame:
    """Person documents (an array, or an object, of persons) to typed rows
    with the default zip (N02). Provenance columns present on ``docs`` are
    carried along."""
    flat = flatten(docs, v)
    cols = [path(F.col("value"), f, t).alias(f) for f, t in PERSON_FIELDS.items()]
    zip_ = default_zip(path(F.col("value"), "zip", "string")).alias("zip")
    keep = [c for c in docs.columns if c != v]
    return flat.select(*cols, zip_, *keep, "pos")


def marts(master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PERSON_AGE(name, age) and PERSON_LOCATION(name, location) (N03),
    recomputed from the master so re-runs never duplicate rows (D6)."""
    return master.select("name", "age"), master.select("name", "location")


def strip_outer_array(docs: DataFrame, text: str, element: str = "element") -> DataFrame:
    """STRIP_OUTER_ARRAY: one row per element of a document that is an array,
    one row for any other document; ``element`` is a VARIANT. Text that is no
    JSON keeps one row whose element is NULL; blank text and empty arrays give
    none. The other columns, the text included, are carried along."""
    v = F.try_parse_json(F.col(f"`{text}`"))
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))
    return (docs.filter(F.trim(F.regexp_replace(F.col(f"`{text}`"), r"\s+", " ")) != "")
            .select("*", F.explode(items).alias(element)))


def typed_fields(element: str, schema: StructType, names: dict[str, str] | None = None) -> tuple[list[Column], Column]:
    """``$1:field::type`` for every column of ``schema`` out of one element, and
    the reasons why a load should reject it: ``not an object``, or the columns
    whose value is there but does not cast. ``names`` maps a column to a JSON
    field of another name (JSON names are case-sensitive)."""
    v = F.col(f"`{element}`")
    cols, bad = [], [F.when(~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)),
                            F.lit("not an object"))]
    for f in schema.fields:
        p = f"$['{(names or {}).get(f.name, f.name)}']"
        c = F.try_variant_get(v, p, f.dataType.simpleString())
        there = F.try_variant_get(v, p, "variant")
        bad.append(F.when(there.isNotNull() & ~F.is_variant_null(there) & c.isNull(), F.lit(f.name)))
        cols.append(c.alias(f.name))
    return cols, F.array_compact(F.array(*bad))
