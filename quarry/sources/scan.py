"""Staged-file scans (S01-S06, S08, S17) and file formats.

A stage is just a path plus a format; reads are lazy DataFrames, so a "view
over files" is the same plan inlined wherever it is used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StringType, StructField, StructType

from quarry.schemas import SCHEMAS  # noqa: F401  (re-exported for callers)

ROW_ID = "_quarry_mid"
BLOCK = "_quarry_block"
FILE = "_quarry_file"


NO_DATA = "\u0001\u0002\u0001"


@dataclass(frozen=True)
class CsvFormat:
    """A named CSV file format.

    ``enclosure``: FIELD_OPTIONALLY_ENCLOSED_BY; ``escape``: escape char for
    the enclosure; ``escape_unenclosed``: escape char for the delimiter in
    unquoted fields (handled by a regex split, JVM side); ``multi_line``:
    enclosed fields may hold line ends, which costs the splitting of plain
    files (gzip files are read whole anyway).
    """
    delimiter: str = ","
    compression: str = "auto"
    enclosure: str | None = None
    escape: str | None = None
    escape_unenclosed: str | None = None
    skip_header: int = 0
    null_if: tuple[str, ...] = field(default_factory=tuple)
    empty_field_as_null: bool = True
    multi_line: bool = False

    def reader_options(self) -> dict[str, str]:
        o = {"sep": self.delimiter, "header": "true" if self.skip_header else "false",
             "mode": "PERMISSIVE"}
        o["quote"] = self.enclosure if self.enclosure else "\u0000"
        if self.enclosure and self.empty_field_as_null:
            # a token no data holds: an empty field reads as it, and so as NULL, an enclosed one as ''
            o["nullValue"] = NO_DATA
        if self.escape:
            o["escape"] = self.escape
        if self.multi_line:
            o["multiLine"] = "true"
        return o

    def writer_options(self, header: bool = True) -> dict[str, str]:
        # Spark's writer trims strings unless told otherwise
        o = {"sep": self.delimiter, "header": "true" if header else "false",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        comp = self.compression.lower()
        if comp not in ("auto", "none"):
            o["compression"] = comp
        if self.enclosure:
            o["quote"] = self.enclosure
            o["quoteAll"] = "false"
        else:
            o["quote"] = "\u0000"
        if self.escape:
            o["escape"] = self.escape
        return o


def apply_null_if(df: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """NULL_IF=(...): the reader takes one null token, the rest map here."""
    if not values:
        return df
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(*values), F.lit(None)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _without_first_lines(n: int):
    """Drop the first ``n`` lines of every file: rows come split by split, in
    order, and only the split at byte 0 holds a file's first lines."""
    def run(batches):
        import pyarrow as pa
        held, seen = None, 0
        for batch in batches:
            keep = []
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                if (path, start) != held:
                    held, seen = (path, start), 0
                seen += 1
                keep.append(start > 0 or seen > n)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def _skip_lines(spark: SparkSession, path: str | list[str], fmt: CsvFormat, schema: StructType | None,
                corrupt_col: str | None) -> DataFrame:
    """SKIP_HEADER above 1: lines dropped by position, the others parsed as CSV.
    With a corrupt column the file's metadata stay with every row."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"),
                                         F.col("_metadata.file_block_start").alias("start"))
    options = {**fmt.reader_options(), "header": "false"}
    if schema is None:
        names = spark.read.options(**options).csv(path).columns
        schema = StructType([StructField(c, StringType(), True) for c in names])
    fields = list(schema.fields)
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType(), True))
        options["columnNameOfCorruptRecord"] = corrupt_col
    rest = lines.mapInArrow(_without_first_lines(fmt.skip_header), "value string, path string, start long")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    out = rest.select(F.from_csv("value", ddl, options).alias("r"), F.struct(
        F.col("path").alias("file_path"), F.col("start").alias("file_block_start")).alias("_metadata"))
    return out.select("r.*", *(["_metadata"] if corrupt_col else []))


def _typed_null_if(df: DataFrame, schema: StructType, values: tuple[str, ...], sep: str,
                   corrupt_col: str | None) -> DataFrame:
    """Several null tokens in typed columns: columns read as text, tokens to
    NULL, then cast; a row with a value that does not cast is corrupt, and so is
    one the reader found corrupt (missing or extra fields)."""
    text = {f.name: F.col(f"`{f.name}`") for f in schema.fields}
    kept = {n: F.when(c.isin(*values), F.lit(None)).otherwise(c) for n, c in text.items()}
    cast = {f.name: kept[f.name].try_cast(f.dataType) for f in schema.fields}
    cols = [cast[f.name].alias(f.name) for f in schema.fields]
    if corrupt_col:
        bad = F.lit(False)
        for n in text:
            bad = bad | (kept[n].isNotNull() & cast[n].isNull())
        cols.append(F.coalesce(corrupt_col, F.when(bad, F.concat_ws(
            sep, *[F.coalesce(c, F.lit("")) for c in text.values()]))).alias(corrupt_col))
    # a column only for lines dropped by position; the reader's own stay in reach
    return df.select(*cols, *[c for c in df.columns if c == "_metadata"])


def _as_text(schema: StructType | None, fmt: CsvFormat) -> StructType | None:
    """Text columns where null tokens must be told from values before the cast."""
    if schema is None or not fmt.null_if:
        return schema
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def _null_if(df: DataFrame, schema: StructType | None, fmt: CsvFormat, corrupt_col: str | None) -> DataFrame:
    if schema is None or not fmt.null_if:
        return apply_null_if(df, fmt.null_if)
    return _typed_null_if(df, schema, fmt.null_if, fmt.delimiter, corrupt_col)


def read_csv(spark: SparkSession, path: str | list[str], fmt: CsvFormat,
             schema: StructType | None = None, corrupt_col: str | None = None) -> DataFrame:
    if fmt.skip_header > 1:
        return _null_if(_skip_lines(spark, path, fmt, _as_text(schema, fmt), corrupt_col), schema, fmt, corrupt_col)
    r = spark.read.options(**fmt.reader_options())
    typed = schema is not None and any(not isinstance(f.dataType, StringType) for f in schema.fields)
    if typed and len(fmt.null_if) == 1:
        r = r.option("nullValue", fmt.null_if[0])
    elif typed and fmt.null_if:
        raw = _as_text(schema, fmt)
        if corrupt_col:
            raw = StructType(raw.fields + [StructField(corrupt_col, StringType(), True)])
            r = r.option("columnNameOfCorruptRecord", corrupt_col)
        return _null_if(r.schema(raw).csv(path), schema, fmt, corrupt_col)
    if schema is not None:
        if corrupt_col:
            schema = StructType(schema.fields + [StructField(corrupt_col, StringType(), True)])
            r = r.option("columnNameOfCorruptRecord", corrupt_col)
        r = r.schema(schema)
    df = r.csv(path)
    if not fmt.empty_field_as_null:
        df = df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
                         if isinstance(f.dataType, StringType) and f.name != corrupt_col else F.col(f"`{f.name}`")
                         for f in df.schema.fields])
    return apply_null_if(df, fmt.null_if)


def scan_csv_positional(spark: SparkSession, path: str, fmt: CsvFormat,
                        positions: dict[int, str]) -> DataFrame:
    """SELECT $1 AS a, $2 AS b ... FROM @stage (S01): untyped columns by
    1-based ordinal. Unnamed ordinals are never projected, so the CSV
    parser skips them (column pruning)."""
    df = read_csv(spark, path, fmt)
    cols = df.columns
    return df.select(*[F.col(f"`{cols[p - 1]}`").alias(n) for p, n in sorted(positions.items())])


def split_escaped(line: Column, delimiter: str, escape: str, n: int) -> list[Column]:
    """Fields of a line whose delimiter may be escaped (``a\\,b,c``); the escape
    character escapes itself, escape + N is NULL, missing fields are NULL."""
    import re
    d, e = re.escape(delimiter), re.escape(escape)
    # a delimiter after an even number of escapes (up to 64) ends a field
    parts = F.split(line, f"(?<=(?<!{e})(?:{e}{e}){{0,32}}){d}")
    field = lambda i: F.get(parts, F.lit(i))
    return [F.when(field(i) == escape + "N", F.lit(None)).otherwise(F.regexp_replace(field(i), f"{e}(.)", "$1"))
            for i in range(n)]


def scan_escaped(spark: SparkSession, path: str, fmt: CsvFormat, names: list[str]) -> DataFrame:
    """Delimited text whose delimiters are escaped rather than enclosed. The
    header line is the one that equals the joined names."""
    lines = spark.read.text(path)
    if fmt.skip_header:
        lines = lines.filter(F.col("value") != fmt.delimiter.join(names))
    fields = split_escaped(F.col("value"), fmt.delimiter, fmt.escape_unenclosed or "\\", len(names))
    return lines.select(*[c.alias(n) for c, n in zip(fields, names)])


def write_escaped(df: DataFrame, path: str, fmt: CsvFormat) -> None:
    import re
    d, e = fmt.delimiter, fmt.escape_unenclosed or "\\"
    # the escape character first, then the delimiter; NULL is escape + N
    quoted = lambda s: s.replace("\\", "\\\\")  # noqa: E731  (in a replacement text)
    esc = [F.coalesce(F.regexp_replace(F.regexp_replace(F.col(c).cast("string"), re.escape(e), quoted(e + e)),
                                       re.escape(d), quoted(e + d)), F.lit(e + "N")) for c in df.columns]
    header = d.join(df.columns)
    body = df.select(F.concat_ws(d, *esc).alias("value"))
    if fmt.skip_header:
        # a header line per output file, via a tiny union kept in the same write
        spark = df.sparkSession
        body = spark.createDataFrame([(header,)], "value string").unionByName(body)
    body.write.mode("overwrite").text(path)


def scan_variant(spark: SparkSession, path: str, column: str = "v") -> DataFrame:
    """JSON documents into one VARIANT column (S04). A bad line gives NULL.

    Folders are read as plain nesting (no ``k=v`` partition inference): a
    single-variant scan that also carries partition values and file
    metadata fails in Spark 4.1, and a stage's folders are not table
    partitions anyway."""
    return (spark.read.option("singleVariantColumn", column)
            .option("recursiveFileLookup", "true").json(path))


def scan_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Typed JSON scan; a top-level array yields one row per element
    (STRIP_OUTER_ARRAY) (S05)."""
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 where: Column | None = None) -> DataFrame:
    """Parquet scan (S06); the projection and predicate reach the reader
    (ReadSchema / PushedFilters)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df


def select_files(df: DataFrame, pattern: str) -> DataFrame:
    """PATTERN='regex' of COPY INTO (S08): keep rows of files whose full
    path matches. The predicate is on a constant file-metadata column, so
    Spark prunes non-matching files before reading them."""
    return df.filter(F.col("_metadata.file_path").rlike(pattern))


def unload_json_arrays(df: DataFrame, path: str, bucket_col: str | None = None,
                       rows_per_doc: int = 64) -> None:
    """Write rows as JSON-array documents, one array per line.

    Documents hold at most ``rows_per_doc`` rows: rows are chunked by their
    position inside the producing task, never by a data key, so a hot key
    cannot make one huge document.
    """
    mid = F.monotonically_increasing_id()
    chunk = (F.shiftright(mid, 33) * F.lit(1 << 20) + F.floor((mid % F.lit(1 << 33)) / rows_per_doc))
    docs = (df.withColumn("_doc", chunk)
            .groupBy("_doc")
            .agg(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("value")))
    docs.select("value").write.mode("overwrite").text(path)


# ------------------------------------------------------------ provenance ----
def tag_rows(df: DataFrame) -> DataFrame:
    """Capture, in the scan itself, what row numbering needs later: the
    file, the start of the split the row came from, and a per-task
    monotonically increasing id (consecutive within a split)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "_metadata"],
                     F.col("_metadata.file_path").alias(FILE),
                     F.col("_metadata.file_block_start").alias(BLOCK),
                     F.monotonically_increasing_id().alias(ROW_ID))


def number_rows(tagged: DataFrame, out: str = "file_row_number", only: DataFrame | None = None) -> DataFrame:
    """1-based row number of each row inside its file (S17), for text
    formats that have no ``_metadata.row_index``.

    Prefix sums over splits: one small row per (file, split) gives each
    split's offset, which is joined back. No window ever holds a whole
    file, so a 100 GB file is numbered by as many tasks as it has splits.
    ``only`` is the part of ``tagged`` whose rows need a number.
    """
    splits = tagged.groupBy(FILE, BLOCK).agg(
        F.min(ROW_ID).alias("_first_id"), F.count(F.lit(1)).alias("_rows"))
    w = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(FILE, BLOCK, "_first_id",
                            F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_offset"))
    j = (tagged if only is None else only).join(offsets, [FILE, BLOCK])
    return (j.withColumn(out, F.col("_offset") + (F.col(ROW_ID) - F.col("_first_id")) + 1)
            .drop("_offset", "_first_id"))


def with_provenance(df: DataFrame, ingest_time: bool = True) -> DataFrame:
    """METADATA$FILENAME, METADATA$FILE_ROW_NUMBER and an NTZ ingest time."""
    n = number_rows(tag_rows(df))
    n = n.withColumn("filename", F.col(FILE))
    if ingest_time:
        n = n.withColumn("ingestedtimestamp", F.localtimestamp())
    return n.drop(BLOCK, ROW_ID, FILE)
