"""Compress vectors to product-quantiser codes with exact integer distances.

Components become integers, vectors are cut into equal parts, and every part
position has a codebook of its own that two rounds of assignment and averaging
improve. A distance is |x|^2 - 2 x.c + |c|^2; the products x.c come from float64
matrix products of limbs: integers are broken into ``LIMB`` bits, so that every
sum of a product stays below 2^53 and is exact, and the products are put
together again as 64-bit integers. Ties go to the first smallest distance.

Each round is one pass over the staged vectors: a task returns the sums and
counts of its parts per codebook entry, Spark adds them up, and the codebooks
(entries x dimension integers, whatever the number of vectors) travel back
with the next pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import require_columns, staged

LIMB = 20  # bits; two limbs multiply to less than 2^40
WIDTH = 4096  # terms of one float64 sum: 2^40 * 2^12 < 2^53
ROWS = 1024  # vectors whose distances are held at once
HEAVY = 1024  # labels with a larger share of the rows than 1 / HEAVY are joined by broadcast

Matrices = Iterator[tuple[pa.RecordBatch, np.ndarray]]


def integer_parts(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, ints) of the usable rows: no NULL vector, no NULL, NaN or
    infinite component; x becomes floor(scale * x), computed in doubles."""
    x = F.col(vec_col)
    ok = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.filter(ok).select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), ints.alias("ints"))


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as float64 arrays of whole numbers below 2^LIMB in size, lowest first:
    x is the sum of ``limb[k] * 2**(LIMB * k)``. Only the last one has a sign."""
    out = []
    while np.abs(x).max(initial=0) >= 1 << LIMB:
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*out, x.astype(np.float64)]


def exact_dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``x`` (parts, n, width) and ``c`` (parts, k, width)."""
    total = np.zeros((x.shape[0], x.shape[1], c.shape[1]), dtype=np.int64)
    for at in range(0, x.shape[2], WIDTH):
        right = limbs(c[:, :, at:at + WIDTH])
        for i, a in enumerate(limbs(x[:, :, at:at + WIDTH])):
            for j, b in enumerate(right):
                total += (a @ b.transpose(0, 2, 1)).astype(np.int64) << (LIMB * (i + j))
    return total


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per part (parts, n): index of the first nearest entry and its squared distance."""
    far = (books * books).sum(axis=2)[:, None, :] - 2 * exact_dots(x, books)
    code = far.argmin(axis=2)
    return code, np.take_along_axis(far, code[:, :, None], axis=2)[:, :, 0] + (x * x).sum(axis=2)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` integers; shorter vectors are filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    size = np.diff(column.offsets.to_numpy())
    if (size == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim), dtype=np.int64)
    out[np.arange(dim) < size[:, None]] = flat
    return out


def _parts(batches: Iterator[pa.RecordBatch], dim: int, parts: int) -> Matrices:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            rows = _matrix(some.column("ints"), dim)
            yield some, rows.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2)


def _sums(books: np.ndarray) -> Callable:
    """Sums and counts of the parts nearest to each entry, one row per cell of a
    task: cell (part, entry, position), the count behind the last position."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), dtype=np.int64)
        for _, x in _parts(batches, parts * width, parts):
            code, _ = nearest(x, books)
            slot = (code + np.arange(parts)[:, None] * entries).reshape(-1)
            order = np.argsort(slot, kind="stable")
            own, first, count = np.unique(slot[order], return_index=True, return_counts=True)
            if width:
                total[own, :width] += np.add.reduceat(x.reshape(-1, width)[order], first, axis=0)
            total[own, width] += count
        used = np.flatnonzero(total[:, width])
        cells = used[:, None] * (width + 1) + np.arange(width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cells.reshape(-1)), pa.array(total[used].reshape(-1))],
                                         names=["cell", "total"])
    return run


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; unused entries stay."""
    parts, entries, width = books.shape
    sums = (rows.select("ints").mapInArrow(_sums(books), "cell long, total long")
            .groupBy("cell").agg(F.sum("total").alias("total")).toArrow())  # at most a row per cell of the books
    total = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    total[sums["cell"].to_numpy()] = sums["total"].to_numpy()
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)


def _codes(books: np.ndarray) -> Callable:
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _parts(batches, parts * width, parts):
            code, error = nearest(x, books)
            text = code.T.astype(np.uint8).tobytes().hex()
            n = 2 * parts
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id"), some.column("label"),
                 pa.array([text[i:i + n] for i in range(0, n * some.num_rows, n)], pa.string()),
                 pa.array(error.sum(axis=0), pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add the errors' sum over equal labels. Labels that hold a large share of
    the rows are few and are joined by broadcast, so no task gets one whole."""
    totals = staged(coded.groupBy(F.col("label").alias("_l")).agg(
        F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")), "labels")
    heavy = F.broadcast(totals.filter(F.col("_n") * HEAVY > coded.count()).select("_l", "label_error"))
    same = F.col("label").eqNullSafe(F.col("_l"))
    light = coded.join(heavy, same, "left_anti")
    return (coded.join(heavy, same).drop("_l")
            .unionByName(light.join(totals.drop("_n"), same).drop("_l")))


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """Per usable vector: vec_id, code (two hex digits a part), error (squared
    distances summed over the parts), label_error (error summed over equal labels,
    NULL labels together), codebooks_sha256, label.

    The codebooks start as the parts of the ``entries`` smallest ids (at most 256;
    fewer vectors make smaller codebooks; of rows that repeat an id the smaller
    vector comes first; NULL ids last). Vectors that are NULL or hold NULL or
    non-finite components take no part; NULL ids and labels do, and repeated
    rows each count. Shorter vectors, and a dimension that ``parts`` does not
    divide, are filled up with zeros. Extra columns are ignored; no usable
    vector gives no rows. Components so large that an error may not fit 64 bits
    raise ValueError.
    """
    require_columns(vectors, id_col, vec_col, label_col)
    if not 1 <= entries <= 256:
        raise ValueError(f"a code has two hex digits: 1 to 256 entries, not {entries}")
    rows = staged(integer_parts(vectors, id_col, vec_col, label_col, scale), "parts")
    dim, low, high = rows.agg(F.max(F.size("ints")), F.min(F.array_min("ints")), F.max(F.array_max("ints"))).first()
    dim = -(-(dim or 0) // parts) * parts
    if dim * (2 * max(abs(low or 0), abs(high or 0)) + 1) ** 2 >= 1 << 63:
        raise ValueError(f"components from {low} to {high} are too large for 64-bit errors of {dim} dimensions")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).select("ints").toArrow()["ints"]
    books = _matrix(first.combine_chunks(), dim).reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    shape = f"vec_id {fields['vec_id']}, label {fields['label']}, code string, error long"
    if not len(first):
        return (vectors.sparkSession.createDataFrame([], shape)
                .select("vec_id", "code", "error", F.col("error").alias("label_error"),
                        F.col("code").alias("codebooks_sha256"), "label"))
    for _ in range(rounds):
        books = refined(rows, books)
    coded = staged(rows.mapInArrow(_codes(books), shape), "codes")
    return _with_label_error(coded).select("vec_id", "code", "error", "label_error",
                                           F.lit(books_digest(books)).alias("codebooks_sha256"), "label")


def _round_sql(book: str, near: str, new: str) -> str:
    """Assign every part to ``book`` (CTE ``near``) and average into CTE ``new``."""
    return f"""
{near} AS MATERIALIZED (
  SELECT vec_id, label, p, x, unnest([arg_min(c, d * 64 + c)]) AS c, min(d) AS d FROM (
    SELECT a.vec_id, a.label, a.p, a.x, b.c,
           CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts a JOIN {book} b ON a.p = b.p) GROUP BY vec_id, label, p, x
), {new} AS MATERIALIZED (
  SELECT b.p, b.c, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN (
    SELECT p, c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT p, c, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT p, c, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM {near}) GROUP BY p, c, i) GROUP BY p, c
  ) m ON m.p = b.p AND m.c = b.c)"""


CODES_ORACLE = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, e[p * (len(e) // 16) + 1:(p + 1) * (len(e) // 16)] AS x FROM v, range(16) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS c, x FROM parts
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64)
), {_round_sql("book0", "near0", "book1")}, {_round_sql("book1", "near1", "book2")},
{_round_sql("book2", "near2", "unused")}, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', c), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, c)) FROM book2) AS codebooks_sha256, label
FROM coded
"""
