"""Exact top-k inner products: norm-sorted blocks, rotated partial sums.

Candidates are dealt and sorted by descending length and packed into blocks.
A rotation from the eigenvectors of the Gram matrix puts most of every inner
product into its first coordinates. For a query with k-th best score t so far

- a block is skipped if its longest vector times the query's length is below t,
- a candidate is skipped if its partial sum plus the product of both residual
  lengths is below t (Cauchy-Schwarz),

and what is left is scored exactly in integers. The query set is stated: groups of
query blocks are joined to the candidate blocks that are long enough for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import require_columns, shuffle_parts, staged

CANDIDATES, QUERIES, HEAD, CHUNK = 4096, 1024, 4096, 1024
GROUP = 16  # query blocks that meet a candidate block in one place
BLOCK = "block long, top double, ids binary, ints binary"
_ARROW = pa.schema([("block", pa.int64()), ("top", pa.float64()), ("ids", pa.binary()), ("ints", pa.binary())])


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> DataFrame:
    """(vec_id, ints, norm) of usable vectors: no NULL, NaN or infinite
    component, x becomes floor(scale * x)."""
    ok = F.col(vec_col).isNotNull() & F.forall(F.col(vec_col), lambda x: (
        x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    ints = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return (vectors.filter(ok & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("ints")).withColumn("norm", norm))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` integers; shorter vectors are filled with zeros."""
    out = np.zeros((len(column), dim), dtype=np.int64)
    for k, row in enumerate(column.to_pylist()):
        out[k, :len(row)] = row
    return out


def _blocks(dim: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                some = batch.slice(k, rows)
                yield pa.RecordBatch.from_pylist([{
                    "block": (part << 32) | n, "top": max(some.column("norm").to_pylist()),
                    "ids": some.column("vec_id").to_numpy().astype("<i8").tobytes(),
                    "ints": _matrix(some.column("ints"), dim).astype("<i8").tobytes()}], schema=_ARROW)
                n += 1
    return run


def _gram(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column("ints"), dim).astype(np.float64)
            total += m.T @ m
        i, j = np.divmod(np.arange(dim * dim, dtype=np.int64), dim)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], names=["i", "j", "s"])
    return run


def _unpack(ids: bytes, ints: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, dtype="<i8")
    return i, np.frombuffer(ints, dtype="<i8").reshape(len(i), dim)


class Queue:
    """The best k of every query of a block, and its bar for further candidates."""

    def __init__(self, ids: np.ndarray, ints: np.ndarray, bar: np.ndarray, rotation: np.ndarray, first: int, k: int):
        self.ids, self.ints, self.bar, self.first, self.k, self.rotation = ids, ints, bar.copy(), first, k, rotation
        turned = ints.astype(np.float64) @ rotation
        self.lead = turned[:, :first]
        self.rest = np.sqrt((turned[:, first:] ** 2).sum(axis=1))
        self.norm = np.sqrt((ints.astype(np.float64) ** 2).sum(axis=1))
        self.best = [np.zeros(0, dtype=np.int64)] * 3  # query index, score, candidate id

    def offer(self, ids: np.ndarray, ints: np.ndarray) -> None:
        for at in range(0, len(ids), CHUNK):
            own, vec = ids[at:at + CHUNK], ints[at:at + CHUNK]
            real = vec.astype(np.float64)
            norm = np.sqrt((real ** 2).sum(axis=1))
            # a margin for rounding; scores are whole numbers
            slack = 0.5 + 1e-9 * self.norm * norm.max(initial=0.0)
            alive = self.norm * norm.max(initial=0.0) + slack >= self.bar
            if not alive.any():
                return  # candidates come by descending length
            q = np.flatnonzero(alive)
            turned = real @ self.rotation
            rest = np.sqrt((turned[:, self.first:] ** 2).sum(axis=1))
            bound = self.lead[q] @ turned[:, :self.first].T + np.outer(self.rest[q], rest) + slack[q][:, None]
            a, b = np.nonzero(bound >= self.bar[q][:, None])
            a = q[a]
            other = self.ids[a] != own[b]
            a, b = a[other], b[other]
            if len(a):
                score = np.concatenate([np.einsum("ij,ij->i", self.ints[a[i:i + 65536]], vec[b[i:i + 65536]])
                                        for i in range(0, len(a), 65536)])
                self._keep(a, score, own[b])

    def _keep(self, query: np.ndarray, score: np.ndarray, cand: np.ndarray) -> None:
        query, score, cand = (np.concatenate(x) for x in zip(self.best, (query, score, cand)))
        order = np.lexsort((cand, -score, query))
        query, score, cand = query[order], score[order], cand[order]
        start = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        size = np.diff(np.append(start, len(query)))
        rank = np.arange(len(query)) - np.repeat(start, size)
        keep = rank < self.k
        self.best = [query[keep], score[keep], cand[keep]]
        full = start[size >= self.k]
        self.bar[query[full]] = np.maximum(self.bar[query[full]], score[full + self.k - 1])


def _start(head_ids: bytes, head_ints: bytes, dim: int, rotation: np.ndarray, first: int, k: int):
    """Add to each query block its bars against the longest candidates, and the
    length a candidate needs to matter for any of its queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ints = _unpack(head_ids, head_ints, dim)
        for batch in batches:
            for r in batch.to_pylist():
                q = Queue(*_unpack(r["ids"], r["ints"], dim), np.full(len(r["ids"]) // 8, -np.inf), rotation, first, k)
                q.offer(ids, ints)
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(q.bar <= 0, 0.0, q.bar / q.norm)
                yield pa.RecordBatch.from_pylist([{
                    "block": r["block"], "need": float(np.nan_to_num(need).min(initial=np.inf)) * (1 - 1e-9) - 1e-6,
                    "ids": r["ids"], "ints": r["ints"], "bar": q.bar.astype("<f8").tobytes()}], schema=pa.schema(
                    [("block", pa.int64()), ("need", pa.float64()), ("ids", pa.binary()), ("ints", pa.binary()),
                     ("bar", pa.binary())]))
    return run


def _search(dim: int, rotation: np.ndarray, first: int, k: int):
    """Rows sorted by (query block, descending top): block pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, queue = None, None
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("q", "q_ids", "q_ints", "bar", "ids", "ints")]):
                if r[0] != held:
                    if queue is not None:
                        yield _found(queue)
                    held = r[0]
                    queue = Queue(*_unpack(r[1], r[2], dim), np.frombuffer(r[3], dtype="<f8"), rotation, first, k)
                queue.offer(*_unpack(r[4], r[5], dim))
        if queue is not None:
            yield _found(queue)
    return run


def _found(queue: Queue) -> pa.RecordBatch:
    query, score, cand = queue.best
    return pa.RecordBatch.from_arrays([pa.array(queue.ids[query].astype(np.int64)), pa.array(cand), pa.array(score)],
                                      names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100,
          k: int = 10, scale: int = 1024) -> DataFrame:
    """Per query (rows whose id is divisible by ``every``) its ``k`` best other
    vectors: query_id, rank, vec_id, score; ties go to the smaller id.

    Vectors that are NULL or hold NULL or non-finite components take no part,
    nor do NULL ids. Shorter vectors count as filled with zeros. A repeated id
    is one query (its smallest vector) but a candidate each time. Extra
    columns are ignored; no usable vector gives no rows. Scores must fit a long.
    """
    require_columns(vectors, id_col, vec_col)
    spark = vectors.sparkSession
    rows = staged(integer_vectors(vectors, id_col, vec_col, scale), "vectors")
    dim = max(1, rows.agg(F.coalesce(F.max(F.size("ints")), F.lit(0))).first()[0])
    # dim x dim sums, whatever the number of vectors
    sums = (rows.select("ints").mapInArrow(_gram(dim), "i long, j long, s double")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow())
    gram = np.zeros((dim, dim))
    gram[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["s"].to_numpy()
    values, axes = np.linalg.eigh((gram + gram.T) / 2)
    rotation = np.ascontiguousarray(axes[:, ::-1])
    energy = np.cumsum(np.maximum(values[::-1], 0))
    first = int(np.searchsorted(energy, 0.6 * energy[-1])) + 1 if energy[-1] > 0 else 1
    first = min(first, dim)

    order = [F.desc("norm"), F.asc("vec_id")]
    blocks = staged(rows.repartitionByRange(shuffle_parts(spark), F.desc("norm")).sortWithinPartitions(*order)
                    .mapInArrow(_blocks(dim, CANDIDATES), BLOCK), "candidates")
    head = rows.orderBy(*order).limit(HEAD).toArrow()
    ids = head["vec_id"].to_numpy().astype("<i8").tobytes()
    ints = _matrix(head["ints"].combine_chunks(), dim).astype("<i8").tobytes() if len(head) else b""
    stated = (rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("ints").alias("ints"))
              .withColumn("norm", F.lit(0.0)))
    n_q = stated.count()
    asked = staged(stated.repartitionByRange(-(-n_q // QUERIES) or 1, "vec_id").sortWithinPartitions("vec_id")
                   .mapInArrow(_blocks(dim, QUERIES), BLOCK)
                   .mapInArrow(_start(ids, ints, dim, rotation, first, k),
                               "block long, need double, ids binary, ints binary, bar binary"), "queries")
    # query blocks in groups: a candidate block moves once for each group that needs it, and a
    # query block is copied to as many salts as there are tasks to share its candidates
    salts, groups = shuffle_parts(spark), -(-n_q // (QUERIES * GROUP)) or 1
    asked = asked.withColumn("g", F.pmod(F.shiftright("block", 32), F.lit(groups)).cast("int"))
    least = asked.groupBy("g").agg(F.min("need").alias("least"))
    wanted = (blocks.select("block", "top", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
              .join(least, "g").filter(F.col("top") >= F.col("least")).select("block", "g"))
    moved = blocks.join(wanted, "block").select(
        "g", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), "top", "ids", "ints")
    left = asked.select("g", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.col("block").alias("q"),
                        "need", F.col("ids").alias("q_ids"), F.col("ints").alias("q_ints"), "bar")
    # merged, not broadcast: the planner's size of a side does not see its copies
    met = (moved.join(left.hint("merge"), ["g", "salt"]).filter(F.col("top") >= F.col("need"))
           .select("q", "top", "q_ids", "q_ints", "bar", "ids", "ints").sortWithinPartitions("q", F.desc("top")))
    found = met.mapInArrow(_search(dim, rotation, first, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


TOPK_ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
