"""Ranked lexical search: MaxScore over document blocks with bounds of term pairs.

1. Documents become blocks of postings: for the terms asked for, the rows that
   hold them and how often. Number and length of documents and the document
   frequencies are counted over all of them.
2. Frequencies turn into impacts. The terms of an item are paired off, most
   frequent first; every block works out the intersection list of each pair and
   keeps its joint maximum impact.
3. Pairs of an item share no term, so the joint impacts that the lists hold for a
   document add up to a lower bound of its score. A block keeps its k best lower
   bounds of each item; the k-th best over all blocks is where the bar starts.
4. Each block answers each item. A pair gives a document at most its joint
   maximum or, where only one of the terms occurs, that term's maximum: never
   more than both maxima together, often far less. Blocks whose bounds stay
   below the bar are skipped; documents that only hold terms whose bounds
   together stay below it are never scored; the others are dropped as soon as
   score and remaining bounds fall behind. Scores are exact integers.

Queries are a stated set that meets all documents block by block; they come in
groups of ``QUERY_BYTES``, so what travels to the tasks is bounded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import require_columns, staged

DOCS, POSTINGS = 4096, 1 << 20  # a block ends at so many documents, or once it has so many postings
QUERY_BYTES = 1 << 22  # text of the items that are answered in one pass

#: terms are runs of A-Z, a-z, 0-9 and everything beyond ASCII; only A-Z changes case
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

#: columns of a block's row: the numbers of an array, packed
KINDS = {"ids": "<i8", "nulls": "|b1", "sizes": "<i4", "terms": "<i4", "ends": "<i4", "rows": "<i4", "times": "<i4",
         "impacts": "<i8", "pairs": "<i4", "pair_top": "<i8", "low_items": "<i4", "low_scores": "<i8"}
BLOCK = ("ids", "nulls", "sizes", "terms", "ends", "rows", "times")
INDEX = ("ids", "nulls", "terms", "ends", "rows", "impacts", "pairs", "pair_top", "low_items", "low_scores")


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_TERMS).split() if text else []


class Items:
    """A group of items: distinct terms are numbered, an item is a list of (term, times)."""

    def __init__(self, texts: list[str | None]):
        number: dict[bytes, int] = {}
        self.items = [[(number.setdefault(t, len(number)), n) for t, n in Counter(terms(x)).items()] for x in texts]
        self.vocabulary = list(number)

    def pair_off(self, weights: np.ndarray) -> None:
        """Units of every item: (term, times, term, times, pair); a last odd term has
        no partner (-1). Equal pairs of several items have one number."""
        number: dict[tuple, int] = {}
        self.units = []
        for item in self.items:
            order = sorted(item, key=lambda x: (weights[x[0]], x))
            units = [(*a, *b, number.setdefault((*a, *b), len(number))) for a, b in zip(order[::2], order[1::2])]
            if len(order) % 2:
                units.append((*order[-1], -1, 0, -1))
            self.units.append(np.array(units, dtype=np.int64).reshape(-1, 5))
        self.pairs = np.array(list(number), dtype=np.int64).reshape(-1, 4)


def _record(**columns: np.ndarray | list) -> pa.RecordBatch:
    """One row of packed arrays."""
    return pa.RecordBatch.from_arrays([pa.array([np.asarray(c, dtype=KINDS[n]).tobytes()], pa.binary())
                                       for n, c in columns.items()], names=list(columns))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: np.frombuffer(c[i].as_buffer(), dtype=KINDS[n]) for n, c in zip(batch.schema.names, batch.columns)}


def _shape(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} binary" for n in names)


def _blocks(vocabulary: list[bytes]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {t: i for i, t in enumerate(vocabulary)}.get
        ids, sizes, held, found = [], [], [], []

        def block() -> pa.RecordBatch:
            # term by term, then row by row
            key = np.array(found, dtype=np.int64) * len(ids) + np.repeat(np.arange(len(ids)), held)
            key, times = np.unique(key, return_counts=True)
            term, row = np.divmod(key, len(ids))
            own, count = np.unique(term, return_counts=True)
            return _record(ids=[d or 0 for d in ids], nulls=[d is None for d in ids], sizes=sizes, terms=own,
                           ends=np.cumsum(count), rows=row, times=times)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                before = len(found)
                found += [t for t in map(get, words) if t is not None]
                ids.append(doc)
                sizes.append(len(words))
                held.append(len(found) - before)
                if len(ids) == DOCS or len(found) >= POSTINGS:
                    yield block()
                    ids, sizes, held, found = [], [], [], []
        if ids:
            yield block()
    return run


def _frequencies(size: int) -> Callable:
    """Documents, their lengths and the documents of each term, one row a task and
    number: -2 and -1 before the terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, dtype=np.int64)
        for b in _records(batches):
            total[:2] += len(b["sizes"]), int(b["sizes"].sum(dtype=np.int64))
            total[b["terms"] + 2] += np.diff(b["ends"], prepend=0)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used - 2), pa.array(total[used])], names=["term", "n"])
    return run


def weight(documents: int, holding: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def _intersections(pairs: np.ndarray, size: int, place: np.ndarray, start: np.ndarray, rows: np.ndarray,
                   impact: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per pair that some document of the block holds whole: the rows and their joint impacts."""
    out, line = {}, np.full(size, -1, dtype=np.int64)
    for p in np.flatnonzero((place[pairs[:, 0]] >= 0) & (place[pairs[:, 2]] >= 0)).tolist():
        a, times_a, c, times_c = pairs[p]
        x, y = (slice(start[place[t]], start[place[t] + 1]) for t in (a, c))
        line[rows[x]] = impact[x]
        met = line[rows[y]]
        line[rows[x]] = -1
        hit = met >= 0
        if hit.any():
            out[p] = rows[y][hit], times_a * met[hit] + times_c * impact[y][hit]
    return out


def _largest(x: np.ndarray, k: int) -> np.ndarray:
    return x if len(x) <= k else np.partition(x, len(x) - k)[len(x) - k:]


def _index(items: Items, weights: np.ndarray, documents: int, length: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _records(batches):
            size, times = len(b["sizes"]), b["times"].astype(np.int64)
            m = np.array([75 + 25 * n * documents // length for n in b["sizes"].tolist()], dtype=np.int64)
            start = np.concatenate([[0], b["ends"]])
            impact = (np.repeat(weights[b["terms"]], np.diff(start))
                      * (1_000_000_000 * times // (1000 * times + 12 * m[b["rows"]])))
            place = np.full(len(weights), -1)
            place[b["terms"]] = np.arange(len(b["terms"]))
            met = _intersections(items.pairs, size, place, start, b["rows"], impact)
            low = []
            for units in items.units:
                total = np.zeros(size, dtype=np.int64)
                for p in units[:, 4].tolist():
                    if p in met:
                        total[met[p][0]] += met[p][1]
                low.append(_largest(total[total > 0], k))
            yield _record(ids=b["ids"], nulls=b["nulls"], terms=b["terms"], ends=b["ends"], rows=b["rows"],
                          impacts=impact, pairs=list(met), pair_top=[joint.max() for _, joint in met.values()],
                          low_items=np.repeat(np.arange(len(low)), [len(x) for x in low]),
                          low_scores=np.concatenate([np.zeros(0, np.int64), *low]))
    return run


def _lower_bounds(size: int, k: int) -> Callable:
    """A task's k best lower bounds per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, score = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for b in _records(batches):
            item, score = np.concatenate([item, b["low_items"]]), np.concatenate([score, b["low_scores"]])
            order = np.lexsort((-score, item))
            item, score = item[order], score[order]
            first = np.searchsorted(item, np.arange(size))
            keep = np.arange(len(item)) - first[item] < k
            item, score = item[keep], score[keep]
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score)], names=["item", "score"])
    return run


class Best:
    """The k best (score, id) of an item; NULL ids come after all others."""

    def __init__(self, bar: int, k: int):
        self.bar, self.k = max(bar, 1), k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def offer(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]
        if len(order) == self.k:
            self.bar = max(self.bar, int(self.score[-1]))


def _answer(units: np.ndarray, best: Best, size: int, top: np.ndarray, pair_top: np.ndarray, posting: Callable
            ) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block that reach the bar, and their scores."""
    none = np.zeros(0, dtype=np.int64)
    bound = np.maximum.reduce([units[:, 1] * top[units[:, 0]], units[:, 3] * top[units[:, 2]], pair_top[units[:, 4]]])
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    units, rest = units[order].tolist(), np.cumsum(bound[order][::-1])[::-1].tolist()
    if not rest or rest[0] < best.bar:
        return none, none
    score = np.zeros(size, dtype=np.int64)
    alive = None  # rows in the running, once the essential units are added
    for unit, left in zip(units, rest):
        if alive is None and left < best.bar:
            alive = np.flatnonzero(score)
        if alive is not None:
            alive = alive[score[alive] + left >= best.bar]
            if not len(alive):
                return none, none
        for term, times in (unit[:2], unit[2:4]):
            rows, impact = posting(term)
            if alive is None or len(alive) * 8 > len(rows):
                score[rows] += times * impact
            elif len(rows):
                at = np.minimum(np.searchsorted(rows, alive), len(rows) - 1)
                hit = rows[at] == alive
                score[alive[hit]] += times * impact[at[hit]]
    alive = np.flatnonzero(score) if alive is None else alive
    alive = alive[score[alive] >= best.bar]
    return alive, score[alive]


def _search(items: Items, bars: np.ndarray, k: int) -> Callable:
    size = len(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(int(bar), k) for bar in bars]
        for b in _records(batches):
            ids, null = b["ids"], b["nulls"]
            start = np.concatenate([[0], b["ends"]])
            top, pair_top = np.zeros(size + 1, np.int64), np.zeros(len(items.pairs) + 1, np.int64)
            if len(b["terms"]):
                top[b["terms"]] = np.maximum.reduceat(b["impacts"], start[:-1])
            pair_top[b["pairs"]] = b["pair_top"]
            span = np.zeros((size + 1, 2), dtype=np.int64)
            span[b["terms"], 0], span[b["terms"], 1] = start[:-1], start[1:]

            def posting(term: int) -> tuple[np.ndarray, np.ndarray]:
                x, y = span[term]
                return b["rows"][x:y], b["impacts"][x:y]

            for j, units in enumerate(items.units):
                rows, score = _answer(units, best[j], len(ids), top, pair_top, posting)
                if len(rows):
                    best[j].offer(score, ids[rows], null[rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), [len(x.id) for x in best])),
             pa.concat_arrays([pa.array(x.id, pa.int64(), mask=x.null) for x in best] or [pa.array([], pa.int64())]),
             pa.array(np.concatenate([np.zeros(0, np.int64), *[x.score for x in best]]))],
            names=["item", "doc_id", "score"])
    return run


def _ranked(df: DataFrame, k: int, *order) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), *order))
    return df.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


def _answers(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of one group of items."""
    size = len(items.vocabulary)
    blocks = staged(docs.mapInArrow(_blocks(items.vocabulary), _shape(BLOCK)), "lexical-blocks")
    counts = np.zeros(size + 2, dtype=np.int64)
    sums = (blocks.select("sizes", "terms", "ends").mapInArrow(_frequencies(size), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).toArrow())  # at most a row per term asked for
    counts[sums["term"].to_numpy() + 2] = sums["n"].to_numpy()
    documents, length = map(int, counts[:2])
    weights = np.array([weight(documents, n) for n in counts[2:].tolist()], dtype=np.int64)
    items.pair_off(weights)
    index = staged(blocks.mapInArrow(_index(items, weights, documents, length, k), _shape(INDEX)), "lexical-index")
    lower = index.select("low_items", "low_scores").mapInArrow(
        _lower_bounds(len(items.items), k), "item int, score long")
    # one row an item: the k-th best lower bound, where so many documents have one
    start = _ranked(lower, k).filter(F.col("rank") == k).select("item", "score").toArrow()
    bars = np.zeros(len(items.items), dtype=np.int64)
    bars[start["item"].to_numpy()] = start["score"].to_numpy()
    found = index.drop("low_items", "low_scores").mapInArrow(_search(items, bars, k),
                                                             "item int, doc_id long, score long")
    return _ranked(found, k, F.asc_nulls_last("doc_id"))


def search(docs: DataFrame, queries: DataFrame, k: int = 20, item_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """Per row of ``queries`` its ``k`` best documents with a score above 0:
    item_id, rank (from 1), doc_id, score; ties go to the smaller doc_id.

    ``docs`` needs doc_id and text. NULL and empty texts hold no terms: such
    documents are never found nor counted, such items find nothing. Rows that
    repeat an id are documents (or items) each; a NULL doc_id comes last of its
    ties; a NULL item id is kept. Extra columns are ignored; empty tables give
    no rows.
    """
    require_columns(docs, "doc_id", "text")
    require_columns(queries, item_col, text_col)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = queries.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).orderBy("item_id", "text")
    groups, ids, texts, held = [], [], [], 0

    def answer() -> None:
        items = Items(texts)
        if items.vocabulary:
            names = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind}")
            groups.append(_answers(docs, items, k).join(F.broadcast(names), "item")
                          .select("item_id", "rank", "doc_id", "score"))

    kind = asked.schema["item_id"].dataType.simpleString()
    for row in asked.toLocalIterator():
        own = len(row.text or "")
        if ids and held + own > QUERY_BYTES:
            answer()
            ids, texts, held = [], [], 0
        ids.append(row.item_id)
        texts.append(row.text)
        held += own + 16
    answer()
    if not groups:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = groups[0]
    for more in groups[1:]:
        out = out.unionByName(more)
    return out


SEARCH_ORACLE = r"""
WITH lowered AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 'q', row_number() OVER (), item_id, text FROM benchmark
), bags AS MATERIALIZED (
  SELECT kind, r, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM lowered
), counted AS MATERIALIZED (
  SELECT kind, r, id, size, word, count(*) AS times
  FROM (SELECT kind, r, id, len(words) AS size, unnest(words) AS word FROM bags) GROUP BY ALL
), corpus AS (
  SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM bags WHERE kind = 'd' AND len(words) > 0
), weights AS MATERIALIZED (
  SELECT word, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, corpus WHERE kind = 'd' GROUP BY word, n
), scores AS (
  SELECT q.r, q.id AS item_id, d.r AS dr, d.id AS doc_id, CAST(sum(q.times * w * (
           (1000000000 * d.times) // (1000 * d.times + 12 * (75 + (25 * d.size * n) // l)))) AS BIGINT) AS score
  FROM counted q JOIN counted d ON q.kind = 'q' AND d.kind = 'd' AND q.word = d.word
  JOIN weights ON weights.word = d.word, corpus
  GROUP BY q.r, q.id, d.r, d.id
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
"""
