"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of tokens (its documents in id order). Every window of
``length`` tokens gives each queue a quantum in its target share; what a
whole number of tokens leaves over or short is the queue's deficit, carried
into the next window. The shares are split along a balanced tree of queues:
a node passes floor(c * left / all) of the first c tokens to its left side.
That is monotone in c and exact at the end, so the service a queue has had
after any window, and its deficit, follow from the window's number alone and
each partition picks up where the one before it ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import before, bounded_rows, by_range, require_columns, small, staged, task_of
from quarry.llm.tokens import encoder

MAX_SOURCES = 10_000  # queues; more raise an error

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


class Rounds:
    """Service of the queues in phases; a phase ends when a queue runs dry.

    ``totals``: tokens by queue; ``shares``: target weights (default: the
    totals, one phase, all queues run dry together). Of a phase's queues each
    gives tokens in proportion to the shares of the queues that still have any.
    """

    def __init__(self, totals: list[int], shares: list[float] | None = None, length: int = 4096):
        self.length = length
        left, weight = list(totals), [float(x) for x in (shares or totals)]
        self.phases: list[tuple[int, list[int], list[int]]] = []  # global start, sums of quanta, done before
        start, done = 0, [0] * len(left)
        while any(left):
            live = [s for s, n in enumerate(left) if n]
            if not any(weight[s] > 0 for s in live):
                for s in live:
                    weight[s] = 1.0
            live = [s for s in live if weight[s] > 0]
            first = min(live, key=lambda s: left[s] / weight[s])
            gives = [0] * len(left)
            for s in live:
                gives[s] = min(left[s], int(left[first] * (weight[s] / weight[first])))
            gives[first] = left[first]
            if shares is None:
                gives = list(left)
            self.phases.append((start, [0, *np.cumsum(np.array(gives, dtype=object)).tolist()], list(done)))
            start += sum(gives)
            left = [a - b for a, b in zip(left, gives)]
            done = [a + b for a, b in zip(done, gives)]
        self.total = start

    @staticmethod
    def served(sums: list[int], queue: int, tokens: int) -> tuple[int, int]:
        """(tokens of ``queue``, tokens of queues before it) among a phase's first ``tokens``."""
        lo, hi, here, ahead = 0, len(sums) - 1, tokens, 0
        while hi - lo > 1:
            mid = (lo + hi) // 2
            both = sums[hi] - sums[lo]
            to_left = here * (sums[mid] - sums[lo]) // both if both else 0
            if queue < mid:
                here, hi = to_left, mid
            else:
                ahead, here, lo = ahead + to_left, here - to_left, mid
        return here, ahead

    @staticmethod
    def _window(upto, t: int, guess: int, first: int, last: int) -> tuple[int, tuple[int, int], tuple[int, int]]:
        """The window of a phase (``first`` to ``last``) that serves token ``t``, with the
        service before and after it. A guess may be off by any number of windows where
        small queues share a node, so steps that double, then halve, bracket it."""
        lo, at_lo, step = guess, upto(guess), 1
        hi, at_hi = None, None
        while at_lo[0] > t:
            hi, at_hi = lo, at_lo
            lo, step = max(first, lo - step), 2 * step
            at_lo = upto(lo)
        step = 1
        while hi is None:
            far = min(last + 1, lo + step)
            at_far, step = upto(far), 2 * step
            if at_far[0] > t:
                hi, at_hi = far, at_far
            else:
                lo, at_lo = far, at_far
        while hi - lo > 1:
            mid = (lo + hi) // 2
            at_mid = upto(mid)
            if at_mid[0] > t:
                hi, at_hi = mid, at_mid
            else:
                lo, at_lo = mid, at_mid
        return lo, at_lo, at_hi

    def pieces(self, queue: int, at: int, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the document, length, window, offset) of tokens [at, at + size) of ``queue``."""
        end = at + size
        pos = at
        for g, sums, done in self.phases:
            give, all_ = sums[queue + 1] - sums[queue], sums[-1]
            lo, hi = max(pos, done[queue]), min(end, done[queue] + give)
            if lo >= hi:
                continue
            t, stop = lo - done[queue], hi - done[queue]
            clamp = lambda x: max(0, min(all_, x))
            upto = lambda w: self.served(sums, queue, clamp(w * self.length - g))  # noqa: E731, B023
            first, last = g // self.length, (g + all_ - 1) // self.length
            w = max(first, min(last, (g + t * all_ // give) // self.length))
            while t < stop:
                w, (a, ahead_a), (b, ahead_b) = self._window(upto, t, w, first, last)
                n = min(stop, b) - t
                before_phase = max(0, g - w * self.length)
                yield t + done[queue] - at, n, w, before_phase + ahead_b - ahead_a + t - a
                t, w = t + n, min(last, w + 1)
            pos = hi


def _tokenise(path: str, byte_level: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, byte_level)
        end, wide = enc._pack([end_id]), enc.kind.itemsize
        part, so_far = TaskContext.get().partitionId(), {}
        for batch in batches:
            at = 0
            for ids in enc.encode_batch(batch.column("text"), end):
                some = batch.slice(at, len(ids))
                sizes = pc.binary_length(ids).to_numpy().astype(np.int64) // wide
                starts = []
                for s, n in zip(some.column("source").to_pylist(), sizes.tolist()):
                    starts.append(so_far.get(s, 0))
                    so_far[s] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, dtype=np.int32)), some.column("doc_id"), some.column("source"),
                     pa.array(starts, pa.int64()), pa.array(sizes), ids],
                    names=["part", "doc_id", "source", "start", "n", "ids"])
                at += len(ids)
    return run


def _cut(rounds: Rounds, queues: dict, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                out: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id",
                                                        "offset", "ids")}
                cols = [some.column(c).to_pylist() for c in ("doc_id", "source", "at", "n", "ids")]
                for doc, source, at, n, ids in zip(*cols):
                    raw = np.frombuffer(ids, dtype=kind).astype("<u4").tobytes()
                    for start, size, window, offset in rounds.pieces(queues[source], at, n):
                        for c, v in zip(out, (doc, start, size, n, window, offset, raw[4 * start:4 * (start + size)])):
                            out[c].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                    [(c, pa.binary() if c == "ids" else pa.int64()) for c in out]))
    return run


def pack(docs: DataFrame, tokenizer: str, byte_level: bool = False, end_id: int = 2, length: int = 4096,
         shares: dict | None = None, order: str | None = None) -> DataFrame:
    """Pack all documents into sequences of ``length`` tokens; per piece doc_id,
    start, length, doc_tokens, sequence_id, offset and its ids (little-endian
    unsigned 32-bit).

    Needs doc_id, text, source; extra columns are ignored. NULL text is empty
    (one end id), NULL source is a queue of its own, NULL ids come first.
    Repeated rows are documents each. ``shares`` weighs sources; without it
    every window has the corpus's own proportions, and only the last window
    can be short. Sources absent from ``shares`` come when all others are dry.
    ``order`` names a column of places that already mix the sources: then all
    documents are one queue in that order (ties by id), and take no shares.
    """
    require_columns(docs, "doc_id", "text", "source", *([order] if order else []))
    if order and shares:
        raise ValueError("the order has decided the mixture; shares do not apply")
    queues = (by_range(docs.select("doc_id", F.lit(None).cast("string").alias("source"), "text", order), order, "doc_id")
              if order else by_range(docs.select("doc_id", "source", "text"), "doc_id"))
    tokens = staged(
        queues
        .mapInArrow(task_of("tokens", _tokenise(tokenizer, byte_level, end_id)),
                    "part int, doc_id long, source string, start long, n long, ids binary"), "queues")
    base = before(tokens.groupBy("part", "source").agg(F.sum("n").alias("_n")), "part", "_n", "_base", "source")
    totals = {r["source"]: r["n"] for r in bounded_rows(
        tokens.groupBy("source").agg(F.sum("n").alias("n")), MAX_SOURCES, "the list of sources")}
    names = sorted(totals, key=lambda s: (s is not None, s))
    rounds = Rounds([totals[s] for s in names], [shares.get(s, 0) for s in names] if shares else None, length)
    kind = encoder(tokenizer, byte_level).kind.str
    b = small(base.select(F.col("part").alias("_p"), F.col("source").alias("_s"), "_base"))
    placed = (tokens.join(b, (F.col("part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s")))
              .select("doc_id", "source", (F.col("start") + F.col("_base")).alias("at"), "n", "ids"))
    return placed.mapInArrow(task_of("cut", _cut(rounds, {s: k for k, s in enumerate(names)}, kind)), PIECES)
