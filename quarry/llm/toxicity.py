"""Toxicity scores by FTRL-proximal logistic regression on hashed word n-grams.

Features of a text are the presence of its words, their stems (the first
STEM letters: languages that inflect or compound spread a root over many
words), word pairs and skip pairs (one word left out), hashed into 2^BITS
slots. FTRL keeps a rate per
coordinate and sets weights with little evidence to exact zeros, so a model
is a short list of (slot, weight), broadcast with the scoring function.

Training is on a bounded sample of the labelled rows (``max_rows``, smallest
hashes of the id), dealt to ``shards`` learners whose weights are averaged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import require_columns, return_memory, worker_cache

BITS = 20
STEM = 4
MAX_ROWS, SHARDS, PASSES = 12_000, 4, 2
ALPHA, BETA, L1, L2 = 3.0, 1.0, 4.0, 0.0
_WORD = re.compile(r"\w+")
_CACHE_WORDS = 400_000


class _Hashes(dict):
    """Word -> 64-bit hash of its first ``cut`` letters, computed once per task."""

    def __init__(self, cut: int | None):
        super().__init__()
        self.cut = cut

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        v = self[word] = xxhash.xxh64_intdigest(word[:self.cut], seed=self.cut or 0)
        return v


_HASHES, _STEMS = _Hashes(None), _Hashes(STEM)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_SHIFT = np.uint64(64 - BITS)


def slots(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots of words, stems, pairs and skip pairs, in text order."""
    words = _WORD.findall(text.lower()) if text else []
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    stems = np.fromiter(map(_STEMS.__getitem__, words), dtype=np.uint64, count=len(words))
    one, stem = (h * _MIX[0]) >> _SHIFT, (stems * _MIX[0]) >> _SHIFT
    two = ((h[:-1] * _MIX[1] ^ (h[1:] >> np.uint64(7))) * _MIX[0]) >> _SHIFT
    skip = ((h[:-2] * _MIX[2] ^ (h[2:] >> np.uint64(11))) * _MIX[0]) >> _SHIFT
    return one, stem, two, skip


def features(text: str | None) -> np.ndarray:
    """Distinct slots of a whole text, ascending."""
    return np.unique(np.concatenate(slots(text))).astype(np.int64)


class Ftrl:
    def __init__(self, prior: float):
        self.prior = prior
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = np.abs(z) > L1
        return np.where(free, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = _sigmoid(self.prior + w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, x))))


@dataclass
class Model:
    """prior: log-odds of an empty text; slot/weight: the non-zero weights."""
    prior: float
    slot: np.ndarray
    weight: np.ndarray

    def scorer(self) -> Column:
        prior, slot, weight = self.prior, self.slot.astype(np.int32), self.weight.astype(np.float32)

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            worker_cache("toxicity")
            dense = np.zeros(1 << BITS, dtype=np.float32)
            dense[slot] = weight
            try:
                for texts in batches:
                    yield pd.Series([_sigmoid(prior + _sum(dense, t)) for t in texts], dtype="float64")
            finally:  # a worker lives on in later stages, which need the memory
                _HASHES.clear()
                _STEMS.clear()
                return_memory()
        return score


def _sum(dense: np.ndarray, text: str | None) -> float:
    """Sum of weights over the distinct slots; few slots have a weight, so
    only those are made distinct."""
    at = np.concatenate(slots(text))
    hit = at[dense[at] != 0]
    return float(dense[np.unique(hit)].sum(dtype=np.float64)) if len(hit) else 0.0


def _learn_shard(prior: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        worker_cache("toxicity")
        rows = rows.sort_values(["_h", "doc_id"])
        model = Ftrl(prior)
        seen = [features(t) for t in rows["text"]]
        labels = rows["label"].to_numpy()
        for _ in range(PASSES):
            for at, y in zip(seen, labels):
                model.learn(at, int(y))
        w = model.weights()
        at = np.flatnonzero(w)
        _HASHES.clear()
        _STEMS.clear()
        return_memory()
        return pd.DataFrame({"slot": at, "weight": w[at]})
    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS,
          shards: int = SHARDS) -> Model:
    """Fit on at most ``max_rows`` labelled, not held-out documents.

    Rows with a NULL id or label are left out; of several labels of an id the
    largest counts. Without any usable row the model scores 0.25 everywhere.
    """
    require_columns(docs, "doc_id", "text")
    require_columns(labels, "doc_id", label_col)
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
    picked = (usable.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
              .withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(max_rows))
    # at most ``max_rows`` ids
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    spread = rows.withColumn("_shard", F.pmod(F.col("_h"), F.lit(shards)).cast("int"))
    n, pos = picked.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (pos + 0.5) / (n + 2.0)
    prior = math.log(share / (1 - share))
    # each shard returns at most 2^BITS weights; L1 leaves few
    learnt = spread.groupBy("_shard").applyInPandas(_learn_shard(prior), "slot long, weight double")
    mean = (learnt.groupBy("slot").agg((F.sum("weight") / F.lit(float(shards))).alias("weight"))
            .orderBy("slot").toArrow())
    return Model(prior, mean["slot"].to_numpy(), mean["weight"].to_numpy())


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add ``out`` (0 to 1) to every row; NULL and empty texts score the prior.
    An input column of that name raises ValueError."""
    require_columns(docs, text_col)
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    return docs.withColumn(out, model.scorer()(F.col(text_col)))
