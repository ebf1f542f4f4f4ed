"""Repeated passages by a depth-limited radix sort of suffixes.

Only the first ``window`` bytes of a suffix matter. Ordering the suffixes of
all documents outright would move every byte ``window`` times, so suffixes
are first dealt by an anchor: of the GRAM-byte strings inside a window the one
with the smallest hash. Equal windows have equal anchors, and neighbouring
windows mostly share theirs.

1. Every document tells the hashes of its anchors; one that no other document
   has cannot lie in a repeated window. What a batch of documents can settle
   among itself it settles, and sends each hash once.
2. Windows whose anchor is shared are sent, as runs around their
   anchor, to the anchor's bucket. There the suffixes are sorted by most
   significant digit passes (8 bytes a digit, groups of one document drop out
   after each pass) down to ``window`` bytes. The groups left are exactly the
   repeated windows; all but those of the smallest id are covered.
3. Covered windows of a document merge into spans, which are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import require_columns, shuffle_parts, small, staged

WINDOW, GRAM = 50, 16
SEGMENT = 1 << 20  # bytes of a text looked at at once
BUCKET_BYTES = 8 << 20  # text bytes per bucket, about
LOW = np.uint64((1 << 40) - 1)
_MUL, _FIN = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
_POWERS = [np.uint64(pow(_MUL, 1 << k, 1 << 64)) for k in range(8)]

#: kind TOLD: for a bucket of hashes or runs; REPLY: for the documents with id % buckets = bucket
TOLD, REPLY, TEXT = 0, 1, 2
MESSAGE = "bucket int, kind int, payload binary"
SMALL_IDS = 1_000_000  # longer lists of ids join by a shuffle


def anchors(raw: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every GRAM-byte string, position of each window's anchor): the
    leftmost smallest hash among the strings inside the window."""
    h = raw.astype(np.uint64) + np.uint64(1)
    size = 1
    for k in range(4):  # GRAM = 2^4
        h = h[:-size] * _POWERS[k] + h[size:]
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * _FIN
    h ^= h >> np.uint64(32)
    inside = window - GRAM + 1
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= inside:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < inside:
        least = np.minimum(least[:size - inside], least[inside - size:])
    return h, (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(text: str | None, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping pieces of a text's bytes that hold every window once."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    for at in range(0, max(0, len(raw) - window + 1), SEGMENT):
        yield at, raw[at:at + SEGMENT + window - 1]


def _name(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 40 bits of a hash as one number."""
    return (((h >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40)) | (h & LOW)


def _own_names(text: str | None, window: int, buckets: int) -> np.ndarray:
    found = []
    for _, raw in segments(text, window):
        h, at = anchors(raw, window)
        found.append(h[at[np.concatenate([[True], at[1:] != at[:-1]])]])
    return np.unique(_name(np.concatenate(found), buckets)) if found else np.zeros(0, dtype=np.uint64)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, compressed: equal high bytes cost nothing."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    return zstandard.compress(planes, 1)


def _expand(payload: bytes, *kinds: str) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(payload), dtype=np.uint8)
    widths = [np.dtype(k).itemsize for k in kinds]
    n, out, at = len(planes) // sum(widths), [], 0
    for k, w in zip(kinds, widths):
        out.append(np.ascontiguousarray(planes[at:at + n * w].reshape(w, n).T).reshape(-1).view(k))
        at += n * w
    return out


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "payload"])


def _replies(buckets: int, doc: np.ndarray, *more: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One message per bucket of documents, rows in order of ids."""
    if not len(doc):
        return []
    to = doc % buckets
    order = np.lexsort((doc, to))
    to = to[order]
    start = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
    return [(int(to[x]), REPLY, _squeeze(doc[order[x:y]], *[m[order[x:y]] for m in more]))
            for x, y in zip(start, [*start[1:], len(to)])]


def _pieces(batches: Iterator[pa.RecordBatch], most: int = 24 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``most`` text bytes."""
    for batch in batches:
        sizes = np.cumsum(pd.Series(batch.column("text").to_pylist()).str.len().fillna(0).to_numpy(dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = sizes[at - 1] if at else 0
            n = max(1, int(np.searchsorted(sizes, base + most, side="right")) - at)
            yield batch.slice(at, n)
            at += n


def _tell(window: int, buckets: int):
    """Per batch: hashes shared inside it as hits of their documents, and every
    hash once, with one of its documents, for its bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            ids = batch.column("doc_id").to_pylist()
            own = [_own_names(t, window, buckets) for t in batch.column("text").to_pylist()]
            if not any(map(len, own)):
                continue
            names = np.concatenate(own)
            docs = np.repeat(np.array(ids, dtype=np.int64), [len(x) for x in own])
            order = np.argsort(names, kind="stable")
            names, docs = names[order], docs[order]
            start = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
            size = np.diff(np.append(start, len(names)))
            differ = np.maximum.reduceat(docs, start) != np.minimum.reduceat(docs, start)
            many = np.repeat(differ, size)
            out = _replies(buckets, docs[many], names[many])
            names, docs = names[start], docs[start]
            which = names >> np.uint64(40)
            cut = np.searchsorted(which, np.arange(buckets + 1, dtype=np.uint64))
            for b in np.unique(which).tolist():
                x = slice(cut[b], cut[b + 1])
                low = names[x] & LOW
                out.append((b, TOLD, _squeeze(np.diff(low, prepend=low[:1] * 0), docs[x])))
            yield _messages(out)
    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple], list[bytes]]]:
    """(bucket, replies that pass through, what was told), from rows sorted by bucket."""
    held: int | None = None
    through, own = [], []
    for batch in batches:
        for b, kind, payload in zip(*[c.to_pylist() for c in batch.columns]):
            if b != held and held is not None:
                yield held, through, own
                through, own = [], []
            held = b
            if kind == REPLY:
                through.append((b, kind, payload))
            else:
                own.append(payload)
    if held is not None:
        yield held, through, own


def _answer(buckets: int):
    """Hits of documents: hashes of a bucket that several documents told."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, out, own in _buckets(batches):
            if own:
                lows, docs = zip(*[(np.cumsum(x, dtype=np.uint64), d)
                                   for x, d in (_expand(p, "<u8", "<i8") for p in own)])
                low, doc = np.concatenate(lows), np.concatenate(docs)
                order = np.argsort(low, kind="stable")
                low, doc = low[order], doc[order]
                start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
                size = np.diff(np.append(start, len(low)))
                differ = np.maximum.reduceat(doc, start) != np.minimum.reduceat(doc, start)
                many = np.repeat(differ, size)
                out = out + _replies(buckets, doc[many], (np.uint64(b) << np.uint64(40)) | low[many])
            if out:
                yield _messages(out)
    return run


def _mail(batches: Iterator[pa.RecordBatch], *kinds: str) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """((doc_id, rk, text), the document's rows of its bucket's replies), from
    rows sorted by (bucket, kind): replies come before the texts."""
    held, letters, table, edges = None, [], None, {}
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("bucket", "kind", "payload", "doc_id", "rk", "text")]
        for b, kind, payload, doc, rk, text in zip(*cols):
            if b != held:
                held, letters, table, edges = b, [], None, {}
            if kind == REPLY:
                letters.append(payload)
                continue
            if letters:
                table = [np.concatenate(x) for x in zip(*[_expand(p, "<i8", *kinds) for p in letters])]
                order = np.argsort(table[0], kind="stable")
                table, letters = [x[order] for x in table], []
                start = np.flatnonzero(np.concatenate([[True], table[0][1:] != table[0][:-1]]))
                edges = {int(table[0][x]): (x, y) for x, y in zip(start, [*start[1:], len(order)])}
            if doc in edges:
                x, y = edges[doc]
                yield (doc, rk, text), [t[x:y] for t in table[1:]]


def _runs(window: int, buckets: int):
    """Runs of windows around shared anchors, to the anchors' buckets.

    Equal runs inside a batch are sent once, with the smallest id; the windows
    of the others are covered at once.
    """
    def flush(found: dict[int, list]) -> pa.RecordBatch:
        out, covered = [], []
        for bucket, rows in found.items():
            rows.sort()
            sent: list[tuple] = []
            for r in rows:
                if sent and sent[-1][0] == r[0] and r[1] > sent[-1][1]:
                    covered.append(r[1:])
                else:
                    sent.append(r)
            meta = _squeeze(*np.array([r[1:] for r in sent], dtype=np.int64).T.copy())
            body = zstandard.compress(b"".join([r[0] for r in sent]), 1)
            out.append((bucket, TOLD, len(meta).to_bytes(4, "little") + meta + body))
        if covered:
            out += _replies(buckets, *np.array(covered, dtype=np.int64).T.copy())
        return _messages(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        size = 0
        for (doc, rk, text), (hits,) in _mail(batches, "<u8"):
            hits = np.unique(hits)
            for at, raw in segments(text, window):
                for bucket, a, n, body in _candidates(raw, window, buckets, hits):
                    found.setdefault(bucket, []).append((body, doc, rk, at + a, n))
                    size += len(body) + 200
            if size > 64 << 20:
                yield flush(found)
                found, size = {}, 0
        if found:
            yield flush(found)
    return run


def _candidates(raw: np.ndarray, window: int, buckets: int, hit: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    """(bucket, first window, windows, bytes) of the runs of windows whose anchor is in ``hit``."""
    h, at = anchors(raw, window)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    size = np.diff(np.append(start, len(at)))
    names = _name(h[at[start]], buckets)
    known = hit[np.minimum(np.searchsorted(hit, names), len(hit) - 1)] == names
    bucket = (names[known] >> np.uint64(40)).astype(np.int64)
    data = raw.tobytes()
    return [(b, a, k, data[a:a + k + window - 1])
            for b, a, k in zip(bucket.tolist(), start[known].tolist(), size[known].tolist())]


def radix_groups(data: np.ndarray, at: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` at ``at`` that agree on ``window`` bytes with one of
    another document: (their index, the smallest document of their group)."""
    pad = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    digit = np.zeros(len(data) + 1, dtype=np.uint64)
    for k in range(8):
        digit = (digit << np.uint64(8)) | pad[k:k + len(digit)]
    live = np.arange(len(at))
    group = np.zeros(len(at), dtype=np.int64)
    depth = 0
    while depth < window and len(live):
        take = min(8, window - depth)
        key = digit[at[live] + depth] >> np.uint64(8 * (8 - take))
        order = np.lexsort((key, group))
        live, key, group = live[order], key[order], group[order]
        edge = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        start = np.flatnonzero(edge)
        size = np.diff(np.append(start, len(live)))
        own = doc[live]
        differ = np.maximum.reduceat(own, start) != np.minimum.reduceat(own, start)
        keep = np.repeat(differ, size)
        group = np.repeat(np.arange(len(start)), size)[keep]
        live = live[keep]
        depth += take
    if not len(live):
        return live, live
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.minimum.reduceat(doc[live], start)
    return live, np.repeat(least, np.diff(np.append(start, len(live))))


def _cover(window: int, buckets: int):
    """Covered windows of documents as (first window, windows) runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, out, own in _buckets(batches):
            if own:
                least: dict[bytes, int] = {}
                rows = []
                for p in own:
                    n = int.from_bytes(p[:4], "little")
                    data, at = zstandard.decompress(p[4 + n:]), 0
                    for doc, rk, first, count in zip(*[x.tolist() for x in _expand(p[4:4 + n], *["<i8"] * 4)]):
                        body = data[at:at + count + window - 1]
                        at += len(body)
                        rows.append((body, doc, rk, first, count))
                        if doc < least.get(body, 1 << 63):
                            least[body] = doc
                # equal runs repeat as a whole: only the smallest id's is sorted
                covered = [r[1:] for r in rows if r[1] > least[r[0]]]
                rest = [r for r in rows if r[1] == least[r[0]]]
                doc, rk, first, count = np.array([r[1:] for r in rest], dtype=np.int64).T
                data = np.frombuffer(b"".join([r[0] for r in rest]), dtype=np.uint8)
                base = np.cumsum(count + window - 1) - (count + window - 1)
                row = np.repeat(np.arange(len(doc)), count)
                step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                found, smallest = radix_groups(data, base[row] + step, doc[row], window)
                found = np.sort(found[doc[row[found]] > smallest])
                # neighbouring windows of a run as one
                edge = np.concatenate([[True], (row[found][1:] != row[found][:-1]) | (np.diff(found) != 1)]) \
                    if len(found) else np.zeros(0, dtype=bool)
                start = np.flatnonzero(edge)
                size = np.diff(np.append(start, len(found)))
                r = row[found[start]]
                parts = [np.stack([doc[r], rk[r], first[r] + step[found[start]], size])]
                if covered:
                    parts.append(np.array(covered, dtype=np.int64).T)
                out = out + _replies(buckets, *np.concatenate(parts, axis=1).copy())
            if out:
                yield _messages(out)
    return run


def merged(at: np.ndarray, n: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Byte spans [a, b) covered by runs of ``n`` windows that start at ``at``."""
    order = np.argsort(at, kind="stable")
    out: list[list[int]] = []
    for a, k in zip(at[order].tolist(), n[order].tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + k + window - 1)
        else:
            out.append([a, a + k + window - 1])
    return [(a, b) for a, b in out]


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for (doc, rk, text), (key, first, count) in _mail(batches, "<i8", "<i8", "<i8"):
            mine = key == rk
            if not mine.any() or (doc, rk) in done:
                continue
            done.add((doc, rk))
            raw, at, kept = text.encode(), 0, []
            spans = merged(first[mine], count[mine], window)
            for a, b in spans:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc]), pa.array([rk]), pa.array([sum(b - a for a, b in spans)]), pa.array([len(spans)]),
                 pa.array([b"".join(kept)], pa.binary())], names=["doc_id", "rk", "n_removed", "n_spans", "kept"])
    return run


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in batch.column("payload").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_expand(p, *["<i8"] * 4)[0]))], names=["doc_id"])


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents that lose bytes: doc_id, rk (xxhash64 of the text), n_removed,
    n_spans and kept (the remaining bytes).

    A byte goes if it lies in a ``window``-byte string that also starts in a
    document with a smaller id. NULL texts and NULL ids take no part, texts
    shorter than ``window`` cannot repeat. Rows that repeat an id do not cover
    each other; equal rows give one result. Extra columns are ignored.
    """
    require_columns(docs, "doc_id", "text")
    if window < 2 * GRAM:
        raise ValueError(f"window must be at least {2 * GRAM} bytes")
    spark = docs.sparkSession
    docs = (docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
            .filter(F.octet_length("text") >= window).withColumn("rk", F.xxhash64("text")))

    # whole copies lose everything to the smallest id of their text; they tell
    # nothing new, so a list of them that is short enough is left out up front
    prints = staged(docs.select("doc_id", "rk", F.sha2("text", 256).alias("_sha"),
                                F.octet_length("text").cast("long").alias("_n")), "prints")
    total = prints.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    least = prints.groupBy("_sha").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    copies = staged(prints.join(least, "_sha").filter("doc_id > _first").select("doc_id", "rk", "_n").distinct(),
                    "copies")
    few = copies.limit(SMALL_IDS + 1).count() <= SMALL_IDS
    if few:
        docs = docs.join(F.broadcast(copies.select("doc_id", "rk")), ["doc_id", "rk"], "left_anti")

    buckets = max(shuffle_parts(spark), total // BUCKET_BYTES + 1)

    def dealt(df: DataFrame, *order: str) -> DataFrame:
        return df.repartition(min(buckets, 100_000), "bucket").sortWithinPartitions("bucket", *order)

    def delivered(texts: DataFrame, replies: DataFrame) -> DataFrame:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("rk", "long"), ("text", "string"))]
        rows = texts.select(F.pmod("doc_id", F.lit(buckets)).cast("int").alias("bucket"), F.lit(TEXT).alias("kind"),
                            F.lit(None).cast("binary").alias("payload"), "doc_id", "rk", "text")
        return dealt(rows.unionByName(replies.select("*", *none)), "kind")

    told = docs.select("doc_id", "text").mapInArrow(_tell(window, buckets), MESSAGE)
    hits = dealt(told).mapInArrow(_answer(buckets), MESSAGE)
    runs = delivered(docs, hits).mapInArrow(_runs(window, buckets), MESSAGE)
    spans = staged(dealt(runs).mapInArrow(_cover(window, buckets), MESSAGE), "spans")
    hurt = staged(spans.mapInArrow(_named, "doc_id long").distinct(), "hurt")
    cut = delivered(docs.join(small(hurt, SMALL_IDS), "doc_id", "left_semi"), spans).mapInArrow(
        _cut(window), "doc_id long, rk long, n_removed long, n_spans long, kept binary")
    if few:
        cut = cut.unionByName(copies.select("doc_id", "rk", F.col("_n").alias("n_removed"),
                                            F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")))
    return cut


def cut_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.
    A NULL text counts as empty."""
    cut = staged(cut_repeats(docs, window).select("doc_id", "rk", "n_removed", "n_spans",
                                                  F.sha2("kept", 256).alias("_sha")), "cut")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"),
                       F.xxhash64("text").alias("rk"), F.sha2(raw, 256).alias("_whole"))
    return rows.join(cut, ["doc_id", "rk"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("_sha", "_whole").alias("kept_sha256"))
