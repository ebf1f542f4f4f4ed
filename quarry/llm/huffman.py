"""Canonical length-limited Huffman codes over token ids, in numpy."""

from __future__ import annotations

import numpy as np

LIMIT = 18  # longest code in bits; 2^18 codes exceed any vocabulary in use here


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge).

    Level lists hold the sorted leaves merged with pairs of the level below;
    of the top list the first 2n - 2 items are taken, and each level's taken
    leaves are a prefix of the symbols by weight, so counts are enough.
    """
    counts = np.asarray(counts, dtype=np.int64)
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) == 0:
        return lengths
    if len(used) == 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, pairs = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(leaves))
        merged = both[at]
        even = len(merged) // 2 * 2
        pairs = merged[0:even:2] + merged[1:even:2]
    take, depth = 2 * len(leaves) - 2, np.zeros(len(leaves), dtype=np.int64)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols by code, code by symbol): codes count up by (length, symbol)."""
    symbols = np.flatnonzero(lengths)
    symbols = symbols[np.lexsort((symbols, lengths[symbols]))]
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, last = 0, 0
    for s in symbols.tolist():
        n = int(lengths[s])
        code <<= n - last
        codes[s], last = code, n
        code += 1
    return symbols, codes


class Coder:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        symbols, self.codes = canonical(lengths)
        self.bits = max(1, int(lengths.max(initial=1)))
        span = (1 << (self.bits - lengths[symbols].astype(np.int64)))
        self.symbol_at = np.zeros(1 << self.bits, dtype=np.uint32)
        self.length_at = np.ones(1 << self.bits, dtype=np.int64)
        n = int(span.sum())
        self.symbol_at[:n] = np.repeat(symbols, span)
        self.length_at[:n] = np.repeat(lengths[symbols].astype(np.int64), span)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """(bits of ``ids``, bit offset of each ``every``-th id)."""
        n = self.lengths[ids].astype(np.int64)
        end = np.cumsum(n)
        at = end - n
        word = at >> 5
        value = self.codes[ids] << (64 - (at & 31) - n).astype(np.uint64)
        out = np.zeros(int(end[-1] >> 5) + 2, dtype=np.uint64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        w = word[first]
        out[w] += np.add.reduceat(value >> np.uint64(32), first)
        out[w + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return out.astype(">u4").tobytes()[:int(end[-1] + 7) >> 3], at[::every].astype(np.uint32)

    def decode(self, payloads: list[bytes], sizes: list[int], starts: list[np.ndarray], every: int) -> list[np.ndarray]:
        """Ids of each payload. All runs between checkpoints advance together,
        one id a step: a table look-up on the next ``bits`` bits of each run."""
        pad = bytes(8)
        raw = np.frombuffer(b"".join([x for p in payloads for x in (p, pad)]), dtype=np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        base = np.concatenate([[0], np.cumsum([len(p) + 8 for p in payloads])])[:-1] * 8
        pos = np.concatenate([s.astype(np.int64) + b for s, b in zip(starts, base)])
        steps = min(every, max(sizes, default=0))
        out = np.empty((steps, len(pos)), dtype=np.uint32)
        last, shift, mask = len(window) - 1, 32 - self.bits, (1 << self.bits) - 1
        for k in range(steps):
            peek = (window[np.minimum(pos >> 3, last)] >> (shift - (pos & 7)).astype(np.uint32)) & mask
            out[k] = self.symbol_at[peek]
            pos += self.length_at[peek]
        result, lane = [], 0
        for n, s in zip(sizes, starts):
            result.append(out[:, lane:lane + len(s)].T.reshape(-1)[:n])
            lane += len(s)
        return result
