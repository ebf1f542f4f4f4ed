"""Encode whole texts with a public tokenizer, one cache of words per worker.

Both tokenizers cut a text into pieces before any merge, and never across the
edge from a non-space to a white-space character. Pieces between such edges
are therefore encoded once per worker and looked up afterwards; texts whose
white space does not allow that cut are encoded whole. A batch of texts is cut
by Arrow, so Python sees the distinct pieces of a batch only. ``tests/llm``
holds all ways against each other.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm.common import worker_cache

CACHE_WORDS = 400_000  # pieces of a generation; a worker keeps the last two
BATCH_BYTES = 16 << 20  # text that is cut at once; longer texts are encoded one by one

#: byte-level: a piece is a word with its leading space, or one line end.
_BYTE_PIECE = re.compile(r"\n| ?[^ \n]+")
#: other or repeated white space, a last space, or text of a special token
_BYTE_ODD = re.compile(r"[^\S \n]|\s\s| \Z|<\|")
#: punctuation behind a Latin letter or digit starts a piece in both vocabularies
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS = frozenset(_PUNCTUATION)
#: letters that end in a mark once they are normalised and lower case
_ENDS = ("\u0130\u0958-\u095f\u09dc\u09dd\u09df\u0a33\u0a36\u0a59-\u0a5b\u0a5e\u0b5c\u0b5d\u0f43\u0f4d"
          "\u0f52\u0f57\u0f5c\u0f69\ufb1d\ufb1f\ufb2a-\ufb36\ufb38-\ufb3c\ufb3e\ufb40\ufb41\ufb43\ufb44"
          "\ufb46-\ufb4e")
#: a full stop or comma that ends a run of punctuation, which is one piece
_GLUED = re.compile(f"[.,](?<=[^\\w\\s].|[_{_ENDS}].)\\s")
#: a full stop or comma that may belong to a piece with what is before it
_BYTE_GLUED = re.compile("[.,](?<![0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff].)[ \\n]")


def _byte_pieces(text: str) -> list[str]:
    """What ``_BYTE_PIECE`` finds, and empty pieces beside outer white space; a stop
    or comma between a Latin letter or digit and white space is a piece."""
    if "\0" in text:
        return _BYTE_PIECE.findall(text)
    cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
    if not _BYTE_GLUED.search(text):
        cut = cut.replace(",\0", "\0,\0").replace(".\0", "\0.\0")
    return cut.split("\0")


def _byte_odd(text: str) -> bool:
    """``_BYTE_ODD``; most texts have single spaces or line ends and need no search."""
    if " ".join(text.split()) == text.replace("\n", " "):
        return "<|" in text
    return _BYTE_ODD.search(text) is not None


def _word_odd(text: str) -> bool:
    """White space only separates; \\x1c-\\x1f is white space to split() alone."""
    return "<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text


def _word_pieces(text: str) -> list[str]:
    """Words; a stop or comma between a letter and white space is a word. The
    vocabulary is lower case, and inside Latin-1 lower() is its own rule."""
    try:
        text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    if not _GLUED.search(text):
        for mark in ".,":
            text = text.replace(f"{mark} ", f" {mark} ").replace(f"{mark}\n", f" {mark}\n")
    return text.split()


#: for Arrow (RE2, whose \\s is ASCII) what the patterns above say; more texts may be odd or glued, with the same ids
_SPACES = r"\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BYTE_ODD_RE2 = rf"[\x00{_SPACES}]|[ \n][ \n]| \z|<\|"
_BYTE_GLUED_RE2 = r"(?:\A|[^0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])[.,][ \n]"
_WORD_ODD_RE2 = r"[\x1c-\x1f]|<\|"
_GLUED_RE2 = rf"(?:[^\pL\pN\s]|[{_ENDS}])[.,][ \n]"


def _replaced(texts: pa.Array, *pairs: tuple[str, str]) -> pa.Array:
    for old, new in pairs:
        texts = pc.replace_substring(texts, old, new)
    return texts


def _byte_cut(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """``_byte_pieces`` of all texts but the odd ones, and which those are."""
    odd = pc.match_substring_regex(texts, _BYTE_ODD_RE2)
    texts = pc.if_else(odd, "", texts)
    cut = _replaced(texts, (" ", "\0 "), ("\n", "\0\n\0"))
    marked = _replaced(cut, (",\0", "\0,\0"), (".\0", "\0.\0"))
    return pc.split_pattern(pc.if_else(pc.match_substring_regex(texts, _BYTE_GLUED_RE2), cut, marked), "\0"), odd


def _word_cut(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """``_word_pieces`` of all texts but the odd ones (empty pieces beside outer white space), and which those are."""
    odd = pc.match_substring_regex(texts, _WORD_ODD_RE2)
    texts = pc.if_else(odd, "", texts)
    texts = pc.if_else(pc.match_substring_regex(texts, r"[^\x00-\x{ff}]"), texts, pc.utf8_lower(texts))
    marked = _replaced(texts, (". ", " . "), (".\n", " .\n"), (", ", " , "), (",\n", " ,\n"))
    return pc.utf8_split_whitespace(pc.if_else(pc.match_substring_regex(texts, _GLUED_RE2), texts, marked)), odd


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file; every node has the package installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, path: str, byte_level: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.model.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.pieces, self.odd = (_byte_pieces, _byte_odd) if byte_level else (_word_pieces, _word_odd)
        self.cut = _byte_cut if byte_level else _word_cut
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # ids that begin a word (with its space) or end one
        names = [t for t, _ in sorted(self.model.get_vocab().items(), key=lambda x: x[1])]
        self.byte_level = byte_level
        self.edges = np.array([t.startswith("\u0120") if byte_level else t.endswith("</w>") for t in names])
        self.line = self.model.token_to_id("\u010a")

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _encode_joined(self, words: list[str], lines: bool = False) -> list[bytes]:
        """Words encoded as one text, which is cut again before every id that
        begins with a space or after every id that ends a word; ``lines``: words
        without a space, cut at the line ends between them."""
        text = ("\n" if lines else "" if self.byte_level else " ").join(words)
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
        at = np.flatnonzero(ids == self.line if lines else self.edges[ids])
        if len(at) != len(words) - lines:
            return [self._pack(e.ids) for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
        wide = self.kind.itemsize
        raw = ids.tobytes()
        if lines:
            return [raw[x:y] for x, y in zip([0, *((at + 1) * wide).tolist()], [*(at * wide).tolist(), len(raw)])]
        if self.byte_level:
            cuts = [*(at * wide).tolist(), len(raw)]
        else:
            cuts = [0, *((at + 1) * wide).tolist()]
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def _learn(self, words: list[str]) -> None:
        """Put all ``words`` (distinct, none in the cache) into the cache; a word with
        punctuation behind it is made of the word and the punctuation."""
        cache, old = self.cache, self.old
        new, parts, glued = [], set(), []
        for w, known in zip(words, map(old.get, words)):
            if known is not None:
                cache[w] = known
            elif w[-1:] in _MARKS and (stem := w.rstrip(_PUNCTUATION)) and stem[-1] <= "\u00ff" and stem[-1].isalnum():
                end = w[len(stem):]
                glued.append((w, stem, end))
                parts.add(stem)
                parts.add(end)
            else:
                new.append(w)
        for x in parts.difference(cache, new):
            if x in old:
                cache[x] = old[x]
            else:
                new.append(x)
        joined, lines, plain = [], [], []
        for w in new:
            if w[:1] == " " if self.byte_level else w.isalpha():
                joined.append(w)
            elif self.byte_level and w.isalpha():
                lines.append(w)
            else:
                plain.append(w)
        for kind in (joined, lines):
            for i in range(0, len(kind), 4096):
                some = kind[i:i + 4096]
                cache.update(zip(some, self._encode_joined(some, kind is lines)))
        for i in range(0, len(plain), 4096):
            some = plain[i:i + 4096]
            for w, e in zip(some, self.model.encode_batch_fast(some, add_special_tokens=False)):
                cache[w] = self._pack(e.ids)
        for w, stem, end in glued:
            cache[w] = cache[stem] + cache[end]

    def encode(self, text: str | None) -> bytes:
        """Ids of one text, packed as ``self.kind``."""
        if not text:
            return b""
        if self.odd(text):
            return self._pack(self.model.encode(text, add_special_tokens=False).ids)
        words = self.pieces(text)
        self._know(set(words))
        return b"".join(map(self.cache.__getitem__, words))

    def _know(self, words: set[str] | list[str]) -> None:
        """Have all ``words`` (distinct) in the cache."""
        missing = [w for w, known in zip(words, map(self.cache.get, words)) if known is None]
        if missing:
            if len(self.cache) + 2 * len(missing) > CACHE_WORDS:  # a new generation starts: look all of them up in it
                self.old, self.cache = self.cache, {}
                missing = list(words)
            self._learn(missing)

    def encode_batch(self, texts: pa.Array, end: bytes = b"") -> Iterator[pa.Array]:
        """Ids of all texts with ``end`` behind each, packed as ``self.kind``, in
        arrays of some texts each that follow one another."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            to = int(np.searchsorted(sizes, done + BATCH_BYTES, "right"))
            if to > at:
                yield self._encode_some(texts.slice(at, to - at), end)
            else:
                to = at + 1
                yield pa.array([self.encode(texts[at].as_py()) + end], pa.binary())
            at = to

    def _encode_some(self, texts: pa.Array, end: bytes) -> pa.Array:
        lists, odd = self.cut(pc.fill_null(texts, ""))
        pieces = lists.flatten().dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        self._know(distinct)
        ids = list(map(self.cache.__getitem__, distinct))
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        # an odd text is a piece, and so is the end
        words = len(ids)
        ids += [self.encode(texts[int(k)].as_py()) for k in whole]
        more = np.ones(len(texts), dtype=np.int64)
        more[whole] = 2
        last = np.cumsum(more)
        added = np.full(last[-1], len(ids), dtype=np.int32)
        added[last[whole] - 2] = np.arange(words, len(ids))
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
        codes = np.insert(pieces.indices.to_numpy(), np.repeat(ends, more), added)
        taken = pa.array([*ids, end], pa.binary()).take(pa.array(codes))
        _, offsets, data = taken.buffers()
        cuts = np.frombuffer(offsets, dtype=np.int32)[taken.offset:][np.concatenate([[0], ends + last])]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts), data])


def encoder(path: str, byte_level: bool) -> Encoder:
    """One encoder per Python worker process; workers are reused across tasks."""
    kept = worker_cache("tokens")
    key = (path, byte_level)
    if key not in kept:
        kept[key] = Encoder(path, byte_level)
    return kept[key]
