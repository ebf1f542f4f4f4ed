"""Near duplicates from bottom-k sketches of one hash function.

1. Every document's set of word shingles is hashed once; equal sets form a
   class, and a class keeps the K smallest hashes (its sketch).
2. Inverted lists: keys are runs of three neighbouring retained values, so a
   frequent shingle alone makes no list. Two sets whose union is retained
   whole always share a run at similarity 0.8 (of U values at most U/5 are
   unshared, which leaves three shared in a row for U >= 6; U = 5 has keys of
   its own); for larger sets the chance to share none is below 1e-6.
3. Each list gives its pairs with the list's most connected class (which has
   most entries beside it over all its lists: an original before its edited
   copies). They are estimated on the sketch of the union (its K smallest
   values), then verified on the full sets. Links join classes to components.
4. Lists that still hold several components are compared in blocks, only
   across components and by the estimate. A block reports which classes hang
   together by such pairs, as a forest: fewer rows than it has classes.
5. The classes that hang together over all lists form groups. Each group is
   compared in blocks on the full sets; a block returns a forest of verified
   links. After that every pair of a list is either compared or known to be
   connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import batches_of, require_columns, small, staged, task_of
from quarry.llm.components import components

K = 256  # retained values, 32 bits of each
KEYED = 48  # of them make the keys of the inverted lists
#: of the K smallest of a union so many are shared at similarity 0.8, but for a chance below 1e-6
LEAST_SHARED = 171
BLOCK = 1536  # classes of a list or group compared at once
BLOCK_CHARS = 1 << 23  # about so many characters of a group's texts make a block
HEAD = 256  # pairs of a class checked in one go; more are dealt over several tasks

SLICE = 1024  # rows of an Arrow batch, and of texts that are Python strings at a time
COLUMNS = 4096  # values whose overlaps are counted by one matrix product
_PAD = np.iinfo(np.int64).max


def shingles(text: str | None, size: int) -> set[bytes]:
    """Distinct ``size``-word shingles; fewer words are one shingle, none give none.
    ``bytes`` lower() and split() are exactly A-Z and the ASCII white space."""
    words = text.encode().lower().split() if text else []
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    if size == 2:
        return {a + b" " + b for a, b in set(zip(words, words[1:]))}
    return {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def _sketch(size: int):
    digest, h = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sizes, prints, kept = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text, size)
                values = np.fromiter(map(h, own), dtype=np.uint64, count=len(own)).view(np.int64)
                values.sort()
                sizes.append(len(own))
                prints.append(digest(values.tobytes()))
                kept.append(values[:K] >> 32)
            ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, dtype=np.int64), *kept]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "n", "digest", "sketch"])
    return task_of("near_dup", run)


def _list_keys(n: Column, sketch: Column) -> Column:
    s = F.slice(sketch, 1, KEYED)
    runs = F.when(F.size(s) >= 3, F.transform(
        F.sequence(F.lit(1), F.size(s) - 2), lambda i: F.xxhash64(
            F.element_at(s, i), F.element_at(s, i + 1), F.element_at(s, i + 2)))).otherwise(F.array().cast("array<long>"))
    # a set of four inside a set of five
    four = lambda *at: F.xxhash64(F.lit("four"), *[F.get(s, F.lit(i)) for i in at])
    tiny = (F.when(n == 4, F.array(four(0, 1, 2, 3)))
            .when(n == 5, F.array(*[four(*[i for i in range(5) if i != out]) for out in range(5)]))
            .otherwise(F.array().cast("array<long>")))
    return F.array_distinct(F.concat(runs, tiny))


def _alike(n_a: Column, s_a: Column, n_b: Column, s_b: Column, percent: int) -> Column:
    """May the pair reach the threshold? Sizes first, then the union sketch."""
    union = F.slice(F.array_sort(F.array_union(s_a, s_b)), 1, K)
    shared = F.size(F.array_intersect(union, F.array_intersect(s_a, s_b)))
    whole = (n_a <= K) & (n_b <= K) & (F.size(F.array_union(s_a, s_b)) <= K)
    return ((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
            & F.when(whole, (shared + 1) * 100 >= F.size(union) * percent).otherwise(shared >= LEAST_SHARED))


def _verify(size: int, percent: int):
    """Keep the pairs whose full sets reach the threshold; rows of a class follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, set()
        for batch in _slices(batches):
            keep = []
            for x, y in zip(*[batch.column(c).to_pylist() for c in ("text_a", "text_b")]):
                if x != held:
                    held, own = x, shingles(x, size)
                other = shingles(y, size)
                both = len(own & other)
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return task_of("near_dup", run)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct texts of the ids; an id that repeats has each of its texts."""
    return docs.select("doc_id", "text").join(small(ids), "doc_id", "left_semi").distinct()


def _dealt(pairs: DataFrame) -> DataFrame:
    """Pairs with ``_salt``, which splits the pairs of a class that has many, and the
    number of its salts: a frequent class meets its partners in several tasks."""
    many = staged(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HEAD).cast("int").alias("_salts"))
                  .filter("_salts > 1"), "heads")
    return (pairs.join(small(many), "a", "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
            .withColumn("_salt", F.pmod(F.xxhash64("b"), F.col("_salts")).cast("int")))


def _salted(side: DataFrame, dealt: DataFrame) -> DataFrame:
    """A row of ``side`` (with column a) for each salt of its class."""
    salts = dealt.filter("_salts > 1").select("a", "_salts").distinct()
    return (side.join(small(salts), "a", "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts"))


def _links(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Exact check of candidate pairs (with salts). Only texts of candidates are
    shuffled: the list of their ids is broadcast if it is short, else joined."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidates")
    texts = _texts(docs, ids)
    second = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    first = _salted(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), pairs)
    both = second.join(first, ["a", "_salt"])
    return staged(both.select("a", "b", "text_a", "text_b")
                  .mapInArrow(_verify(size, percent), "a long, b long").distinct(), "links")


def _shared(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """The estimate of ``_alike`` for rows of padded sketches."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != _PAD
    twice = np.zeros(both.shape, dtype=bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(~twice & real, axis=1)
    shared = (twice & (rank <= K)).sum(axis=1)
    union = (~twice & real).sum(axis=1)
    whole = (n_a <= K) & (n_b <= K) & (union <= K)
    return np.where(whole, 100 * (shared + 1) >= percent * union, shared >= LEAST_SHARED)


def _overlaps(sketches: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of values that rows of ``left`` and ``right`` share."""
    row = np.repeat(np.arange(len(sketches)), [len(x) for x in sketches])
    _, column, count = np.unique(np.concatenate(sketches), return_inverse=True, return_counts=True)
    often = count > 1
    column = np.where(often[column], (np.cumsum(often) - 1)[column], -1)
    total = np.zeros((len(left), len(right)))
    for at in range(0, int(often.sum()), COLUMNS):
        own = (column >= at) & (column < at + COLUMNS)
        has = np.zeros((len(sketches), COLUMNS), dtype=np.float32)
        has[row[own], column[own] - at] = 1
        total += has[left] @ has[right].T
    return total


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``label`` (smallest member of each node's group) once the pairs x, y are joined."""
    while True:
        low = np.minimum(label[x], label[y])
        more = label.copy()
        for side in (x, y):
            np.minimum.at(more, label[side], low)
        more = more[more]
        if (more == label).all():
            return label
        label = more


def _across(rows: list[tuple], comp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of blocks i and j of one (key, i, j), and which pairs are across components, once each."""
    block = np.array([r[5] for r in rows])
    left, right = np.flatnonzero(block == rows[0][1]), np.flatnonzero(block == rows[0][2])
    ok = comp[left][:, None] != comp[right][None, :]
    return left, right, ok if rows[0][1] != rows[0][2] else np.triu(ok, 1)


def _by_block(decide):
    """Rows sorted by (key, i, j): call ``decide`` on the rows of each; it returns links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in _with_end(_slices(batches)):
            a, b = [], []
            for r in _rows(batch) if batch is not None else [(None,) * 3]:
                if held and r[:3] != held[0][:3]:
                    x, y = decide(held)
                    a, b, held = a + x, b + y, []
                held.append(r)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return task_of("near_dup", run)


def _estimate_block(percent: int):
    """Rows (key, i, j, rep, comp, block, n, sketch): who hangs together by pairs that may reach the threshold.

    Matrix products count all overlaps of two blocks; the estimate on the union
    sketch decides on the pairs that this leaves, unless they hang together already.
    """
    def decide(rows: list[tuple]) -> tuple[list[int], list[int]]:
        ids, comp, n = (np.array([r[c] for r in rows]) for c in (3, 4, 6))
        size = np.array([len(r[7]) for r in rows])
        left, right, ok = _across(rows, comp)
        ok &= 100 * np.minimum.outer(n[left], n[right]) >= percent * np.maximum.outer(n[left], n[right])
        if len(rows) > 16 and ok.any():
            both = _overlaps([r[7] for r in rows], left, right)
            sizes = np.add.outer(size[left], size[right])
            whole = np.logical_and.outer(n[left] <= K, n[right] <= K) & (sizes - both <= K)
            ok &= np.where(whole, (100 + percent) * (both + 1) >= percent * sizes, both >= LEAST_SHARED)
        x, y = np.nonzero(ok)
        if not len(x):
            return [], []
        x, y = left[x], right[y]
        sketch = np.full((len(rows), K), _PAD)
        for k, r in enumerate(rows):
            sketch[k, :len(r[7])] = r[7]
        label = np.arange(len(rows))
        while len(x):
            i, j = x[:4096], y[:4096]
            good = _shared(sketch[i], sketch[j], n[i], n[j], percent)
            label = _joined(label, i[good], j[good])
            x, y = x[4096:], y[4096:]
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
        hung = np.flatnonzero(label != np.arange(len(rows)))
        return ids[hung].tolist(), ids[label[hung]].tolist()
    return _by_block(decide)


def _verify_block(size: int, percent: int):
    """Rows (key, i, j, rep, comp, block, text): a forest of links between
    components whose full sets reach the threshold. Overlaps are counted on
    64-bit hashes, each link is then confirmed on the shingles themselves."""
    h = xxhash.xxh3_64_intdigest

    def decide(rows: list[tuple]) -> tuple[list[int], list[int]]:
        comp = np.unique(np.array([r[4] for r in rows]), return_inverse=True)[1]
        left, right, ok = _across(rows, comp)
        sets = []
        for r in rows:
            own = shingles(r[6], size)
            sets.append(np.fromiter(map(h, own), dtype=np.uint64, count=len(own)))
        n = np.array([len(x) for x in sets])
        both = _overlaps(sets, left, right)
        ok &= 100 * both >= percent * (np.add.outer(n[left], n[right]) - both)
        x, y = np.nonzero(ok)
        root = list(range(int(comp.max()) + 1))

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c
        a, b, c = [], [], comp.tolist()
        for i, j in zip(left[x].tolist(), right[y].tolist()):
            u, v = find(c[i]), find(c[j])
            if u != v:
                one, two = shingles(rows[i][6], size), shingles(rows[j][6], size)
                if 100 * len(one & two) >= percent * len(one | two):
                    root[v] = u
                    a.append(rows[i][3])
                    b.append(rows[j][3])
        return a, b
    return _by_block(decide)


def _in_blocks(members: DataFrame, weight: Column, *columns: str) -> DataFrame:
    """Rows (key, i, j, rep, comp, block, ...) of ``members`` for every pair of blocks of a
    key, sorted; blocks hold about ``BLOCK`` classes and at most a bounded ``weight``."""
    blocks = members.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)),
                                                   F.ceil(F.sum(weight) / F.lit(BLOCK_CHARS))).alias("_g"))
    return (members.join(blocks, "key")
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("_g")))
            .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_g") - 1)))
            .select("key", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "rep", "comp",
                    "block", *columns)
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep"))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of plain values; an array in the last column stays one."""
    *plain, last = batch.columns
    if not pa.types.is_list(last.type):
        return zip(*[c.to_pylist() for c in batch.columns])
    flat, ends = last.values.to_numpy(), last.offsets.to_numpy()
    return zip(*[c.to_pylist() for c in plain], (flat[x:y].astype(np.int64) for x, y in zip(ends, ends[1:])))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``SLICE`` rows."""
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable
    over links of ``percent`` % similarity or more), kept.

    Needs doc_id and text; extra columns are ignored. NULL, empty and blank
    texts have no shingles and link with nothing. A NULL id has only exact
    copies as links and loses to any id. Rows that repeat an id are one
    document. An empty table gives no rows. Keys and ``LEAST_SHARED`` are made
    for 80 % or more; a lower ``percent`` would miss links and raises ValueError.
    """
    if not 80 <= percent <= 100:
        raise ValueError(f"percent must be 80 to 100, not {percent}")
    require_columns(docs, "doc_id", "text")
    with batches_of(docs.sparkSession, SLICE):
        return _near_duplicates(docs.select("doc_id", "text"), size, percent)


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    rows = staged(docs.mapInArrow(_sketch(size),
                                  "doc_id long, n long, digest binary, sketch array<int>"), "sketches")
    classes = staged(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest", "n").agg(
        F.min("doc_id").alias("rep"), F.min_by("sketch", "doc_id").alias("sketch")), "classes")

    keys = classes.select("rep", F.explode(_list_keys(F.col("n"), F.col("sketch"))).alias("key"))
    shared = (keys.groupBy("key").agg(F.count(F.lit(1)).alias("_c"), F.min("rep").alias("_x"), F.max("rep").alias("_y"))
              .filter(F.col("_x") != F.col("_y")))
    entries = staged(keys.join(shared.select("key", "_c"), "key"), "entries")
    degree = entries.groupBy("rep").agg(F.sum("_c").alias("_d"))
    ranked = staged(entries.join(degree, "rep").select("key", "rep", F.struct("_d", (-F.col("rep")).alias("_r"))
                                                       .alias("_rank")), "ranked")
    heads = ranked.groupBy("key").agg(F.max("_rank").alias("_top"))
    lists = staged(ranked.join(heads, "key").select("key", "rep", (-F.col("_top._r")).alias("head")), "lists")
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"),
                                    F.col("sketch").alias(f"s_{x}"))
    pairs = staged(_dealt(lists.filter("rep != head").select(
        F.least("head", "rep").alias("a"), F.greatest("head", "rep").alias("b")).distinct()), "head-pairs")
    pairs = (pairs.join(side("b"), "b").join(_salted(side("a"), pairs), ["a", "_salt"])
             .filter(_alike(F.col("n_a"), F.col("s_a"), F.col("n_b"), F.col("s_b"), percent))
             .select("a", "b", "_salt", "_salts").distinct())
    links = _links(staged(pairs, "pairs"), docs, size, percent)
    groups = staged(components(links), "components")

    comp = F.coalesce("component", "rep").alias("comp")
    placed = staged(lists.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("key", "rep", comp), "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).filter("_x != _y")
    members = placed.join(mixed.select("key"), "key").join(classes.select("rep", "n", "sketch"), "rep")
    hung = staged(_in_blocks(members, F.lit(0), "n", "sketch")
                  .mapInArrow(_estimate_block(percent), "a long, b long").distinct(), "hung")
    if not hung.isEmpty():
        together = staged(components(hung).select(F.col("id").alias("rep"), F.col("component").alias("key")), "groups")
        texts = _texts(docs, together.select(F.col("rep").alias("doc_id"))).withColumnRenamed("doc_id", "rep")
        members = (together.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("key", "rep", comp)
                   .join(texts, "rep"))
        more = staged(_in_blocks(staged(members, "members"), F.length("text"), "text")
                      .mapInArrow(_verify_block(size, percent), "a long, b long"), "links")
        groups = staged(components(links.select("a", "b").union(more)), "components")

    found = (classes.join(groups.withColumnRenamed("id", "rep"), "rep", "left")
             .select("digest", F.coalesce("component", "rep").alias("_comp")))
    return (rows.join(found, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("_comp", "doc_id")).otherwise(F.col("doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))
