"""Top-k search over many query groups; shards against a plain permutation."""

import random
import struct

import pytest
import xxhash

from quarry.llm import topk_search
from quarry.llm.sharding import shard_documents


def test_many_groups_and_blocks_equal_brute_force(spark, monkeypatch):
    for name, n in (("QUERIES", 3), ("GROUP", 2), ("CANDIDATES", 4), ("HEAD", 5)):
        monkeypatch.setattr(topk_search, name, n)
    rng = random.Random(4)
    rows = [(k, [float(rng.randint(-9, 9)) * (1 + k % 7) for _ in range(5)]) for k in range(300)]
    rows += [(7, [1.0] * 5), (300, [0.0] * 5), (None, [2.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.top_k(df, every=10, k=4, scale=1).collect()
    known = [(i, v) for i, v in rows if i is not None]
    want = set()
    for q, v in known:
        if q % 10 == 0:
            scores = sorted((-int(sum(x * y for x, y in zip(v, w))), i) for i, w in known if i != q)[:4]
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_no_cross_join(spark, capsys):
    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(200)], "vec_id long, embedding array<double>")
    topk_search.top_k(df).explain("formatted")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def plain_place(x, n, seed):
    """Feistel network over a grid of at least n places, walked until the place is below n."""
    a = 1
    while a * a < n:
        a += 1
    b = -(-n // a)

    def mixed(value, key, m):
        h = 42
        for word in (value, key):
            h = xxhash.xxh64_intdigest(struct.pack("<q", word), seed=h)
        return (h - (1 << 64) if h >> 63 else h) % m

    p = x
    while True:
        left, right = divmod(p, b)
        for k in range(6):
            if k % 2 == 0:
                left = (left + mixed(right, seed * 1000 + k, a)) % a
            else:
                right = (right + mixed(left, seed * 1000 + k, b)) % b
        p = left * b + right
        if p < n:
            return p


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1009])
def test_shards_follow_the_plain_permutation(spark, n):
    docs = spark.range(n).selectExpr("id * 3 AS doc_id", "repeat('x', CAST(id AS INT)) AS text").repartition(5)
    for seed in (20, 21):
        places = [plain_place(k, n, seed) for k in range(n)]
        assert sorted(places) == list(range(n))
        got = {r.doc_id: (r.shard, r.slot) for r in shard_documents(docs, 8, seed).collect()}
        assert got == {3 * k: (p % 8, p // 8) for k, p in enumerate(places)}


def test_shards_of_null_and_repeated_ids_keep_every_row(spark):
    docs = spark.createDataFrame([(None, "a"), (None, None), (1, "a"), (1, "a"), (1, "b")], "doc_id long, text string")
    got = shard_documents(docs, 2).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "None", "None"]
