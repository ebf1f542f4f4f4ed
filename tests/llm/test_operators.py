"""Each operator against a brute-force version on a small table with NULLs,
empty texts, ties, repeated rows and extra columns, and on an empty table."""

import hashlib
import random
import zlib

import numpy as np
import pytest

SCHEMA = "doc_id long, text string, source string, label string, score double, part int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    out, passage = [], " ".join(rng.choice(words) for _ in range(30))
    for k in range(120):
        text = " ".join(rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(1, 120)))
        if k % 7 == 0:
            text = text + "\n" + passage + " \t x  y"
        if out and k % 5 == 0:  # a near copy
            base = (out[rng.randrange(len(out))][1] or "").split(" ")
            for _ in range(max(1, len(base) // 30)):
                base[rng.randrange(len(base))] = rng.choice(words)
            text = " ".join(base)
        if out and k % 11 == 0:  # an exact copy but for white space
            text = (out[-1][1] or "").replace(" ", "  ")
        out.append((k * 3 + 1, text, f"s{k % 3}", "x", 0.5, k))
    out += [(2, None, None, None, None, None), (5, "", "s0", "x", 1.0, 1), (8, " \n\t", "s0", "x", 1.0, 1),
            (11, "Ünïcode 日本語 <|endoftext|> x. it's \"so.\" \x1c y", "s1", "x", 1.0, 1),
            (400, "a b c d e", "s1", "x", 1.0, 1), (401, "A b c d e f", "s1", "x", 1.0, 1)]
    out.append(max(out, key=lambda r: len(r[1] or ""))[:1] + out[3][1:])  # an id that repeats
    return [(10_000 + i, *r[1:]) if i == len(out) - 1 else r for i, r in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def byte_words(text):
    return (text or "").encode().lower().split()


def plain_components(rows, size, percent):
    sets = {}
    for r in rows:
        w = byte_words(r[1])
        sets[r[0]] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("size", [1, 2, 5])
def test_near_duplicates(docs, empty, rows, size):
    from quarry.llm.near_dup import near_duplicates
    want = plain_components(rows, size, 80)
    got = near_duplicates(docs, size, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert any(r.doc_id != r.component_id for r in got)
    if size == 2:
        assert near_duplicates(empty, 2).collect() == []


def test_near_duplicates_refuses_thresholds_its_keys_miss(docs):
    from quarry.llm.near_dup import near_duplicates
    for percent in (79, 70, 0, 101):
        with pytest.raises(ValueError):
            near_duplicates(docs, 2, percent)


def test_near_copies_of_small_sets(spark):
    """Four shingles inside five, the one case without a shared run of three."""
    from quarry.llm.near_dup import near_duplicates
    rows = []
    for k in range(60):
        five = [f"w{k}{c}" for c in "abcde"]
        rows += [(100 * k + out, " ".join(w for i, w in enumerate(five) if i != out)) for out in range(5)]
        rows.append((100 * k + 9, " ".join(five)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, 1, 80).collect()}
    assert got == {d: c for d, (_, c) in plain_components(rows, 1, 80).items()}


def test_exact_duplicates(docs, empty, rows):
    from quarry.llm.exact_dup import exact_duplicates
    norm = lambda t: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r)
    for counters in (2, 1024):
        got = exact_duplicates(docs, counters=counters).collect()
        assert len(got) == len(rows)
        for g in got:
            text = next(r[1] for r in rows if r[0] == g.doc_id)
            own = groups[norm(text)]
            keep = min(own, key=lambda r: (-len(r[1] or ""), r[0]))[0]
            assert (g.keep_id, g.group_size, g.kept) == (keep, len(own), g.doc_id == keep)
            assert g.text_sha256 == hashlib.sha256(norm(text).encode()).hexdigest()
    assert exact_duplicates(empty).collect() == []


def test_repeated_passages(docs, empty, rows):
    from quarry.llm.suffix_dedup import cut_report
    first, want = {}, {}
    for r in sorted(rows, key=lambda r: r[0]):
        raw = (r[1] or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - 49):
            if first.setdefault(raw[p:p + 50], r[0]) < r[0]:
                gone[p:p + 50] = True
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[r[0]] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in cut_report(docs).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 1000
    assert cut_report(empty).collect() == []


def ids_of(name, rows, end):
    from tokenizers import Tokenizer
    from quarry.llm.tokens import tokenizer_path
    model = Tokenizer.from_file(tokenizer_path(name))
    return {r[0]: model.encode(r[1] or "", add_special_tokens=False).ids + [end] for r in rows}


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_token_file_round_trip(spark, docs, empty, rows, tmp_path):
    from quarry.llm.token_file import read_token_file, write_token_file
    from quarry.llm.tokens import tokenizer_path
    path = tokenizer_path("byte_bpe_50k.json")
    want, start = {}, 0
    for d, ids in sorted(ids_of("byte_bpe_50k.json", rows, 0).items()):
        want[d] = (start, len(ids), packed(ids))
        start += len(ids)
    write_token_file(docs, str(tmp_path / "t"), path)
    got = {r.doc_id: (r.start, r.n_tokens, bytes(r.ids)) for r in read_token_file(spark, str(tmp_path / "t")).collect()}
    assert got == want
    write_token_file(empty, str(tmp_path / "e"), path)
    assert read_token_file(spark, str(tmp_path / "e")).collect() == []


@pytest.mark.parametrize("name, byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_words_encode_like_whole_texts(rows, monkeypatch, name, byte_level):
    from quarry.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 500)  # generations change many times
    enc = tokens.Encoder(tokens.tokenizer_path(name), byte_level)
    marks = [" ", " ", "\n", ".", ",", "!", "'", "'s", "'LL", "##", "a", "B", "\u00c9", "\u00df", "\u03a3", "\u0130", "1",
             "\u00b2", "\u00aa", "x", "<", "|", "_", "-", "\u2026", "\xa0", "\x85", "\u0301", "\u4e2d", "\x1c", "\0", "="]
    rng = random.Random(3)
    odd = ["".join(rng.choices(marks, k=rng.randint(1, 30))) for _ in range(5000)]
    for text in [r[1] for r in rows] + odd:
        ids = enc.model.encode(text or "", add_special_tokens=False).ids
        assert enc.encode(text) == enc._pack(ids), text


def test_code_lengths_are_optimal_and_limited():
    from quarry.llm.huffman import Coder, code_lengths
    rng = np.random.default_rng(1)
    counts = (1.5 ** np.arange(40)).astype(np.int64)
    for limit in (6, 12, 18):
        n = code_lengths(counts, limit).astype(int)
        assert n.max() <= limit and sum(2.0 ** -x for x in n) == 1.0
    coder = Coder(code_lengths(counts, 12))
    ids = rng.integers(0, 40, 1000)
    bits, marks = coder.encode(ids, 64)
    assert coder.decode([bits], [1000], [marks], 64)[0].tolist() == ids.tolist()


@pytest.mark.parametrize("shares", [None, {"s0": 1, "s1": 5}])
def test_packing(docs, empty, rows, shares):
    from quarry.llm.packing import pack
    from quarry.llm.tokens import tokenizer_path
    path = tokenizer_path("word_bpe_49k.json")
    want = ids_of("word_bpe_49k.json", rows, 2)
    got = pack(docs, path, length=256, shares=shares).collect()
    parts, windows = {}, {}
    for r in got:
        parts.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids)))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.doc_tokens == len(want[r.doc_id])
    assert {d: b"".join(x[2] for x in sorted(p)) for d, p in parts.items()} == {d: packed(i) for d, i in want.items()}
    full = sum(len(i) for i in want.values())
    assert sorted(windows) == list(range(-(-full // 256)))
    for w, p in windows.items():
        ends = [a + n for a, n in sorted(p)]
        assert [a for a, _ in sorted(p)] == [0, *ends[:-1]]
        assert ends[-1] == min(256, full - 256 * w)
    assert pack(empty, path).collect() == []


def test_packing_keeps_proportions():
    from quarry.llm.packing import Rounds
    totals = [100_000, 7, 5_000, 33_333]
    r = Rounds(totals)
    for w in range(1, r.total // 4096):
        for q, n in enumerate(totals):
            got = r.served(r.phases[0][1], q, 4096 * w)[0]
            assert abs(got - n / r.total * 4096 * w) < 3


@pytest.mark.parametrize("big, length", [(20_000, 16), (2 ** 33, 4096)])
@pytest.mark.parametrize("shares", [None, [7, 1, 1, 2, 3, 1, 2, 9]])
def test_packing_of_tiny_queues_between_large_ones(big, length, shares):
    """Documents of one token each: every window they reach is full, nothing twice."""
    from quarry.llm.packing import Rounds
    totals = [big, 1, 3, 2, 5, 1, 2, big]
    r = Rounds(totals, shares, length)
    windows = {}
    for q, n in enumerate(totals):
        for t in range(n if n < 10 else 0):
            (start, size, w, offset), = r.pieces(q, t, 1)
            assert (start, size) == (0, 1)
            windows.setdefault(w, []).append(offset)
    if big < 10 ** 6:
        windows |= {w: windows.get(w, []) for w in range(-(-r.total // length))}
    for q in (0, 7):  # the large queues' tokens of those windows: bisect for the first, take until the last
        for w, own in windows.items():
            lo, hi = 0, big
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if next(r.pieces(q, mid, 1))[2] < w else (lo, mid)
            for t in range(lo, big):
                _, _, at, offset = next(r.pieces(q, t, 1))
                if at != w:
                    break
                own.append(offset)
    for w, own in windows.items():
        assert sorted(own) == list(range(min(length, r.total - w * length))), w


def test_url_rules(spark):
    from quarry.llm.url_rules import DEFAULT_VERDICT, PAGE_RULES, judge_pages, judge_urls
    urls = [None, "", "no scheme", "http://Example.COM/en/1?x", "https://www.example.com/en/", "http://a.net/es/x#y",
            "http://net/fr/", "http://anet/fr/", "http://x.com", "http://x.com/", "http://", "ftp://b.example.com/en",
            "http://b.example.com/en/#/", "http://example.com:80/en/", "a://b://c.com/"] * 2
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")

    def plain(url, rules):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest
        for c in "/?#":
            host = host.split(c, 1)[0]
        path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
        host = host.translate({k: k + 32 for k in range(65, 91)})
        fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[2:] if fit else (None, DEFAULT_VERDICT)))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_pages(pages).collect()}
    assert got == {k: plain(u, PAGE_RULES) for k, u in enumerate(urls)}
    more = [("com", "/", "block"), ("example.com", "/en", "allow"), ("b.example.com", "/", "block"), ("x.com", "", "allow")]
    rules = spark.createDataFrame(more, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got == {k: plain(u, more) for k, u in enumerate(urls)}
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert {r.rule for r in judge_urls(pages, rules.limit(0)).collect()} == {None}


def test_top_k(spark):
    from quarry.llm.topk_search import top_k
    rng = np.random.default_rng(3)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=8)], 1) for k in range(500)]
    rows += [(500 + k, rows[7][1], 1) for k in range(30)]  # ties
    rows += [(600, None, 1), (601, [float("nan")] * 8, 1), (602, [None] * 8, 1), (603, [float("inf")] * 8, 1), (700, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    ok = {k: np.array([int(np.floor(1024 * x)) for x in v] + [0] * (8 - len(v)))
          for k, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (k for k in ok if k % 100 == 0):
        best = sorted(((-int(ok[q] @ v), k) for k, v in ok.items() if k != q))[:10]
        want |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(best)}
    assert {tuple(r) for r in top_k(df).collect()} == want
    assert top_k(df.limit(0)).collect() == []


def test_mixing(docs, empty, rows):
    from quarry.llm.mixing import mix_sources, schedule, whole_shares
    shares = whole_shares([0.5, 0.31, 0.1, 0.09], 64)
    done = [0] * 4
    for s, i, release, deadline, slot in schedule(shares):
        assert release <= slot < deadline and i == done[s]
        done[s] += 1
        assert all(abs(done[k] - shares[k] / 64 * (slot + 1)) < 1 for k in range(4))
    got = mix_sources(docs, block_bytes=256).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert sorted(r.position for r in got) == list(range(len(rows)))
    order = sorted(got, key=lambda r: r.position)
    assert [r.slot for r in order] == sorted(r.slot for r in got)
    assert mix_sources(empty).collect() == []


def test_mixing_keeps_exact_weights(docs, monkeypatch):
    from fractions import Fraction
    from quarry.llm import mixing
    weights = [1.0, 3e4, 0.37 * 1e5, 7.5]  # two are far under 1/4096
    exact = [Fraction(w) / sum(map(Fraction, weights)) for w in weights]
    done = [0] * 4
    _, size, plan = mixing.slot_plan(weights, [2, 9_000, 50_000, 8], 1)
    assert size == 1
    for s, i, release, deadline, slot in plan:
        assert i == done[s] and abs(i / exact[s] - release) <= 1 and release <= slot < deadline
        assert abs(i - exact[s] * slot) < 1 + 1e-6  # within a block of the target weight
        done[s] += 1
    assert done == [2, 9_000, 50_000, 8]
    given = dict(zip([None, "s0", "s1", "s2"], weights))
    whole = mixing.mix_sources(docs, given, block_bytes=256).collect()
    assert all(abs(r.weight - given[r.source] / sum(weights)) < 1e-9 for r in whole)
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 16)  # blocks grow until the schedule is short
    again = mixing.mix_sources(docs, given, block_bytes=1).collect()
    total = sum(r.size for r in again)
    assert {r.block_bytes for r in again} == {next(1 << k for k in range(40) if total >> k <= 16)}
    assert len({(r.source, r.block) for r in again}) <= 16 + 4 and len(again) == len(whole)
    for r in whole + again:  # within a block of the target weight, at every block size
        assert r.release <= r.slot < r.deadline
        assert abs(r.block - Fraction(given[r.source]) / sum(map(Fraction, weights)) * r.slot) < 1 + 1e-6


def test_mixing_of_a_source_of_tiny_weight():
    from quarry.llm import mixing
    _, _, plan = mixing.slot_plan([1e-9, 1.0], [3, 1_000], 1)
    assert len(plan) == 1_003  # no step for an empty slot
    assert all(release <= slot < deadline for _, _, release, deadline, slot in plan)
    assert len({x[4] for x in plan}) == len(plan)


def test_sharding(docs, empty, rows):
    from quarry.llm.sharding import shard_documents
    for shards in (1, 3, 8):
        got = shard_documents(docs, shards).collect()
        assert sorted((r.shard, r.slot) for r in got) == sorted((k % shards, k // shards) for k in range(len(rows)))
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert all((r["size"], r.text_crc32) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id])) for r in got)
    assert shard_documents(empty).collect() == []


def test_toxicity_learns_and_scores_every_row(spark, docs, empty):
    from quarry.llm.toxicity import score_documents, train
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefgh") * 3 for _ in range(40)) + (" vile scum" if k % 4 == 0 else ""))
            for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k, _ in rows] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    model = train(df, labels)
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    got = {r.doc_id: r.score for r in score_documents(df, model).collect()}
    assert all((got[k] >= 0.5) == (k % 4 == 0) for k in held)
    assert score_documents(docs, model, out="toxic").filter("toxic BETWEEN 0 AND 1").count() == docs.count()
    none = train(empty, labels.limit(0))
    assert {r.toxic for r in score_documents(docs, none, out="toxic").collect()} == {0.25}
    with pytest.raises(ValueError):
        score_documents(docs, model)


def test_pipeline_stages(spark, rows):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "packing"]
    df = p.near_dedup(spark, docs, sf)
    want = plain_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert df.columns == docs.columns
    assert {r.doc_id for r in df.collect()} == {d for d, (_, c) in want.items() if d == c}
    assert {r.doc_id for r in p.mix(spark, docs, sf).collect()} == set(want)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    safe = {r.doc_id for r in p.toxicity(spark, docs, sf).collect()}
    assert sum(d in safe for d, t in labels.items() if not t) >= 0.99 * sum(not t for t in labels.values())
    pieces = p.run(spark, sf).collect()
    assert sum(x.length for x in pieces) == sum({x.doc_id: x.doc_tokens for x in pieces}.values())
    for name, f in p.STAGES:
        assert f(spark, docs.limit(0), sf).collect() == []


def test_pipeline_packs_in_the_order_of_the_mix(spark, monkeypatch):
    import corpus_pipeline as p
    from quarry.llm.mixing import mix_sources
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    # the stages before mix only drop rows
    monkeypatch.setattr(p, "STAGES", [x for x in p.STAGES if x[0] in ("mix", "packing")])
    key = lambda rows: sorted((r.sequence_id, r.offset, r.doc_id, r.start, r.length) for r in rows)
    got = key(p.run(spark, sf).collect())
    place = {r.doc_id: r.position for r in mix_sources(docs, alpha=p.ALPHA).collect()}
    first = [d for _, _, d, start, _ in got if start == 0]
    assert first == sorted(place, key=place.get)  # documents begin in mixed order
    at = 0
    for w, offset, _, _, n in got:  # gapless
        assert 4096 * w + offset == at
        at += n
    names = sorted({r.source for r in docs.collect()}, key=str)
    weights = {s: 1 + 50 * k for k, s in enumerate(names)}
    monkeypatch.setattr(p, "mix_sources", lambda d, **kw: mix_sources(d, weights=weights))
    other = key(p.run(spark, sf).collect())
    assert other != got and sorted(x[2] for x in other if x[3] == 0) == sorted(first)
    monkeypatch.setattr(p, "STAGES", p.STAGES[1:])
    assert key(p.run(spark, sf).collect()) not in (got, other)


def test_pipeline_decides_repeated_ids_by_row(spark):
    import corpus_pipeline as p
    one, two, three = ("".join(f"{x}{k} " for k in range(60)) for x in "xyz")
    near = one.replace("x59 ", "other ")
    rows = [(1, one, "a"), (1, one, "a"), (2, one, "a"), (2, two, "a"), (2, two + " ", "b"), (3, three, "a"),
            (4, near, "a"), (4, "alone", "a"), (None, two, "a"), (None, two, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = p.exact_dedup(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, one, "a"), (2, two + " ", "b"), (3, three, "a"), (4, "alone", "a"), (4, near, "a")]
    assert sorted(tuple(r) for r in got.filter("doc_id IS NOT NULL").collect()) == sorted(want)
    assert got.filter("doc_id IS NULL").count() == 2  # never dropped
    got = p.near_dedup(spark, docs, "")
    left = [tuple(r) for r in got.filter("doc_id IS NOT NULL").collect()]
    assert sorted((d, t.strip()) for d, t, _ in left) == sorted(
        (d, t.strip()) for d, t in [(1, one), (2, two), (3, three), (4, "alone")])
    assert got.filter("doc_id IS NULL").count() == 2
