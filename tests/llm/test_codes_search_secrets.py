"""Vector codes, lexical search and secret scan against plain versions, on
tables with NULLs, empty and long texts, ties, repeated rows and extra columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

VECTORS = "vec_id long, embedding array<float>, label int, code string, error long"
DOCS = "doc_id long, text string, item int, score double"


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    kept = [(i, v + [0] * (dim - len(v)), label, v) for i, v, label in kept]
    w = dim // parts
    cut = lambda v: [v[p * w:(p + 1) * w] for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[3]))[:entries]
    books = [[cut(v)[p] for _, v, *_ in first] for p in range(parts)]

    def assign(v):
        out = []
        for p, x in enumerate(cut(v)):
            far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in books[p]]
            out.append((far.index(min(far)), min(far)))
        return out
    for _ in range(rounds):
        held = {}
        for _, v, *_ in kept:
            for p, (c, _) in enumerate(assign(v)):
                held.setdefault((p, c), []).append(cut(v)[p])
        for (p, c), own in held.items():
            books[p][c] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = [(i, label, "".join(f"{c:02x}" for c, _ in assign(v)), sum(d for _, d in assign(v)))
             for i, v, label, _ in kept]
    total = Counter()
    for _, label, _, e in coded:
        total[label] += e
    return Counter((i, code, e, total[label], digest) for i, label, code, e in coded)


def codes(df, **more):
    from quarry.llm.vector_codes import compress
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in compress(df, **more).collect())


@pytest.mark.parametrize("dim, size", [(32, 1.0), (48, 30_000.0)])
def test_codes(spark, dim, size):
    rng = random.Random(dim)
    rows = [(k * 5 % 311, [rng.gauss(0, size) for _ in range(dim)], rng.choice([0, 0, 1, None])) for k in range(300)]
    rows += [rows[7], rows[7], (rows[8][0], rows[9][1], 1), (None, rows[3][1], None), (900, rows[4][1], 2)]
    rows += [(901, None, 1), (902, [None] + [0.0] * (dim - 1), 1), (903, [math.nan] * dim, 1), (904, [math.inf] * dim, 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    assert codes(df) == plain_codes(rows)


def test_codes_of_few_and_uneven_vectors(spark):
    rows = [(1, [0.5, -0.25, 3.0], 1), (2, [0.5], 1), (3, [], None), (3, [], None), (4, [2.0] * 17, 1)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], VECTORS)
    assert codes(df, entries=3) == plain_codes(rows, entries=3)
    assert codes(df.limit(0)) == Counter()
    assert codes(df.filter("vec_id = 3")) == plain_codes(rows[2:4])


def test_codes_refuse_what_64_bits_cannot_hold(spark):
    from quarry.llm.vector_codes import compress
    df = spark.createDataFrame([(1, [1e30] * 16, 1, None, None)], VECTORS)
    with pytest.raises(ValueError):
        compress(df)


def test_dots_of_limbs_are_exact():
    from quarry.llm.vector_codes import LIMB, exact_dots, limbs
    rng = np.random.default_rng(5)
    for bits in (3, LIMB - 1, LIMB, 29, 35):
        top = 1 << bits
        x, c = rng.integers(-top, top + 1, (2, 5, 7)), rng.integers(-(1 << 24), 1 << 24, (2, 4, 7))
        x[0, 0], c[0, 0] = top, -(1 << 24)
        want = [[[sum(int(a) * int(b) for a, b in zip(u, v)) for v in c[p]] for u in x[p]] for p in range(2)]
        assert exact_dots(x, c).tolist() == want
        again = sum(part.astype(np.int64) << (LIMB * k) for k, part in enumerate(limbs(x)))
        assert (again == x).all() and all(np.abs(part).max() <= 1 << LIMB for part in limbs(x))
    wide = np.full((1, 1, 9000), (1 << LIMB) - 1)
    assert exact_dots(wide, wide)[0, 0, 0] == 9000 * ((1 << LIMB) - 1) ** 2


def plain_search(docs, items, k=20):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))
    bags = [(d, Counter(split(t)), len(split(t))) for d, t in docs]
    n, length = sum(1 for *_, s in bags if s), sum(s for *_, s in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    out = Counter()
    for item, text in items:
        found = []
        for d, bag, size in bags:
            if not size:
                continue
            m = 75 + 25 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10 ** 9 * bag[w] // (1000 * bag[w] + 12 * m))
                        for w in split(text) if w in bag)
            if score > 0:
                found.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(found)[:k], 1):
            out[item, rank, d, -score] += 1
    return out


def found(docs, items, **more):
    from quarry.llm.lexical_search import search
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in search(docs, items, **more).collect())


@pytest.fixture(scope="module")
def library():
    rng = random.Random(11)
    words = [f"w{k}é" if k % 5 == 0 else f"W{k}" for k in range(300)]
    weights = [1 / (k + 1) for k in range(300)]
    text = lambda n: " ".join(w + rng.choice(["", "", ",", "-x", "\x00"]) for w in rng.choices(words, weights, k=n))
    items = [(k, text(rng.randint(1, 40))) for k in range(30)]
    docs = [(k * 7 % 1009, text(rng.choice([1, 5, 30, 200]))) for k in range(600)]
    docs += [(2000 + k, text(20) + " " + items[k % 30][1]) for k in range(90)]  # passages of the items
    docs += [docs[3], docs[3], (docs[4][0], docs[5][1]), (None, docs[6][1]), (None, docs[6][1])]
    docs += [(3000 + k, "same words twice same") for k in range(50)]  # ties beyond k
    docs += [(4000, None), (4001, ""), (4002, " .,-"), (4003, text(30_000))]
    items += [(50, None), (51, ""), (52, "..."), (53, "nowhere"), (54, "SAME same Words"), (54, "twice"), (None, "twice")]
    return docs, items


def test_search(spark, library, monkeypatch):
    from quarry.llm import lexical_search
    docs, items = library
    d = spark.createDataFrame([(*r, 1, 0.5) for r in docs], DOCS).repartition(7)
    q = spark.createDataFrame([(*r, "x", 3) for r in items], "item_id long, text string, doc_id string, rank int")
    want = plain_search(docs, items)
    assert found(d, q) == want
    assert found(d, q, k=3) == plain_search(docs, items, 3)
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", 500)  # several groups of items
    assert found(d, q) == want


def test_search_of_empty_tables(spark, library):
    docs, items = library
    d = spark.createDataFrame([(*r, 1, 0.5) for r in docs[:20]], DOCS)
    q = spark.createDataFrame(items, "item_id long, text string")
    assert found(d, q.limit(0)) == found(d.limit(0), q) == found(d, q.filter("item_id = 52")) == Counter()


def test_pair_bounds_skip_and_hold(spark, library):
    """Bounds of pairs never pass the maxima's sum, and hold for every document."""
    from quarry.llm import lexical_search as ls
    import pyarrow as pa
    docs, items = library
    group = ls.Items([t for _, t in items])
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in docs], "text": [t for _, t in docs]})
    blocks = list(ls._blocks(group.vocabulary)(iter([batch])))
    n = sum(1 for _, t in docs if ls.terms(t))
    length = sum(len(ls.terms(t)) for _, t in docs)
    df = Counter(w for _, t in docs for w in set(ls.terms(t)))
    weights = np.array([ls.weight(n, df[w]) for w in group.vocabulary])
    group.pair_off(weights)
    tighter = 0
    for b in ls._records(ls._index(group, weights, n, length, 5)(iter(blocks))):
        start = np.concatenate([[0], b["ends"]])
        impact = np.zeros((len(b["ids"]), len(weights) + 1), dtype=np.int64)
        for t, x, y in zip(b["terms"], start, start[1:]):
            impact[b["rows"][x:y], t] = b["impacts"][x:y]
        joint = dict(zip(b["pairs"].tolist(), b["pair_top"].tolist()))
        for units in group.units:
            for a, ta, c, tc, p in units.tolist():
                one, two = ta * impact[:, a], tc * impact[:, c]
                bound = max(one.max(), two.max(), joint.get(p, 0))
                assert (one + two).max() <= bound <= one.max() + two.max()
                tighter += bound < one.max() + two.max()
    assert tighter > 50


def plain_secrets(text):
    from quarry.llm.secret_scan import ALLOWED, CLASSES
    text, out = text or "", []
    base = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                                  re.I | re.A), 2, 12),
            ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]
    for i, (_, p, group, least) in enumerate(base):
        out += [(m.start(), i, m.end()) for m in p.finditer(text) if len(m.group(group)) >= least]
    counts = [sum(1 for o in out if o[1] == i) for i in range(3)]
    names = [b[0] for b in base] + [c.kind for c in CLASSES]
    join = lambda spans: ",".join(f"{names[i]}:{x}:{y}" for x, i, y in sorted(spans))
    plain = join(out)
    for j, c in enumerate(CLASSES):
        for m in re.finditer("[" + re.escape(c.alphabet) + "]{%d,}" % c.window, text):
            value, spans = m.group(0), []
            if any(re.search(x, value) for x in ALLOWED):
                continue
            for a in range(len(value) - c.window + 1):
                share = [n / c.window for n in Counter(value[a:a + c.window]).values()]
                if -sum(x * math.log2(x) for x in share) >= c.bits - 1e-9:
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = a + c.window
                    else:
                        spans.append([a, a + c.window])
            out += [(m.start() + x, 3 + j, m.start() + y) for x, y in spans]
    return *counts, plain, join(out)


def test_secrets(spark):
    from quarry.llm.secret_scan import find_secrets
    rng = random.Random(3)
    free = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
    some = lambda letters, low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    def piece():
        return rng.choice([
            lambda: some(free, 1, 90), lambda: some("0123456789abcdef", 1, 60), lambda: "password: \"token:a1B2c3D4e5F6g7",
            lambda: rng.choice(["password", "Secret", "TOKEN", "api_key", "apiKey", "passwd"]) + rng.choice(["\"", "'", ""])
            + rng.choice([" ", "", "  "]) + rng.choice(":=") + rng.choice([" \"", "", "'"]) + some(free, 1, 20),
            lambda: "AKIA" + some("ABCDEFGH012AKI", 1, 25), lambda: "é日本\U0001F600", lambda: some("0123456789", 1, 40),
            lambda: some("ABC", 20, 60) + some(free, 30, 30) + some("ab", 20, 30) + some(free, 30, 30),
            lambda: "example-" + some(free, 40, 40), lambda: some("abcdefghij", 1, 9)])()
    texts = [rng.choice([" ", "\n", ""]).join(piece() for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "toKen=abcdefghijklm", "ſecret=abcdefghijklm", "paſſword:abcdefghijklmn",
              " ".join(f"token=abcdefghijklm{k}" for k in range(3000)), some(free, 20_000, 20_000), "x" * 100_000]
    rows = [(k, t, 1, 0.5) for k, t in enumerate(texts)] + [(0, texts[0], 1, 0.5), (None, texts[1], None, None)]
    got = find_secrets(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_spans, r.spans) == plain_secrets(r.text), r.doc_id
    assert sum("base64_entropy" in r.spans for r in got) > 50
    assert find_secrets(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        find_secrets(spark.createDataFrame([], "text string, spans int"))


def test_secrets_need_no_python_worker_and_no_shuffle(spark):
    from quarry.llm.queries import op13
    plan = op13(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("text, spans", [
    ("key f3a1 9b0c", ""), ("0123456789012345678901234", "hex:0:25"),
    ("see thisisonelongwordwithoutanysecret/andanotherpath", ""),
    ("x Zk3qLw9TfR2vYb7NcXe5HgUd8 y", "base64_entropy:2:27"),
    ("example_Zk3qLw9TfR2vYb7NcXe5HgUd8", "")])
def test_allow_list_and_entropy(spark, text, spans):
    from quarry.llm.secret_scan import find_secrets
    assert find_secrets(spark.createDataFrame([(text,)], "text string")).first().spans == spans
