"""Near duplicates where lists are split: dense groups just above and below the
threshold, small blocks, salted heads, long texts and ids that repeat."""

import random

import pytest


def plain(rows, size, percent=80):
    """Smallest reachable id per id; all texts of an id count for it."""
    sets = []
    for d, t in rows:
        w = (t or "").lower().split()
        sets.append((d, {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())))
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {d: find(d) for d, _ in sets}


def found(spark, rows, size):
    from quarry.llm.near_dup import near_duplicates
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return {r.doc_id: r.component_id for r in near_duplicates(df, size, 80).collect()}


def edited(rng, words, changes):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"e{rng.randrange(10 ** 9)}"
    return words


@pytest.mark.parametrize("length", [120, 600])
def test_dense_groups_in_small_blocks(spark, monkeypatch, length):
    """Copies of a template that lie above and below 0.8, sets under and over the sketch."""
    from quarry.llm import near_dup
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    monkeypatch.setattr(near_dup, "HEAD", 8)
    monkeypatch.setattr(near_dup, "BLOCK_CHARS", 1 << 14)
    rng, rows = random.Random(length), []
    for t in range(4):
        base = [f"t{t}w{k}" for k in range(length)]
        for k in range(45):
            # two edited copies share about (1 - 2 * edits) of their shingles
            changes = int(length * rng.choice([0.01, 0.03, 0.05, 0.06, 0.08]))
            rows.append((len(rows) * 3 % 541, " ".join(edited(rng, base, changes))))
    rows += [(1000 + k, " ".join(f"u{k}x{i}" for i in range(40))) for k in range(20)] + [(2000, None), (2001, "")]
    want = plain(rows, 2)
    got = found(spark, rows, 2)
    assert got == want
    assert 8 < len(set(want.values())) < len(rows) - 20


def test_recall_of_large_sets(spark):
    """Pairs at and above the threshold whose sets are larger than the sketch."""
    rng, rows = random.Random(5), []
    for k in range(120):
        base = [f"p{k}w{i}" for i in range(rng.randint(300, 1500))]
        rows.append((2 * k, " ".join(base)))
        rows.append((2 * k + 1, " ".join(edited(rng, base, int(len(base) * rng.choice([0.02, 0.05, 0.054]))))))
    want, got = plain(rows, 2), found(spark, rows, 2)
    linked = [d for d in want if want[d] != d]
    assert len(linked) > 80
    assert got == want


def test_every_text_of_a_repeated_id_counts(spark):
    one, two, near = ([f"{c}{i}" for i in range(60)] for c in "abb")
    near[30] = "other"
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(near)), (3, " ".join(one)), (4, "alone")]
    assert found(spark, rows, 2) == {1: 1, 2: 1, 3: 1, 4: 4}


def test_a_worker_keeps_only_what_its_operator_uses():
    from quarry.llm import common, near_dup, tokens
    import pyarrow as pa
    enc = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json"), False)
    assert tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json"), False) is enc
    texts = [f"some words of text {k} " * 3 for k in range(3 * near_dup.SLICE + 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    got = list(near_dup._sketch(2)(iter([batch])))
    assert max(b.num_rows for b in got) <= near_dup.SLICE
    assert [i for b in got for i in b.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert common._KEPT == {"near_dup": {}}


def test_list_columns_of_a_slice_keep_their_rows():
    from quarry.llm import near_dup
    import pyarrow as pa
    n = 2 * near_dup.SLICE + 7
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([[k, k + 1] for k in range(n)])],
                                       names=["rep", "sketch"])
    rows = [r for b in near_dup._slices(iter([batch])) for r in near_dup._rows(b)]
    assert [(a, s.tolist()) for a, s in rows] == [(k, [k, k + 1]) for k in range(n)]


def test_hashes_of_words_do_not_outlive_training():
    import pandas as pd
    from quarry.llm import toxicity
    rows = pd.DataFrame({"_h": [1, 2], "doc_id": [1, 2], "text": ["one two three", "four five"], "label": [0, 1]})
    toxicity._learn_shard(0.0)(rows)
    assert not toxicity._HASHES and not toxicity._STEMS


def test_stops_and_commas_are_pieces_of_their_own_in_the_byte_vocabulary():
    from quarry.llm import tokens
    enc = tokens.Encoder(tokens.tokenizer_path("byte_bpe_50k.json"), True)
    assert enc.pieces("one, two. é3,\nx") == ["one", ",", " two", ".", " é3", ",", "\n", "x"]
    for text in ("one, two. three", "a , b", "a., b", ", a", "don't, it's. x", "हि, x. y", "x², y", "a_, b", "é, ß.\nñ", "&&&, a"):
        assert enc.encode(text) == enc._pack(enc.model.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("name, byte_level", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_batch_is_cut_by_arrow_and_python_sees_its_distinct_pieces(monkeypatch, name, byte_level):
    import pyarrow as pa
    from quarry.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 500)
    enc = tokens.Encoder(tokens.tokenizer_path(name), byte_level)
    end = enc._pack([7])
    marks = [" ", " ", " ", "\n", ". ", ", ", ".", ",", "!", "'", "'s", "##", "a", "B", "É", "ß", "Σ", "İ",
             "1", "²", "ª", "x", "<|", "_", "…", "\xa0", "\x85", "́", "中", "\x1c", "\0", "İ. "]
    rng = random.Random(4)
    texts = [None, "", "<|endoftext|>", *["".join(rng.choices(marks, k=rng.randint(1, 12))) for _ in range(20_000)],
             *[f"{a}{chr(c)}{b}" for c in range(0x3100) for a, b in (("x", "y"), ("x ", ". y"))], None]
    want = [enc._pack(e.ids) + end for e in enc.model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    for size in (100, 1 << 20):  # texts longer than a batch too
        monkeypatch.setattr(tokens, "BATCH_BYTES", size if size > 100 else 6)
        some = len(texts) if size > 100 else 2000
        got = [x for part in enc.encode_batch(pa.array(["z", *texts], pa.string()).slice(1, some), end)
               for x in part.to_pylist()]
        assert got == want[:some]
    assert [enc.encode(t) + end for t in texts] == want
    asked = []
    known = enc._know
    monkeypatch.setattr(enc, "_know", lambda words: (asked.extend(words), known(words)))
    out = [x for part in enc.encode_batch(pa.array(["one two. one two"] * 1000), end) for x in part.to_pylist()]
    assert len(out) == 1000 and len(asked) == len(set(asked)) < 8
    assert [*enc.encode_batch(pa.array([], pa.string()), end)] == []


@pytest.mark.parametrize("fails", [False, True])
def test_a_task_drops_other_caches_and_returns_memory_at_its_end(monkeypatch, fails):
    from quarry.llm import common
    monkeypatch.setattr(common, "_KEPT", {"tokens": {1: "many words"}, "mix": {2: "own"}})
    returned = []
    monkeypatch.setattr(common, "return_memory", lambda: returned.append(dict(common._KEPT)))

    def run(batches):
        for b in batches:
            if fails and b == 3:
                raise KeyError(b)
            yield 2 * b
    rows = common.task_of("mix", run)(iter([1, 2, 3]))
    assert next(rows) == 2 and returned == [{"mix": {2: "own"}}]
    if fails:
        with pytest.raises(KeyError):
            list(rows)
    else:
        assert list(rows) == [4, 6]
    assert len(returned) == 2 and common._KEPT == {"mix": {2: "own"}}


def test_every_python_step_of_the_pipeline_returns_its_memory():
    import inspect
    from quarry.llm import exact_dup, mixing, near_dup, packing, token_file
    for module in (exact_dup, mixing, packing, token_file):
        text = "".join(inspect.getsource(module).split())
        assert text.count("mapInArrow(") == text.count("mapInArrow(task_of(") > 0, module
    text = inspect.getsource(near_dup)
    assert text.count("    def run(") == text.count('    return task_of("near_dup", run)') == 3
