"""Words whose bytes cancel out in polynomials modulo 2**64, texts of one repeated word, and a benchmark too large to broadcast."""

import random

import numpy as np
import pytest
from folioflow.llm import op1_jaccard, op4_decontaminate, op5_tokens
from folioflow.llm.kernels import SPACED, spans, words


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "b", "a")) for n in (1024, 4096)]
FILL = "one two three four five six seven eight nine ten eleven twelve"


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for x, y in PAIRS:
        for w in (x, y):
            rows.append((len(rows), w))
            rows.append((len(rows), f"{FILL} {w} {FILL} {w}"))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def brute(rows, items):
    return op4_decontaminate.brute_force(rows, items)


def found(df, bench):
    got = op4_decontaminate.contamination(df, bench).collect()
    return {r.doc_id: (r.n_words, sum(s.after - s.first for s in r.spans), len(r["items"])) for r in got}


def test_patterned_words_do_not_link(docs):
    df, rows = docs
    got = {r.doc_id: r.component_id for r in op1_jaccard.jaccard_classes(df).collect()}
    assert got == {i: i for i in range(len(rows))}


def test_patterned_words_are_no_hits(spark, docs):
    df, rows = docs
    items = [(1, PAIRS[0][0]), (2, f"x {FILL} {PAIRS[1][1]} one two")]
    want = {d: v[:3] for d, v in brute(rows, items).items()}
    assert found(df, spark.createDataFrame(items, "item_id long, text string")) == want
    assert 0 < sum(v[1] > 0 for v in want.values()) < len(want)


def test_patterned_words_get_the_librarys_ids():
    from folioflow.llm.word_bpe import Encoder

    enc = Encoder(op5_tokens.tokenizer_path())
    texts = [w for pair in PAIRS for w in pair]
    count, ids = enc.encode(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(count)[:-1])] == [x.ids for x in enc.full.encode_batch(texts, add_special_tokens=False)]


def test_span_hash_is_the_words():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAb\0é") for _ in range(rng.randrange(1, 140))) for _ in range(4000)]
    raw = " ".join(texts).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, h = words(data, np.array([0]), SPACED)
    own = [SPACED.fold[data[a:b]].tobytes() for a, b in zip(starts, ends, strict=True)]
    by = {}
    for w, v in zip(own, h.tolist(), strict=True):
        assert by.setdefault(w, v) == v
    assert len(set(by.values())) == len(by)
    other = spans(SPACED.fold[data], starts, ends, 1)
    assert not (other == h).any()


@pytest.mark.parametrize("limit", [1 << 20, 10])
def test_repeated_words_and_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(op4_decontaminate, "BLOCK_WORDS", limit)
    rng = random.Random(4)
    word = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(1, "a " * 50), (2, "a " * 50), (2, "b " * 30), (3, "a b " * 20), (4, word(12)), (5, word(9)), (None, "a " * 12), (6, "c b"), (7, None), (8, "-")]
    rows = [(i, word(rng.randrange(0, 60))) for i in range(60)] + [(100, "a " * 3000), (101, "A-b " * 500), (102, None), (103, ""), (104, "a " * 9 + "b " * 11)]
    df = spark.createDataFrame(rows + [rows[60], (None, rows[61][1]), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = [(i, t) for i, t in items if i is not None]
    want = brute(rows, known)
    got = op4_decontaminate.contamination(df, bench).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        if r.doc_id is not None:
            w = want[r.doc_id]
            assert (r.n_words, sum(s.after - s.first for s in r.spans), len(r["items"])) == w[:3]
    none = sorted((r.n_words, len(r["items"])) for r in got if r.doc_id is None)
    assert none == sorted([(0, 0), (want[101][0], want[101][2])])
    extra = df.selectExpr("doc_id", "text", "1 as row", "2 as _row", "3 as spans")
    left = op4_decontaminate.clean(extra, bench)
    assert left.columns == extra.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(d for d, v in want.items() if v[1] == 0)
    assert [r.text for r in left.collect() if r.doc_id is None] == [None]
    assert op4_decontaminate.clean(df.limit(0), bench).count() == 0


def test_ranges_dealt_in_small_parts(spark, monkeypatch):
    """Shared shingles are counted alike however few postings are dealt at a time."""
    rng = random.Random(11)
    words_ = [f"v{i}" for i in range(60)]
    common = " ".join(words_[:7])
    rows = [(i, " ".join([common, *(rng.choice(words_) for _ in range(rng.randrange(3, 25)))])) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(0, 120, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sets = {d: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for d, t in rows}
    every = {}
    for d, s in sets.items():
        for g in s:
            every.setdefault(g, set()).add(d)
    want = {d: (len(s), sum(len(every[g]) > 1 for g in s)) for d, s in sets.items()}
    for dealt, block in ((1 << 22, 8 << 20), (40, 300)):
        monkeypatch.setattr(op1_jaccard, "DEALT", dealt)
        monkeypatch.setattr(op1_jaccard, "BLOCK_BYTES", block)
        assert {r.doc_id: (r.n, r.shared) for r in op1_jaccard.document_sets(df).collect()} == want
