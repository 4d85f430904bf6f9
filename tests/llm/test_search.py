"""Ranked search against plain Python and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from folioflow.llm import op13_search as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items, k=50):
    docs = [(i, Counter(terms(t))) for i, t in rows if i is not None and terms(t)]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in asked.items():
        found = []
        for i, c in docs:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def tables(rng, n):
    words = [f"W{i}" for i in range(120)] + ["É", "é", "ß", "x" * 300, "e", "a1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda m: rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=m))
    rows = [(i * 3, text(rng.choice([0, 1, 3, 40, 90]))) for i in range(n)]
    rows += [(3, rows[1][1]), (6, rows[5][1]), (6, rows[5][1]), (None, rows[7][1]), (1, None), (2, ""), (4, "--"), (5, "w0 " * 30_000), (-8, rows[9][1])]
    items = [(f"i{j}", text(rng.choice([1, 2, 8, 30]))) for j in range(25)] + [("i1", "w5 w6"), (None, "w1"), ("z", None), ("y", "nowhere"), ("x", "W0"), ("w", "w0 nowhere w1 w1")]
    return rows, items


@pytest.mark.parametrize("shard, run, passes", [(8 << 20, 256, 1 << 15), (3000, 4, 20)])
def test_against_plain_python(spark, monkeypatch, shard, run, passes):
    monkeypatch.setattr(op, "SHARD_BYTES", shard)
    monkeypatch.setattr(op, "RUN", run)
    monkeypatch.setattr(op, "QUERY_TERMS", passes)
    monkeypatch.setattr("folioflow.llm.kernels.CHUNK_BYTES", 2000)
    rows, items = tables(random.Random(5), 400)
    docs = spark.createDataFrame([(i, t, 1, 1) for i, t in rows], "doc_id long, text string, term int, score int").repartition(5)
    for k in (50, 3):
        got = op.search(docs, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, rank int"), k)
        assert sorted(map(tuple, got.collect())) == brute(rows, items, k)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, "same words here") for i in range(300, 0, -1)] + [(1000 + i, f"other {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = op.search(docs, spark.createDataFrame([("q", "words")], "item_id string, text string"))
    assert [r.doc_id for r in sorted(got.collect(), key=lambda r: r["rank"])] == list(range(1, 51))


def test_empty_tables(spark):
    none, some = (spark.createDataFrame(x, "doc_id long, text string") for x in ([], [(1, "a b")]))
    q, empty = (spark.createDataFrame(x, "item_id string, text string") for x in ([("q", "a")], []))
    for docs, items in ((none, q), (some, empty), (none, empty), (some, spark.createDataFrame([("q", None)], "item_id string, text string"))):
        got = op.search(docs, items)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.collect() == []


def test_packed_numbers():
    values = np.concatenate([np.arange(300), 1 << np.arange(62), (1 << np.arange(62)) - 1])
    raw, size = op.packed(values)
    assert size.sum() == len(raw) and op.unpacked(raw).tolist() == values.tolist()
    assert op.unpacked(op.packed(np.empty(0, np.int64))[0]).tolist() == []


def test_whole_index_has_every_posting(spark):
    rows, _ = tables(random.Random(8), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    (shard,) = op.index_shards(docs).collect()
    ids, names = np.frombuffer(shard.docs, "<i8"), bytes(shard.terms).split(b" ")
    size, raw, at, got = op.unpacked(np.frombuffer(shard.bytes, np.uint8)), np.frombuffer(shard.postings, np.uint8), 0, []
    for name, n in zip(names, size.tolist(), strict=True):
        pairs = op.unpacked(raw[at : at + n])
        at += n
        got += [(name.decode(), int(ids[d]), tf) for d, tf in zip(np.cumsum(pairs[::2]), pairs[1::2].tolist(), strict=True)]
    assert sorted(got) == sorted((t, i, c) for i, text in rows if i is not None for t, c in Counter(terms(text)).items())


def test_sql(spark, tmp_path):
    rows, items = tables(random.Random(6), 200)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = op.op13_search(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({op.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
