"""Tries, bucket totals, gains and ranks against plain Python and SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from folioflow.llm import op12_resample as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, depth=2):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, depth + 1) for i in range(len(w) - k + 1)]


def bucket(feature, buckets=10_000):
    return zlib.crc32(feature.encode()) % buckets


def brute(rows, target, share=25, least=20):
    each = [(i, *runs(t)) for i, t in rows]
    s, t = Counter(bucket(f) for _, _, fs in each for f in fs), Counter(bucket(f) for x in target for f in runs(x)[1])
    a, b = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (a + 10_000) / ((s[k] + 1) * (b + 10_000))))
    out = []
    for i, n, fs in each:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    line = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(line[: share * len(line) // 100]):
        r[5] = k + 1
    return sorted((tuple(r) for r in out), key=str)


def texts(rng, n):
    words = [f"W{i}" for i in range(300)] + ["É", "é", "ß", "x" * 65, "y" * 300, "e", "a1"]
    out = [rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 19, 20, 21, 60]))) for _ in range(n)]
    return out + [None, "", " ", "--", "one", "aA " * 30_000, "b" * 100_000]


@pytest.mark.parametrize("nodes", [1 << 20, 50])
def test_against_plain_python(spark, monkeypatch, nodes):
    monkeypatch.setattr(op, "NODES", nodes)
    monkeypatch.setattr("folioflow.llm.kernels.CHUNK_BYTES", 5000)
    rng = random.Random(9)
    rows = list(enumerate(texts(rng, 200)))
    rows += [(3, rows[3][1])] * 5 + [(None, rows[20][1])] * 3 + [(None, None), (4, "a b " * 30)]
    target = texts(rng, 10) + [None, "w1 w2 w3"]
    docs = spark.createDataFrame([(i, t, 1, 1) for i, t in rows], "doc_id long, text string, row int, score int").repartition(5)
    got = op.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target)


def test_deeper_runs():
    rng = random.Random(2)
    some = texts(rng, 30)
    trie, totals = op.Trie(4, 100), np.zeros(100, np.int64)
    raw = [(t or "").encode() for t in some]
    trie.walk(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
    trie.fold(totals)
    want = Counter(bucket(f, 100) for t in some for f in runs(t, 4)[1])
    assert totals.tolist() == [want[k] for k in range(100)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op.resampled(none, none).collect() == []
    one = spark.createDataFrame([(1, "a " * 40)] * 8, "doc_id long, text string")
    assert sorted(map(tuple, op.resampled(one, none).collect()), key=str) == brute([(1, "a " * 40)] * 8, [])


def test_sql(spark, tmp_path):
    rng = random.Random(4)
    rows = list(enumerate(texts(rng, 150)))
    spark.createDataFrame(rows + [(None, "w1 " * 25)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(t,) for t in texts(rng, 20)], "text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = op.op12_resample(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({op.ORACLE})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
