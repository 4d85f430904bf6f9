"""Fingerprints and their components against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from folioflow.llm import op11_simhash as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(rows, radius=3):
    """(doc_id, fingerprint, component) of every row by union-find over all pairs."""
    prints = [(i, fingerprint(t)) for i, t in rows if i is not None]
    top = list(range(len(prints)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= radius:
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    low = {}
    for a, (i, _) in enumerate(prints):
        low[root(a)] = min(low.get(root(a), i), i)
    return sorted((i, f"{p:016x}", low[root(a)]) for a, (i, p) in enumerate(prints))


def test_xxh64_of_every_length():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 4000, dtype=np.uint8)
    starts = rng.integers(0, 3000, 3000)
    ends = starts + np.concatenate([np.arange(600), rng.integers(0, 1000, 2400)])
    want = [xxhash.xxh64_intdigest(raw[s:e].tobytes(), 42) for s, e in zip(starts, ends, strict=True)]
    assert op.xxh64(raw, starts, ends, 42).tolist() == want


def texts(rng, n):
    words = [f"w{i}" for i in range(400)] + ["É", "é", "ÀB", "x" * 300, "-"]
    base = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 4, 40, 200]))) for _ in range(n)]
    near = []
    for t in base:
        w = t.split(" ")
        w[rng.randrange(len(w))] = rng.choice(words)
        near += ["\n".join(w), t.upper(), t + " "]
    return base + near + [None, "", " ", "\t\r\n", "one", " one", "one  two", "One\tTwo", "long " * 20_000, "a" * 100_000]


@pytest.mark.parametrize("block, tile", [(1 << 14, 128), (16, 4)])
def test_components(spark, monkeypatch, block, tile):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "TILE", tile)
    rng = random.Random(3)
    t = texts(rng, 80)
    rows = list(enumerate(t)) + [(3, t[9]), (7, t[7]), (7, t[7]), (None, t[5]), (None, None)]
    docs = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "doc_id long, text string, fp int, component_id int").repartition(5)
    got = op.simhash_classes(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == classes(rows)


def test_empty_table(spark):
    assert op.simhash_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("two", [False, True])
def test_links_between_blocks(two):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (30, 60, 3), dtype=np.uint64)
    near = (centre[:, None] ^ np.where(rng.random((30, 60, 3)) < 0.6, flips, np.uint64(0)).sum(2, dtype=np.uint64)).ravel()
    every = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 500, dtype=np.uint64), np.array([0, 1, 7, 15, 2**64 - 1], np.uint64)]))
    a, b = (every[::2], every[1::2]) if two else (every, None)
    u, v = op.close_links(a, b, 3)
    assert ((np.bitwise_count(u ^ v) >= 0) & (u != v)).all() and len(u) < len(every)

    def roots(pairs):
        top = {int(x): int(x) for x in every}

        def root(x):
            while top[x] != x:
                x = top[x]
            return x

        for x, y in pairs:
            x, y = sorted((root(int(x)), root(int(y))))
            top[y] = x
        return {x: root(x) for x in top}

    other = a if b is None else b
    assert roots(zip(u, v, strict=True)) == roots((x, y) for x in a for y in other[np.bitwise_count(x ^ other) <= 3])


def test_counts_differ_by_the_distance_at_most():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64))
    gap = np.abs(op.counts_of(a).astype(int) - op.counts_of(b))
    for cut in op.CUTS:
        assert (gap[:, cut].sum(1) <= np.bitwise_count(a ^ b)).all()
        assert (op.counts_of(a)[:, cut].sum(1, dtype=int) == np.bitwise_count(a)).all()
