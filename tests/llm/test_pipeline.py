"""run() and its stages against plain Python over all rows, with repeated rows, null doc_ids, clashing names and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as pipe
from folioflow.llm import op2_mix, op4_decontaminate, op5_tokens, op7_quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _n int, _k string, _i int, _d int, row string, k1 int"
VOCAB = [f"word{i}" for i in range(300)]


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset({tuple(w)}) if w else frozenset()


def brute_unique(rows):
    """One row of each component: the smallest doc_id, null last, then any of equal ones (compared by doc_id and set)."""
    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    parts = defaultdict(list)
    for i in range(len(rows)):
        if sets[i]:
            parts[find(i)].append(i)
    return parts, [i for i in range(len(rows)) if not sets[i]]


def brute_copies(rows, weights=(1, 2, 3), most=3):
    """{index: copies} by the definition: ranks in a source by size, then the hash of doc_id."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size, strict=True):
        total[r[3]] += n
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + ([None] if None in total else [])
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    full, level = set(), 0.0
    while True:
        w = sum(weight[s] for s in order if s not in full)
        level = (sum(total.values()) - sum(float(most) * total[s] for s in full)) / w if w else math.inf
        more = {s for s in order if most * total[s] < level * weight[s]}
        if more == full:
            break
        full = more
    out, targets = {}, {}
    for s in order:
        targets[s] = min(level * weight[s], float(most) * total[s])
        rate = targets[s] / total[s] if total[s] else 0.0
        offset = int(hashlib.md5(f"mix|{s or ''}".encode()).hexdigest()[:5], 16) / (1 << 20)
        mine = [i for i, r in enumerate(rows) if r[3] == s]
        name = lambda i: str(rows[i][0]) if rows[i][0] is not None else hashlib.md5(rows[i][1].encode()).hexdigest() if rows[i][1] is not None else ""
        mine.sort(key=lambda i: (size[i], hashlib.md5(name(i).encode()).hexdigest(), -1 if rows[i][0] is None else rows[i][0], zlib.crc32((rows[i][1] or "").encode())))
        for rank, i in enumerate(mine):
            out[i] = min(math.floor(rate * (rank + 1) + offset) - math.floor(rate * rank + offset), math.ceil(rate))
    return out, targets, total, size


def corpus(seed=6, n=160):
    rng = random.Random(seed)
    prose = lambda k: " ".join(rng.choice(VOCAB) for _ in range(k))
    passage, rows = prose(30), []
    for i in range(n):
        t = prose(rng.choice([3, 20, 40, 40, 40, 80]))
        if i % 9 == 0:
            t += " " + " ".join(passage.split()[5:20])
        rows.append((i, t, "en", rng.choice(["a", "b", "c", None]), len(t), 1, "k", 2, 3, "r", i))
    for i in range(0, n, 6):
        w = rows[i][1].split()
        w[-1] = "edited"
        rows.append((1000 + i, " ".join(w), *rows[i][2:]))
    t = prose(40)
    rows += [(None, t, "en", "a", 5, 1, "k", 2, 3, "r", 0)] * 7 + [(5000, t + " x", "en", "a", 5, 1, "k", 2, 3, "r", 0)]
    rows += [(5001, prose(30), "en", "b", 5, 1, "k", 2, 3, "r", 0)] * 5 + [(5002, prose(30), "en", "b", 5, 1, "k", 2, 3, "r", 0), (5002, prose(30), "en", "b", 5, 1, "k", 2, 3, "r", 0)]
    rows += [(None, None, None, None, None, None, None, None, None, None, None), (6000, "", "en", "b", 0, 1, "k", 2, 3, "r", 0), (None, f"{prose(5)} {passage} {prose(5)}", "en", "c", 9, 1, "k", 2, 3, "r", 0)]
    rng.shuffle(rows)
    return rows, passage


@pytest.fixture(scope="module")
def data():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.createDataFrame(data[0], COLUMNS)


def test_one_of_each_group_stays(spark, docs, data):
    rows, _ = data
    parts, lone = brute_unique(rows)
    got = pipe.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    left = Counter(map(tuple, got.collect()))
    assert sum(left.values()) == len(parts) + len(lone)
    for mine in parts.values():
        best = min((rows[i][0] is None, rows[i][0] or 0) for i in mine)
        assert sum(left[r] for r in {rows[i] for i in mine}) >= 1
        assert any(left[rows[i]] and (rows[i][0] is None, rows[i][0] or 0) == best for i in mine)
    assert all(left[rows[i]] for i in lone)


def test_unique_ids_take_the_short_way(spark, data):
    rows = list({r[0]: r for r in data[0] if r[0] is not None}.values())
    parts, lone = brute_unique(rows)
    got = {r.doc_id for r in pipe.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), "").collect()}
    assert got == {min(rows[i][0] for i in p) for p in parts.values()} | {rows[i][0] for i in lone}


def test_no_hit_survives(spark, docs, data, tmp_path):
    rows, passage = data
    spark.createDataFrame([("1", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = pipe.decontaminate(spark, docs, str(tmp_path))
    hit = op4_decontaminate.brute_force(list(enumerate(r[1] for r in rows)), [("1", passage)])
    assert got.columns == docs.columns
    assert Counter(map(tuple, got.collect())) == Counter(r for i, r in enumerate(rows) if not hit[i][1])
    assert any(hit[i][1] and r[0] is None for i, r in enumerate(rows))


def test_the_mix_is_its_copies(spark, docs, data):
    rows, _ = data
    want, targets, total, size = brute_copies(rows)
    got = op2_mix.copies(docs).collect()
    taken = lambda pairs: sorted((d if d is not None else -1, n, k) for d, n, k in pairs)
    assert taken((r.doc_id, r["size"], r.copies) for r in got) == taken((rows[i][0], size[i], k) for i, k in want.items())
    assert all(abs(r.target - targets[r.source]) < 1e-9 * max(1, r.target) and r.source_size == total[r.source] for r in got)
    mix = op2_mix.mixed(docs)
    assert mix.columns == docs.columns
    due = Counter()
    for i, k in want.items():
        due[rows[i]] += k
    assert Counter(map(tuple, mix.collect())) == +due


def test_mix_of_repeated_rows(spark):
    rows = [(1, "a b", "s")] * 40 + [(2, f"w{i}", "s") for i in range(90)] + [(3, "c d e", "t")] * 2
    df = spark.createDataFrame(rows * 3, "doc_id long, text string, source string").withColumn("m", pipe.F.create_map(pipe.F.lit("x"), pipe.F.col("text")))
    assert op2_mix.mixed(df).count() == op2_mix.copies(df).agg({"copies": "sum"}).first()[0]
    assert op2_mix.mixed(df).columns == df.columns


def test_run(spark, data, tmp_path):
    """Every stage of run() in plain Python but the classifier, whose model is taken as fitted."""
    from tokenizers import Tokenizer

    rows = list({r[0]: r for r in data[0] if r[0] is not None}.values())
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], int(len(r[1]) > 100)) for r in rows if r[0] < 120], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("1", data[1]), ("2", None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {}
    for r in pipe.run(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = op7_quality.fitted(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    keep = {r.doc_id for r in op7_quality.scored(docs, model).collect() if r.keep}
    assert 0 < len(keep) < len(rows)
    rows = [r for r in rows if r[0] in keep]
    parts, lone = brute_unique(rows)
    rows = [min((rows[i] for i in p), key=lambda r: r[0]) for p in parts.values()] + [rows[i] for i in lone]
    hit = op4_decontaminate.brute_force([(r[0], r[1]) for r in rows], [("1", data[1])])
    rows = [r for r in rows if not hit[r[0]][1]]
    want, *_ = brute_copies(rows)
    tok, due = Tokenizer.from_file(op5_tokens.tokenizer_path()), {}
    for i, k in want.items():
        ids = tok.encode(rows[i][1] or "", add_special_tokens=False).ids + [2]
        if k:
            due[rows[i][0]] = [(len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] * k
    assert got == due


def test_empty_tables(spark, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipe.run(spark, str(tmp_path)).count() == 0
    for _, stage in pipe.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
