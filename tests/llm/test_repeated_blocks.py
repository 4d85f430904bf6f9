"""Rows that repeat across files and partitions, block by block."""

import random

import pytest
from folioflow.llm import op1_jaccard
from test_llm_ops import brute_components


@pytest.mark.parametrize("block", [8 << 20, 400])
def test_a_table_and_its_copy(spark, monkeypatch, tmp_path, block):
    monkeypatch.setattr(op1_jaccard, "BLOCK_BYTES", block)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 30, 60]))) for _ in range(40)]
    texts += [t + " more" for t in texts[:15]] + [None, "", "one two"]
    rows = [(i, t) for i, t in enumerate(texts)]
    for k in range(3):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/{k}")
    docs = spark.read.parquet(*[f"{tmp_path}/{k}" for k in range(3)])
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op1_jaccard.jaccard_classes(docs).collect())
    want = brute_components([(i, t, None) for i, t in rows])
    assert got == sorted((i, *want[i]) for i in want for _ in range(3))
