"""Large components, repeated vec_ids, extra columns and vectors of many lengths, against exact integers."""

import math
import random

import pytest
from folioflow.llm import op9_topk


@pytest.mark.parametrize("values", [1 << 22, 8])
def test_any_finite_component(spark, monkeypatch, values):
    monkeypatch.setattr(op9_topk, "QUERY_VALUES", values)
    rng = random.Random(9)
    rows = [(i, [rng.choice([rng.uniform(-2, 2), rng.uniform(-2, 2), 1e6 * rng.random(), -3e15, 1e16]) for _ in range(rng.choice([3, 4, 4, 5]))]) for i in range(150)]
    rows += [(151, rows[3][1]), (151, rows[3][1]), (100, rows[100][1]), (200, []), (250, [1e200, 1.0]), (251, [-1e200])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, q string")
    q = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    clip = lambda x: max(-(1 << 63), min(x, (1 << 63) - 1))
    want, done = set(), set()
    for a, v in q:
        if a % 50 == 0 and a not in done:
            done.add(a)
            best = sorted((-clip(sum(x * y for x, y in zip(v, w))), b) for b, w in q if b != a)[:5]
            want |= {(a, r, b, -s) for r, (s, b) in enumerate(best, 1)}
    got = [tuple(r) for r in op9_topk.top_k(df).collect()]
    assert len(got) == len(set(got)) == len(want) and set(got) == want
