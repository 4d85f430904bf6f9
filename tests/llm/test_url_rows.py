"""URL rules on many random hosts, repeated pages, extra columns and empty tables."""

import random

import pytest
from folioflow.llm import op8_url

SCHEMA = "page_id long, url string, host string, rule int, path string"


@pytest.mark.parametrize("most", [500_000, 50])
def test_many_rules_and_odd_tables(spark, monkeypatch, most):
    monkeypatch.setattr(op8_url, "RULE_BLOCK", most)
    rng = random.Random(5)
    host = lambda: ".".join(rng.choice(["a", "b", "ab", "com", "net"]) for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(5)))
    rules = [(rng.choice(["allow", "block"]), host(), path()) for _ in range(300)]
    pages = [(i, f"http://{host()}{path()}", "x", 1, "y") for i in range(500)]
    pages += [(1000 + i, "http://x.ab.com/ab/b", "x", 1, "y") for i in range(400)]
    pages += pages[:20] + [(None, pages[0][1], None, None, None), (900, "http://a/" + "b" * 100000, "x", 1, "y"), (901, "://", "x", 1, "y")]
    df, rd = spark.createDataFrame(pages, SCHEMA), spark.createDataFrame(rules, "verdict string, host string, path string")
    got = sorted(map(str, op8_url.judged(df, rd).collect()))
    want = []
    for i, u, *_ in pages:
        h, s, p = u.split("://", 1)[1].partition("/")
        fit = [r for r in rules if (h == r[1] or h.endswith("." + r[1])) and (s + p).startswith(r[2])]
        best = max(fit, key=lambda r: (r[1].count("."), len(r[2]), r[0]), default=None)
        want.append((i, h, s + p, best and best[1] + best[2], best[0] if best else "allow"))
    assert got == sorted(str(spark_row(*w)) for w in want)
    assert op8_url.judged(df.limit(0), rd).count() == 0
    assert {(r.rule, r.verdict) for r in op8_url.judged(df, rd.limit(0)).collect()} == {(None, "allow")}


def spark_row(*values):
    from pyspark.sql import Row

    return Row(**dict(zip(("page_id", "host", "path", "rule", "verdict"), values, strict=True)))
