"""Ratios, rounding and the cleaner against plain Python."""

import difflib
import random
import time

import pytest
from folioflow.functions import matching
from folioflow.functions import text as tx
from folioflow.functions.sqlparts import rounded
from pyspark.sql import functions as F


def pairs(rng, n):
    out = [("", ""), ("", "a"), ("a", ""), (None, "a"), ("a", None), ("a" * 400, "a" * 300), ("ab" * 150, "ba" * 150), ("\U0001F600é", "é\U0001F600"), ("x", "x\n")]
    for _ in range(n):
        letters = rng.choice(["ab", "abcde", "abcdeሀለሐ \n", "abcdefghijklmnopqrstuvwxyz    "])
        word = lambda k, letters=letters: "".join(rng.choice(letters) for _ in range(k))
        a = word(rng.choice([1, 2, 5, 12, 30]))
        b = a
        for _ in range(rng.randrange(5)):
            i, j = sorted(rng.randrange(len(b) + 1) for _ in range(2))
            b = b[:i] + word(rng.randrange(4)) + b[j if rng.random() < 0.3 else i :]
        out.append((a, rng.choice([b, word(rng.choice([1, 4, 20]))])))
    return out


def test_ratio_of_short_texts(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs(random.Random(3), 10_000))]
    got = {r.i: r.r for r in spark.createDataFrame(rows, "i int, a string, b string").select("i", matching.ratio("a", "b").alias("r")).collect()}
    want = {i: None if a is None or b is None else difflib.SequenceMatcher(None, a, b).ratio() for i, a, b in rows}
    assert got == want


def test_ratio_of_long_texts(spark):
    rng = random.Random(4)
    words = ["the", "of", "zebra", "quick", "ሰላም", "x", "jumps", "1234", "over"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for n in (20, 39, 41, 60, 150, 300):
        a = text(n)
        rows += [(a, text(n)), (a, a.replace("quick", "quack")), (a[len(a) // 2 :] + a[: len(a) // 2], a), (a, a[:150])]
    got = [r.r for r in spark.createDataFrame(rows, "a string, b string").select(matching.ratio("a", "b").alias("r")).collect()]
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in rows]


def test_rounding_is_of_the_binary_value(spark):
    rng = random.Random(7)
    rows = [(x,) for x in [0.125, 2.675, 0.0625, 0.1875, 0.5, 0.0005, 1.0, 0.0, 0.9995, 1e-20, None] + [rng.random() for _ in range(2000)] + [k / 2000 for k in range(2001)]]
    got = spark.createDataFrame(rows, "x double").select("x", F.expr(rounded("x", 3)).alias("a"), F.expr(rounded("x", 2)).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(None, None) if x is None else (round(x, 3), round(x, 2)) for (x,) in rows]


def cleaned(text):
    """The reading cleaner by its definition."""
    import re

    text = text.replace("**", "").replace("、", "").replace("<<", "«").replace(">>", "»")
    for pattern, to in ((r"(?m)^\s*#+\s+", ""), (r"\s*\n\s*", " "), (r"\s*(?:::|፡፡|：：)", "።"), (r"[ \t]{2,}", " ")):
        text = re.sub(pattern, to, text)
    return text.strip()


def test_cleaner_by_definition(spark):
    rng = random.Random(8)
    some = ["a", "b", " ", "  ", "\n", "\n\n", "#", "##", "# ", "\t", "::", ":", "፡፡", "：：", "**", "、", "<<", ">>", "\u00a0", "\r\n", "\x0b", "\u2003"]
    rows = [("".join(rng.choice(some) for _ in range(rng.randrange(14))),) for _ in range(6000)]
    got = spark.createDataFrame(rows, "t string").select("t", tx.clean_text(F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [cleaned(t) for (t,) in rows]


@pytest.mark.parametrize("run", [" ", "\n", " \n", "\t", "# ", "#", "\n#", ":", "\u2003"])
def test_cleaner_takes_time_as_the_text_grows(spark, run):
    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(run), 1_000_000 // len(run)), F.lit("b")).alias("t"))
    df.select(F.length(tx.clean_text(F.col("t")))).collect()
    began = time.time()
    df.select(F.length(tx.clean_text(F.col("t")))).collect()
    assert time.time() - began < 3
