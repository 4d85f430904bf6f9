"""Secret scans against a plain scan of every window, and on very long candidates and very many matches."""

import math
import random
import re
import time
from collections import Counter

from folioflow.llm import op6_secrets as op


def brute(text):
    """Entropy spans, one window at a time."""
    base = [m.span() for m in re.finditer(op.ASSIGN, text, re.A) if len(m[2]) >= op.ASSIGN_LEAST]
    base += [m.span() for p in (op.ACCESS, op.HEX) for m in re.finditer(p, text)]
    out = []
    for m in re.finditer(op.CANDIDATE, text):
        s = m[0]
        if any(re.search(a, s) for a in op.ALLOW):
            continue
        kind = "hex" if re.fullmatch("[0-9a-fA-F]+", s) else "alnum" if re.fullmatch("[A-Za-z0-9]+", s) else "base64"
        good = []
        for i in range(len(s) - op.WINDOW + 1):
            n = Counter(s[i : i + op.WINDOW]).values()
            if math.log2(op.WINDOW) - sum(c * math.log2(c) for c in n) / op.WINDOW >= op.THRESHOLDS[kind] - 1e-12:
                good.append(i)
        if good:
            a, b = m.start() + good[0], m.start() + good[-1] + op.WINDOW
            if not any(x <= a and b <= y for x, y in base):
                out.append((a, b))
    return out


def test_entropy_is_the_scan_of_every_window(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 9)):
            some = rng.choice([op.ALPHABET, "0123456789abcdef", "ab1", "aBcD0", op.ALPHABET[:62]])
            parts.append(rng.choice(["", "token=", "é ", "password: '", "AKIA"]) + "".join(rng.choice(some) for _ in range(rng.choice([5, 19, 20, 21, 40, 90]))))
        texts.append(rng.choice([" ", "\n", "é"]).join(parts))
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [rows[0], (None, texts[1], 1), (900, None, 1), (901, "", 1)], "doc_id long, text string, assign int")
    got = op.secrets(df).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        t = texts[1] if r.doc_id is None else texts[r.doc_id] if r.doc_id < 900 else ""
        assert [(x.start, x.end) for x in r.entropy] == brute(t)
        assert [(x.start, x.end) for x in r.hex] == [m.span() for m in re.finditer(op.HEX, t)]
    assert sum(len(r.entropy) for r in got) > 100


def test_time_grows_with_the_text(spark):
    rng = random.Random(3)
    blob = "".join(rng.choice(op.ALPHABET) for _ in range(1_000_000))
    many = " ".join(f"token={''.join(rng.choice('abcdefgh') for _ in range(8))}" for _ in range(100_000))
    keys = " ".join("".join(rng.choice(op.ALPHABET[:62]) for _ in range(24)) for _ in range(20_000))
    df = spark.createDataFrame([(0, blob), (1, many), (2, keys)], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in op.secrets(df).collect()}
    assert time.time() - began < 60
    assert [(x.start, x.end) for x in got[0].entropy] == [(0, 1_000_000)]
    assert len(got[1].assign) == 100_000 and all(x.start == 15 * i for i, x in enumerate(got[1].assign))
    assert len(got[2].entropy) > 15_000
