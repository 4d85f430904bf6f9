"""Quotes of every level are linked; the shallowest matched level names the parent.  Against plain Python and the SQL."""

import hashlib
import random
import re
from collections import Counter

import duckdb

from folioflow.llm import op3_chat as op

SCHEMA = "conv_id long, turn long, role string, text string, own string, h int"


def test_deeper_quotes(spark):
    rows = [
        (1, 0, "user", "First words here.\nMore of them."),
        (1, 1, "assistant", "Second words."),
        (1, 2, "user", ">> First words here.\n>> More of them.\nonly nested"),
        (1, 3, "assistant", "> Second words, edited\n>>> First words here.\nfallback"),
        (1, 4, "user", "> Second words.\n>> First words here.\n>> More of them.\nshallowest"),
        (1, 5, "user", ">> unknown\nno match"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.parent_turn, r.root_turn, r.depth) for r in op.linked(df).collect()}
    assert got == {0: (None, 0, 0), 1: (None, 1, 0), 2: (0, 0, 1), 3: (0, 0, 1), 4: (1, 1, 1), 5: (None, 5, 0)}


def test_long_lead_lines_go(spark):
    df = spark.createDataFrame([(1, 0, None, "Said before."), (1, 1, None, f"On {'a very long day ' * 60} somebody wrote:\n> Said before.\nYes.\nIt wrote:\nkept")], "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.content, r.parent_turn) for r in op.linked(df).collect()}
    assert got == {0: ("Said before.", None), 1: ("Yes.\nIt wrote:\nkept", 0)}


def norm(t):
    return re.sub(r"\s+", " ", t.lower(), flags=re.A).strip(" ")


def brute(rows):
    """conv_id, turn, content, quotes, deepest, parent, root, depth of every row, message by message."""
    parsed = []
    for c, t, _, text, *_ in rows:
        lines = re.split(r"\r?\n", text or "")
        mark = [re.match(op.MARK, x) for x in lines]
        own = [x for i, x in enumerate(lines) if not mark[i] and not (re.search(op.LEAD, x) and i + 1 < len(lines) and mark[i + 1])]
        content = re.sub(r"^\s+|\s+$", "", "\n".join(own), flags=re.A)
        runs, levels = [], []
        for x, m in zip(lines, mark, strict=True):
            n = m[0].count(">") if m else 0
            levels += [n] * bool(m)
            body = norm(re.sub(op.MARK + r"[ \t]?", "", x))
            if not runs or runs[-1][0] != n:
                runs.append((n, []))
            runs[-1][1].append(body)
        units = Counter()
        for n, body in runs:
            body = [b for b in body if b]
            if n and body:
                for b in body:
                    units[n, b] += 1
                units[n, " ".join(body)] += op.PASSAGE_WEIGHT
        wrote = {norm(x) for x in [content, *re.split(r"\n\s*\n", content), *own]}
        parsed.append((c, t, hashlib.md5((text or "").encode()).hexdigest(), content, levels, units, wrote))
    spoke, parent = {}, {}
    for c, t, k, *_, wrote in parsed:
        if c is not None and t is not None:
            for w in wrote:
                spoke.setdefault((c, w), set()).add((t, k))
    for c, t, k, _, _, units, _ in parsed:
        if c is None or t is None:
            continue
        score = Counter()
        for (n, body), w in units.items():
            have = [x for x in spoke.get((c, body), ()) if x[0] < t]
            if have:
                score[n, max(have)] += w
        if score:
            parent[c, t, k] = max((-n, s, f) for (n, f), s in score.items())[2]
    out = []
    for c, t, k, content, levels, *_ in parsed:
        up, depth, node = t, 0, (t, k)
        while (c, *node) in parent:
            node = parent[c, node[0], node[1]]
            up, depth = node[0], depth + 1
        out.append((c, t, content, len(levels), max(levels, default=0), parent[c, t, k][0] if (c, t, k) in parent else None, up, depth))
    return out


def conversations(n):
    rng = random.Random(12)
    rows, said = [], {}
    for i in range(n):
        c = 0 if rng.random() < 0.33 else rng.randrange(1, 60)
        before = said.setdefault(c, [])
        lines = []
        if before and rng.random() < 0.8:
            for _ in range(rng.randrange(1, 3)):
                quoted = rng.choice(before[-40:]).split("\n")
                if rng.random() < 0.3:
                    lines.append("Somebody wrote:")
                depth = rng.choice(["> ", "> ", ">> ", ">", " > > "])
                part = [(">" + x if x.startswith(">") else depth + x) for x in quoted]
                lines += part[: rng.randrange(1, len(part) + 1)]
                if rng.random() < 0.2:
                    lines[-1] += " edited"
        lines += [rng.choice(["Yes.", "No  way", "", f"Line {rng.randrange(400)} of it", f"Unique {i}", "THE common line"]) for _ in range(rng.randrange(0, 5))]
        text = rng.choice(["\n", "\n", "\r\n"]).join(lines)
        turn = len(before) if rng.random() < 0.97 else max(0, len(before) - 1)
        before.append(text)
        rows.append((c, turn, rng.choice(["user", "assistant", None]), text, "x", 1))
    rows += rows[5:25] + [(None, 3, "user", "> Yes.", "x", 1), (7, None, "user", "> Yes.\nno turn", "x", 1), (8, 2, "user", None, "x", 1), (8, 3, "user", "> " * 3000 + "deep\n" + "long " * 40000, "x", 1)]
    return rows


def test_nested_conversations(spark, monkeypatch):
    rows = conversations(4000)
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(brute(rows), key=str)
    assert sum(r[5] is not None for r in want) > 1500 and max(r[7] for r in want) > 8
    take = lambda rs: sorted(((r.conv_id, r.turn, r.content, r.n_quotes, r.deepest_quote, r.parent_turn, r.root_turn, r.depth) for r in rs), key=str)
    assert take(op.linked(df).collect()) == want
    monkeypatch.setattr(op, "STRETCH", 16)
    assert take(op.linked(df).collect()) == want
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert take(spark.createDataFrame(con.execute(op.ORACLE).to_arrow_table().to_pylist(), "conv_id long, turn long, role string, content string, n_quotes long, deepest_quote long, parent_turn long, root_turn long, depth long, formatted string").collect()) == want
    assert op.linked(df.limit(0)).count() == 0
