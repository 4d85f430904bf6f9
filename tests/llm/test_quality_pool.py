"""Co-training hands on unlabelled rows of the whole table: against one process with every row in memory."""

import random

import numpy as np
import pyarrow as pa
from folioflow.llm import op7_quality as q


def brute(rows, y):
    """The rounds with all rows in memory; the first len(y) rows are the labelled ones."""
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=list(q._COLUMNS))
    views, n = q._views(batch), len(y)
    held = np.array([q.zlib.crc32(str(r[0]).encode()) % q.HELD == 0 for r in rows[:n]])
    own, pool = [x[:n][~held] for x in views], [x[n:] for x in views]
    sets = [(x, y[~held].astype(float), np.ones(len(x))) for x in own]
    models, open_, taken = [q.Logistic.fit(*s) for s in sets], np.ones(len(pool[0]), bool), 0
    for _ in range(q.ROUNDS):
        given = []
        for v in (0, 1):
            z = models[v].logit(pool[v])
            size = np.floor((np.abs(z) - np.log(q.SURE / (1 - q.SURE))) * q.BINS)
            for label in (0, 1):
                fit = np.flatnonzero(open_ & (size >= 0) & ((z > 0) == bool(label)))
                most = max(1, int(q.SHARE * len(z) * (y == label).mean()))
                if len(fit) > most:
                    fit = fit[size[fit] >= np.sort(size[fit])[-most]]
                given.append((1 - v, fit, label))
            for _, fit, _ in given[-2:]:
                open_[fit] = False
                taken += len(fit)
        for to, fit, label in given:
            x, t, w = sets[to]
            sets[to] = (np.vstack([x, pool[to][fit]]), np.append(t, np.full(len(fit), float(label))), np.append(w, np.full(len(fit), 0.5)))
        models = [q.Logistic.fit(*s) for s in sets]
    return models, views, taken


def least(x, y, ridge):
    """Logits of the ridge-penalised logistic fit on standardised columns, by damped Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z, w = np.column_stack([(x - mean) / scale, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    loss = lambda w: (np.logaddexp(0, z @ w) - y * (z @ w)).sum() + 0.5 * (penalty * w**2).sum()
    for _ in range(300):
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        k = 1.0
        while loss(w - k * step) > loss(w) and k > 1e-9:
            k /= 2
        w = w - k * step
    return lambda v: ((v - mean) / scale) @ w[:-1] + w[-1]


def probabilities(models, views, held, y):
    """Calibrated and combined on the held rows."""
    n, t, logits = len(y), y[held].astype(float), [m.logit(v) for m, v in zip(models, views, strict=True)]
    base = float(np.log(y.mean() / (1 - y.mean())))
    sides = []
    for x in logits:
        f = least(x[:n][held][:, None], t, 0.1)
        slope = f(np.ones((1, 1)))[0] - f(np.zeros((1, 1)))[0]
        sides.append(f(x[:, None]) if slope > 0 else np.full(len(x), base))
    both = least(np.column_stack([c[:n][held] for c in sides]), t, 0.1)(np.column_stack(sides))
    return [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*sides, both)]


def test_pool_is_every_unlabelled_row(spark, monkeypatch):
    monkeypatch.setattr(q, "FAN", 2)
    rng = random.Random(8)
    rows = []
    for i in range(9600):
        bad = rng.random() < 0.4
        text = " ".join(("#" if bad and rng.random() < 0.5 else "") + "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(12))
        rows.append((i if i < 9500 else None, text + "\n" * (bad and rng.random() < 0.6), rng.choice(["en", "de"]), "s", len(text), int(bad)))
    # Rows that repeat and tie, and a very long text.
    for i in range(400, 9600, 40):
        rows[i] = (rows[i][0], *rows[360][1:])
    rows[501] = (501, "abc #de " * 60_000, "en", "s", 480_000, 1)
    y = np.array([1 - r[5] for r in rows[:300]])
    rows = [r[:5] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    models, views, taken = brute(rows, y)
    assert taken > 8000 * 2 * q.SHARE * q.ROUNDS * 0.5
    got = q.fitted(docs, labels)
    for v, (a, b) in enumerate(zip((got.content, got.meta), models, strict=True)):
        assert np.abs(a.logit(views[v]) - b.logit(views[v])).max() < 1e-3
    held = np.array([q.zlib.crc32(str(r[0]).encode()) % q.HELD == 0 for r in rows[:300]])
    want = probabilities(models, views, held, y)
    found = q.scored(docs, got).collect()
    assert len(found) == len(rows)
    ids = {r.doc_id: r for r in found if r.doc_id is not None}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            r = ids[doc_id]
            assert max(abs(a - b[i]) for a, b in zip((r.p_content, r.p_meta, r.p_quality), want, strict=True)) < 2e-3
    stay = {r.doc_id for r in q.kept(docs.where("doc_id IS NOT NULL"), got).select("doc_id").collect()}
    clear = [(r[0], p) for r, p in zip(rows, want[2], strict=True) if r[0] is not None and abs(p - q.KEEP) > 2e-3]
    assert len(clear) > 9000 and all((i in stay) == (p >= q.KEEP) for i, p in clear)
    assert stay == {r.doc_id for r in found if r.keep and r.doc_id is not None}
