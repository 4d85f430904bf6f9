"""Quality classifier by co-training.

Two views of a document: its content (byte, word-shape and word statistics of
the whole text) and its page metadata (language, source, stated length, layout
of lines).  A logistic model per view is fitted on labelled rows; in each round
either model scores all unlabelled rows and hands its most confident
pseudo-labels to the other.  Both are then calibrated on held-out labels, and
the calibrated views are combined to score every document.

Fitting uses at most LABELLED labelled rows, picked by a hash of doc_id (a
documented bound of the fit), and every unlabelled row.  The views of unlabelled
rows stay on the executors, which count confident rows by size of logit, pick
them, and add up the sums of each refit.  Scoring reads all of every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from .common import documents, stored
from .kernels import SPACED, U64, chunks, doc_of, release, released, texts_of, words

#: Bound of the fit: labelled rows.
LABELLED = 16_000
#: Rounds of co-training, pseudo-labels per class and round (share of the unlabelled rows), least confidence.
ROUNDS, SHARE, SURE = 4, 0.05, 0.9
#: Bins per unit of logit in which confident rows are counted; rows of one bin are handed on together.
BINS = 64
#: Partial sums that one task, or the driver, adds up.
FAN = 32
#: One labelled row in HELD is kept back for calibration.
HELD = 4
#: Points at which a fit takes sums, at most.
STEPS = 30
WORD_BINS, META_BINS = 64, 32
CONTENT_DIM = 128 + 8 + WORD_BINS + 10
META_DIM = 2 * META_BINS + 8
#: Rows that the fit and the scores take at a time.
BLOCK = 2048
#: A document is kept from this calibrated probability of good quality on.
KEEP = 0.5


def content_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: shares of bytes, of word bins, and word statistics."""
    n = len(offsets) - 1
    out = np.zeros((n, CONTENT_DIM), np.float32)
    for first, last in chunks(offsets):
        own = data[offsets[first] : offsets[last]]
        at, size = offsets[first:last] - offsets[first], np.diff(offsets[first : last + 1])
        rows = last - first
        owner = np.repeat(np.arange(rows), size)
        # ASCII bytes one by one, the others in 8 groups.
        kind = np.where(own < 128, own, 128 + (own >> 3 & 7)).astype(np.int64)
        hist = np.bincount(owner * 136 + kind, minlength=rows * 136).reshape(rows, 136)
        out[first:last, :136] = np.sqrt(hist / np.maximum(size, 1)[:, None])
        s, e, h = words(own, at, SPACED)
        doc = doc_of(s, at)
        count = np.bincount(doc, minlength=rows)
        per = np.maximum(count, 1)
        bins = np.bincount(doc * WORD_BINS + (h >> U64(58)).astype(np.int64), minlength=rows * WORD_BINS).reshape(rows, WORD_BINS)
        out[first:last, 136 : 136 + WORD_BINS] = np.sqrt(bins / per[:, None])
        length = (e - s).astype(np.float64)
        mean = np.bincount(doc, weights=length, minlength=rows) / per
        square = np.bincount(doc, weights=length**2, minlength=rows) / per
        # A word that stands twice in a row, and words that occurred before in the text.
        again = np.zeros(rows)
        if len(h) > 1:
            again = np.bincount(doc[1:], weights=(h[1:] == h[:-1]) & (doc[1:] == doc[:-1]), minlength=rows)
        order = np.lexsort((h, doc)) if len(h) else np.empty(0, np.int64)
        new = np.ones(len(h), bool)
        if len(h):
            new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        distinct = np.bincount(doc[order][new], minlength=rows) if len(h) else np.zeros(rows)
        lone = np.bincount(doc, weights=length == 1, minlength=rows) / per
        long_ = np.bincount(doc, weights=length > 14, minlength=rows) / per
        letters = np.bincount(owner, weights=((own | 32) >= 97) & ((own | 32) <= 122) | (own >= 128), minlength=rows) / np.maximum(size, 1)
        digits = np.bincount(owner, weights=(own >= 48) & (own <= 57), minlength=rows) / np.maximum(size, 1)
        upper = np.bincount(owner, weights=(own >= 65) & (own <= 90), minlength=rows) / np.maximum(size, 1)
        stats = [mean / 10, np.sqrt(np.maximum(square - mean**2, 0)) / 10, again / per, distinct / per, lone, long_, letters, digits, upper, np.log1p(count) / 10]
        out[first:last, 136 + WORD_BINS :] = np.stack(stats, 1)
    return out


def meta_view(data: np.ndarray, offsets: np.ndarray, lang, source, n_chars) -> np.ndarray:
    """One row per document: language and source bins, stated length, and how its lines lie on the page."""
    n = len(offsets) - 1
    out = np.zeros((n, META_DIM), np.float32)
    for j, column in enumerate((lang, source)):
        seen: dict = {}
        for i, v in enumerate(column):
            if v not in seen:
                seen[v] = zlib.crc32(str(v).encode()) % META_BINS
            out[i, j * META_BINS + seen[v]] = 1
    size = np.diff(offsets)
    break_ = np.flatnonzero(data == 10)
    lines = np.bincount(np.searchsorted(offsets[1:], break_, "right"), minlength=n)[:n] + 1.0 if len(break_) else np.ones(n)
    stated = np.array([-1 if v is None else v for v in n_chars], np.float64)
    known = stated >= 0
    begin = np.unique(np.concatenate([offsets[:-1][size > 0], break_ + 1])) if len(data) else np.empty(0, np.int64)
    begin = begin[begin < len(data)]
    length = np.diff(np.append(begin, len(data)))
    doc = np.searchsorted(offsets[1:], begin, "right") if len(begin) else np.empty(0, np.int64)
    mean = np.bincount(doc, weights=length, minlength=n)[:n] / lines
    square = np.bincount(doc, weights=length.astype(np.float64) ** 2, minlength=n)[:n] / lines
    short = np.bincount(doc, weights=length < 20, minlength=n)[:n] / lines
    rest = [np.log1p(np.where(known, stated, 0)) / 10, known, np.log1p(lines) / 10, np.log1p(mean) / 10, np.log1p(np.sqrt(np.maximum(square - mean**2, 0))) / 10, short, np.where(known, stated / np.maximum(size, 1), 0).clip(0, 2), np.ones(n)]
    out[:, 2 * META_BINS :] = np.stack(rest, 1)
    return out


def _penalty(d: int, ridge: float) -> np.ndarray:
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-6
    return penalty


def newton_sums(x, y, weight, mean, scale, w, bounded: bool = False) -> np.ndarray:
    """The rows' share of the loss, its gradient and its Hessian, packed in one vector; bounded: a Hessian that bounds the loss's everywhere.

    The bound's weights, tanh(z/2) / 2z, make every step with it go down.  A
    block of rows at a time.
    """
    d = x.shape[1] + 1
    loss, g, h = 0.0, np.zeros(d), np.zeros((d, d))
    for i in range(0, len(x), BLOCK):
        part = slice(i, i + BLOCK)
        z = np.ones((len(x[part]), d))
        np.divide(x[part] - mean, scale, out=z[:, :-1])
        at, k = z @ w, weight[part]
        p = 1 / (1 + np.exp(-np.clip(at, -30, 30)))
        size = np.maximum(np.abs(at), 1e-6)
        loss += float((k * (np.logaddexp(0, at) - y[part] * at)).sum())
        g += z.T @ (k * (p - y[part]))
        curve = k * (np.tanh(size / 2) / (2 * size) if bounded else p * (1 - p))
        h += (z * curve[:, None]).T @ z
    return np.concatenate([[loss], g, h[np.triu_indices(d)]])


class Descent:
    """The least penalised loss from sums at one point after another: Newton steps, and where one goes up, a step of the bound from the best point."""

    def __init__(self, w: np.ndarray, ridge: float):
        self.w, self.penalty, self.best = w, _penalty(len(w), ridge), None
        #: Whether the sums wanted next are those of the bound, and whether the last step was one of the bound.
        self.bounded, self.sure, self.done = False, False, False

    def take(self, sums: np.ndarray) -> None:
        """Sums at self.w; sets the next point, or done."""
        d = len(self.w)
        loss = sums[0] + 0.5 * float((self.penalty * self.w**2).sum())
        if not self.bounded and self.best is not None and loss >= self.best[0]:
            # A step of the bound that does not go down is at the end of what numbers can tell.
            self.done, self.bounded, self.w = self.sure, True, self.best[1]
            return
        small = not self.bounded and self.best is not None and self.best[0] - loss < 1e-7 * (1 + abs(loss))
        self.best, self.sure, self.bounded = (loss, self.w), self.bounded, False
        h = np.zeros((d, d))
        h[np.triu_indices(d)] = sums[1 + d :]
        step = np.linalg.solve(h + np.triu(h, 1).T + np.diag(self.penalty), sums[1 : 1 + d] + self.penalty * self.w)
        self.done = small or np.abs(step).max() < 1e-5
        self.w = self.w - step


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = STEPS) -> Logistic:
        """The least ridge-penalised loss on standardised columns, a block of rows at a time."""
        mean = x.mean(0, dtype=np.float64)
        scale = np.sqrt(sum(((x[i : i + BLOCK] - mean) ** 2).sum(0) for i in range(0, len(x), BLOCK)) / len(x)) + 1e-6
        at = Descent(np.zeros(x.shape[1] + 1), ridge)
        for _ in range(steps):
            at.take(newton_sums(x, y, weight, mean, scale, at.w, at.bounded))
            if at.done:
                break
        w = at.best[1]
        return cls(mean, scale, w[:-1], float(w[-1]))

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for i in range(0, len(x), BLOCK):
            part = slice(i, i + BLOCK)
            out[part] = ((x[part] - self.mean) / self.scale) @ self.w + self.b
        return np.clip(out, -30, 30)


@dataclass
class CoTrained:
    content: Logistic
    meta: Logistic
    #: Calibrations (slope, offset) per view and the combination's weights.
    cal: tuple
    mix: Logistic | None
    base: float

    def score(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        la, lb = self.content.logit(a), self.meta.logit(b)
        ca, cb = (s * x + o for (s, o), x in zip(self.cal, (la, lb), strict=True))
        both = self.mix.logit(np.stack([ca, cb], 1)) if self.mix else ca + cb - self.base
        squash = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
        return squash(ca), squash(cb), squash(both)


def _bin(z: np.ndarray, sure: float) -> np.ndarray:
    """Bin of each logit's size, from 0 where the model is sure enough, negative below."""
    return np.floor((np.abs(z) - np.log(sure / (1 - sure))) * BINS).astype(np.int64)


def handed(views, turns, sure: float) -> tuple[np.ndarray, np.ndarray]:
    """Which turn hands each row on (-1: none), and as which label.  A turn is (view, its model, least bins of labels 0 and 1)."""
    turn, label = np.full(len(views[0]), -1), np.zeros(len(views[0]), np.int64)
    for k, (v, model, least) in enumerate(turns):
        left = np.flatnonzero(turn < 0)
        z = model.logit(views[v][left])
        pick = _bin(z, sure) >= np.where(z > 0, least[1], least[0])
        turn[left[pick]], label[left[pick]] = k, z[pick] > 0
    return turn, label


def least_bins(counts: dict, most: tuple[int, int]) -> tuple[int, int]:
    """For each label the highest bin from which on there are `most` rows, or 0. counts: rows by (label, bin)."""
    out = [0, 0]
    for label in (0, 1):
        n = 0
        for b in sorted((b for k, b in counts if k == label), reverse=True):
            n += counts[label, b]
            if n >= most[label]:
                out[label] = b
                break
    return tuple(out)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return texts_of(column)[0].view(np.float32).reshape(-1, width)


def _pool_views(batch: pa.RecordBatch):
    return _matrix(batch.column(0), CONTENT_DIM), _matrix(batch.column(1), META_DIM)


def _count_open(pool: DataFrame, turns, v: int, model: Logistic, sure: float) -> dict:
    """Sure rows of the pool that no turn has handed on, by (label, bin)."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            views = _pool_views(batch)
            z = model.logit(views[v][handed(views, turns, sure)[0] < 0])
            b = _bin(z, sure)
            for key, n in zip(*(x.tolist() for x in np.unique((2 * b + (z > 0))[b >= 0], return_counts=True)), strict=True):
                total[key] = total.get(key, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["key", "n"])

    # Two labels of at most 30 * BINS bins.
    rows = pool.mapInArrow(released(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return {(r.key & 1, r.key >> 1): r.n for r in rows}


def _picked(pool: DataFrame, turns, sure: float) -> DataFrame:
    """What the last two turns hand on: the view that gets the row, the label, the row in that view."""
    last = len(turns) - 2

    def run(batches):
        for batch in batches:
            views = _pool_views(batch)
            turn, label = handed(views, turns, sure)
            for k in (last, last + 1):
                to, rows = 1 - turns[k][0], np.flatnonzero(turn == k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), to, np.int32)), pa.array(label[rows].astype(np.int32)), pa.array([r.tobytes() for r in views[to][rows]], pa.binary())], names=["view", "label", "x"])

    return stored(pool.mapInArrow(released(run), "view int, label int, x binary"), "handed")


def _added(batches):
    total: dict = {}
    for batch in batches:
        for v, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[v] = total.get(v, 0) + np.frombuffer(x)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["view", "sums"])


def _summed(given: DataFrame, n: int, part) -> dict:
    """Sums over the given rows by view: part(view, x, label) adds up one batch. n: partitions of given."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            view, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for v, width in enumerate((CONTENT_DIM, META_DIM)):
                own = view == v
                sums = part(v, _matrix(batch.column(2).filter(pa.array(own)), width), label[own].astype(float)) if own.any() else None
                if sums is not None:
                    total[v] = total.get(v, 0) + sums
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["view", "sums"])

    parts = given.mapInArrow(released(run), "view int, sums binary")
    while n > FAN:
        n = -(-n // FAN)
        parts = parts.repartition(n).mapInArrow(_added, "view int, sums binary")
    out: dict = {}
    for r in parts.collect():
        out[r.view] = out.get(r.view, 0) + np.frombuffer(r.sums)
    return out


def refit(own, models, given: DataFrame, weight: float = 0.5, ridge: float = 1.0, steps: int = STEPS) -> list[Logistic]:
    """Logistic.fit of both views on the labelled rows own[v] = (x, y) and all given rows, whose sums come from the executors; starts from `models`."""
    n = given.rdd.getNumPartitions()
    centre = [x.mean(0, dtype=np.float64) for x, _ in own]

    def moments(v, x, _):
        d = x - centre[v]
        return np.concatenate([[len(x)], d.sum(0), (d**2).sum(0)])

    far, at = _summed(given, n, moments), {}
    for v, (x, _) in enumerate(own):
        total = far.get(v, 0) + sum(moments(v, x[i : i + BLOCK], None) for i in range(0, len(x), BLOCK))
        first, second = total[1:].reshape(2, -1) / total[0]
        mean, scale = centre[v] + first, np.sqrt(np.maximum(second - first**2, 0)) + 1e-6
        slope = models[v].w / models[v].scale
        at[v] = (mean, scale, Descent(np.append(slope * scale, models[v].b + slope @ (mean - models[v].mean)), ridge))
    for _ in range(steps):
        point = {v: (mean, scale, a.w, a.bounded) for v, (mean, scale, a) in at.items() if not a.done}
        if not point:
            break
        far = _summed(given, n, lambda v, x, y, point=point: newton_sums(x, y, np.full(len(y), weight), *point[v]) if v in point else None)
        for v in point:
            x, y = own[v]
            at[v][2].take(newton_sums(x, y, np.ones(len(y)), *point[v]) + far.get(v, 0))
    best = {v: (mean, scale, a.best[1]) for v, (mean, scale, a) in at.items()}
    return [Logistic(m, s, w[:-1], float(w[-1])) for m, s, w in (best[0], best[1])]


def co_train(a, b, y, held, pool: DataFrame, rounds: int = ROUNDS, share: float = SHARE, sure: float = SURE) -> CoTrained:
    """a, b: labelled rows' views, y: labels, held: rows kept for calibration; pool: both views of all unlabelled rows."""
    fit = ~held
    if len(set(y[fit].tolist())) < 2:
        # Nothing to tell apart: every document gets the labels' share of good ones, or even odds without labels.
        share_good = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        flat = [Logistic(np.zeros(d), np.ones(d), np.zeros(d), 0.0) for d in (a.shape[1], b.shape[1])]
        prior = float(np.log(share_good / (1 - share_good)))
        return CoTrained(*flat, ((0.0, prior), (0.0, prior)), None, prior)
    own = [(x[fit], y[fit].astype(float)) for x in (a, b)]
    models = [Logistic.fit(*x, np.ones(fit.sum())) for x in own]
    size, turns, given = pool.count(), [], None
    most = tuple(max(1, int(share * size * (y.mean() if label else 1 - y.mean()))) for label in (0, 1))
    for _ in range(rounds if size else 0):
        found = 0
        for v in (0, 1):
            counts = _count_open(pool, turns, v, models[v], sure)
            turns.append((v, models[v], least_bins(counts, most)))
            found += len(counts)
        if not found:
            break
        new = _picked(pool, turns, sure)
        given = new if given is None else given.unionByName(new)
        models = refit(own, models, given)
    one = np.ones(held.sum())
    cal, mix, base = ((1.0, 0.0), (1.0, 0.0)), None, float(np.log(max(y.mean(), 1e-3) / max(1 - y.mean(), 1e-3)))
    if held.sum() >= 20 and len(set(y[held].tolist())) == 2:
        t, logits = y[held].astype(float), [models[0].logit(a[held]), models[1].logit(b[held])]
        cal = []
        for x in logits:
            m = Logistic.fit(x[:, None], t, one, ridge=0.1)
            slope = max(float(m.w[0] / m.scale[0]), 0.0)
            cal.append((slope, float(m.b - m.w[0] / m.scale[0] * m.mean[0]) if slope else base))
        mix = Logistic.fit(np.stack([s * x + o for (s, o), x in zip(cal, logits, strict=True)], 1), t, one, ridge=0.1)
    return CoTrained(models[0], models[1], tuple(cal), mix, base)


_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")], F.col("n_chars").cast("long").alias("n_chars"))


def _views(batch: pa.RecordBatch):
    data, offsets = texts_of(batch.column(1))
    return content_view(data, offsets), meta_view(data, offsets, *[batch.column(i).to_pylist() for i in (2, 3, 4)])


def _features(batches):
    for batch in batches:
        _, offsets = texts_of(batch.column(1))
        for first, last in chunks(offsets):
            part = batch.slice(first, last - first)
            a, b = _views(part)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in a], pa.binary()), pa.array([r.tobytes() for r in b], pa.binary())], names=["doc_id", "a", "b"])


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, seed: int = 1) -> CoTrained:
    """Fits on at most `labelled` labelled documents, which bounds what is collected, and on every row without a label.

    Rows without doc_id have no label; an unlabelled row that repeats weighs as
    often as it stands there, a labelled doc_id counts once.  Of a doc_id's
    labels the largest holds; null labels are none.  Without labels every
    document's probability is one half, with labels of one class it is their
    share of good ones (0.999 or 0.001): a table of such labels keeps all or
    nothing.  Empty tables give such a model too.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    ids = marks.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(labelled)
    views = lambda d: d.select(*_COLUMNS).mapInArrow(released(_features), "doc_id long, a binary, b binary")
    rows = _rows(docs)
    # Views are joined, not texts: they are smaller.
    rest = views(rows.where("doc_id IS NOT NULL")).join(marks, "doc_id", "left_anti").unionByName(views(rows.where("doc_id IS NULL")))
    pool = stored(rest.select("a", "b"), "views")
    # At most `labelled` rows of two integers: a proven bound.
    table, y = views(rows.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")).toArrow(), {r.doc_id: r.y for r in ids.collect()}
    have, pick = np.unique(table["doc_id"].to_numpy(), return_index=True)

    def view(name, width):
        column = table[name].combine_chunks()
        return np.frombuffer(column.buffers()[2], np.float32).reshape(-1, width)[pick] if len(pick) else np.zeros((0, width), np.float32)

    a, b = view("a", CONTENT_DIM), view("b", META_DIM)
    del table
    t = np.array([y[d] for d in have.tolist()], np.int64)
    held = np.array([zlib.crc32(str(d).encode()) % HELD == 0 for d in have], bool)
    model = co_train(a, b, t, held, pool)
    del a, b
    release()
    return model


def _score(side):
    schema = pa.schema([("doc_id", pa.int64()), ("p_content", pa.float64()), ("p_meta", pa.float64()), ("p_quality", pa.float64())])

    def run(batches):
        model = side.value
        for batch in batches:
            _, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets):
                part = batch.slice(first, last - first)
                pc, pm, p = model.score(*_views(part))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(np.round(x, 9)) for x in (pc, pm, p)]], schema=schema)

    return run


def scored(docs: DataFrame, model: CoTrained, keep: float = KEEP) -> DataFrame:
    """One row per document: doc_id, p_content, p_meta, p_quality, keep.

    Null texts are empty, null languages and sources are values of their own, a
    null length is unknown.  Long texts are read whole.  Repeated rows come back
    once each with equal scores.  An empty table gives no rows.  Extra columns
    are not read.
    """
    side = docs.sparkSession.sparkContext.broadcast(model)
    return _rows(docs).mapInArrow(released(_score(side)), "doc_id long, p_content double, p_meta double, p_quality double").withColumn("keep", F.col("p_quality") >= keep)


def kept(docs: DataFrame, model: CoTrained, keep: float = KEEP) -> DataFrame:
    """The documents that the model keeps, with all their columns; decided where they lie, without a join."""
    side = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean", ArrowUDFType.SCALAR_ITER)
    def good(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        try:
            for own in columns:
                batch = pa.RecordBatch.from_arrays(list(own), names=list(_COLUMNS))
                _, offsets = texts_of(batch.column(1))
                p = [side.value.score(*_views(batch.slice(a, b - a)))[2] for a, b in chunks(offsets)]
                # Rounded as in scored(), so that both decide alike.
                yield pa.array(np.round(np.concatenate(p), 9) >= keep if p else np.empty(0, bool))
        finally:
            release()

    types = ("long", "string", "string", "string", "long")
    return docs.where(good(*[F.col(c).cast(t) for c, t in zip(_COLUMNS, types, strict=True)]))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
