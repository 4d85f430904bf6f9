"""Benchmark decontamination by winnowing.

Of every window of consecutive k-gram hashes the smallest is kept, for the
benchmark and for the documents.  A span of K + W - 1 words that both hold has
the same window, so both keep the same fingerprint: joining fingerprints misses
no span of that length.  Each join hit is then extended left and right to every
whole benchmark window around it, and counts where all words of the window are
there, by two independent hashes.

A benchmark of up to BLOCK_WORDS words travels to the executors whole (a checked
bound), and documents are judged where they lie.  A larger one stays distributed:
a bitmap of fixed size picks the documents' windows that may occur in it, and
those join the benchmark's windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from .common import bitmap, documents, fresh_names, stored
from .kernels import ALNUM, U64, chunks, doc_of, grams, release, released, sliding, texts_of, words

#: Words of a window, of a fingerprint, and fingerprints of which the smallest is kept (K + W - 1 = WINDOW).
WINDOW, K = 10, 5
#: Words of a benchmark that is broadcast, about 30 bytes each.
BLOCK_WORDS = 1 << 20
#: Bits of the bitmap that stands for a larger benchmark's fingerprints (8 MB).
SIEVE_BITS = 1 << 26


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Which hashes are the smallest of at least one window of w; ties are all kept."""
    low = sliding(np.minimum, h, w)
    if not len(low):
        return np.zeros(len(h), bool)
    pad = np.zeros(w - 1, U64)
    return sliding(np.maximum, np.concatenate([pad, low, pad]), w) == h


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... count[0] of them, then the same for the next."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - (total - count), count)


class Text:
    """The words of a buffer of texts: hashes, row of each word, first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.at, self.rows = data, offsets[:-1], len(offsets) - 1
        self.starts, _, self.h = words(data, self.at, ALNUM)
        self.doc = doc_of(self.starts, self.at)
        self.begin = np.searchsorted(self.doc, np.arange(self.rows + 1))
        self.count = np.diff(self.begin)
        self._grams: dict = {}

    def grams(self, m: int, seed: int = 0) -> np.ndarray:
        """Hash of the m words from each word on; those that leave a row are never asked for."""
        if (m, seed) not in self._grams:
            if seed and ("h", seed) not in self._grams:
                self._grams["h", seed] = words(self.data, self.at, ALNUM, seed)[2]
            self._grams[m, seed] = grams(self._grams["h", seed] if seed else self.h, m)
        return self._grams[m, seed]

    def inside(self, m: int) -> np.ndarray:
        """Whether the m words from each word on lie in one row."""
        return self.doc[: len(self.doc) - m + 1] == self.doc[m - 1 :] if len(self.doc) >= m else np.zeros(0, bool)

    def prints(self, k: int, window: int) -> np.ndarray:
        """First words of the kept fingerprints; a window across rows only adds some."""
        g = self.grams(k)
        if not len(g):
            return np.empty(0, np.int64)
        # A buffer shorter than a window of fingerprints holds no whole window.
        return np.flatnonzero(winnow(g, window - k + 1) & self.inside(k))


class Fingerprints:
    """A broadcast benchmark: fingerprints, the windows around each, and the items of each window."""

    def __init__(self, ids: list[str], texts: list[str], window: int, k: int):
        self.window, self.k, around = window, k, window - k + 1
        self.ids = sorted(set(ids))
        number = {v: i for i, v in enumerate(self.ids)}
        item = np.array([number[v] for v in ids], np.int64)
        t = Text(*texts_of(pa.array([x or "" for x in texts], pa.large_string())))
        # All windows, by length, then hashes; equal ones are one.
        length = np.minimum(t.count, window)
        keys = []
        for m in np.unique(length[length > 0]).tolist():
            own = length[t.doc] == m
            first = np.flatnonzero(own[: len(t.doc) - m + 1] & t.inside(m) & ((m == window) | (t.count[t.doc] == m))[: len(t.doc) - m + 1])
            keys.append((np.full(len(first), m), t.grams(m)[first], t.grams(m, 1)[first], first))
        m, g, c, first = (np.concatenate(x) for x in zip(*keys, strict=True)) if keys else (np.empty(0, np.int64), np.empty(0, U64), np.empty(0, U64), np.empty(0, np.int64))
        order = np.lexsort((c, g, m))
        m, g, c, first = m[order], g[order], c[order], first[order]
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        which = np.cumsum(new) - 1
        self.length, self.hash, self.check = m[new], g[new], c[new]
        pairs = np.unique(which * (len(self.ids) + 1) + item[t.doc[first]])
        self.items = pairs % (len(self.ids) + 1)
        self.items_from = np.searchsorted(pairs // (len(self.ids) + 1), np.arange(len(self.hash) + 1))
        self.short = [int(x) for x in np.unique(self.length) if x < window]
        # Fingerprints, each with the windows that hold it; equal surroundings are one.
        window_of = np.full(len(t.h) + 1, -1, np.int64)
        full = m == window
        window_of[first[full]] = which[full]
        at = t.prints(k, window)
        ctx = np.stack([np.where((at >= o) & (t.doc[at] == t.doc[np.maximum(at - o, 0)]), window_of[np.maximum(at - o, 0)], -1) for o in range(around)], 1) if len(at) else np.empty((0, around), np.int64)
        some = (ctx >= 0).any(1)
        table = np.concatenate([t.grams(k)[at[some]].view(np.int64)[:, None], ctx[some]], 1) if some.any() else np.empty((0, around + 1), np.int64)
        table = np.unique(table, axis=0)
        prints = table[:, 0].copy().view(U64)
        order = np.argsort(prints, kind="stable")
        self.prints, self.ctx = prints[order], table[order, 1:].astype(np.int32)
        #: Tells most absent fingerprints by 16 of their bits.
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.prints >> U64(48)).astype(np.int64)] = True

    def hits(self, t: Text) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every benchmark window in the texts, once each."""
        found = []
        if len(self.prints):
            g = t.grams(self.k)
            at = t.prints(self.k, self.window)
            at = at[self.sieve[(g[at] >> U64(48)).astype(np.int64)]]
            lo = np.searchsorted(self.prints, g[at], "left")
            count = np.searchsorted(self.prints, g[at], "right") - lo
            p, e = np.repeat(at, count), _ranges(lo, count)
            inside = t.inside(self.window)
            for o in range(self.ctx.shape[1] if len(p) else 0):
                s, w = p - o, self.ctx[e, o]
                ok = (w >= 0) & (s >= 0) & (s < len(inside))
                s, w = s[ok], w[ok].astype(np.int64)
                ok = inside[s] & (t.grams(self.window)[s] == self.hash[w])
                found.append((s[ok], w[ok]))
        for m in self.short:
            lo, hi = np.searchsorted(self.length, [m, m + 1])
            g = t.grams(m)
            spot = np.searchsorted(self.hash[lo:hi], g)
            s = np.flatnonzero((self.hash[lo:hi][np.minimum(spot, hi - lo - 1)] == g) & t.inside(m)) if len(g) else np.empty(0, np.int64)
            count = np.searchsorted(self.hash[lo:hi], g[s], "right") - spot[s]
            found.append((np.repeat(s, count), _ranges(spot[s] + lo, count)))
        s, w = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
        if len(s):
            ok = np.zeros(len(s), bool)
            for m in np.unique(self.length[w]).tolist():
                own = np.flatnonzero(self.length[w] == m)
                ok[own] = t.grams(m, 1)[s[own]] == self.check[w[own]]
            both = np.unique(np.stack([s[ok], w[ok]], 1), axis=0)
            s, w = both[:, 0], both[:, 1]
        return s, w


def _covered(t: Text, s: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, after) of the runs of words that windows cover; a run stays in its row."""
    n = len(t.h)
    step = np.bincount(s, minlength=n + 1) - np.bincount(s + length, minlength=n + 1)
    on = np.cumsum(step)[:n] > 0
    new = t.doc[1:] != t.doc[:-1]
    first, last = on.copy(), on.copy()
    first[1:] &= ~on[:-1] | new
    last[:-1] &= ~on[1:] | new
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_OUT = "doc_id long, n_words long, spans array<struct<first:int,after:int>>, items array<string>"
_SPAN = pa.struct([("first", pa.int32()), ("after", pa.int32())])
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def _search(side):
    def run(batches):
        have = side.value
        names = pa.array(have.ids, pa.string())
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets):
                t = Text(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                s, w = have.hits(t)
                a, b = _covered(t, s, have.length[w]) if len(s) else (s, s)
                d = t.doc[a]
                spans = pa.StructArray.from_arrays([pa.array((x - t.begin[d]).astype(np.int32)) for x in (a, b)], fields=list(_SPAN))
                # Distinct (row, item), by item id.
                count = have.items_from[w + 1] - have.items_from[w]
                pairs = np.unique(np.repeat(t.doc[s], count) * (len(have.ids) + 1) + have.items[_ranges(have.items_from[w], count)])
                edge = lambda rows, t=t: pa.array(np.searchsorted(rows, np.arange(t.rows + 1)).astype(np.int32))
                items = pa.ListArray.from_arrays(edge(pairs // (len(have.ids) + 1)), names.take(pa.array(pairs % (len(have.ids) + 1))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, t.rows).cast(pa.int64()), pa.array(t.count.astype(np.int64)), pa.ListArray.from_arrays(edge(d), spans).cast(_OUT_ARROW.field("spans").type), items], schema=_OUT_ARROW)

    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("i"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t")).where("i IS NOT NULL AND t <> ''")


def _broadcastable(items: DataFrame) -> bool:
    """A text has one word for two bytes at most."""
    return (items.agg(F.sum(F.octet_length("t") / 2 + 1)).first()[0] or 0) <= BLOCK_WORDS


def _side(items: DataFrame, window: int, k: int):
    rows = items.collect()  # at most BLOCK_WORDS words
    return items.sparkSession.sparkContext.broadcast(Fingerprints([r.i for r in rows], [r.t for r in rows], window, k))


# ---- a benchmark that is too large to broadcast ----------------------------

_WINDOW = "item string, m int, g long, c long, print long"


def _item_windows(window: int, k: int):
    """Every window of every item, and with g null every kept fingerprint."""
    schema = pa.schema([("item", pa.string()), ("m", pa.int32()), ("g", pa.int64()), ("c", pa.int64()), ("print", pa.int64())])

    def run(batches):
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets):
                t = Text(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                ids = batch.column(0).slice(first, t.rows)
                length = np.minimum(t.count, window)
                for m in np.unique(length[length > 0]).tolist():
                    s = np.flatnonzero(t.inside(m) & (length[t.doc[: len(t.doc) - m + 1]] == m))
                    g, c = t.grams(m)[s].view(np.int64), t.grams(m, 1)[s].view(np.int64)
                    mark = pa.array(g) if m < window else pa.nulls(len(s), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(t.doc[s])), pa.array(np.full(len(s), m, np.int32)), pa.array(g), pa.array(c), mark], schema=schema)
                at = t.prints(k, window)
                at = at[t.count[t.doc[at]] >= window]
                none = pa.nulls(len(at), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.string()), pa.array(np.full(len(at), window, np.int32)), none, none, pa.array(t.grams(k)[at].view(np.int64))], schema=schema)

    return run


def _candidates(window: int, k: int, short: list[int], side):
    """Per document: its words, and the windows around fingerprints that the bitmap knows."""
    win = pa.struct([("at", pa.int32()), ("m", pa.int32()), ("g", pa.int64()), ("c", pa.int64())])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("wins", pa.list_(win))])

    def run(batches):
        sieve = side.value
        known = lambda g: ((sieve[((g % U64(SIEVE_BITS)) >> U64(6)).astype(np.int64)] >> (g & U64(63))) & U64(1)).astype(bool)
        for batch in batches:
            data, offsets = texts_of(batch.column(2))
            for first, last in chunks(offsets):
                t = Text(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                at = t.prints(k, window)
                at = at[known(t.grams(k)[at])] if len(at) else at
                inside = t.inside(window)
                s = np.unique(np.concatenate([at - o for o in range(window - k + 1)]))
                s = s[(s >= 0) & (s < len(inside))]
                s = s[inside[s]]
                parts = [(s, np.full(len(s), window))]
                for m in short:
                    s = np.flatnonzero(t.inside(m) & known(t.grams(m))) if len(t.grams(m)) else np.empty(0, np.int64)
                    parts.append((s, np.full(len(s), m)))
                s, m = (np.concatenate(x) for x in zip(*parts, strict=True))
                g, c = np.empty(len(s), U64), np.empty(len(s), U64)
                for v in np.unique(m).tolist():
                    g[m == v], c[m == v] = t.grams(v)[s[m == v]], t.grams(v, 1)[s[m == v]]
                order = np.argsort(t.doc[s], kind="stable")
                s, m, g, c = (x[order] for x in (s, m, g, c))
                d = t.doc[s]
                wins = pa.StructArray.from_arrays([pa.array((s - t.begin[d]).astype(np.int32)), pa.array(m.astype(np.int32)), pa.array(g.view(np.int64)), pa.array(c.view(np.int64))], fields=list(win))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(t.rows + 1)).astype(np.int32)), wins)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, t.rows), batch.column(1).slice(first, t.rows), pa.array(t.count.astype(np.int64)), lists.cast(schema.field("wins").type)], schema=schema)

    return run


def _joined(texts: DataFrame, items: DataFrame, window: int, k: int) -> DataFrame:
    """contamination() by a join of windows; nothing of the benchmark's size is collected or broadcast."""
    spark = texts.sparkSession
    have = stored(items.mapInArrow(released(_item_windows(window, k)), _WINDOW), "windows")
    short = sorted(r.m for r in have.where(F.col("m") < window).select("m").distinct().collect())  # lengths below the window
    side = spark.sparkContext.broadcast(bitmap(have.where("print IS NOT NULL").select("print"), SIEVE_BITS))
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    base = stored(rows.mapInArrow(released(_candidates(window, k, short, side)), "row long, doc_id long, n_words long, wins array<struct<at:int,m:int,g:long,c:long>>"), "candidates")
    wins = base.where(F.size("wins") > 0).select("row", F.explode("wins").alias("w")).select("row", "w.*")
    items_of = have.where("g IS NOT NULL").select("item", "m", "g", "c").distinct()
    # Windows that occur at all, then their items by distinct window of a document.
    real = stored(wins.join(items_of.select("m", "g", "c").distinct(), ["m", "g", "c"], "left_semi"), "hits")
    which = real.select("row", "m", "g", "c").distinct().join(items_of, ["m", "g", "c"]).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # Runs of a document: at most as many windows as it has words.
    line = Window.partitionBy("row").orderBy("at", "after")
    ends = real.groupBy("row", "at").agg(F.max(F.col("at") + F.col("m")).alias("after"))
    new = F.coalesce(F.col("at") > F.max("after").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    runs = ends.withColumn("new", new).withColumn("run", F.sum("new").over(line)).groupBy("row", "run").agg(F.min("at").alias("first"), F.max("after").alias("after"))
    spans = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "after"))).alias("spans"))
    out = base.select("row", "doc_id", "n_words").join(spans, "row", "left").join(which, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("spans", F.expr("cast(array() as array<struct<first:int,after:int>>)")).alias("spans"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, spans (merged hit word ranges), items (ids whose windows occur, sorted).

    A window is `window` consecutive item words, or the whole of a shorter
    item.  Null, empty and wordless texts have no words and no hits; items
    without id or words match nothing.  Repeated documents, with or without
    doc_id, come back once each; repeated items count once.  Long texts are
    read whole; texts and items that repeat one word cost their length.  Extra
    columns are not read.  An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = _items(benchmark)
    if _broadcastable(items):
        return texts.mapInArrow(released(_search(_side(items, window, k))), _OUT)
    return _joined(texts, items, window, k)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """The documents without a benchmark window, all columns; each row is judged by itself, with or without doc_id."""
    items, columns = _items(benchmark), docs.columns
    if _broadcastable(items):
        search = _search(_side(items, window, k))

        @F.arrow_udf("boolean", ArrowUDFType.SCALAR_ITER)
        def untouched(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            try:
                for text in texts:
                    batch = pa.RecordBatch.from_arrays([pa.nulls(len(text), pa.int64()), text], names=["doc_id", "text"])
                    spans = [r.column(2).offsets.to_numpy() for r in search([batch])]
                    yield pa.array(np.concatenate([np.diff(x) for x in spans]) == 0 if spans else np.empty(0, bool))
            finally:
                release()

        # Only texts go to Python, and only one bit of each comes back.
        return docs.where(untouched(F.col("text").cast("string")))
    (row,) = fresh_names(columns, "row")
    keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    found = contamination(keyed.select(F.col(row).alias("doc_id"), "text"), benchmark, window, k)
    return keyed.join(found.where(F.size("spans") > 0).select(F.col("doc_id").alias(row)), row, "left_anti").select(*columns)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.after - s.first)")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """The definition, word by word, for tests: {doc_id: (n_words, n_hit, n_items, digest)}."""
    import re

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    windows: dict = {}
    for i, t in items:
        w = cut(t)
        for j in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[j : j + window]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for d, t in docs:
        w, hit, which = cut(t), set(), set()
        for m in sizes:
            for j in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[j : j + m]))) is not None:
                    hit |= set(range(j, j + m))
                    which |= own
        out[d] = (len(w), len(hit), len(which), hashlib.sha256(",".join(sorted(which)).encode()).hexdigest())
    return out


ORACLE = rf"""
WITH w AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
own AS (
  SELECT rid, i, m, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)),
hits AS (SELECT rid, i, m, item_id FROM own JOIN windows USING (m, t)),
words_hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM hits)) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words_hit USING (rid) LEFT JOIN items USING (rid)
"""
