"""Importance resampling towards a target distribution, with partition-local word tries.

A trie's first level holds words, the next one the words that follow them, so a
node is a feature: a run of words.  A node carries how often the run came and
the CRC state of its bytes, which continues its parent's over a space and its
own word.

1. Each partition walks its texts into a trie and folds it into totals per
   bucket (CRC modulo the number of buckets); totals are merged by bucket.
2. Totals of raw and target texts give each bucket a gain, a table of fixed size.
3. Each partition builds its trie again with the gains attached to the nodes;
   a document's weight is the floored mean over the paths it walks.
4. A Gumbel draw from the hash of doc_id is added; the highest scores are drawn,
   ranked by range, without one task that holds them all.

A trie that reaches NODES nodes is folded and begun anew, so memory is bounded
whatever the vocabulary; sums do not depend on it.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, documents, numbered, stored
from .kernels import ALNUM, U64, chunks, doc_of, released, texts_of, words

#: Nodes at which a trie is folded into its buckets' totals.
NODES = 1 << 20
#: Bytes of a word up to which CRC states of many words are advanced together.
LONG = 64
#: Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = np.uint32(0xEDB88320)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ POLYNOMIAL, t >> np.uint32(1))
    return t


TABLE = _crc_table()


def advanced(state: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32s `state`, each continued over its span of bytes."""
    out = ~state
    rows = np.flatnonzero((sizes > 0) & (sizes <= LONG))
    for j in range(LONG):
        rows = rows[sizes[rows] > j]
        if not rows.size:
            break
        s = out[rows]
        out[rows] = (s >> np.uint32(8)) ^ TABLE[(s & np.uint32(255)) ^ raw[starts[rows] + j]]
    out = ~out
    view = memoryview(np.ascontiguousarray(raw))
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = zlib.crc32(view[starts[i] : starts[i] + sizes[i]], int(state[i]))
    return out


class _Level:
    """Nodes of one depth, numbered as they come and found by their sorted keys."""

    def __init__(self):
        self.keys, self.ids = np.empty(0, U64), np.empty(0, np.int64)
        self.state, self.count, self.gain = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of distinct sorted keys, and which of them are new."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        out = np.empty(len(keys), np.int64)
        out[known] = self.ids[at[known]]
        fresh = np.flatnonzero(~known)
        out[fresh] = len(self.keys) + np.arange(len(fresh))
        self.keys = np.insert(self.keys, at[fresh], keys[fresh])
        self.ids = np.insert(self.ids, at[fresh], out[fresh])
        return out, fresh

    def grow(self, state: np.ndarray, gains: np.ndarray | None, buckets: int) -> None:
        self.state = np.concatenate([self.state, state])
        self.count = np.concatenate([self.count, np.zeros(len(state), np.int64)])
        if gains is not None:
            self.gain = np.concatenate([self.gain, gains[(state % np.uint32(buckets)).astype(np.int64)]])


class Trie:
    """Runs of 1 to `depth` words with their counts, CRC states and, if given, their buckets' gains."""

    def __init__(self, depth: int, buckets: int, gains: np.ndarray | None = None):
        self.depth, self.buckets, self.gains = depth, buckets, gains
        self.begin()

    def begin(self) -> None:
        self.levels = [_Level() for _ in range(self.depth)]
        # Bytes of all words, one after the other.
        self.bytes, self.start, self.size = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)

    def nodes(self) -> int:
        return sum(len(x.keys) for x in self.levels)

    def _learn(self, folded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        total = int(sizes.sum())
        begin = np.cumsum(sizes) - sizes
        at = np.arange(total) + np.repeat(starts - begin, sizes)
        self.start = np.concatenate([self.start, len(self.bytes) + begin])
        self.size = np.concatenate([self.size, sizes])
        self.bytes = np.concatenate([self.bytes, folded[at]])
        self.levels[0].grow(advanced(np.zeros(len(starts), np.uint32), folded, starts, sizes), self.gains, self.buckets)

    def walk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts the texts' runs; per text the number of words, of runs, and the sum of the runs' gains."""
        rows = len(offsets) - 1
        starts, ends, h = words(data, offsets, ALNUM)
        doc = doc_of(starts, offsets[:-1]) if rows else starts
        n_words = np.bincount(doc, minlength=rows).astype(np.int64)
        n, gained = n_words.copy(), np.zeros(rows, np.int64)
        if not len(h):
            return n_words, n, gained
        keys, first, which, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        ids, fresh = self.levels[0].place(keys)
        if fresh.size:
            self._learn(ALNUM.fold[data], starts[first[fresh]], (ends - starts)[first[fresh]])
        self.levels[0].count[ids] += times
        word = node = ids[which]
        self._gain(self.levels[0], node, doc, gained)
        for d in range(1, self.depth):
            inside = doc[:-1][: len(node) - 1] == doc[d : d + len(node) - 1] if len(node) > 1 else np.empty(0, bool)
            # A run that leaves its text has no child; runs are kept by their first word.
            kept = np.flatnonzero(inside & (node[: len(inside)] >= 0))
            if not kept.size:
                break
            pair = (node[kept].astype(U64) << U64(32)) | word[kept + d].astype(U64)
            keys, which, times = np.unique(pair, return_inverse=True, return_counts=True)
            ids, fresh = self.levels[d].place(keys)
            if fresh.size:
                parent, last = (keys[fresh] >> U64(32)).astype(np.int64), (keys[fresh] & U64(0xFFFFFFFF)).astype(np.int64)
                space = np.full(1, 32, np.uint8)
                state = advanced(self.levels[d - 1].state[parent], space, np.zeros(len(fresh), np.int64), np.ones(len(fresh), np.int64))
                self.levels[d].grow(advanced(state, self.bytes, self.start[last], self.size[last]), self.gains, self.buckets)
            self.levels[d].count[ids] += times
            self._gain(self.levels[d], ids[which], doc[kept], gained)
            n += np.bincount(doc[kept], minlength=rows)
            node = np.full(len(node) - 1, -1, np.int64)
            node[kept] = ids[which]
        return n_words, n, gained

    def _gain(self, level: _Level, node: np.ndarray, doc: np.ndarray, gained: np.ndarray) -> None:
        """Adds up gains along the paths; doc is sorted."""
        if self.gains is not None and len(node):
            begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            gained[doc[begin]] += np.add.reduceat(level.gain[node], begin)

    def fold(self, totals: np.ndarray) -> None:
        """Adds the nodes' counts to their buckets' totals."""
        for level in self.levels:
            np.add.at(totals, (level.state % np.uint32(self.buckets)).astype(np.int64), level.count)


def _walked(trie: Trie, column: pa.Array):
    """Walks the texts of a column, about a megabyte at a time; a full trie is handed out before it is begun anew."""
    data, offsets = texts_of(column)
    for first, last in chunks(offsets):
        found = trie.walk(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        yield found, trie.nodes() >= NODES
        if trie.nodes() >= NODES:
            trie.begin()


def _total_rows(depth: int, buckets: int):
    def run(batches):
        trie, totals = Trie(depth, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, full in _walked(trie, batch.column(0)):
                if full:
                    trie.fold(totals)
        trie.fold(totals)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some], pa.int64())], names=["bucket", "n"])

    return run


def bucket_totals(texts: DataFrame, depth: int = 2, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many runs of 1 to depth words of all texts (one string column) fall into each bucket; empty buckets are left out."""
    rows = texts.mapInArrow(released(_total_rows(depth, buckets)), "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gain_table(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, from totals of at most `buckets` rows each."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for out, df in ((s, raw), (t, target)):
        for r in df.collect():  # at most `buckets` rows
            out[r.bucket] = r.n
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((int(y) + 1) * (all_s + buckets) / ((int(x) + 1) * (all_t + buckets)))) for x, y in zip(s, t, strict=True)], np.int64)


def _scored_rows(depth: int, buckets: int, side):
    def run(batches):
        trie = Trie(depth, buckets, side.value)
        for batch in batches:
            parts = [[np.empty(0, np.int64)] * 3]
            parts += [found for found, _ in _walked(trie, batch.column(1))]
            n_words, n, gained = (np.concatenate(x) for x in zip(*parts, strict=True))
            weight = gained // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (n_words, n, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def resampled(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, depth: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank; docs and target have `text`, docs `doc_id`.

    Of the documents with at least least_words words, share percent (rounded
    down) are drawn by score, ties to the smaller doc_id; rank numbers them from
    1 and is null for the rest.  Null, empty and wordless texts have no features
    and weight 0.  Rows without doc_id are documents too: they share one draw,
    that of an empty id, and come last among ties.  Repeated rows are documents
    of their own and tie; they are ranked next to each other.  Without target
    texts all its counts are 0.  Other columns are not read.  An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gains = gain_table(bucket_totals(rows.select("text"), depth, buckets), bucket_totals(target.select(F.col("text").cast("string")), depth, buckets), buckets)
    side = spark.sparkContext.broadcast(gains)
    scored = rows.mapInArrow(released(_scored_rows(depth, buckets, side)), "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    drawn = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = stored(scored.withColumn("score", F.col("weight") + drawn).withColumn("row", F.monotonically_increasing_id()), "scored")
    enough = scored.where(F.col("n_words") >= least_words)
    draw = share * enough.count() // 100
    # The row's number parts rows that are equal in all else, so no range is one task's whatever repeats.
    line = numbered(enough, F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row"))
    ranked = line.withColumn("rank", F.when(F.col("i") < draw, F.col("i") + 1)).drop("i")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT row, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS f FROM b),
bucket AS (
  SELECT f, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(0, CAST(len(hex(f)) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex(f), 2 * i + 1, 2) AS BIGINT))), lambda c, y: xor(c >> 8, t[1 + (xor(c, y) & 255)])), 4294967295) % 10000 AS BIGINT) AS k
  FROM (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)), crc),
s AS (SELECT k, count(*) AS n FROM df JOIN bucket USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN bucket USING (f) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM df) + 10000) AS DOUBLE) / CAST((coalesce(s.n, 0) + 1) * ((SELECT count(*) FROM bf) + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM (SELECT DISTINCT k FROM bucket) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
mean AS (SELECT row, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM df JOIN bucket USING (f) JOIN gain USING (k) GROUP BY row),
each AS (
  SELECT row, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(CAST((g - ((g % n) + n) % n) / n AS BIGINT), 0) AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN mean USING (row)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM each),
ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (25 * (SELECT count(*) FROM ranked)) // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (row)
"""
