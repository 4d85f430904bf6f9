"""Ranked lexical search: document-at-a-time merging of compressed postings, shard by shard.

Index: documents are cut into shards of a few megabytes of text.  A shard is one
row: its doc_ids in ascending order, their lengths, its terms, and per term the
postings, sorted by document, as differences and counts in seven-bit groups.  For
a stated set of queries only their terms are indexed, which a bitmap of fixed
size sees to; the shards are written once and read by every step that follows.

Search: a task keeps one bounded heap of results per query, keyed by score, then
doc_id.  In a shard a heap holds one cursor per posting list of the query, by the
document it stands at; the lists are merged in ascending order of documents, a
run at a time, so every document's score is whole when it is met.  Lists that
together cannot lift a document past the heap's worst result are only looked up
for documents that another list brings.  Results of all tasks are merged last.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bitmap, documents, numbered, stored
from .kernels import ALNUM, U64, chunks, doc_of, released, texts_of, words

#: Bytes of text of one shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20
#: Bits of the bitmap of the queries' terms (2 MB).
SIEVE_BITS = 1 << 24
#: Terms of queries that are searched in one pass over the index; one query is never cut.
QUERY_TERMS = 1 << 15
#: Postings of the foremost list whose documents make one run.
RUN = 256
#: Groups in which a query's results are merged before they meet.
MERGE = 32


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative values in groups of seven bits, lowest first, and how many bytes each takes."""
    v = values.astype(U64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        more = v >= U64(1 << (7 * k)) if 7 * k < 64 else np.zeros(len(v), bool)
        if not more.any():
            break
        size += more
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    rows = np.arange(len(v))
    for k in range(int(size.max(initial=0))):
        rows = rows[size[rows] > k]
        group = (v[rows] >> U64(7 * k)) & U64(127)
        out[begin[rows] + k] = group | ((size[rows] > k + 1).astype(U64) << U64(7))
    return out, size


def unpacked(raw: np.ndarray) -> np.ndarray:
    """The values that packed() wrote."""
    if not len(raw):
        return np.empty(0, np.int64)
    end = np.flatnonzero(raw < 128)
    begin = np.concatenate([[0], end[:-1] + 1])
    size, out = end - begin + 1, np.zeros(len(end), U64)
    rows = np.arange(len(end))
    for k in range(int(size.max())):
        rows = rows[size[rows] > k]
        out[rows] |= (raw[begin[rows] + k] & np.uint8(127)).astype(U64) << U64(7 * k)
    return out.view(np.int64)


_SHARD = "shard long, n_docs long, n_terms long, docs binary, sizes binary, terms binary, dfs binary, bytes binary, postings binary"
_SHARD_ARROW = pa.schema([(x, pa.int64()) for x in ("shard", "n_docs", "n_terms")] + [(x, pa.binary()) for x in ("docs", "sizes", "terms", "dfs", "bytes", "postings")])


class _Builder:
    """Gathers the documents of one shard."""

    def __init__(self):
        self.ids, self.sizes, self.doc, self.hash, self.names, self.n = [], [], [], [], {}, 0

    def add(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, sieve: np.ndarray | None) -> None:
        starts, ends, h = words(data, offsets, ALNUM)
        doc = doc_of(starts, offsets[:-1])
        self.ids.append(ids)
        self.sizes.append(np.bincount(doc, minlength=len(ids)))
        if sieve is not None:
            bit = (h & U64(SIEVE_BITS - 1)).astype(np.int64)
            keep = ((sieve[bit >> 6] >> (bit & 63).astype(U64)) & U64(1)).astype(bool)
            starts, ends, h, doc = starts[keep], ends[keep], h[keep], doc[keep]
        self.doc.append(doc + self.n)
        self.hash.append(h)
        self.n += len(ids)
        each, first = np.unique(h, return_index=True)
        folded = ALNUM.fold[data]
        for x, at in zip(each.tolist(), first.tolist(), strict=True):
            if x not in self.names:
                self.names[x] = folded[starts[at] : ends[at]].tobytes()

    def row(self, shard: int) -> dict:
        ids, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        # Documents without a term answer no query.
        order = np.argsort(ids, kind="stable")
        order = order[sizes[order] > 0]
        place = np.zeros(len(ids), np.int64)
        place[order] = np.arange(len(order))
        each, term = np.unique(np.concatenate(self.hash), return_inverse=True)
        key, tf = np.unique((term.astype(U64) << U64(32)) | place[np.concatenate(self.doc)].astype(U64), return_counts=True)
        term, doc = (key >> U64(32)).astype(np.int64), (key & U64(0xFFFFFFFF)).astype(np.int64)
        step = doc.copy()
        same = term[1:] == term[:-1]
        step[1:][same] -= doc[:-1][same]
        raw, size = packed(np.stack([step, tf], 1).ravel())
        df = np.bincount(term, minlength=len(each))
        taken = np.bincount(np.repeat(term, 2), weights=size, minlength=len(each)).astype(np.int64)
        return {
            "shard": shard, "n_docs": len(order), "n_terms": int(sizes.sum()), "docs": ids[order].astype("<i8").tobytes(), "sizes": packed(sizes[order])[0].tobytes(),
            "terms": b" ".join(self.names[x] for x in each.tolist()), "dfs": packed(df)[0].tobytes(), "bytes": packed(taken)[0].tobytes(), "postings": raw.tobytes(),
        }


def _shard_rows(side):
    def run(batches):
        sieve = None if side is None else side.value
        part, made, now, held = TaskContext.get().partitionId(), 0, _Builder(), 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets):
                now.add(ids[first:last], data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], sieve)
                held += int(offsets[last] - offsets[first])
                if held >= SHARD_BYTES:
                    yield pa.RecordBatch.from_pylist([now.row((part << 32) | made)], schema=_SHARD_ARROW)
                    made, now, held = made + 1, _Builder(), 0
        if now.n:
            yield pa.RecordBatch.from_pylist([now.row((part << 32) | made)], schema=_SHARD_ARROW)

    return run


def index_shards(docs: DataFrame, sieve: np.ndarray | None = None) -> DataFrame:
    """The index, one row per shard: all terms of all documents, or those in a bitmap of terms' hashes."""
    side = None if sieve is None else docs.sparkSession.sparkContext.broadcast(sieve)
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(_shard_rows(side)), _SHARD)


def _term_rows(batches):
    """(item_id, term, h): every item's distinct terms."""
    for batch in batches:
        ids, (data, offsets) = batch.column(0), texts_of(batch.column(1))
        starts, ends, h = words(data, offsets, ALNUM)
        doc = doc_of(starts, offsets[:-1])
        # Distinct by row and hash.
        order = np.lexsort((h, doc))
        new = np.ones(len(order), bool)
        new[1:] = (doc[order][1:] != doc[order][:-1]) | (h[order][1:] != h[order][:-1])
        pick, folded = order[new], ALNUM.fold[data]
        terms = [folded[a:b].tobytes() for a, b in zip(starts[pick].tolist(), ends[pick].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc[pick])), pa.array(terms, pa.binary()), pa.array(h[pick].view(np.int64))], names=["item_id", "term", "h"])


def _df_rows(batches):
    """(term, df) of every shard."""
    for batch in batches:
        for terms, dfs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = unpacked(np.frombuffer(dfs, np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(terms.split(b" ") if len(found) else [], pa.binary()), pa.array(found, pa.int64())], names=["term", "df"])


class Results:
    """At most k results, the best by score, then smaller doc_id."""

    __slots__ = ("heap", "k")

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def least(self) -> int:
        """A score below this finds no place."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = np.flatnonzero(scores >= self.least())
        if len(some) > self.k:
            some = some[np.lexsort((ids[some], -scores[some]))[: self.k]]
        for score, i in zip(scores[some].tolist(), ids[some].tolist(), strict=True):
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, (score, -i))
            elif (score, -i) > self.heap[0]:
                heapq.heapreplace(self.heap, (score, -i))


def merged(lists: list[tuple[np.ndarray, np.ndarray, int]], ids: np.ndarray, results: Results) -> None:
    """Offers the documents of a shard to one query's results.

    lists: per term its documents (ascending places in ids), what each gains by
    it, and the most it gains.
    """
    lists = sorted(lists, key=lambda x: x[2])
    below = np.cumsum([x[2] for x in lists]).tolist()
    # A document in none but the first `weak` lists cannot reach the results.
    weak = next((i for i, b in enumerate(below) if b >= results.least()), len(lists))
    heap = [(int(lists[i][0][0]), i, 0) for i in range(weak, len(lists))]
    heapq.heapify(heap)
    while heap:
        first, i, at = heap[0]
        last = int(lists[i][0][min(at + RUN, len(lists[i][0])) - 1])
        total = np.zeros(last - first + 1, np.int64)
        while heap and heap[0][0] <= last:
            _, i, at = heap[0]
            docs, gains, _ = lists[i]
            end = at + int(np.searchsorted(docs[at:], last, "right"))
            # A list names a document once.
            total[docs[at:end] - first] += gains[at:end]
            if end < len(docs):
                heapq.heapreplace(heap, (int(docs[end]), i, end))
            else:
                heapq.heappop(heap)
        found = np.flatnonzero(total)
        scores, found = total[found], found + first
        for i in range(weak - 1, -1, -1):
            some = scores + below[i] >= results.least()
            found, scores = found[some], scores[some]
            if not len(found):
                break
            docs, gains, _ = lists[i]
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            scores = scores + np.where(docs[at] == found, gains[at], 0)
        if len(found):
            results.offer(scores, ids[found])


def _search(side, all_docs: int, all_terms: int, k: int):
    """side: items [(item_id, [(number, weight)])], and the number of each term."""

    def run(batches):
        items, number = side.value
        results = [Results(k) for _ in items]
        weights = np.zeros(len(number), np.int64)
        for _, terms in items:
            for t, w in terms:
                weights[t] = w
        for batch in batches:
            for row in batch.to_pylist():
                _shard(row, number, weights, items, results)
        rows = [(item, -i, score) for (item, _), r in zip(items, results, strict=True) for score, i in r.heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["item_id", "doc_id", "score"])

    def _shard(row, number, weights, items, results):
        ids, n = np.frombuffer(row["docs"], "<i8"), unpacked(np.frombuffer(row["sizes"], np.uint8))
        dfs, size = unpacked(np.frombuffer(row["dfs"], np.uint8)), unpacked(np.frombuffer(row["bytes"], np.uint8))
        m = 100 - 50 + (50 * n * all_docs) // all_terms
        begin, raw = np.cumsum(size) - size, np.frombuffer(row["postings"], np.uint8)
        asked = [(number[t], i) for i, t in enumerate(row["terms"].split(b" ")) if t in number] if len(dfs) else []
        lists: dict = {}
        for t, i in asked:
            pairs = unpacked(raw[begin[i] : begin[i] + size[i]])
            docs, tf = np.cumsum(pairs[::2]), pairs[1::2]
            gains = weights[t] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[docs]))
            some = gains > 0
            if some.any():
                lists[t] = (docs[some], gains[some], int(gains.max()))
        for (_, terms), result in zip(items, results, strict=True):
            own = [lists[t] for t, _ in terms if t in lists]
            if own and sum(x[2] for x in own) >= result.least():
                merged(own, ids, result)

    return run


def _top(found: DataFrame, k: int, *by: str | Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item_id", *by).orderBy(F.col("score").desc(), "doc_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Each item's k best documents: item_id, rank (from 1), doc_id, score; items have item_id and text, docs doc_id and text.

    Scores are those of the contract, in whole numbers; a score of 0 is no
    result; item_id keeps its type.  Null, empty and termless texts answer nothing and count nowhere.
    Rows without doc_id or item_id are left out.  Rows of one item_id are one
    item with the terms of all.  Repeated rows of documents are documents of
    their own and tie.  Extra columns are not read.  An empty table on either
    side gives no rows.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    none = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    asked = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = stored(asked.mapInArrow(released(_term_rows), "item_id string, term binary, h long").distinct(), "terms")
    index = stored(index_shards(docs, bitmap(asked.select("h"), SIEVE_BITS)), "index")
    sums = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    if not sums.docs or asked.isEmpty():
        return none
    df = index.select("terms", "dfs").mapInArrow(released(_df_rows), "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * sums.docs + 2)) / (2 * F.col("df") + 1)))
    # Items in order, cut where a pass is full; terms that no document has are of no use.
    placed = numbered(asked.select("item_id", "term"), F.col("item_id"), F.col("term"))
    start = placed.groupBy("item_id").agg((F.min("i") / QUERY_TERMS).cast("long").alias("pass"))
    placed = stored(placed.join(df, "term").join(start, "item_id").select("pass", "item_id", "term", weight.alias("w")), "weights")
    found = None
    for r in placed.select("pass").distinct().orderBy("pass").collect():  # one row per QUERY_TERMS terms
        number, own = {}, {}
        for x in placed.where(F.col("pass") == r["pass"]).toArrow().to_pylist():  # QUERY_TERMS terms and one item's at most
            own.setdefault(x["item_id"], []).append((number.setdefault(bytes(x["term"]), len(number)), x["w"]))
        side = spark.sparkContext.broadcast((list(own.items()), number))
        one = index.mapInArrow(released(_search(side, sums.docs, sums.terms, k)), "item_id string, doc_id long, score long")
        one = stored(one.withColumn("part", F.spark_partition_id() % MERGE), "found")
        found = one if found is None else found.union(one)
    if found is None:
        return none
    return _top(_top(found, k, "part"), k).select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL),
q AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL)),
sums AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
df AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, sums GROUP BY term, docs),
m AS (SELECT row, doc_id, 100 - 50 + (50 * len(w) * docs) // terms AS m FROM d, sums WHERE len(w) > 0),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m USING (row) GROUP BY item_id, row, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""
