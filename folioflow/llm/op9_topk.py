"""Exact top-k search by inner product over a bit-sliced index.

Rows are quantised to integers and packed into blocks.  A block's index holds,
per dimension, one bitmap per bit of the offset attribute.  For a query the
slices are added with bitmap arithmetic (carry-save adders; a negative factor
uses the complemented slices), which gives the slices of the score of every row
in the block.  The best rows are then selected from the most significant slice
downward; rows tied at the boundary are resolved exactly, by vec_id.

Queries are a stated set.  Up to QUERY_VALUES of their components are broadcast
and rows are searched where they lie; more queries meet the rows in a grid: each
cell is one block of rows against one block of queries.  Each block keeps k rows
per query, and those meet in a second selection, which Spark cuts to k per query
and task before its shuffle.  Components from LARGE on would need a slice per bit
in every block; rows and queries that hold one are scored with exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, stored
from .kernels import released

#: Components of queries in a block (32 MB); rows in one index block; queries whose bitmaps are added together.
QUERY_VALUES, ROW_BLOCK, TOGETHER = 1 << 22, 1 << 16, 64
SCALE = 256
#: Components below LARGE in vectors of up to WIDEST of them have 64-bit products.
LARGE, WIDEST = 1 << 24, 1 << 14


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): floor(scale * x) of every component, as doubles that hold the integer exactly.

    Vectors null or with null or non-finite components are left out, and those
    with a component that scale takes out of the doubles.
    """
    x = F.transform("embedding", lambda v: v.cast("double") * F.lit(float(scale)))
    ok = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # From 2**53 on a double is an integer.
    whole = F.transform("x", lambda v: F.when(F.abs(v) < float(1 << 53), F.floor(F.when(F.abs(v) < float(1 << 53), v).otherwise(0.0)).cast("double")).otherwise(v))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(ok).select("vec_id", whole.alias("q"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of components, short ones filled with zeros (they add nothing to a product)."""
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), size.max(initial=0)))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _wider(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


class SlicedIndex:
    """Bit slices of one block of rows, in vec_id order."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.n = len(ids)
        self.low = self.rows.min(0)
        shifted = (self.rows - self.low).astype(np.uint64)
        self.bits = [int(x).bit_length() for x in shifted.max(0)]
        words = -(-self.n // 64)
        self.slices = []
        pad = np.zeros((words * 64,), np.uint8)
        self.live = self._pack(np.ones(self.n, np.uint8), pad)
        for d, bits in enumerate(self.bits):
            own = [self._pack(((shifted[:, d] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), pad) for b in range(bits)]
            self.slices.append(own)

    def _pack(self, bits: np.ndarray, pad: np.ndarray) -> np.ndarray:
        pad[: self.n] = bits
        return np.packbits(pad, bitorder="little").view(np.uint64)

    def score_slices(self, queries: np.ndarray) -> list[np.ndarray]:
        """Bitmaps (query, word) of each bit of the score less the query's constant, lowest first."""
        columns: list[list[np.ndarray]] = []

        def put(level: int, bitmap: np.ndarray) -> None:
            while len(columns) <= level:
                columns.append([])
            columns[level].append(bitmap)
            # Three bitmaps of a weight become one of it and one of the next.
            if len(columns[level]) == 3:
                a, b, c = columns[level]
                half = a ^ b
                columns[level] = [half ^ c]
                put(level + 1, (a & b) | (half & c))

        factor, negative = np.abs(queries), queries < 0
        for d, bits in enumerate(self.bits):
            if not bits:
                continue
            top = int(factor[:, d].max()).bit_length()
            flip = np.where(negative[:, d], ~np.uint64(0), np.uint64(0))[:, None]
            every = [(s[None, :] ^ flip) & self.live for s in self.slices[d]]
            for f in range(top):
                on = np.where((factor[:, d] >> f) & 1, ~np.uint64(0), np.uint64(0))[:, None]
                for b, s in enumerate(every):
                    put(f + b, s & on)
        # Two bitmaps of a weight are left at most: one carry pass.
        out, carry = [], None
        level = 0
        while level < len(columns) or carry is not None:
            own = list(columns[level]) if level < len(columns) else []
            if carry is not None:
                own.append(carry)
            if len(own) == 3:
                half = own[0] ^ own[1]
                out.append(half ^ own[2])
                carry = (own[0] & own[1]) | (half & own[2])
            elif len(own) == 2:
                out.append(own[0] ^ own[1])
                carry = own[0] & own[1]
            else:
                out.append(own[0] if own else np.zeros((len(queries), len(self.live)), np.uint64))
                carry = None
            level += 1
        return out

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query, vec_id, score) of the k best rows per query, its own row left out, ties to the smaller vec_id."""
        slices = self.score_slices(queries)
        live = np.broadcast_to(self.live, (len(queries), len(self.live))).copy()
        for i, q in enumerate(query_ids):
            for r in range(int(np.searchsorted(self.ids, q, "left")), int(np.searchsorted(self.ids, q, "right"))):
                live[i, r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        sure, maybe = np.zeros_like(live), live
        for s in reversed(slices):
            high = sure | (maybe & s)
            n = np.bitwise_count(high).sum(1)
            more, less, exact = (n > k)[:, None], (n < k)[:, None], (n == k)[:, None]
            # Too many: the boundary lies among rows with this bit. Too few: they are in, the rest stays open.
            sure = np.where(less | exact, high, sure)
            maybe = np.where(more, maybe & s, np.where(less, maybe & ~s, np.uint64(0)))
        out = []
        for i, q in enumerate(query_ids):
            take = self._rows(sure[i])
            # Rows are in vec_id order, so the first open ones are the smallest ids of the tie.
            take = np.concatenate([take, self._rows(maybe[i])[: max(0, k - len(take))]])
            score = self.rows[take] @ queries[i]
            for j in np.lexsort((self.ids[take], -score))[:k]:
                out.append((int(q), int(self.ids[take[j]]), int(score[j])))
        return out

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.n])


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _exact(query_ids, queries, ids, rows, k: int) -> list:
    """The k best rows per query with integers of any size; scores stop at the ends of a long."""
    whole = lambda m: np.array([[int(x) for x in r] for r in m] or np.empty((0, 0)), object).reshape(len(m), -1)
    out, right = [], whole(rows)
    for q, v in zip(query_ids.tolist(), whole(queries), strict=True):
        score = (right @ v).tolist() if len(v) and len(ids) else [0] * len(ids)
        held = [max(-(1 << 63), min(s, (1 << 63) - 1)) for s in score]
        out += [(q, i, -s) for s, i in sorted((-s, i) for s, i in zip(held, ids.tolist(), strict=True) if i != q)[:k]]
    return out


def _best(query_ids, queries, ids, rows, k: int) -> pa.RecordBatch:
    """The k best of a block of rows for each of a block of queries."""
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = _wider(queries, width), _wider(rows, width)
    plain = lambda m: (np.abs(m).max(1, initial=0) < LARGE) & (width <= WIDEST)
    pq, pr, out = plain(queries), plain(rows), []
    if pq.any() and pr.any():
        index, few, q = SlicedIndex(ids[pr], rows[pr].astype(np.int64)), query_ids[pq], queries[pq].astype(np.int64)
        for i in range(0, len(few), TOGETHER):
            out += index.top(few[i : i + TOGETHER], q[i : i + TOGETHER], k)
    if not pr.all():
        out += _exact(query_ids[pq], queries[pq], ids[~pr], rows[~pr], k)
    if not pq.all():
        out += _exact(query_ids[~pq], queries[~pq], ids, rows, k)
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], schema=_FOUND)


def _stack(parts):
    width = max(m.shape[1] for _, m in parts)
    return np.concatenate([i for i, _ in parts]), np.concatenate([_wider(m, width) for _, m in parts])


def _blocks(batches):
    """(ids, rows) of about ROW_BLOCK rows each."""
    held = []
    for batch in batches:
        held.append((batch.column(0).to_numpy(), _matrix(batch.column(1))))
        if sum(len(i) for i, _ in held) >= ROW_BLOCK:
            yield _stack(held)
            held = []
    if held:
        yield _stack(held)


def _search(side, k: int):
    def run(batches):
        for ids, rows in _blocks(batches):
            yield _best(*side.value, ids, rows, k)

    return run


def _packed(batches):
    """A block of rows as one row: its ids and its components."""
    for ids, rows in _blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([rows.astype("<f8").tobytes()], pa.binary())], names=["ids", "values"])


def _cells(k: int):
    def run(batches):
        unpack = lambda i, v: (n := np.frombuffer(i.as_py(), "<i8"), np.frombuffer(v.as_py(), "<f8").reshape(len(n), -1))
        for batch in batches:
            for row in range(batch.num_rows):
                (ids, rows), (query_ids, queries) = (unpack(batch.column(c)[row], batch.column(c + 1)[row]) for c in (0, 2))
                yield _best(query_ids, queries, ids, rows, k)

    return run


def _grid(rows: DataFrame, stated: DataFrame, blocks: int, k: int) -> DataFrame:
    """Every block of rows against every block of queries; a side is copied once per block of the other, nothing is collected."""
    tasks = max(1, -(-partitions(rows.sparkSession) // blocks))
    queries = stated.dropDuplicates(["vec_id"]).repartition(blocks, "vec_id").mapInArrow(released(_packed), "ids binary, values binary")
    queries = stored(queries.select(F.monotonically_increasing_id().alias("block"), F.col("ids").alias("query_ids"), F.col("values").alias("query_values")), "queries")
    names = F.array(*[F.lit(r.block) for r in queries.select("block").collect()])  # one number per block of queries
    line = rows.mapInArrow(released(_packed), "ids binary, values binary").withColumn("line", F.pmod(F.xxhash64("ids"), F.lit(tasks)))
    cells = line.withColumn("block", F.explode(names)).join(queries.withColumn("line", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long")))), ["block", "line"])
    return cells.select("ids", "values", "query_ids", "query_values").mapInArrow(released(_cells(k)), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = SCALE) -> DataFrame:
    """Each query's k best rows: query_id, rank (from 1), vec_id, score; all, if there are fewer.

    Queries are the rows whose vec_id is divisible by `every`; a query's own
    row, or rows repeated under its vec_id, are no candidates for it, and of
    different queries under one vec_id any one is taken.  Vectors of other
    lengths count as filled with zeros.  Repeated rows under another vec_id are
    rows of their own; rows repeated under one vec_id count once per copy and
    tie.  Null vec_ids, null vectors and vectors with null or non-finite
    components take no part; finite ones of any size do, and a score that leaves
    the longs stops at their end, where it ties with others.  Extra columns are not read.  An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    stated = rows.where(F.col("vec_id") % every == 0)
    size = stated.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("width")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = -(-size.n * max(1, size.width) // QUERY_VALUES)
    if blocks == 1:
        block = stated.dropDuplicates(["vec_id"]).toArrow().combine_chunks()  # at most QUERY_VALUES components
        side = spark.sparkContext.broadcast((block["vec_id"].to_numpy(), _matrix(block["q"].combine_chunks())))
        found = rows.mapInArrow(released(_search(side, k)), "query_id long, vec_id long, score long")
    else:
        found = _grid(rows, stated, blocks, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
e AS (SELECT vec_id, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM q),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score FROM e a JOIN e b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
