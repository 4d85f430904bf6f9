"""SimHash near-dedup by exact tiled comparison.

A document's fingerprint has a bit for each bit that over half its shingles'
hashes have.  Distinct fingerprints are ordered by their population counts (of
the whole, then of halves, quarters and bytes, so neighbours agree in most of
them), cut into blocks, and blocks into tiles.  Two fingerprints that differ in r
bits have counts that differ by r at most, summed over the parts of any cut; so

1. pairs of blocks come from an equi-join on the counts of both halves, each
   block with the counts it holds and the other with those within the radius;
2. in a pair of blocks, a tile skips tiles, and single fingerprints of others,
   whose counts of halves, quarters or bytes differ beyond the radius;
3. the rest is compared by NumPy's exclusive-or and bit counts, every pair.

A pair of blocks returns a spanning forest of its links, so a group of m near
copies gives about m rows, not m squared, and components lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, documents, join_hot, partitions, stored
from .kernels import SPACED, U64, chunks, doc_of, released, texts_of, words

#: Fingerprints of one block; a pair of them is one unit of work.
BLOCK = 1 << 14
#: Fingerprints of a tile, and pairs that one NumPy pass compares.
TILE, PAIRS = 128, 1 << 20
#: Bytes up to which a shingle is hashed together with others.
LONG = 256

# The primes of XXH64.
P1 = U64(0x9E3779B185EBCA87)
P2 = U64(0xC2B2AE3D27D4EB4F)
P3 = U64(0x165667B19E3779F9)
P4 = U64(0x85EBCA77C2B2AE63)
P5 = U64(0x27D4EB2F165667C5)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * P2, 31) * P1


def xxh64(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of every span of bytes raw[starts:ends]."""
    size = ends - starts
    buf = np.zeros(len(raw) + 8, np.uint8)
    buf[: len(raw)] = raw
    # A 64-bit value at every byte.
    at64 = np.ndarray(len(raw) + 1, "<u8", buf, 0, (1,))
    s = U64(seed)
    with np.errstate(over="ignore"):
        out = np.full(len(starts), s + P5, U64)
        at = starts.astype(np.int64)
        wide = np.flatnonzero((size >= 32) & (size <= LONG))
        if wide.size:
            acc = [np.full(wide.size, v, U64) for v in (s + P1 + P2, s + P2, s, s - P1)]
            for stripe in range(LONG // 32):
                on = np.flatnonzero(size[wide] >= 32 * (stripe + 1))
                if not on.size:
                    break
                base = starts[wide[on]] + 32 * stripe
                for k in range(4):
                    acc[k][on] = _round(acc[k][on], at64[base + 8 * k])
            h = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
            for v in acc:
                h = (h ^ _round(np.zeros(1, U64), v)) * P1 + P4
            out[wide] = h
            at[wide] += size[wide] & ~31
        out += size.astype(U64)
        left = np.where(size <= LONG, ends - at, 0)
        rows = np.flatnonzero(left >= 8)
        while rows.size:
            out[rows] = _turn(out[rows] ^ _round(np.zeros(1, U64), at64[at[rows]]), 27) * P1 + P4
            at[rows] += 8
            left[rows] -= 8
            rows = rows[left[rows] >= 8]
        rows = np.flatnonzero(left >= 4)
        out[rows] = _turn(out[rows] ^ ((at64[at[rows]] & U64(0xFFFFFFFF)) * P1), 23) * P2 + P3
        at[rows] += 4
        left[rows] -= 4
        rows = np.flatnonzero(left >= 1)
        while rows.size:
            out[rows] = _turn(out[rows] ^ (buf[at[rows]].astype(U64) * P5), 11) * P1
            at[rows] += 1
            left[rows] -= 1
            rows = rows[left[rows] >= 1]
        out = (out ^ (out >> U64(33))) * P2
        out = (out ^ (out >> U64(29))) * P3
        out ^= out >> U64(32)
    view = memoryview(buf)
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(view[starts[i] : ends[i]], seed)
    return out


def _shingles(data: np.ndarray, offsets: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle; a row with fewer words than k has the whole sequence, one without words none."""
    starts, ends, _ = words(data, offsets, SPACED)
    if not len(starts):
        return np.empty(0, U64), np.empty(0, np.int64)
    # The words with one space after each: bytes of words, and the one that follows a word.
    mark = SPACED.is_word[data]
    keep = mark.copy()
    keep[1:] |= mark[:-1]
    joined = SPACED.fold[np.where(mark, data, 32)[keep]]
    place = np.cumsum(keep) - 1
    starts, ends = place[starts], place[ends - 1] + 1
    doc = doc_of(starts, place_of(offsets, keep))
    same = doc[: max(0, len(doc) - k + 1)] == doc[k - 1 :] if len(doc) >= k else np.empty(0, bool)
    first = np.flatnonzero(same)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    begin = np.concatenate([[0], np.cumsum(count)])
    few = np.flatnonzero((count > 0) & (count < k))
    h = xxh64(joined, np.concatenate([starts[first], starts[begin[few]]]), np.concatenate([ends[first + k - 1], ends[begin[few + 1] - 1]]), seed)
    owner = np.concatenate([doc[first], few])
    order = np.argsort(owner, kind="stable")
    return h[order], owner[order]


def place_of(offsets: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Where rows begin once only the kept bytes are left."""
    return np.concatenate([[0], np.cumsum(keep)])[offsets]


def fingerprints(data: np.ndarray, offsets: np.ndarray, k: int = 3, seed: int = 42) -> np.ndarray:
    """Per row a bit for every bit that over half of its shingles' hashes have; no words, no bits."""
    rows = len(offsets) - 1
    out = np.zeros(rows, U64)
    h, owner = _shingles(data, offsets, k, seed)
    if not len(h):
        return out
    n = np.bincount(owner, minlength=rows)
    some = np.flatnonzero(n)
    begin = np.concatenate([[0], np.cumsum(n[some])[:-1]])
    for bit in range(64):
        ones = np.add.reduceat(((h >> U64(bit)) & U64(1)).astype(np.int64), begin)
        out[some] |= (2 * ones > n[some]).astype(U64) << U64(bit)
    return out


def _print_rows(k: int, seed: int):
    def run(batches):
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            found = [np.empty(0, U64)]
            for first, last in chunks(offsets):
                found.append(fingerprints(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], k, seed))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.concatenate(found).view(np.int64))], names=["doc_id", "fp"])

    return run


def document_prints(docs: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row with a doc_id; fp's 64 bits as a long."""
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(_print_rows(k, seed)), "doc_id long, fp long")


#: Population counts by which fingerprints are ordered; the counts of what they leave out follow from them.
PARTS = [(0, 64), (0, 32), (0, 16), (32, 48), (0, 8), (16, 24), (32, 40), (48, 56)]


def counts_of(fp: np.ndarray) -> np.ndarray:
    """Population counts of both halves, the four quarters and the eight bytes: a row of 14 for each fingerprint."""
    by = np.bitwise_count(fp[:, None] >> (U64(8) * np.arange(8, dtype=U64)) & U64(0xFF)).astype(np.int8)
    quarters = by.reshape(-1, 4, 2).sum(2, dtype=np.int8)
    return np.concatenate([quarters.reshape(-1, 2, 2).sum(2, dtype=np.int8), quarters, by], 1)


#: Which of those counts add up to one cut.
CUTS = (slice(0, 2), slice(2, 6), slice(6, 14))

_TILED = "block long, cells array<int>, prints binary"
_TILED_ARROW = pa.schema([("block", pa.int64()), ("cells", pa.list_(pa.int32())), ("prints", pa.binary())])


def _cut(batches):
    """Blocks of fingerprints that come in order, with the counts of halves they hold, as 64 * low + high."""
    part, made, held, n = TaskContext.get().partitionId(), 0, [], 0

    def emit(fp, number):
        c = counts_of(fp).astype(np.int32)
        return pa.RecordBatch.from_pylist([{"block": (part << 32) | number, "cells": np.unique(c[:, 0] * 64 + c[:, 1]).tolist(), "prints": fp.tobytes()}], schema=_TILED_ARROW)

    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
        n += len(held[-1])
        while n >= BLOCK:
            whole = np.concatenate(held)
            yield emit(whole[:BLOCK], made)
            held, n, made = [whole[BLOCK:]], n - BLOCK, made + 1
    if n:
        yield emit(np.concatenate(held), made)


def _far(lo_a, hi_a, lo_b, hi_b, radius: int) -> np.ndarray:
    """Whether counts within [lo, hi] of a and of b must differ beyond the radius, in any cut."""
    gap = np.maximum(np.maximum(lo_b - hi_a, lo_a - hi_b), 0)
    out = np.zeros(gap.shape[:-1], bool)
    for cut in CUTS:
        out |= gap[..., cut].sum(-1) > radius
    return out


class Forest:
    """Minimum labels of numbered nodes under links that come in batches."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while a.size:
            x, y = label[a], label[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label[:] = label[label]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        node = np.flatnonzero(self.label != np.arange(len(self.label)))
        return node, self.label[node]


def close_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks' fingerprints, or of one block's with themselves."""
    other = left if right is None else right
    every = left if right is None else np.concatenate([left, right])
    forest, base = Forest(len(every)), len(every) - len(other)
    ca, cb = counts_of(left), counts_of(other)
    begin = np.arange(0, len(other), TILE)
    lo_b, hi_b = np.minimum.reduceat(cb, begin), np.maximum.reduceat(cb, begin)
    for i in range(0, len(left), TILE):
        mine = ca[i : i + TILE]
        lo, hi = mine.min(0), mine.max(0)
        tiles = np.flatnonzero(~_far(lo, hi, lo_b, hi_b, radius))
        if right is None:
            tiles = tiles[tiles >= i // TILE]
        if not tiles.size:
            continue
        among = (tiles[:, None] * TILE + np.arange(TILE)).ravel()
        among = among[among < len(other)]
        among = among[~_far(lo, hi, cb[among], cb[among], radius)]
        step = max(1, PAIRS // len(mine))
        for j in range(0, len(among), step):
            some = among[j : j + step]
            x, y = np.nonzero(np.bitwise_count(left[i : i + TILE, None] ^ other[some]) <= radius)
            forest.add(i + x, base + some[y])
    node, top = forest.links()
    return every[node], every[top]


def _compare(radius: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                left = np.frombuffer(row["a"], U64)
                u, v = close_links(left, None if row["b"] is None else np.frombuffer(row["b"], U64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return run


def print_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(u, v): links that tie together every two of distinct fingerprints `fp` which differ in at most radius bits."""
    spark = prints.sparkSession
    bit = lambda lo, hi: F.bit_count(F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit(-1 if hi - lo == 64 else (1 << (hi - lo)) - 1)))
    order = [bit(lo, hi) for lo, hi in PARTS] + [F.col("fp")]
    line = prints.select("fp").repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    blocks = stored(line.mapInArrow(released(_cut), _TILED), "blocks")
    # Blocks meet where the counts of halves differ by the radius at most; the smaller number comes first.
    near = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    cells = blocks.select("block", F.explode("cells").alias("cell"))
    around = cells.select(F.col("block").alias("x"), F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in near])).alias("d"), F.shiftright("cell", 6).alias("p"), F.col("cell").bitwiseAND(F.lit(63)).alias("q"))
    around = around.select("x", (F.col("p") + F.col("d.x")).alias("p"), (F.col("q") + F.col("d.y")).alias("q")).distinct()
    met = cells.select(F.col("block").alias("y"), F.shiftright("cell", 6).alias("p"), F.col("cell").bitwiseAND(F.lit(63)).alias("q"))
    pairs = around.join(met, ["p", "q"]).where("x < y").select("x", "y").distinct()
    data = blocks.select("block", "prints")
    two = pairs.join(data.select(F.col("block").alias("x"), F.col("prints").alias("a")), "x").join(data.select(F.col("block").alias("y"), F.col("prints").alias("b")), "y")
    work = two.select("x", "y", "a", "b").union(data.select(F.col("block").alias("x"), F.col("block").alias("y"), F.col("prints").alias("a"), F.lit(None).cast("binary").alias("b")))
    work = work.repartition(partitions(spark), "x", "y").select("a", "b")
    return work.mapInArrow(released(_compare(radius)), "u long, v long")


def simhash_classes(docs: DataFrame, k: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (16 hex digits), component_id, n_same.

    component_id is the smallest doc_id reachable by links between fingerprints
    that differ in at most `radius` bits; n_same is the number of rows with the
    same fingerprint.  A null, empty or all-space text has fingerprint zero, which
    links like any other.  Rows without doc_id are left out.  Repeated rows come
    back once each.  Other columns are not read.  An empty table gives no rows.
    """
    base = stored(document_prints(docs, k, seed), "prints")
    classes = stored(base.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_same")), "classes")
    links = stored(print_links(classes, radius), "links")
    parts = components(links).withColumnRenamed("node", "fp")
    named = classes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stored(join_hot(named, first, "component").select("fp", "component_id", "n_same"), "named")
    discard(classes, links)
    out = join_hot(base, named, "fp")
    return out.select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id", "n_same")


def _oracle() -> str:
    """XXH64 in SQL: 64-bit arithmetic on 128-bit numbers, lanes from the hexadecimal form of a shingle's bytes."""
    p1, p2, p3, p4, p5 = (f"{int(p)}::UBIGINT" for p in (P1, P2, P3, P4, P5))
    whole = "18446744073709551616::UHUGEINT"
    mul = lambda a, b: f"CAST((({a})::UHUGEINT * ({b})::UHUGEINT) % {whole} AS UBIGINT)"
    add = lambda a, b: f"CAST((({a})::UHUGEINT + ({b})::UHUGEINT) % {whole} AS UBIGINT)"
    turn = lambda x, r: f"({mul(x, f'{1 << r}')} | (({x}) >> {64 - r}))"
    step = lambda acc, lane: mul(turn(add(acc, mul(lane, p2)), 31), p1)
    lane = lambda at, size: "(" + " | ".join(f"(CAST('0x' || substr(x, 2 * ({at}) + {2 * k + 1}, 2) AS UBIGINT) << {8 * k})" for k in range(size)) + ")"
    each = lambda values, start, body: f"list_reduce(list_prepend({start}, {values}), lambda g, y: {body})"
    seed = 42
    first = [(seed + int(P1) + int(P2)) % 2**64, (seed + int(P2)) % 2**64, seed, (seed - int(P1)) % 2**64]
    accs = ",\n    ".join(f"{each(f'[{lane(f'32 * j + {8 * k}', 8)} FOR j IN range(n // 32)]', f'{v}::UBIGINT', step('g', 'y'))} AS a{k}" for k, v in enumerate(first))
    merged = "CAST((" + " + ".join(f"{turn(f'a{k}', r)}::UHUGEINT" for k, r in enumerate((1, 7, 12, 18))) + f") % {whole} AS UBIGINT)"
    for k in range(4):
        merged = add(mul(f"xor({merged}, {step('0', f'a{k}')})", p1), p4)
    return rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT row, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s FROM w),
b AS (SELECT s, hex(encode(s)) AS x, CAST(octet_length(encode(s)) AS BIGINT) AS n FROM (SELECT DISTINCT s FROM s)),
wide AS (SELECT s, x, n, {accs} FROM b WHERE n >= 32),
head AS (SELECT s, x, n, n // 32 * 32 AS pos, {merged} AS h FROM wide UNION ALL SELECT s, x, n, 0, {(seed + int(P5)) % 2**64}::UBIGINT FROM b WHERE n < 32),
eight AS (SELECT s, x, n, pos + (n - pos) // 8 * 8 AS pos, {each(f"[{lane('pos + 8 * k', 8)} FOR k IN range((n - pos) // 8)]", add('h', 'n'), add(mul(turn(f"xor(g, {step('0', 'y')})", 27), p1), p4))} AS h FROM head),
four AS (SELECT s, x, n, CASE WHEN n - pos >= 4 THEN pos + 4 ELSE pos END AS pos, CASE WHEN n - pos >= 4 THEN {add(mul(turn(f"xor(h, {mul(lane('pos', 4), p1)})", 23), p2), p3)} ELSE h END AS h FROM eight),
one AS (SELECT s, {each(f"[{lane('pos + k', 1)} FOR k IN range(n - pos)]", 'h', mul(turn(f"xor(g, {mul('y', p5)})", 11), p1))} AS h FROM four),
f1 AS (SELECT s, {mul('xor(h, h >> 33)', p2)} AS h FROM one), f2 AS (SELECT s, {mul('xor(h, h >> 29)', p3)} AS h FROM f1), hash AS (SELECT s, xor(h, h >> 32) AS h FROM f2),
bits AS (SELECT row, bit, 2 * sum(CAST(h >> bit & 1 AS INTEGER)) > count(*) AS up FROM s JOIN hash USING (s), (SELECT unnest(range(64))::UBIGINT AS bit) GROUP BY row, bit),
prints AS (SELECT row, doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM w LEFT JOIN (SELECT row, bit_or(1::UBIGINT << bit) FILTER (up) AS fp FROM bits GROUP BY row) USING (row)),
reps AS (SELECT fp, min(doc_id) AS id, count(*) AS n_same FROM prints GROUP BY fp),
links AS (SELECT a.id AS u, b.id AS v FROM reps a JOIN reps b ON a.fp <> b.fp AND bit_count(CAST(xor(a.fp, b.fp) AS HUGEINT)) <= 3),
reach(id, seen) AS (SELECT id, id FROM reps UNION SELECT v, seen FROM reach JOIN links ON reach.id = u WHERE seen < v),
top AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id, n_same FROM prints JOIN reps USING (fp) JOIN top USING (id)
"""


ORACLE = _oracle()
