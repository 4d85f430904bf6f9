"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word shingles.  The global shingle order is cut
into fragments (hash ranges); overlaps are counted in each fragment on its own
and summed.  Three counts use that cut:

1. per document: how many of its shingles any other document has.  Fewer than
   the threshold's share of its set means it links with nothing, which settles
   most of a corpus without one candidate pair;
2. per candidate pair: partial overlaps by fragment, summed to the intersection;
3. candidates: pairs that meet in the rarest shingles of both (prefix filter), with
   enough shingles left from there on.

Equal sets are one class.  Dense groups are first tied together by one star per
prefix shingle; only pairs whose components still differ are then compared, so
a group of m near copies costs about m pairs, and no link between components is
lost.  Nothing is capped or sampled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bitmap, components, discard, documents, partitions, stored
from .kernels import SPACED, U64, chunks, doc_of, grams, mix64, released, texts_of, words

#: Fragments of the shingle order in the pair counts.
FRAGMENTS = 4
#: Finer fragments whose counts bound a pair's overlap before it is counted.
PROFILE = 128
#: Text bytes whose shingles travel as one block; a task holds about ten times as much.
BLOCK_BYTES = 8 << 20
#: Bits of the broadcast bitmap that goes before the join of sets (2 MB); when it fills up, more sets reach the join.
SIEVE_BITS = 1 << 24


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the size of its set, and all sets one after the other, each sorted."""
    sizes, parts = [], []
    for first, last in chunks(offsets):
        at = offsets[first:last] - offsets[first]
        starts, _, h = words(data[offsets[first] : offsets[last]], at, SPACED)
        rows = last - first
        doc = doc_of(starts, at)
        count = np.bincount(doc, minlength=rows)
        g = grams(h, k)
        inside = doc[: len(g)] == doc[k - 1 :] if len(g) else np.empty(0, bool)
        g, owner = g[inside], doc[: len(g)][inside]
        if (few := np.flatnonzero((count > 0) & (count < k))).size:
            begin = np.concatenate([[0], np.cumsum(count)])
            own = np.array([grams(h[begin[i] : begin[i + 1]], int(count[i]))[0] for i in few], U64)
            own = mix64(own ^ mix64(count[few].astype(U64)))
            spot = np.searchsorted(owner, few)
            g, owner = np.insert(g, spot, own), np.insert(owner, spot, few)
        begin = np.searchsorted(owner, np.arange(rows + 1))
        for a, b in zip(begin[:-1], begin[1:], strict=True):
            g[a:b].sort()
        keep = np.ones(len(g), bool)
        if len(g):
            keep[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
        parts.append(g[keep])
        sizes.append(np.bincount(owner[keep], minlength=rows))
    if not sizes:
        return np.zeros(0, np.int64), np.empty(0, U64)
    return np.concatenate(sizes), np.concatenate(parts)


def _sums(op, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes), U64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    if (some := sizes > 0).any():
        out[some] = op.reduceat(values, begin[some])
    return out


def _prints(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that identify a set."""
    a = mix64(_sums(np.add, mix64(values), sizes))
    b = mix64(_sums(np.bitwise_xor, mix64(values ^ U64(0x5851F42D4C957F2D)), sizes))
    return a.view(np.int64), b.view(np.int64)


#: One row per block and range: documents (range -1) or postings.
_BLOCK = "part int, block long, ids binary, sizes binary, a binary, b binary, postings binary, counts binary"
_BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64())] + [(x, pa.binary()) for x in ("ids", "sizes", "a", "b", "postings", "counts")])


def _blocks(k: int, parts: int):
    """Cuts each block's sets by hash range; a posting travels as the low 32 bits below its range."""

    def emit(at, ids, sizes, values):
        a, b = _prints(values, sizes)
        # Named by where it was cut, so blocks with equal rows stay apart, and by what it holds, so two versions of one block do.
        block = int(mix64(np.array([at, ids[0], len(ids), a[0], a.sum(), ids[-1]], np.int64).view(U64)).sum() >> U64(1))
        owner = np.repeat(np.arange(len(ids), dtype=np.uint32), sizes)
        scaled = (values >> U64(32)) * U64(parts)
        part = (scaled >> U64(32)).astype(np.int32)
        low = ((scaled & U64(0xFFFFFFFF)) ^ (values & U64(0xFFFFFFFF))).astype(np.uint32)
        del scaled
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(parts + 1))
        del part
        rows = [(block % parts, block, ids.tobytes(), sizes.astype(np.int64).tobytes(), a.tobytes(), b.tobytes(), None, None)]
        for p in range(parts):
            if cut[p] < cut[p + 1]:
                pick = order[cut[p] : cut[p + 1]]
                who, how = np.unique(owner[pick], return_counts=True)
                rows.append((p, block, who.astype(np.uint32).tobytes(), None, None, None, low[pick].tobytes(), how.astype(np.uint32).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(_BLOCK_ARROW)], schema=_BLOCK_ARROW)

    def run(batches):
        held, size, at = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets):
                n, values = shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], k)
                held.append((ids[first:last], n, values))
                size += int(offsets[last] - offsets[first])
                if size >= BLOCK_BYTES:
                    yield emit(at, *(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size, at = [], 0, at + 1
        if held:
            yield emit(at, *(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


#: A hash range is counted in finer ranges, one after the other, so a task holds one of them; postings that are dealt at a time.
FINER, DEALT = 64, 1 << 22
_FINE = "fine int, " + _BLOCK
_FINE_ARROW = pa.schema([("fine", pa.int32()), *_BLOCK_ARROW])


#: Marks a posting whose document has been counted; it stands for its shingle among later ones.
COUNTED = U64(1 << 63)


def _repeats(low: np.ndarray) -> np.ndarray:
    """Which of sorted values occur more than once."""
    more = np.zeros(len(low), bool)
    same = low[1:] == low[:-1]
    more[1:] |= same
    more[:-1] |= same
    return more


def _counts(names: np.ndarray, who: np.ndarray) -> list[dict]:
    """Postings per document, a row for each block; who: place in names, document."""
    who, how = np.unique(who, return_counts=True)
    cut = np.searchsorted((who >> U64(32)).astype(np.int64), np.arange(len(names) + 1))
    rows = [(int(b), slice(x, y)) for b, x, y in zip(names, cut[:-1], cut[1:], strict=True) if x < y]
    return [{"part": 0, "block": b, "ids": (who[m] & U64(0xFFFFFFFF)).astype(np.uint32).tobytes(), "counts": how[m].astype(np.uint32).tobytes(), "postings": b""} for b, m in rows]


def _finer(dealt: int):
    """Deals the postings of a range to finer ranges: rows with the blocks met (ids), the postings and whose they are (counts).

    Documents pass as they are.  Postings that repeat among those dealt together
    are counted here, and one of them goes on for all: a shingle that very many
    documents have is one posting in `dealt`.
    """

    def run(batches):
        block, who, low, held = [], [], [], 0

        def deal():
            w, h = np.concatenate(who), np.concatenate(low)
            order = np.argsort(h, kind="stable")
            w, h = w[order], h[order]
            more = _repeats(h)
            found = _counts(np.array(block, np.int64), w[more])
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            w = np.where(more, w | COUNTED, w)[first]
            h = h[first]
            # Sorted postings lie by finer range already.
            cut = np.searchsorted((h >> np.uint32(32 - FINER.bit_length() + 1)).astype(np.int64), np.arange(FINER + 1))
            ids = np.array(block, np.int64).tobytes()
            rows = [{"fine": f, "part": 0, "block": 0, "ids": ids, "postings": h[x:y].tobytes(), "counts": w[x:y].tobytes()} for f, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if x < y]
            return pa.RecordBatch.from_pylist([{"fine": -1} | r for r in found] + rows, schema=_FINE_ARROW)

        for batch in batches:
            for r in batch.to_pylist():
                if r["postings"] is None:
                    yield pa.RecordBatch.from_pylist([r | {"fine": -1}], schema=_FINE_ARROW)
                    continue
                owner = np.repeat(np.frombuffer(r["ids"], np.uint32), np.frombuffer(r["counts"], np.uint32))
                who.append(owner.astype(U64) | U64(len(block) << 32))
                low.append(np.frombuffer(r["postings"], np.uint32))
                block.append(r["block"])
                held += len(owner)
                if held >= dealt:
                    yield deal()
                    block, who, low, held = [], [], [], 0
        if held:
            yield deal()

    return run


def _counted(block: list, who: list, low: list):
    """Of one finer range: which postings other documents have too, counted per document."""
    names, at = np.unique(np.concatenate(block), return_inverse=True)
    begin = np.cumsum([0, *map(len, block)])
    # Blocks are known by their place among all of this range.
    place = lambda k, w: at[begin[k] + ((w & ~COUNTED) >> U64(32)).astype(np.int64)].astype(U64)
    who = np.concatenate([(place(k, w) << U64(32)) | (w & U64(0xFFFFFFFF)) | (w & COUNTED) for k, w in enumerate(who)])
    low = np.concatenate(low)
    order = np.argsort(low, kind="stable")
    who = who[order[_repeats(low[order])]]
    return pa.RecordBatch.from_pylist(_counts(names, who[who < COUNTED]), schema=_BLOCK_ARROW)


def _shared(batches):
    """Rows come sorted by finer range; one of them is held at a time."""
    now, block, who, low = -1, [], [], []
    for batch in batches:
        for r in batch.to_pylist():
            fine = r.pop("fine")
            if fine < 0:
                yield pa.RecordBatch.from_pylist([r], schema=_BLOCK_ARROW)
                continue
            if fine != now and low:
                yield _counted(block, who, low)
                block, who, low = [], [], []
            now = fine
            block.append(np.frombuffer(r["ids"], np.int64))
            who.append(np.frombuffer(r["counts"], U64))
            low.append(np.frombuffer(r["postings"], np.uint32))
    if low:
        yield _counted(block, who, low)


_DOC = "doc_id long, n long, a long, b long, shared long"
_DOC_ARROW = pa.schema([(x, pa.int64()) for x in ("doc_id", "n", "a", "b", "shared")])


def _summed(batches):
    """Rows come sorted by block, its documents first: adds the ranges' counts up per document."""
    now, ids, n, a, b, shared = None, None, None, None, None, None

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, n, a, b, shared)], schema=_DOC_ARROW)

    for batch in batches:
        for r in batch.to_pylist():
            if r["postings"] is None:
                if now is not None:
                    yield flush()
                now = r["block"]
                ids, n, a, b = (np.frombuffer(r[x], np.int64) for x in ("ids", "sizes", "a", "b"))
                shared = np.zeros(len(ids), np.int64)
            else:
                if r["block"] != now:
                    raise ValueError("a block's counts came without its documents")
                shared[np.frombuffer(r["ids"], np.uint32)] += np.frombuffer(r["counts"], np.uint32)
    if now is not None:
        yield flush()


def document_sets(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, n, a, b, shared): set size, 128-bit identity, shingles that other documents have (an upper bound)."""
    p = partitions(docs.sparkSession)
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = rows.mapInArrow(released(_blocks(k, p)), _BLOCK).repartitionById(p, F.col("part"))
    # Sorted by Spark, which spills: a range may be larger than a task's memory.
    counted = cut.mapInArrow(released(_finer(DEALT)), _FINE).sortWithinPartitions("fine").mapInArrow(released(_shared), _BLOCK)
    return counted.repartition(p, "block").sortWithinPartitions("block", F.col("postings").isNotNull()).mapInArrow(released(_summed), _DOC)


def _set_rows(k: int, side):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        sieve = side.value
        for batch in batches:
            b = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(((sieve[b >> 6] >> (b & 63).astype(U64)) & U64(1)).astype(bool)))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = texts_of(batch.column(1))
            for first, last in chunks(offsets, 1 << 20):
                n, values = shingle_sets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], k)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:last], pa.int64()), pa.array(n, pa.int64()), *map(pa.array, _prints(values, n)), lists], schema=schema)

    return run


def _profiles(batches):
    """How many of a class's shared shingles lie in each of PROFILE fragments."""
    schema = pa.schema([("id", pa.int64()), ("profile", pa.list_(pa.int32()))])
    for batch in batches:
        lists = batch.column(1)
        values = lists.flatten().to_numpy(zero_copy_only=False).view(U64)
        size = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(size)), size)
        count = np.bincount(owner * PROFILE + (values >> U64(64 - PROFILE.bit_length() + 1)).astype(np.int64), minlength=len(size) * PROFILE)
        offsets = pa.array(np.arange(len(size) + 1) * PROFILE, pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(count, pa.int32()))], schema=schema)


def _linked(pairs: DataFrame, segments: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (x, y, nx, ny) whose fragments' overlaps sum to the threshold."""
    a = segments.select(F.col("id").alias("x"), "part", F.col("seg").alias("sx"))
    b = segments.select(F.col("id").alias("y"), "part", F.col("seg").alias("sy"))
    part = pairs.join(a, "x").join(b, ["y", "part"]).select("x", "y", "nx", "ny", F.size(F.array_intersect("sx", "sy")).cast("long").alias("k"))
    both = part.groupBy("x", "y", "nx", "ny").agg(F.sum("k").alias("k"))
    return both.where(den * F.col("k") >= num * (F.col("nx") + F.col("ny") - F.col("k"))).select(F.col("x").alias("u"), F.col("y").alias("v"))


def _close(nx, ny, sx, sy, num: int, den: int):
    """Sizes and shared counts under which the threshold can still be met."""
    need = num * (nx + ny)
    return (num * F.greatest(nx, ny) <= den * F.least(nx, ny)) & ((num + den) * F.least(sx, sy) >= need)


def jaccard_classes(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id.

    Documents link when den * |x & y| >= num * |x | y|; component_id is the
    smallest doc_id reachable.  A null, empty or all-space text has no set and
    links with nothing.  Rows without doc_id are left out.  Repeated rows come
    back once each; rows of one doc_id with different texts are linked by their
    own texts.  Columns other than doc_id and text are not read.  An empty table
    gives an empty result.
    """
    base = stored(document_sets(docs, k), "sets")
    linkable = (F.col("n") > 0) & (den * F.col("shared") >= num * F.col("n"))
    # A class is known by a number of its own, its smallest doc_id stands for its text.
    classes = base.where(linkable).groupBy("n", "a", "b").agg(F.min("doc_id").alias("doc_id"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    # A bitmap of fixed size lets through the representatives and few others, so texts are never shuffled; the join then is exact.
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE_BITS))
    side = docs.sparkSession.sparkContext.broadcast(bitmap(classes.select(bit.alias("b")), SIEVE_BITS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("b", bit)
    sets = texts.where("doc_id IS NOT NULL").mapInArrow(released(_set_rows(k, side)), "doc_id long, n long, a long, b long, shingles array<long>")
    sets = sets.join(classes, ["doc_id", "n", "a", "b"]).dropDuplicates(["id"]).select("id", "n", "shingles")
    sets = stored(sets, "shingles")

    # The global order: by number of classes that have the shingle, then hash.  One class's own shingles only take up places.
    # Counts are combined before the shuffle; a shingle that very many classes have is a skewed join, which is dealt anew at run time.
    each = sets.select("id", "n", F.explode("shingles").alias("h"))
    df = each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    known = each.join(df, "h").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("order"))
    known = known.withColumn("s", F.size("order").cast("long")).where(den * F.col("s") >= num * F.col("n"))
    known = stored(known.select("id", "n", "s", F.expr("order.h").alias("order")), "order")
    discard(sets)

    # n - ceil(threshold * n) + 1 shingles, of which n - s are the class's own.
    length = f"cast(greatest(0, s + 1 - ceil({num} * n / {den})) as int)"
    entries = known.select("id", "n", "s", F.posexplode(F.expr(f"slice(order, 1, {length})")).alias("pos", "h"))
    # Two classes that first meet in this shingle share none before it: what is left bounds their overlap.
    entries = stored(entries.select("id", "n", (F.col("s") - F.col("pos")).alias("left"), "h"), "prefix")
    part = F.shiftrightunsigned(F.col("h"), 64 - int(np.log2(FRAGMENTS)))
    segments = stored(known.select("id", F.explode("order").alias("h")).groupBy("id", part.alias("part")).agg(F.collect_list("h").alias("seg")), "segments")

    # Stars: in every prefix shingle's bucket, each member against the one with most shared shingles.
    centre = entries.groupBy("h").agg(F.max(F.struct((F.col("left") / F.col("n")).alias("c"), (-F.col("id")).alias("m"), "n", "left")).alias("top"), F.count("*").alias("members")).where("members > 1")
    star = entries.join(centre.select("h", (-F.col("top.m")).alias("x"), F.col("top.n").alias("nx"), F.col("top.left").alias("lx")), "h")
    star = star.where((F.col("x") != F.col("id")) & _close(F.col("nx"), F.col("n"), F.col("lx"), F.col("left"), num, den)).select("x", F.col("id").alias("y"), "nx", F.col("n").alias("ny")).distinct()
    star = stored(star, "star")
    links = stored(_linked(star, segments, num, den), "links")
    found = stored(components(links), "first")
    discard(star, links)

    # The rest, exactly: buckets that still hold several components, members of different ones only.
    placed = entries.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    # The largest partner that what is left admits; members that admit nobody of their bucket go before any pair is made.
    placed = stored(placed.withColumn("most", F.floor(F.col("left") * (num + den) / num) - F.col("n")), "placed")
    mixed = placed.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("small"), F.max("most").alias("reach")).where("lo < hi").select("h", "small", "reach")
    open_ = placed.join(mixed, "h").where((F.col("most") >= F.col("small")) & (F.col("n") <= F.col("reach"))).drop("small", "reach")
    # A pair's overlap is at most the sum of the smaller of both counts in each fragment, which settles most of them here.
    profiles = known.join(open_.select("id").distinct(), "id", "left_semi").select("id", "order").mapInArrow(released(_profiles), "id long, profile array<int>")
    profiles = stored(profiles, "profiles")
    open_ = stored(open_.join(profiles, "id"), "open")
    discard(entries, placed, profiles, known)
    l, r = (open_.select(*(F.col(c).alias(f"{c}_{side}") for c in ("h", "id", "n", "left", "component", "profile"))) for side in "lr")
    most = F.expr("aggregate(zip_with(profile_l, profile_r, (x, y) -> least(x, y)), 0, (t, x) -> t + x)")
    near = _close(F.col("n_l"), F.col("n_r"), F.col("left_l"), F.col("left_r"), num, den) & ((num + den) * most >= num * (F.col("n_l") + F.col("n_r")))
    cross = l.join(r, (F.col("h_l") == F.col("h_r")) & (F.col("component_l") < F.col("component_r")) & near)
    cross = cross.select(F.col("id_l").alias("x"), F.col("id_r").alias("y"), F.col("n_l").alias("nx"), F.col("n_r").alias("ny")).distinct()
    cross = stored(cross, "cross")
    more = _linked(cross, segments, num, den)
    parts = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
    discard(open_, cross, segments, found)

    # Back to every document; a class's component follows its representative, documents that link with nothing stay as they are.
    named = classes.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(first, "component").select("n", "a", "b", F.col("doc_id").alias("class_id"), "component_id")
    hit = base.where(linkable).join(named, ["n", "a", "b"]).select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id")
    lone = base.where(~linkable).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return hit.unionByName(lone)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "class_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
reps AS (SELECT min(doc_id) AS id, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
each AS (SELECT id, len(s) AS n, unnest(s) AS h FROM reps),
df AS (SELECT h, count(*) AS df FROM each GROUP BY h HAVING count(*) > 1),
placed AS (SELECT id, n, h, n - row_number() OVER (PARTITION BY id ORDER BY coalesce(df, 1), h) + 1 AS remaining FROM each LEFT JOIN df USING (h)),
prefix AS (SELECT id, n, h FROM placed WHERE 100 * remaining >= 75 * n),
pairs AS (SELECT DISTINCT a.id AS x, b.id AS y, a.n AS nx, b.n AS ny FROM prefix a JOIN prefix b ON a.h = b.h AND a.id < b.id AND 75 * greatest(a.n, b.n) <= 100 * least(a.n, b.n)),
links AS (
  SELECT x, y FROM (SELECT x, y, nx, ny, count(*) AS k FROM pairs JOIN each a ON a.id = x JOIN each b ON b.id = y AND b.h = a.h GROUP BY x, y, nx, ny) WHERE 100 * k >= 75 * (nx + ny - k)),
edges AS (SELECT x AS u, y AS v FROM links UNION ALL SELECT y, x FROM links),
reach(node, seen) AS (SELECT id, id FROM reps UNION SELECT edges.v, seen FROM reach JOIN edges ON node = u WHERE seen < edges.v),
component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(c.component_id, sets.doc_id) AS component_id, coalesce(reps.id, sets.doc_id) AS class_id
FROM sets LEFT JOIN reps ON len(sets.s) > 0 AND list_sort(sets.s) = reps.s LEFT JOIN component c ON c.node = reps.id
"""
