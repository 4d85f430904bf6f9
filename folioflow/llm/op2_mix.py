"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target words
over source words.  Documents of a source are lined up by size, their expected
copies are prefix-summed, one offset is added, and a document is emitted once
for each integer boundary its interval crosses.  Lining up by size makes each
stretch of sizes give its share, so the words taken stay within about one
document of the target.

The prefix sum is a rank, found without one task per source: counts by (source,
size), by (source, size, bucket), and inside a bucket.  Rows that repeat are
counted before they are shuffled.  A source, a size or a document of any share of
the rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from .common import documents, fresh_names, partitions, stored

#: No source is given more than this many times its own words.
MOST_COPIES = 3
#: Leading bits of the order within a size that make its buckets (16,384).
BUCKET_BITS = 14
#: Rows that one row of repeated documents becomes at a time.
RUN = 10_000
WORDS = r"[^\x20\x09-\x0D]+"


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with its place i in the order of `source` (code points, null last): by range, so no task holds all."""
    spark, order = sources.sparkSession, F.col("source").asc_nulls_last()
    line = sources.repartitionByRange(partitions(spark), order).sortWithinPartitions(order)
    # An id's low 33 bits number the rows of a partition.
    at = F.monotonically_increasing_id()
    line = stored(line.withColumn("part", F.shiftright(at, 33)).withColumn("own", at.bitwiseAND(F.lit((1 << 33) - 1))), "sources")
    before, n = [], 0
    for r in line.groupBy("part").agg(F.max("own").alias("m")).orderBy("part").collect():  # one row per partition
        before.append((r.part, n))
        n += r.m + 1
    base = spark.createDataFrame(before, "part long, base long")
    return line.join(F.broadcast(base), "part").withColumn("i", F.col("base") + F.col("own")).drop("part", "own", "base")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES, budget: float = 1.0) -> DataFrame:
    """(source, source_size, target) from (source, n): one row per source.

    Sources by code point, null last, weigh `weights` in turn.  Sources that
    would pass `most` times their size stop there; the excess goes to the rest
    by weight, round by round until none passes.  A round is one distributed sum.
    """
    s = _numbered(sizes.groupBy("source").agg(F.sum("n").cast("long").alias("source_size")))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("i"), F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most))).drop("i")
    total = float(s.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, full = 0.0, -1
    while True:
        over = F.col("cap") < F.lit(level) * F.col("w")
        r = s.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("w")))).first()
        if r[0] == full:
            break
        full = r[0]
        level = (total - (r[1] or 0.0)) / r[2] if r[2] else float("inf")
    return s.select("source", "source_size", F.least(F.lit(level) * F.col("w"), F.col("cap")).alias("target"))


def _join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """An inner join in which null keys are equal; right's keys go."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = one if on is None else on & one
    return left.join(right, on).drop(*[f"_{k}" for k in keys])


def _row_key(docs: DataFrame) -> list[Column]:
    """128 bits that tell different rows of a table apart, whatever its columns."""

    def holds_map(t):
        return isinstance(t, (MapType, VariantType)) or (isinstance(t, ArrayType) and holds_map(t.elementType)) or (isinstance(t, StructType) and any(holds_map(f.dataType) for f in t))

    quoted = [(f, F.col("`" + f.name.replace("`", "``") + "`")) for f in docs.schema]
    values = [F.to_json(F.struct(c)) if holds_map(f.dataType) else c for f, c in quoted]
    # A hash passes over nulls, so which they are is a value of its own.
    none = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for _, c in quoted])
    return [F.xxhash64(F.lit(seed), none, *values) for seed in (1, 2)]


def _classes(docs: DataFrame, seed: str, key: bool, **kw) -> tuple[DataFrame, bool]:
    """One row per distinct document: source, size, doc_id, rows, rank of the first, rate, offset, source_size, target; with k1, k2 if key.  And whether any repeats."""
    text, doc = F.col("text").cast("string"), F.col("doc_id").cast("long")
    k1, k2 = _row_key(docs) if key else (F.lit(0).cast("long"), F.lit(0).cast("long"))
    rows = docs.select(
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(doc.cast("string"), F.md5(text.cast("binary")), F.lit("")).cast("binary")).alias("h"),
        doc.alias("doc_id"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        k1.alias("k1"),
        k2.alias("k2"),
    )
    rows = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("rows")), "sizes")
    # The bucket follows the order, so the rank does not depend on it.
    bucket = F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), 32 - BUCKET_BITS)
    rows = rows.withColumn("bucket", bucket)
    counts = rows.groupBy("source", "size", "bucket").agg(F.sum("rows").alias("n"))
    grouped = stored(counts.groupBy("source", "size").agg(F.sum("n").alias("n")), "groups")
    targets = source_targets(grouped.select("source", (F.col("n") * F.col("size")).alias("n")), **kw)
    # Rank 1: documents of smaller sizes in the source, one row per size. Rank 2: of the same size in earlier buckets.
    back = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_size = grouped.select("source", "size", back(Window.partitionBy("source").orderBy("size")).alias("below"))
    by_size = _join(by_size, targets, "source")
    beside = counts.select("source", "size", "bucket", back(Window.partitionBy("source", "size").orderBy("bucket")).alias("beside"))
    base = _join(beside, by_size, "source", "size")
    base = base.select("source", "size", "bucket", (F.col("below") + F.col("beside")).alias("base"), "source_size", "target")
    # Rank 3: inside a bucket.
    line = Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id", "crc", "k1", "k2").rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("own", F.coalesce(F.sum("rows").over(line), F.lit(0)))
    r = _join(r, base, "source", "size", "bucket").withColumn("rank", F.col("base") + F.col("own"))
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    # A multiple of 2**-20, so that sums with whole ranks are exact.
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit(""))).cast("binary")), 1, 5), 16, 10).cast("long") / F.lit(float(1 << 20))
    repeated = not rows.where("rows > 1").isEmpty()
    return r.withColumn("rate", rate).withColumn("offset", offset).drop("own", "base", "bucket"), repeated


def _crossed(rank, n) -> Column:
    """Integer boundaries in the interval of n documents from a rank on, never more than each can give."""
    at = lambda k: F.floor(F.col("rate") * k + F.col("offset"))
    return F.least(at(rank + n) - at(rank), n * F.ceil("rate")).cast("long")


def copies(docs: DataFrame, seed: str = "mix", **kw) -> DataFrame:
    """docs' doc_id, source, size, source_size, target and copies, one row per document.

    size is the number of words of the whole text (null, empty: 0).  A source
    without words gets no target and its documents no copies.  Ties in size are
    ordered by the MD5 of doc_id (of the text, where doc_id is null), then
    doc_id, then a checksum of the text, so reruns agree.  Null sources are one
    source, the last.  Rows that repeat are documents of their own, next to each
    other.  An empty table gives no rows.  Other columns are not read.
    """
    c, _ = _classes(docs, seed, False, **kw)
    c = c.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / RUN))))
    last = F.least(F.lit(RUN - 1).cast("long"), F.col("rows") - 1 - F.col("block") * RUN)
    c = c.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("rank", F.col("rank") + F.col("block") * RUN + F.col("j"))
    return c.withColumn("copies", _crossed(F.col("rank"), F.lit(1))).select("doc_id", "source", "size", "crc", "source_size", "target", "copies")


def mixed(docs: DataFrame, seed: str = "mix", **kw) -> DataFrame:
    """The mix itself: each document's row, as often as it is taken, with all of docs' columns and no others.

    Rows that are equal in every column are one row with the copies of all of
    them; rows that differ anywhere are told apart, also under one doc_id or
    none.  Columns may have any names and types.  An empty table stays empty.
    """
    names = docs.columns
    k1, k2, row, n, m1, m2 = fresh_names(names, "k1", "k2", "row", "n", "m1", "m2")
    c, repeated = _classes(docs, seed, True, **kw)
    c = c.select(F.col("k1").alias(m1), F.col("k2").alias(m2), _crossed(F.col("rank"), F.col("rows")).alias(n)).where(F.col(n) > 0)
    a, b = _row_key(docs)
    whole = F.struct(*[F.col("`" + x.replace("`", "``") + "`") for x in names])
    d = docs.select(a.alias(k1), b.alias(k2), whole.alias(row))
    if repeated:
        # Equal rows are combined before the shuffle, so none is hot.
        d = d.dropDuplicates([k1, k2])
    d = d.join(c, (F.col(k1) == F.col(m1)) & (F.col(k2) == F.col(m2))).select(row, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    return d.select(F.col(f"{row}.*"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = copies(documents(spark, sf_dir))
    return c.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
caps AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / w AS at FROM s),
levels(i, level, full_) AS (
  SELECT 0, 0.0::DOUBLE, -1::BIGINT
  UNION ALL
  SELECT i + 1, ((SELECT sum(source_size) FROM s) - coalesce((SELECT sum(cap) FROM caps WHERE cap < level * w), 0)) / (SELECT sum(w) FROM caps WHERE NOT cap < level * w),
    (SELECT count(*) FROM caps WHERE cap < level * w)
  FROM levels WHERE full_ <> (SELECT count(*) FROM caps WHERE cap < level * w)),
targets AS (SELECT source, source_size, least((SELECT arg_max(level, i) FROM levels) * w, cap) AS target FROM caps),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, h, doc_id) - 1 AS rank FROM d),
r AS (SELECT doc_id, size, source_size, target, rank, coalesce(target / nullif(source_size, 0), 0.0::DOUBLE) AS rate,
    CAST('0x' || substr(md5('mix|' || coalesce(ranked.source, '')), 1, 5) AS BIGINT) / 1048576.0::DOUBLE AS "offset"
  FROM ranked JOIN targets ON ranked.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * least(floor(rate * (rank + 1) + "offset") - floor(rate * rank + "offset"), ceil(rate)) AS BIGINT) AS taken
FROM r
"""
