"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard.  At each level every child draws
-ln(u) / weight, u the MD5 of the row's key and the child's name in (0, 1), and
the smallest draw wins: children win in proportion to their weights, and when
one child's weight grows rows move only into it.  Movement is thus confined to
the subtrees whose weights change.  A shard added later stands as a region of
its own, so it is the only subtree that changes and rows move into it alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, fresh_names, numbered, stored

#: The shape of the first shards; each later one is a region of its own.
REGION_SHARDS, RACK_SHARDS, FIRST_SHARDS = 10, 5, 40
EXTRA_BYTES = 16


@dataclass(frozen=True)
class Tree:
    """Regions of racks of (shard, weight)."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def of(cls, shards: int, weight=lambda i: 1.0) -> Tree:
        regions: dict = {}
        for i in range(shards):
            region = (0, i // REGION_SHARDS) if i < FIRST_SHARDS else (1, i)
            regions.setdefault(region, {}).setdefault((i % REGION_SHARDS) // RACK_SHARDS if i < FIRST_SHARDS else 0, []).append((i, float(weight(i))))
        return cls(tuple(tuple(tuple(rack) for rack in r.values()) for r in regions.values()))


def _pick(key: Column, level: str, node: Column, weights: list[list[float]]) -> Column:
    """The child of `node` with the smallest draw, from 1; weights has a row of children per node."""
    width = max(map(len, weights))
    flat = F.array(*[F.lit(float(w)) for row in weights for w in [*row, *[0.0] * (width - len(row))]])
    draws = []
    for j in range(width):
        w = F.element_at(flat, (node * width + j + 1).cast("int"))
        name = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("null")), F.lit(level), node.cast("string"), F.lit(str(j)))
        u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
        draws.append(F.struct(F.when(w > 0, -F.log(u) / w).otherwise(float("inf")).alias("d"), F.lit(j).alias("j")))
    return F.array_min(F.array(*draws))["j"]


def with_shard(df: DataFrame, key: str, tree: Tree, name: str) -> DataFrame:
    """Adds the shard of column `key`; other columns may have any names, one called `name` is replaced.

    A child's draw depends on its place, so it stays when others come after it.
    """
    cols = [c for c in df.columns if c.lower() != name.lower() or c == key]
    region, rack_, leaf = fresh_names([*df.columns, name], "region", "rack", "leaf")
    weight = lambda rack: sum(w for _, w in rack)
    racks = max(map(len, tree.regions))
    padded = [[*r, *[()] * (racks - len(r))] for r in tree.regions]
    df = df.withColumn(region, _pick(F.col(key), "region", F.lit(0), [[sum(map(weight, r)) for r in tree.regions]]))
    df = df.withColumn(rack_, F.col(region) * racks + _pick(F.col(key), "rack", F.col(region), [[weight(x) for x in r] for r in padded]))
    leaves = [[w for _, w in rack] for r in padded for rack in r]
    width = max(map(len, leaves))
    ids = F.array(*[F.lit(s) for r in padded for rack in r for s in [*(i for i, _ in rack), *[-1] * (width - len(rack))]])
    df = df.withColumn(leaf, F.col(rack_) * width + _pick(F.col(key), "shard", F.col(rack_), leaves))
    return df.select(*["`" + c.replace("`", "``") + "`" for c in cols], F.element_at(ids, (F.col(leaf) + 1).cast("int")).cast("int").alias(name))


def sharded(docs: DataFrame, shards: int = FIRST_SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, grown_shard.

    Only doc_id and the shard count decide; a null doc_id is a key like any
    other, and its rows share a shard.  size is the text's UTF-8 bytes (null:
    none) plus EXTRA_BYTES.  Slots run from 0 without gaps in the order of the
    MD5 of doc_id (of the text, where doc_id is null), then doc_id, checksum and
    size; identical rows get neighbouring slots, and which of them gets which
    shows in no column.  Rows of one doc_id may be any share of the table.  An empty table gives no rows.  Other columns are not read.
    """
    raw = F.col("text").cast("string").cast("binary")
    text = F.coalesce(raw, F.lit("").cast("binary"))
    key = F.col("doc_id").cast("long")
    h = F.md5(F.concat(F.lit("slot|"), F.coalesce(key.cast("string"), F.md5(raw), F.lit(""))).cast("binary"))
    r = docs.select(key.alias("doc_id"), (F.length(text) + EXTRA_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), h.alias("h"))
    r = with_shard(with_shard(r, "doc_id", Tree.of(shards), "shard"), "doc_id", Tree.of(shards + 1), "grown_shard")
    # Read several times below; without it every draw would be made as often.
    r = stored(r.withColumn("row", F.monotonically_increasing_id()), "drawn")
    # Numbered by range over all shards; the row's own number parts rows of one key, however many there are.
    line = numbered(r, *[F.col(c) for c in ("shard", "h", "doc_id", "text_crc32", "size", "row")])
    first = r.groupBy("shard").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    first = first.select(F.col("shard").alias("s"), F.coalesce(before, F.lit(0)).alias("base"))  # a row per shard
    return line.join(F.broadcast(first), line.shard == first.s).select("doc_id", "size", "text_crc32", "shard", (F.col("i") - F.col("base")).alias("slot"), "grown_shard")


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(documents(spark, sf_dir)).withColumn("law", F.lit("key"))


def _oracle(shards: int) -> str:
    """The draws of one tree in SQL, as CTEs that end in at{shards}(rid, shard)."""
    tree = Tree.of(shards)
    racks, width = max(map(len, tree.regions)), max(len(x) for r in tree.regions for x in r)
    nodes = {"region": [], "rack": [], "shard": []}
    for i, r in enumerate(tree.regions):
        nodes["region"].append((0, i, sum(w for x in r for _, w in x), -1))
        for j, x in enumerate(r):
            nodes["rack"].append((i, j, sum(w for _, w in x), -1))
            nodes["shard"] += [(i * racks + j, k, w, s) for k, (s, w) in enumerate(x)]
    out, at = [], "(SELECT rid, key, 0 AS node FROM d)"
    for level, rows in nodes.items():
        name = f"{level}{shards}"
        values = ", ".join(f"({n}, {j}, {w}::DOUBLE, {s})" for n, j, w, s in rows)
        draw = f"-ln((CAST('0x' || substr(md5(p.key || '|{level}|' || p.node || '|' || c.j), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / c.w"
        up = {"region": "j", "rack": f"node * {racks} + j", "shard": "s"}[level]
        out.append(f"{name} AS (SELECT rid, key, {up} AS node FROM (SELECT p.rid, p.key, p.node, arg_min(c.j, {draw}) AS j, arg_min(c.s, {draw}) AS s FROM {at} p JOIN (VALUES {values}) c(node, j, w, s) ON c.node = p.node GROUP BY p.rid, p.key, p.node))")
        at = name
    return ",\n".join(out)


ORACLE = rf"""
WITH tbl AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, octet_length(encode(coalesce(text, ''))) + {EXTRA_BYTES} AS size,
    md5('slot|' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')) AS h,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, tbl),
{_oracle(FIRST_SHARDS)},
{_oracle(FIRST_SHARDS + 1)}
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, CAST(a.node AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY a.node ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(b.node AS INTEGER) AS grown_shard, 'key' AS law
FROM d JOIN shard{FIRST_SHARDS} a USING (rid) JOIN shard{FIRST_SHARDS + 1} b USING (rid)
"""
