"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, join_hot, stored


def components(edges: DataFrame, name: str = "cc", keys: tuple[str, ...] = ()) -> DataFrame:
    """Connected components of (u, v), within equal `keys` if given: one row (keys, node, component) per node, component its smallest node.

    Alternates the large-star and small-star steps, each round written to the
    shared folder, until nothing changes, which takes about log(n) rounds.  Each
    node's least neighbour is found with partial sums, and edges of hubs meet
    theirs where they lie, so no task gets a hub's edges.  With keys, a group
    should be of bounded size (a page).  Nothing is collected but counts and hubs.
    """
    at = [F.col(k) for k in keys]
    on = [*keys, "u"]

    def with_low(rows: DataFrame, low: DataFrame, n: int) -> DataFrame:
        return rows.join(low, on) if keys else join_hot(rows, low, "u", n)

    e = edges.select(*at, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e, before = stored(e, name), None
    n = e.count()
    while True:
        both = e.union(e.select(*at, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*on).agg(F.min("v").alias("m")).select(*on, F.least("u", "m").alias("m"))
        large = with_low(both, low, 2 * n).where("v > u").select(*at, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy(*on).agg(F.min("v").alias("m"))
        joined = with_low(large, low, n)
        small = joined.where("v <> m").select(*at, F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(*on, F.col("m").alias("v"))).distinct()
        last, e = e, stored(small, name)
        discard(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64(*on, "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n = now, now[0]
    tops = e.select(*at, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(*at, F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
