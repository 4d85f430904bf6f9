"""URL filters by a sort-merge range join.

A host is keyed by its labels from the right, each closed by a dot
(blog.example.com: com.example.blog.), which makes "this host and all its
subdomains" the interval of keys that start with the rule's key.  Intervals nest
or are apart.  Each batch of URLs is sorted by key and swept against the sorted
rules with a stack of the rules active at the present key; of those, the longest
whose path the URL's path starts with decides.  Paths of one host nest the same
way and are walked from the longest.

Up to RULE_BLOCK rules are broadcast (a checked bound), and pages meet them where
they lie.  A larger rule table is sorted together with the pages over all tasks by
range, and each task sweeps its stretch once; the rules that are open where a
stretch begins are carried into it.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, stored
from .kernels import released

#: Rules that are broadcast.
RULE_BLOCK = 500_000

#: The rule set of the query: (verdict, host, path).
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


def host_key(host: str) -> str:
    return "".join(f"{x}." for x in reversed(host.split("."))) if host else ""


class Rules:
    """Rules sorted by host key, each with the host around it; per host its paths, sorted, each with the longest other path it starts with."""

    def __init__(self, rules):
        hosts: dict = {}
        for verdict, host, path in rules:
            # Of equal host and path, block wins.
            own = hosts.setdefault(host_key(host), {})
            if own.get(path, (None,))[0] != "block":
                own[path] = (verdict, host + path)
        self.keys = sorted(hosts)
        self.around = self._nested(self.keys)
        self.paths = [sorted(hosts[k]) for k in self.keys]
        self.up = [self._nested(p) for p in self.paths]
        self.says = [[hosts[k][p] for p in paths] for k, paths in zip(self.keys, self.paths, strict=True)]

    @staticmethod
    def _nested(names: list[str]) -> list[int]:
        """For each of sorted names the place of the longest other one it starts with, or -1."""
        out: list[int] = []
        stack: list[int] = []
        for i, name in enumerate(names):
            while stack and not name.startswith(names[stack[-1]]):
                stack.pop()
            out.append(stack[-1] if stack else -1)
            stack.append(i)
        return out

    def match(self, node: int, path: str):
        """The longest path rule of one host that fits."""
        paths = self.paths[node]
        i = bisect_right(paths, path) - 1
        while i >= 0 and not path.startswith(paths[i]):
            i = self.up[node][i]
        return self.says[node][i] if i >= 0 else None

    def sweep(self, keys: list[str], paths: list[str]) -> list:
        """The deciding (verdict, rule) of every URL, or None.  Stretches of rules without a URL are jumped over."""
        out: list = [None] * len(keys)
        stack: list[int] = []
        at = 0
        for i in sorted(range(len(keys)), key=keys.__getitem__):
            key = keys[i]
            after = bisect_right(self.keys, key, at)
            if after > at:
                # The rules around the last one passed are those that are still open there.
                stack, node, at = [], after - 1, after
                while node >= 0:
                    stack.append(node)
                    node = self.around[node]
                stack.reverse()
            while stack and not key.startswith(self.keys[stack[-1]]):
                stack.pop()
            for node in reversed(stack):
                if (found := self.match(node, paths[i])) is not None:
                    out[i] = found
                    break
        return out


def _judge(side):
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("rule_verdict", pa.string())])

    def run(batches):
        rules = side.value
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            said = rules.sweep([host_key(h) for h in hosts], paths)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), batch.column(2).cast(pa.string()), pa.array([s and s[1] for s in said], pa.string()), pa.array([s and s[0] for s in said], pa.string())], schema=schema)

    return run


_SAID = "page_id long, host string, path string, rule string, rule_verdict string"


class _Host:
    """A host on the stack of a sweep, with its path rules."""

    def __init__(self, key: str):
        self.key, self.says, self.paths, self.up = key, {}, None, None

    def add(self, path: str, verdict: str, rule: str) -> None:
        if self.says.get(path, (None,))[0] != "block":
            self.says[path] = (verdict, rule)
        self.paths = None

    def match(self, path: str):
        if self.paths is None:
            self.paths = sorted(self.says)
            self.up = Rules._nested(self.paths)
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.up[i]
        return self.says[self.paths[i]] if i >= 0 else None


def _sweep(batches):
    """Rows of one stretch: the rules carried into it, then rules and pages by key; only the open hosts are held."""
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("rule_verdict", pa.string())])
    stretch, stack = None, []
    for batch in batches:
        out = []
        for part, kind, key, host, path, page, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != stretch:
                stretch, stack = part, []
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if kind < 2:
                if not stack or stack[-1].key != key:
                    stack.append(_Host(key))
                stack[-1].add(path, verdict, host + path)
            else:
                said = next((f for h in reversed(stack) if (f := h.match(path)) is not None), (None, None))
                out.append((page, host, path, said[1], said[0]))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t.type) for i, t in enumerate(schema)], schema=schema)


def _ranged(cut: DataFrame, rules: DataFrame) -> DataFrame:
    """cut (page_id, host, path) with the deciding rule, by one sorted sweep over pages and rules."""
    spark = cut.sparkSession
    key = F.when(F.col("host") == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit(".")))
    none = F.lit(None)
    r = rules.select(F.lit(1).alias("kind"), key.alias("key"), "host", "path", none.cast("long").alias("page_id"), "verdict")
    u = cut.select(F.lit(2).alias("kind"), key.alias("key"), "host", "path", "page_id", none.cast("string").alias("verdict"))
    # The hash splits pages of one URL; rules of a key come before its pages in any case.
    line = r.union(u).repartitionByRange(partitions(spark), "key", "path", F.xxhash64("page_id"))
    line = stored(line.withColumn("part", F.spark_partition_id()), "sweep")
    first = line.groupBy("part").agg(F.min("key").alias("key"))
    # Of a key's labels, all beginnings: at most 128 for each stretch.
    n = F.size(F.split("key", r"\.")) - 1
    open_ = first.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.array_join(F.slice(F.split("key", r"\."), F.lit(1), i), "."), F.lit(".")))).alias("key"))
    carried = r.join(open_, "key").withColumn("kind", F.lit(0)).select("kind", "key", "host", "path", "page_id", "verdict", "part")
    every = line.unionByName(carried).repartition(partitions(spark), "part").sortWithinPartitions("part", F.col("kind") > 0, "key", "kind")
    return every.select("part", "kind", "key", "host", "path", "page_id", "verdict").mapInArrow(released(_sweep), _SAID)


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (host + path, or null), verdict.

    A rule is (verdict, host, path).  Longest means most host labels, then
    longest path; of equal rules block wins.  Null URLs and URLs without ://
    have empty host and path, fit no rule and get the default.  Repeated pages
    come back once each, long URLs are read whole, an empty table gives no rows
    and an empty rule table gives every page the default; other columns are not
    read.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(coalesce(cast(url as string), ''), locate('://', coalesce(cast(url as string), '')) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    known = rules.select("verdict", F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path")).where("host IS NOT NULL")
    held = known.limit(RULE_BLOCK + 1).collect()
    if len(held) <= RULE_BLOCK:
        side = spark.sparkContext.broadcast(Rules([(r.verdict, r.host, r.path) for r in held]))
        out = cut.mapInArrow(released(_judge(side)), _SAID)
    else:
        out = _ranged(cut, known)
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


ORACLE = r"""
WITH rules(verdict, host, path) AS (VALUES ('block','com','/en/'), ('allow','example.com','/en/7'), ('allow','net','/de/'), ('block','example.net','/de/8'), ('block','org','/es/')),
cut AS (SELECT page_id, CASE WHEN strpos(coalesce(url,''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT u.page_id, u.host, u.path, arg_max(r.host || r.path, length(r.host) * 100000 + length(r.path)) AS rule, coalesce(arg_max(r.verdict, length(r.host) * 100000 + length(r.path)), 'allow') AS verdict
FROM u LEFT JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
GROUP BY u.page_id, u.host, u.path
"""
