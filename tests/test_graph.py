"""Joins by hot keys, components of hubs, chains and cliques, and stored tables."""

import random

import pytest
from folioflow import storage
from folioflow.operators import graph
from pyspark.sql import functions as F


def test_join_by_a_hot_key(spark, monkeypatch):
    left = spark.createDataFrame([(i, 7 if i % 3 else i % 2000) for i in range(6000)] + [(-1, None)], "a long, k long")
    right = spark.createDataFrame([(k, k * 2) for k in range(0, 2000, 2)] + [(7, 14)], "k long, b long")
    want = sorted(left.join(right, "k").select("k", "a", "b").collect())
    for rows in (1 << 20, 1000):
        monkeypatch.setattr(storage, "HOT_ROWS", rows)
        got = storage.join_hot(left, right, "k")
        assert sorted(got.select("k", "a", "b").collect()) == want
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()


def brute(edges):
    top = {x: x for e in edges for x in e}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        top[max(x, y)] = min(x, y)
    return {x: root(x) for x in top}


@pytest.mark.parametrize("hot", [1 << 20, 50])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(storage, "HOT_ROWS", hot)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1000, 1150)] + [(5000, 6000 + i) for i in range(400)] + [(a, b) for a in range(30) for b in range(a)]
    edges += [(rng.randrange(8000, 8300), rng.randrange(8000, 8300)) for _ in range(170)] + [(6001, 1003)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    want = brute([e for e in edges if e[0] != e[1]])
    assert got == want


def test_a_hub_of_100_000_edges(spark, monkeypatch):
    monkeypatch.setattr(storage, "HOT_ROWS", 10_000)
    star = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    got = graph.components(star.union(spark.range(200_000, 200_010).select("id", F.col("id") + 1)))
    assert sorted(map(tuple, got.groupBy("component").agg(F.count("*").alias("n")).collect())) == [(0, 100_001), (200_000, 11)]


def test_components_within_keys(spark):
    edges = [(p, i, i + 1) for p in range(3) for i in range(p * 4)]
    got = graph.components(spark.createDataFrame(edges, "page int, u long, v long"), keys=("page",))
    assert sorted(map(tuple, got.select("page", "node", "component").collect())) == [(p, i, 0) for p in (1, 2) for i in range(p * 4 + 1)]
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_stored_tables_go(spark):
    t = storage.stored(spark.range(3).toDF("a"), "x")
    assert t.count() == 3
    storage.discard_all(spark)
    where = spark._jvm.org.apache.hadoop.fs.Path(t._stored_at)
    assert not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
