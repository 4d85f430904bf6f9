"""The SQL of the queries on rows that the driver's tables lack: nulls, repeated rows, ties, odd texts."""

import random

import duckdb
import pytest
from folioflow.llm import op1_jaccard, op2_mix, op4_decontaminate, op6_secrets, op10_shard, op11_simhash

SCHEMA = "doc_id long, text string, source string, shard int, size int"


def texts():
    rng = random.Random(21)
    some = [op6_secrets.ALPHABET, "0123456789abcdef", "ab1", "aBcD0", op6_secrets.ALPHABET[:62]]
    out = [None, "", " ", "\t\n", "A b\x0bC", "é É ß", "one", "One", "x" * 3000, "a b " * 400]
    for _ in range(150):
        parts = [rng.choice(["", "token=", "é ", "PassWord: '", "AKIA", "w "]) + "".join(rng.choice(rng.choice(some)) for _ in range(rng.choice([3, 5, 20, 21, 40]))) for _ in range(rng.randrange(1, 9))]
        out.append(rng.choice([" ", "\n", "é", ". "]).join(parts))
    words = [f"w{i}" for i in range(30)]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(150)]
    return out + out[10:60]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = [(i * 7, t, [None, "", "a", "b", "é"][i % 5], 1, 2) for i, t in enumerate(texts())]
    path = str(tmp_path_factory.mktemp("hard"))
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{path}/documents.parquet")
    items = [("i1", "w1 w2"), ("i2", "a b " * 8), ("i2", "a b " * 8), ("i3", None), ("i4", "--"), (None, "one"), ("i5", "ONE")] + [(f"k{i}", " ".join(r[1].split()[:12])) for i, r in enumerate(rows[170:190])]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet/*.parquet')")
    return path, con


@pytest.mark.parametrize("query, sql", [(op1_jaccard.op1_jaccard_join, op1_jaccard.ORACLE), (op2_mix.op2_mix, op2_mix.ORACLE), (op4_decontaminate.op4_decontaminate, op4_decontaminate.ORACLE), (op6_secrets.op6_secrets, op6_secrets.ORACLE), (op10_shard.op10_shard, op10_shard.ORACLE), (op11_simhash.op11_simhash, op11_simhash.ORACLE)], ids=["op1", "op2", "op4", "op6", "op10", "op11"])
def test_sql(spark, table, query, sql):
    path, con = table
    got = query(spark, path)
    order = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(order)} FROM ({sql})").fetchall()
    assert sorted(map(str, got.select(*order).toArrow().to_pylist())) == sorted(str(dict(zip(order, r, strict=True))) for r in want)


def test_shards_of_null_ids_and_repeated_rows(spark):
    rows = [(None, f"t{i}", "s", 9, 9) for i in range(40)] + [(5, "same", "s", 9, 9)] * 30 + [(5, None, "s", 9, 9), (6, None, None, None, None)]
    got = op10_shard.sharded(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for key in (None, 5):
        assert len({(r.shard, r.grown_shard) for r in got if r.doc_id == key}) == 1
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_of_one_hot_doc_id(spark):
    from pyspark.sql import functions as F

    hot = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 1000).alias("text"))
    got = op10_shard.sharded(hot.repartition(8))
    per = got.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect()
    assert sum(r.n for r in per) == 200_000 and all(r.n == r.d == r.hi + 1 and r.lo == 0 for r in per)
    assert got.where("doc_id = 7").select("shard").distinct().count() == 1


def test_shard_of_any_columns(spark):
    df = spark.createDataFrame([(i, 100, 200, 300, "x") for i in range(50)], "doc_id long, _region int, region int, Rack int, shard string")
    got = op10_shard.with_shard(df, "doc_id", op10_shard.Tree.of(40), "shard")
    assert got.columns == ["doc_id", "_region", "region", "Rack", "shard"]
    assert all((r[1], r[2], r[3]) == (100, 200, 300) and 0 <= r[4] < 40 for r in got.collect())
