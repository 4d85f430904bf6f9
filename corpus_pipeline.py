"""The corpus pipeline: quality, near duplicates, benchmark passages, mix, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last return the
columns of docs, whatever they are called.  Null texts are empty texts; rows
without doc_id are documents of their own in every stage; rows that repeat are
one group of near duplicates; an empty table passes through every stage as an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import op1_jaccard, op2_mix, op4_decontaminate, op5_tokens, op7_quality
from folioflow.llm.common import documents, fresh_names, stored
from folioflow.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects; with no labels, or labels of one class, it rejects none or all."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op7_quality.kept(docs, op7_quality.fitted(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component, that with the smallest doc_id (of equal ones any; rows without doc_id come last).

    Texts without words link with nothing and stay.
    """
    ship(spark)
    columns = docs.columns
    ids = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("named")).first()
    if ids.n == ids.named and docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        found = op1_jaccard.jaccard_classes(docs).where("doc_id <> component_id").select("doc_id")
        return docs.join(found, "doc_id", "left_anti").select(*columns)
    # doc_id does not name a row here, so rows get a number.
    (row,) = fresh_names([*columns, "doc_id", "text", "component_id", "first"], "row")
    keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    names = keyed.select(F.col(row), F.col("doc_id").cast("long").alias("doc_id"))
    group = op1_jaccard.jaccard_classes(keyed.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    group = group.join(names, row)
    first = group.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(row).alias("row")))["row"].alias("first"))
    return keyed.join(first.select(F.col("first").alias(row)), row, "left_semi").select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark window; each is judged where it lies."""
    ship(spark)
    return op4_decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; sources without words give none."""
    ship(spark)
    return op2_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files, reads them back, and returns each document's place and checksum; no documents, no rows."""
    ship(spark)
    return op5_tokens.token_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("token output", tokens),
]

#: A fitted classifier and a tokenizer are not SQL; tests/llm/test_pipeline.py holds run() and each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
