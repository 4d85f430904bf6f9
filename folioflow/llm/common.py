"""What the operators share, beside the library's tables between steps and graph components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components  # noqa: F401
from ..storage import discard, join_hot, partitions, scratch, shared_dir, stored  # noqa: F401


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_names(columns: list[str], *names: str) -> list[str]:
    """Names for helper columns that clash with no column of a table (Spark does not tell cases apart)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, *order) -> DataFrame:
    """df with its place i, from 0, in a total order: by range, so no task holds all; df should be stored."""
    spark = df.sparkSession
    line = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    # An id's low 33 bits number the rows of a partition.
    at = F.monotonically_increasing_id()
    line = stored(line.withColumn("_part", F.shiftright(at, 33)).withColumn("_own", at.bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    before, n = [], 0
    for r in line.groupBy("_part").agg(F.max("_own").alias("m")).orderBy("_part").collect():  # one row per partition
        before.append((r._part, n))
        n += r.m + 1
    base = spark.createDataFrame(before, "_part long, _base long")
    return line.join(F.broadcast(base), "_part").withColumn("i", F.col("_base") + F.col("_own")).drop("_part", "_own", "_base")


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size, as 64-bit words, with the bit of every value (one long column) modulo bits, a power of two."""
    bit = F.col(values.columns[0]).bitwiseAND(F.lit(bits - 1))
    marks = values.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("m")).toArrow()  # at most bits / 64 rows
    out = np.zeros(bits >> 6, np.int64)
    out[marks["w"].to_numpy()] = marks["m"].to_numpy()
    return out.view(np.uint64)


def running(values: str, op: str) -> str:
    """SQL: running op ({x}, {y}) of an array: each round reaches twice as far back, so n elements cost n log n steps."""
    back = "a[i - shiftleft(1, k)]"
    return f"aggregate(sequence(0, cast(ceil(log2(size({values}) + 1)) as int)), {values}, (a, k) -> transform(a, (x, i) -> case when i >= shiftleft(1, k) then {op.format(x='x', y=back)} else x end))"


def let(value: str, name: str, body: str) -> str:
    """SQL: body with `name` bound to value, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"
