"""Tables between steps, in the folder that all executors share, and joins that spread hot keys."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a local one only where that is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    where = tempfile.mkdtemp(prefix="folioflow-")
    atexit.register(shutil.rmtree, where, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{where}")
    return f"file://{where}"


_KEPT: set[str] = set()


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _home(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/folioflow/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path of this application in the shared folder; what is left there goes when the program ends."""
    home = _home(spark)
    if home not in _KEPT:
        _KEPT.add(home)

        def leave():
            if spark.sparkContext._jsc is not None:
                _remove(spark, home)

        atexit.register(leave)
    return f"{home}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes stored tables whose last reader has been written itself."""
    for t in tables:
        _remove(t.sparkSession, t._stored_at)


def discard_all(spark: SparkSession) -> None:
    """Removes every table this application has stored; for long sessions, once all results are written."""
    _remove(spark, _home(spark))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: A key is hot from this many rows on, if it has also over one in HOT_SHARE of all; so there are fewer hot keys than HOT_SHARE.
HOT_ROWS, HOT_SHARE = 1 << 20, 1024


def join_hot(left: DataFrame, right: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Inner join by one column in which right names each key once; left's hot keys are not shuffled.

    Rows of left with a hot key meet right's rows for the hot keys, fewer than
    HOT_SHARE, by broadcast, the others by shuffle.  A table of up to HOT_ROWS
    rows (`rows`, if known) has no hot keys.  Both sides may be read three
    times, so they should be stored.  Null keys join nothing.
    """
    total = left.count() if rows is None else rows
    hot: list = []
    if total >= HOT_ROWS:
        n = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        hot = [r[0] for r in n.where((F.col("n") >= HOT_ROWS) & (F.col("n") * HOT_SHARE > total)).select(key).collect()]  # fewer than HOT_SHARE
    if not hot:
        return left.join(right, key)
    hit = F.col(key).isin(hot)
    cold = left.where(~hit).join(right.where(~hit), key)
    return cold.unionByName(left.where(hit).join(F.broadcast(right.where(hit)), key))
