"""Review edits as a stream: keyed compare-and-set, and upserts of the newest row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


#: What is known of a page: the hash of its text, whether a first text is kept, and the hash its approval was given for.
_CURRENT, _APPROVED = "sha256 string, edited boolean", "sha256 string"
_OUTCOMES = "page long, seq long, kind string, outcome string, archived string, keeps_original boolean, withdraws_approval boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Page(StatefulProcessor):
    """One page's edits and approvals, in the order of seq within a batch, later batches after all earlier ones."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.current, self.approved = handle.getValueState("current", _CURRENT), handle.getValueState("approved", _APPROVED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, edited = self.current.get() if self.current.exists() else (None, False)
        approval = self.approved.get()[0] if self.approved.exists() else None
        known, out = (now, edited, approval), []
        pdf = pd.concat(list(rows)).sort_values("seq", kind="stable")
        for seq, kind, base, body in zip(pdf.seq, pdf.kind, pdf.base, pdf.body_hash, strict=True):
            base = None if pd.isna(base) else base
            fits = base == now
            if kind == "approve":
                # An approval names the text that its reader saw.
                fits = fits and now is not None
                approval = now if fits else approval
                out.append((key[0], seq, kind, "saved" if fits else "conflict", None, False, False))
                continue
            changed = fits and now is not None and now != body
            withdraws = fits and now != body and approval is not None
            out.append((key[0], seq, kind, "saved" if fits else "conflict", now if changed else None, changed and not edited, withdraws))
            if fits:
                now, edited, approval = body, edited or changed, None if withdraws else approval
        if (now, edited) != known[:2]:
            self.current.update((now, edited))
        if approval != known[2]:
            self.approved.update((approval,)) if approval is not None else self.approved.clear()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUTCOMES.split(", ")])

    def close(self) -> None:
        pass


def fold_edits(edits: DataFrame) -> DataFrame:
    """edits (page long, seq long, kind string, base string, body_hash string): each one's outcome against the state of its page.

    kind is edit or approve.  An edit is saved where its base is the page's
    current hash (null: no text yet); a changed one archives what it replaces,
    keeps the first text once, and withdraws an approval.  An approval holds
    where its base is the current hash.  Within a batch rows go by seq; a later
    batch's come after all earlier ones.  A page's state is two small values in
    RocksDB, which the checkpoint brings back after a restart.
    """
    edits.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return edits.groupBy("page").transformWithStateInPandas(_Page(), _OUTCOMES, "append", "None")


#: Parts of an upserted table, by hash of the key; a batch rewrites those it has rows of.
BUCKETS, BUCKET = 64, "bucket__"


def _versions(spark: SparkSession, folder: str) -> dict[int, list[int]]:
    """The whole versions of each bucket, oldest first, from the folders v=<batch>/bucket__=<bucket>."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    root = path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    if fs.exists(root):
        for v in fs.listStatus(root):
            if fs.exists(path(v.getPath(), "_SUCCESS")):
                for b in fs.listStatus(v.getPath()):
                    if b.getPath().getName().startswith(f"{BUCKET}="):
                        out.setdefault(int(b.getPath().getName().partition("=")[2]), []).append(int(v.getPath().getName()[2:]))
    return {b: sorted(v) for b, v in out.items()}


def upsert_stream(stream: DataFrame, folder: str, key: str, order: str, checkpoint: str, buckets: int = BUCKETS):
    """Keeps the newest row per key in buckets under folder/v=<batch>/bucket__=<bucket>; a repeated batch rewrites its own version.

    Returns the writer, to be started with a trigger.  A batch reads and writes
    the buckets it has rows of, in one job; of each bucket the version before is
    kept for a repeat of the batch, older ones go.  current() reads the last.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at = F.pmod(F.xxhash64(key), F.lit(buckets))
        batch = batch.persist()
        try:
            touched = [r.b for r in batch.select(at.alias("b")).distinct().collect()]  # at most `buckets`
            if not touched:
                return
            have = {b: [n for n in v if n < number] for b, v in _versions(spark, folder).items() if b in touched}
            old = [f"{folder}/v={v[-1]}/{BUCKET}={b}" for b, v in have.items() if v]
            rows = batch.unionByName(spark.read.schema(batch.schema).parquet(*old)) if old else batch
            newest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
            newest.withColumn(BUCKET, at).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{folder}/v={number}")
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            for b, v in have.items():
                for n in v[:-1]:
                    fs.delete(path(f"{folder}/v={n}/{BUCKET}={b}"), True)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The last whole version of every bucket."""
    return spark.read.parquet(*[f"{folder}/v={v[-1]}/{BUCKET}={b}" for b, v in _versions(spark, folder).items()])
