"""Transcripts of a book that several writers may save at once: optimistic commits, no locks.

A version is one small file of a log, _log/<n>.json, which names the parts (one
per bucket of pages) that make up the table at that version.  A save reads the
newest version, judges its edits against it, writes new parts for the buckets it
touches, and then creates the next file of the log, which must not exist yet.
Whoever comes second finds it there, throws its parts away, and judges its edits
anew against the version that won: edits of other pages go through, an edit of
a page that has changed is a conflict, and no save that was reported is lost.
"""

from __future__ import annotations

import json
import random
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import revisions

#: Parts of the table, by hash of the page; a save rewrites those it has edits of.
BUCKETS, BUCKET = 16, "bucket__"
TEXTS = "page long, body string, sha256 string"
REVIEWS = "page long, status string, note string, invalidated_at string"
ORIGINALS = "page long, body string"
#: The tables of a version and their columns; history grows by a part with each save.
TABLES = {"transcripts": TEXTS, "reviews": REVIEWS, "originals": ORIGINALS}


class Lost(RuntimeError):
    """Every try met a version that another writer had committed first."""


class PageStore:
    """The versions under a folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{folder}/_log"))

    def version(self) -> tuple[int, dict]:
        """The newest version's number and its parts: table to bucket to folder, and history, a list of folders. 0 is the empty one."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.folder}/_log"))]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
        if not numbers:
            return 0, {**{t: {} for t in TABLES}, "history": []}
        n = max(numbers)
        while not (text := self._text(n)):  # created, its few bytes not there yet
            time.sleep(0.01)
        return n, json.loads(text)

    def _text(self, n: int) -> str:
        stream = self._fs.open(self._path(f"{self.folder}/_log/{n}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return text if text.endswith("\n") else ""

    def _commit(self, n: int, parts: dict) -> bool:
        """Creates version n; false if it exists already."""
        jvm, target = self.spark.sparkContext._jvm, f"{self.folder}/_log/{n}.json"
        body = bytearray((json.dumps(parts) + "\n").encode())
        uri = self._fs.makeQualified(self._path(target)).toUri()
        if uri.getScheme() == "file":
            # Hadoop's local file system looks first and creates afterwards; this is one step.
            options = self.spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
            try:
                jvm.java.nio.file.Files.write(jvm.java.nio.file.Paths.get(uri), body, options)
            except Py4JJavaError as e:
                if "FileAlreadyExists" in e.java_exception.getClass().getName():
                    return False
                raise
            return True
        try:
            out = self._fs.create(self._path(target), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        out.write(body)
        out.close()
        return True

    def _read(self, table: str, parts: dict, touched: list[int] | None = None) -> DataFrame:
        paths = [p for b, p in parts[table].items() if touched is None or int(b) in touched]
        return self.spark.read.schema(TABLES[table]).parquet(*paths) if paths else self.spark.createDataFrame([], TABLES[table])

    def read(self, table: str = "transcripts", number: int | None = None) -> DataFrame:
        """A table at a version, the newest by default; a reader of one version never sees another."""
        parts = self.version()[1] if number is None else json.loads(self._text(number))
        return self._read(table, parts)

    def history(self) -> DataFrame:
        """page, sha256, body of every text that a save replaced."""
        found = self.version()[1]["history"]
        return self.spark.read.schema("page long, sha256 string, body string").parquet(*found) if found else self.spark.createDataFrame([], "page long, sha256 string, body string")

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col("page").cast("long")), F.lit(self.buckets)).cast("int")

    def _try(self, touched: list[int], change: Callable[[dict[str, DataFrame]], tuple[dict[str, DataFrame], DataFrame | None, list]]) -> tuple[bool, list]:
        n, parts = self.version()
        tables, history, said = change({t: self._read(t, parts, touched) for t in TABLES})
        home, new = f"{self.folder}/data/{uuid.uuid4().hex}", {t: dict(p) for t, p in parts.items() if t != "history"}
        for name, df in tables.items():
            df.withColumn(BUCKET, self._bucket()).write.partitionBy(BUCKET).parquet(f"{home}/{name}")
            have = {s.getPath().getName().removeprefix(f"{BUCKET}=") for s in self._fs.listStatus(self._path(f"{home}/{name}")) if s.isDirectory()}
            for b in map(str, touched):
                new[name].pop(b, None)
                if b in have:
                    new[name][b] = f"{home}/{name}/{BUCKET}={b}"
        new["history"] = list(parts["history"])
        if history is not None:
            history.write.parquet(f"{home}/history")
            new["history"].append(f"{home}/history")
        if self._commit(n + 1, new):
            return True, said
        self._fs.delete(self._path(home), True)
        return False, []

    def _retried(self, touched: list[int], change, tries: int) -> list:
        for k in range(tries):
            done, said = self._try(touched, change)
            if done:
                return said
            time.sleep(random.random() * min(1.0, 0.02 * 2**k))
        raise Lost(f"{tries} saves in a row were overtaken")

    def save(self, edits: DataFrame, stamp: str, tries: int = 20) -> list:
        """Saves edits (page, body, sha256, base; one per page): rows of page, outcome, as saved_transcripts() words them.

        What an edit replaces goes to the history, the first text ever to the
        originals, and an approval of a changed page is withdrawn.
        """
        touched = sorted(r[0] for r in edits.select(self._bucket()).distinct().collect())  # at most `buckets`

        def change(now):
            out = revisions.saved_transcripts(now["transcripts"], edits, now["reviews"], now["originals"], F.lit(stamp))
            said = out["outcomes"].collect()  # the pages of one save
            return {t: out[t] for t in TABLES}, out["history"], said

        return self._retried(touched, change, tries) if touched else []

    def review(self, decisions: DataFrame, tries: int = 20) -> list:
        """Stores decisions (page, status, note; sha256, the text an approval was given for): rows of page, outcome.

        An approval of a text that is not the present one is refused, whoever
        saved in between.
        """
        touched = sorted(r[0] for r in decisions.select(self._bucket()).distinct().collect())

        def change(now):
            d = decisions.join(now["transcripts"].select("page", F.col("sha256").alias("_now")), "page", "left")
            stale = (F.col("status") == "approved") & ~F.col("sha256").eqNullSafe(F.col("_now"))
            d = d.withColumn("outcome", F.when(F.coalesce(stale, F.lit(False)), "Approval refers to an older transcript or scan. Reload the page.").otherwise("saved"))
            new = d.where("outcome = 'saved'").select("page", "status", "note", F.lit(None).cast("string").alias("invalidated_at"))
            return {"reviews": now["reviews"].join(new.select("page"), "page", "left_anti").unionByName(new)}, None, d.select("page", "outcome").collect()

        return self._retried(touched, change, tries) if touched else []
