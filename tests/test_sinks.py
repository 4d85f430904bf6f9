"""Files as a source and a sink, replaced whole or not at all, and stores with several writers."""

import hashlib
import os
import threading

import pytest
from folioflow.sources import book_format, exports, versions
from pyspark.sql import functions as F


@pytest.fixture
def folder(tmp_path):
    for name, body in {"page_001.json": "one", "page_002.json": "two", "page_0010.json": "ten", "page_002.original.json": "first", "page_12.json": "short", "notes.txt": "n", ".hidden": "h"}.items():
        (tmp_path / name).write_text(body)
    (tmp_path / "page_003.json").mkdir()
    return tmp_path


def read(spark, folder, **options):
    return book_format.register(spark).read.format("book").options(**options).load(str(folder))


def test_names(spark, folder):
    assert sorted((r.page, r.body) for r in read(spark, folder, names="canonical").collect()) == [(1, "one"), (2, "two"), (10, "ten")]
    assert sorted((r.page, r.name) for r in read(spark, folder, names="page").collect()) == [(1, "page_001.json"), (2, "page_002.json"), (2, "page_002.original.json"), (10, "page_0010.json"), (12, "page_12.json")]
    every = read(spark, folder, names="all", body="false").collect()
    assert {r.name for r in every if r.page is None} == {"notes.txt"} and all(r.body is None and r.size > 0 for r in every)
    assert read(spark, folder / "nowhere").collect() == []
    with pytest.raises(Exception, match="names must be"):
        read(spark, folder, names="odd").collect()


def test_filters_decide_what_is_opened(spark, folder):
    (folder / "page_002.json").write_bytes(b"\xff\xfe not text")
    with pytest.raises(Exception, match="utf-8"):
        read(spark, folder, names="canonical").collect()
    got = lambda where: sorted(r.page for r in read(spark, folder, names="canonical").where(where).collect())
    assert got("page = 1") == [1] and got("page > 2") == [10] and got("page IN (1, 10, 11)") == [1, 10]
    assert got(F.col("name").startswith("page_0010")) == [10] and got("page >= 3 AND page < 10") == [] and got("page IS NULL") == []
    reader = book_format._Reader({"path": str(folder), "names": "canonical"})
    assert list(reader.pushFilters([book_format.EqualTo(("page",), 10), book_format.EqualTo(("body",), "x")])) == [book_format.EqualTo(("body",), "x")]
    assert [f[0] for p in reader.partitions() for f in p.files] == [10]


def test_partitions_by_size(folder, monkeypatch):
    monkeypatch.setattr(book_format, "PART_BYTES", 2 * book_format.FILE_BYTES)
    parts = book_format._Reader({"path": str(folder), "names": "page"}).partitions()
    assert [len(p.files) for p in parts] == [2, 2, 1]


def test_written_files_replace_and_failed_ones_change_nothing(spark, folder):
    book_format.register(spark)
    df = spark.createDataFrame([("page_001.json", "new"), ("page_099.json", "x" * 100_000), ("empty", "")], "name string, body string").repartition(3)
    df.write.format("book").mode("append").save(str(folder))
    assert (folder / "page_001.json").read_text() == "new" and (folder / "empty").read_text() == "" and (folder / "page_002.json").read_text() == "two"
    before = {p.name: p.read_bytes() for p in folder.iterdir() if p.is_file()}
    bad = df.withColumn("body", F.when(F.col("name") == "empty", F.raise_error(F.lit("stop"))).otherwise("later"))
    for wrong in (bad, df.union(df), df.withColumn("name", F.lit("../out")), df.withColumn("body", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match=".+"):
            wrong.write.format("book").mode("append").save(str(folder))
    assert {p.name: p.read_bytes() for p in folder.iterdir() if p.is_file()} == before
    assert not [p for p in os.listdir(folder) if p.startswith(".staging")]
    df.limit(1).write.format("book").mode("overwrite").save(str(folder))
    assert [p.name for p in folder.iterdir() if p.is_file() and not p.name.startswith(".")] == [df.limit(1).first().name]


def test_files_below_a_folder(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.json").write_text("old")
    df = spark.createDataFrame([("a/x.json", "new"), ("b/c/y.json", "é")], "name string, body string")
    assert exports.write_files(df, str(tmp_path)) == 2
    assert (tmp_path / "a/x.json").read_text() == "new" and (tmp_path / "b/c/y.json").read_text() == "é"
    assert sorted(p.name for p in tmp_path.rglob("*") if p.is_file() and not p.name.endswith(".crc")) == ["x.json", "y.json"]


def test_a_failure_before_the_rename_leaves_the_old_text(spark, tmp_path):
    (tmp_path / "x.json").write_text("old")
    (tmp_path / ".x.json.part").mkdir()
    (tmp_path / ".x.json.part" / "in the way").write_text("")
    with pytest.raises(Exception, match=".+"):
        exports.write_files(spark.createDataFrame([("x.json", "new")], "name string, body string"), str(tmp_path))
    assert (tmp_path / "x.json").read_text() == "old"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def edit(spark, rows):
    return spark.createDataFrame([(p, b, sha(b), base) for p, b, base in rows], "page long, body string, sha256 string, base string")


def test_store(spark, tmp_path):
    s = versions.PageStore(spark, str(tmp_path), 2)
    said = lambda rows: {r.page: r.outcome == "saved" for r in rows}
    assert said(s.save(edit(spark, [(1, "a", None), (2, "b", None)]), "t1")) == {1: True, 2: True}
    assert said(s.review(spark.createDataFrame([(1, "approved", "", sha("a")), (2, "approved", "", sha("x"))], "page long, status string, note string, sha256 string"))) == {1: True, 2: False}
    assert said(s.save(edit(spark, [(1, "a2", sha("a")), (2, "b2", sha("old")), (3, "c", "gone")]), "t2")) == {1: True, 2: False, 3: False}
    assert {r.page: r.body for r in s.read().collect()} == {1: "a2", 2: "b"}
    assert [(r.page, r.status, r.invalidated_at) for r in s.read("reviews").collect()] == [(1, None, "t2")]
    assert [tuple(r) for r in s.read("originals").collect()] == [(1, "a")] and [(r.page, r.body) for r in s.history().collect()] == [(1, "a")]
    assert {r.page: r.body for r in s.read(number=1).collect()} == {1: "a", 2: "b"} and s.version()[0] == 3
    assert s.save(edit(spark, []), "t3") == []


def test_a_writer_that_is_overtaken_judges_anew(spark, tmp_path, monkeypatch):
    a, b = (versions.PageStore(spark, str(tmp_path), 2) for _ in range(2))
    a.save(edit(spark, [(1, "one", None), (2, "two", None)]), "t0")
    commit, raced = a._commit, []

    def late(n, parts):
        if not raced:
            raced.append(b.save(edit(spark, [(1, "b", sha("one"))]), "t1"))
        return commit(n, parts)

    monkeypatch.setattr(a, "_commit", late)
    got = {r.page: r.outcome for r in a.save(edit(spark, [(1, "a", sha("one")), (2, "a", sha("two"))]), "t2")}
    assert raced[0][0].outcome == "saved" and got[2] == "saved" and got[1].startswith("This page changed")
    assert {r.page: r.body for r in a.read().collect()} == {1: "b", 2: "a"}
    monkeypatch.setattr(a, "_commit", lambda n, parts: False)
    with pytest.raises(versions.Lost):
        a.save(edit(spark, [(1, "c", sha("b"))]), "t3", tries=2)
    assert len([p for p in (tmp_path / "data").iterdir()]) == 3


def test_two_writers_lose_no_save(spark, tmp_path):
    saved = {"a": [], "b": []}

    def work(name):
        s = versions.PageStore(spark, str(tmp_path), 4)
        for k in range(4):
            now = {r.page: r.sha256 for r in s.read().collect()}
            rows = [(p, f"{name}{k} on {p}", now.get(p)) for p in (0, 1 if name == "a" else 2)]
            saved[name] += [(r.page, f"{name}{k} on {r.page}") for r in s.save(edit(spark, rows), "t") if r.outcome == "saved"]

    threads = [threading.Thread(target=work, args=(n,)) for n in saved]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    s = versions.PageStore(spark, str(tmp_path), 4)
    kept = [(r.page, r.body) for r in s.read().collect()] + [(r.page, r.body) for r in s.history().collect()]
    assert sorted(kept) == sorted(saved["a"] + saved["b"]) and s.version()[0] == 8
    assert sum(p == 1 for p, _ in saved["a"]) == 4 and sum(p == 2 for p, _ in saved["b"]) == 4
