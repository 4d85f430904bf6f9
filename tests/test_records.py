"""Assembly, flags, sinks, imports and the streams, on small hand-made cases."""

import json

import pytest
from pyspark.sql import functions as F

from folioflow.operators import book, transcripts
from folioflow.sources import exports
from folioflow.streaming import reviews


def _blocks(spark):
    rows = [
        ("b", 1, 1, "prayer", None),
        ("b", 2, 1, "ornament", None),
        ("b", 2, 2, "title", "s2"),
        ("b", 3, 1, "verse", None),
        ("b", 3, 2, "ornament", None),
        ("b", 3, 3, "title", "s1"),
        ("b", 4, 1, "title", "s2"),
        ("b", 5, 1, "ornament", None),
    ]
    return spark.createDataFrame(rows, "book string, page int, block_ord int, type string, opens string")


def test_assembly(spark):
    a = book.assemble(_blocks(spark), ["book"]).orderBy("page", "block_ord").collect()
    assert [(r.section, r.block_id, r.moved) for r in a] == [
        (None, "front_matter_001", False),
        ("s2", "front_matter_002", True),
        ("s2", "s2_002", False),
        ("s2", "s2_003", False),
        ("s1", "s2_003", True),
        ("s1", "s1_002", False),
        ("s1", "s1_003", False),
        ("s1", "s1_004", False),
    ]


def test_spans_and_payload(spark, tmp_path):
    a = book.assemble(_blocks(spark), ["book"])
    assert {tuple(r) for r in book.section_spans(a, ["book"]).select("section", "start_page", "end_page", "blocks").collect()} == {("s2", 2, 3, 3), ("s1", 3, 5, 4)}
    rules = spark.createDataFrame([("s1", 1, "one"), ("s2", 2, "two")], "section string, ord int, title string")
    p = book.payload(a, rules, ["book"], ["type"])
    whole, compact = exports.write_book(p, str(tmp_path), "out")
    got = json.loads(open(whole).read())
    assert got == json.loads(open(compact).read())
    assert [s["section_id"] for s in got["sections"]] == ["s1", "s2"] and got["sections_count"] == 2
    assert [x["block_id"] for x in got["sections"][1]["blocks"]] == ["front_matter_002", "s2_002", "s2_003"]
    assert [x["block_id"] for x in got["front_matter"]] == ["front_matter_001"]


def test_payload_of_empty_and_unsectioned(spark):
    rules = spark.createDataFrame([], "section string, ord int")
    none = book.assemble(_blocks(spark).where("false"), ["book"])
    assert book.payload(none, rules, ["book"], ["type"]).count() == 0
    one = book.payload(book.assemble(_blocks(spark).withColumn("opens", F.lit(None).cast("string")), ["book"]), rules, ["book"], ["type"]).first()
    assert one.sections_count == 0 and len(one.front_matter) == 8


def test_coloured_regions(spark):
    a = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["c"])], "r int, tokens array<string>")
    b = spark.createDataFrame([(1, ["a", "b"], ["red", "black"]), (2, ["a", "x"], ["red", "red"])], "r int, words array<string>, colours array<string>")
    got = {r.r: (r.colours, r.unaligned) for r in transcripts.coloured_regions(a, b, ["r"]).collect()}
    assert got == {1: (["red", "black"], False), 2: (["black"], True), 3: (["black"], True)}


def test_import_withdraws_approvals(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"transcripts": {"page_003": {"page": 3}}, "review": {"entries": {"3": {"status": "approved", "note": ""}, "4": {"status": "approved", "note": "old "}, "5": {"status": None, "note": None}}}}))
    pages, entries = exports.read_export(spark, str(tmp_path / "e.json"))
    assert [(r.page, json.loads(r.raw_json)) for r in pages.collect()] == [(3, {"page": 3})]
    got = {r.page: (r.status, r.note) for r in transcripts.imported_reviews(entries, pages).collect()}
    assert got == {3: ("approved", ""), 4: (None, "old [approval withdrawn on import: it referred to an older baseline text]"), 5: (None, "")}


def test_sinks(spark, tmp_path):
    with pytest.raises(ValueError):
        exports.write_json(str(tmp_path / "x.json"), {"a": float("nan")})
    assert not list(tmp_path.iterdir())
    s = spark.createDataFrame([(1, 0.0), (2, 0.9)], "page int, red_ratio double")
    exports.write_page_csv(s.coalesce(1), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


EDITS = [
    [(1, 1, "edit", None, "a"), (1, 2, "edit", "a", "b"), (1, 3, "edit", "a", "c"), (2, 1, "edit", "x", "a"), (2, 2, "edit", None, "d"), (2, 3, "approve", "d", None), (3, 1, "approve", None, None)],
    [(1, 4, "edit", "b", "b"), (2, 4, "approve", "old", None), (2, 5, "edit", "d", "e")],
    [(2, 6, "edit", "e", "f"), (1, 5, "edit", "b", "g")],
]


def test_fold_stream_over_restarts(spark, tmp_path):
    schema = "page long, seq long, kind string, base string, body_hash string"
    for rows in EDITS:  # each run begins from the checkpoint of the one before
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = reviews.fold_edits(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    got = {(r.page, r.seq): (r.outcome, r.archived, r.keeps_original, r.withdraws_approval) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    plain = ("saved", None, False, False)
    conflict = ("conflict", None, False, False)
    assert got == {
        (1, 1): plain, (1, 2): ("saved", "a", True, False), (1, 3): conflict, (2, 1): conflict, (2, 2): plain, (2, 3): plain, (3, 1): conflict,
        (1, 4): plain, (2, 4): conflict, (2, 5): ("saved", "d", True, True), (2, 6): ("saved", "e", False, False), (1, 5): ("saved", "b", False, False),
    }


def test_upsert_stream(spark, tmp_path):
    schema = "page long, seq long, status string"
    for rows in ([(1, 1, "needs_fix"), (2, 1, "approved")], [(1, 2, "approved"), (1, 3, "needs_fix"), (3, 1, None)], [(1, 0, "approved"), (4, 1, "x")], [(4, 2, "y")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        reviews.upsert_stream(stream, str(tmp_path / "t"), "page", "seq", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert {tuple(r) for r in reviews.current(spark, str(tmp_path / "t")).select(*["page", "seq", "status"]).collect()} == {(1, 3, "needs_fix"), (2, 1, "approved"), (3, 1, None), (4, 2, "y")}
    # A bucket without new rows is left alone; of the others the two last versions stay.
    kept = reviews._versions(spark, str(tmp_path / "t"))
    assert all(1 <= len(v) <= 2 for v in kept.values()) and sorted(v[0] for v in kept.values())[0] == 0
