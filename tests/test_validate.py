"""Validators: each fault alone, and the first of several."""

import json

from pyspark.sql import functions as F

from folioflow.operators import validate

GOOD = {"page": 1, "notes": "", "corrections": [], "uncertain": [], "clipped": [], "blocks": [{"type": "verse", "verse_num_am": "፩", "spans": [{"t": "ሀ", "c": "red"}]}]}


def block(**more):
    return {"blocks": [GOOD["blocks"][0], GOOD["blocks"][0] | more]}


def without(d, *names):
    return {k: v for k, v in d.items() if k not in names}


def test_transcripts(spark):
    cases = [
        (GOOD, 1, None),
        (GOOD | {"_extra": [1]}, 1, None),
        ([], 1, "invalid transcript or page number"),
        (GOOD, 0, "invalid transcript or page number"),
        (GOOD, None, "invalid transcript or page number"),
        (GOOD, 2, "transcript page does not match its filename"),
        (GOOD | {"page": "1"}, 1, "transcript page does not match its filename"),
        (GOOD | {"page": True}, 1, None),
        (GOOD | {"blocks": None}, 1, "blocks must be an array with at most 1000 entries"),
        (GOOD | {"blocks": GOOD["blocks"] * 1001}, 1, "blocks must be an array with at most 1000 entries"),
        (GOOD | block(type="song"), 1, "invalid block type"),
        (GOOD | {"blocks": ["x"]}, 1, "invalid block type"),
        (GOOD | block(verse_num_am=None), 1, "verse number must be a string"),
        (GOOD | {"blocks": [without(GOOD["blocks"][0], "verse_num_am")]}, 1, None),
        (GOOD | block(spans={}), 1, "spans must be an array"),
        (GOOD | block(spans=[{"t": "a", "c": "blue"}]), 1, "invalid text/colour span"),
        (GOOD | block(spans=[{"t": 1, "c": "red"}]), 1, "invalid text/colour span"),
        (GOOD | {"notes": None}, 1, "notes must be text"),
        (without(GOOD, "notes"), 1, None),
        (without(GOOD, "uncertain"), 1, "uncertain must be an array"),
        (GOOD | {"clipped": [{"edge": "left", "note": ""}]}, 1, None),
        (GOOD | {"clipped": [{"edge": "top"}]}, 1, "invalid clipped entry"),
        (GOOD | {"corrections": [{"printed": "a", "suggested": "b", "reason": None}], "clipped": 3}, 1, "invalid corrections entry"),
        (GOOD | {"blocks": [{"type": "song"}], "notes": 3}, 1, "invalid block type"),
    ]
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False), p) for i, (v, p, _) in enumerate(cases)] + [(99, "{", 1)], "i int, raw_json string, page int")
    got = {r.i: (r.a, r.b) for r in df.select("i", validate.transcript_error().alias("a"), validate.transcript_error(legacy=True).alias("b")).collect()}
    assert [got[i][0] for i in range(len(cases))] == [e for _, _, e in cases]
    assert got[99][0] and got[19][1] is None and got[21][1] == "invalid clipped entry"


def test_hosted(spark):
    ok = without(GOOD, "corrections")
    cases = [
        (ok, "1", None),
        (ok, "x1", "page must be a number"),
        (ok, "12345", "page must be a number"),
        (ok, "9", "page must be between 1 and 5"),
        ([], "1", "expected a JSON object"),
        (ok | {"blocks": {}}, "1", "expected a 'blocks' array with at most 1000 blocks"),
        (ok | {"blocks": [1]}, "1", "block 1 must be an object"),
        (ok | block(type="x"), "1", "invalid type in block 2"),
        (ok | {"blocks": [without(GOOD["blocks"][0], "verse_num_am")]}, "1", "invalid verse number in block 1"),
        (ok | block(verse_num_am="x" * 101), "1", "invalid verse number in block 2"),
        (ok | block(spans=None), "1", "invalid spans in block 2"),
        (ok | block(spans=[{"t": "", "c": "red"}, {"t": "", "c": "x"}]), "1", "invalid span 2 in block 2"),
        (ok | block(spans=[{"t": "a" * 100_001, "c": "red"}]), "1", "invalid span 1 in block 2"),
        (ok | {"notes": 5}, "1", "invalid notes"),
        (ok | {"notes": None, "clipped": None}, "1", None),
        (ok | {"uncertain": "x"}, "1", "'uncertain' must be an array"),
        (ok | {"uncertain": [0] * 2001}, "1", "'uncertain' contains too many items"),
    ]
    df = spark.createDataFrame([(i, json.dumps(v), p, 5) for i, (v, p, _) in enumerate(cases)] + [(98, "", "1", 5), (99, "{", "1", 5)], "i int, body string, page string, max_page int")
    got = {r.i: r.e for r in df.select("i", validate.hosted_error().alias("e")).collect()}
    assert [got[i] for i in range(len(cases))] == [e for *_, e in cases]
    assert got[98] == "request body is empty or too large" and got[99] == "request body is not valid JSON"


def test_reviews_and_books(spark):
    cases = [("1", {"status": "approved", "note": " a ", "x": 1}, None), ("2", {}, None), ("0", {}, "page must be between 1 and 5"), ("3", [], "review entry 3 must be an object"), ("4", {"status": "maybe"}, "invalid status for page 4"), ("5", {"note": "n" * 4001}, "note for page 5 must be at most 4000 characters")]
    df = spark.createDataFrame([(p, json.dumps(v), 5) for p, v, _ in cases], "page string, raw_json string, max_page int")
    got = {r.page: (r.reason, r.status, r.note) for r in validate.review_entries(df).collect()}
    assert [got[p][0] for p, *_ in cases] == [e for *_, e in cases] and got["1"][1:] == ("approved", "a") and got["2"][1:] == (None, "")
    known = validate.known_books(spark.createDataFrame([("a",), ("b",)], "book_id string"), spark.createDataFrame([("a", 7)], "book_id string, max_page int"))
    assert {r.book_id: (r.max_page, r.reason) for r in known.collect()} == {"a": (7, None), "b": (None, "unknown book")}


def test_layouts(spark):
    cell = {"bbox": [0, 0, 28, 14.5], "category": "Text", "text": "ሰላም"}
    picture = {"bbox": [1, 2, 3, 4], "category": "Picture"}
    cases = [
        ([cell, picture], None),
        ([cell, cell | {"text": "x"}], None),
        ([], "expected a nonempty layout array with at most 2000 regions"),
        ({}, "expected a nonempty layout array with at most 2000 regions"),
        ([cell] * 2001, "expected a nonempty layout array with at most 2000 regions"),
        ([cell, cell], "duplicate layout region"),
        ([cell, cell | {"bbox": [0.0, 0, 28, 14.5]}], "duplicate layout region"),
        ([cell | {"bbox": [-1, 0, 28, 28]}], "bounding box lies outside the submitted image"),
        ([cell | {"bbox": [5, 0, 5, 28]}], "bounding box lies outside the submitted image"),
        ([cell | {"bbox": [0, 0, True, 28]}], "invalid bounding box"),
        ([cell | {"bbox": [0, 0, 28]}], "invalid bounding box"),
        ([cell | {"bbox": [0, 0, "28", 28]}], "invalid bounding box"),
        ([cell | {"category": "made-up"}], "invalid layout category"),
        ([cell | {"text": "  "}], "text region contains no text"),
        ([picture | {"text": 3}], "text region contains no text"),
        ([cell, cell, {"category": "x"}], "duplicate layout region"),
    ]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, (v, _) in enumerate(cases)] + [(99, "```json\n[]\n```")], "page int, content string")
    df = df.withColumn("original", F.struct(F.lit(56.0).alias("w"), F.lit(28.0).alias("h"))).withColumn("sent", F.struct(F.lit(28.0).alias("w"), F.lit(28.0).alias("h")))
    got = {r.page: r for r in validate.layouts(df).collect()}
    assert [got[i].reason for i in range(len(cases))] == [e for _, e in cases]
    assert got[99].reason and got[5].cells is None
    c = got[0].cells
    assert [(x.ord, x.category, x.text, x.x1, x.x2, x.y2) for x in c] == [(0, "Text", "ሰላም", 0.0, 56.0, 14.5), (1, "Picture", "", 2.0, 6.0, 4.0)]


def test_json_and_more_is_no_json(spark):
    """What follows a value makes a body invalid, whatever it looks like."""
    good = ['{"n": 1}', ' [1] \n', "null", '"a"', "12", "  -1.5e3"]
    bad = ["8316107434564120 Thanlyan of", '"a" b', '{"n": 1} x', "[1] [2]", '"a", "b"] c', '1, 2', "[1", "   ", "x"]
    df = spark.createDataFrame([(x,) for x in good + bad], "body string")
    got = {r.body: r.e for r in df.select("body", F.expr(validate.body_error()).alias("e")).collect()}
    assert got == {x: None for x in good} | {x: "request body is not valid JSON" for x in bad}
