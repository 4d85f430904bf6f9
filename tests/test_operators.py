import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as tx
from folioflow.functions import udfs
from folioflow.operators import core, quality, transcripts
from folioflow.sources.pages import select_pages


def test_page_selector():
    assert select_pages("all", 3) == [1, 2, 3]
    assert select_pages("2,1-2", 3) == [1, 2]
    for bad in ("", "1,,2", "3-2", "0", "4", "-1", "x"):
        with pytest.raises(ValueError):
            select_pages(bad, 3)
    assert select_pages("1,,9", 3, strict=False) == [1, 9]
    assert select_pages("sample", 3, strict=False, sample=(2, 5)) == [2, 5]


def test_clean_text(spark):
    cases = [("**አ** << ለ >>\n## ርእስ\nቃል ፡፡  ሁለት ", "አ « ለ » ርእስ ቃል። ሁለት"), ("#tag ## x", "#tag ## x"), ("a\u00a0 ::b", "a።b"), ("\u00a0a\u2003", "a"), ("\n\n # a", "a"), ("a\t \n\n b", "a b")]
    df = spark.createDataFrame(cases, "t string, w string")
    assert [r[0] for r in df.select(tx.clean_text(F.col("t"))).collect()] == [w for _, w in cases]


def test_normalizers(spark):
    df = spark.createDataFrame([("ሀ። ፩ b1ⶀᎀ",)], "t string")
    v, b, old = df.select(tx.normalize(F.col("t")), tx.normalize(F.col("t"), "build"), tx.normalize_v1(F.col("t"))).first()
    assert (v, b, old) == ("ሀ።፩ⶀᎀ", "ሀ።፩", "ሀ።ⶀᎀ")


def test_canonical_hash():
    assert udfs.canonical_hash('{"b": 1.0, "a": "é"}') == udfs.canonical_hash('{"a":"é","b":1.0}')
    assert udfs.canonical_hash('{"a": 1}') != udfs.canonical_hash('{"a": 1.0}')
    assert udfs.canonical_hash(None) is None


def test_runs_and_forward_fill(spark):
    df = spark.createDataFrame([(1, 1, "red", "a"), (1, 2, "red", "b"), (1, 3, "black", "c"), (1, 4, "red", "d")], "p int, o int, c string, t string")
    got = [tuple(r) for r in core.runs(df, ["p"], ["o"], "c", "t").orderBy("run").select("c", "text").collect()]
    assert got == [("red", "a b"), ("black", "c"), ("red", "d")]
    b = spark.createDataFrame([(1, 1, None), (1, 2, "x"), (1, 3, "y"), (1, 4, "x"), (1, 5, None)], "p int, o int, s string")
    got = [r.section for r in core.first_openings(b, ["p"], ["o"], "s").orderBy("o").collect()]
    assert got == [None, "x", "y", "y", "y"]  # a section that was opened before does not open again


def test_group_lines_first_fit(spark):
    words = spark.createDataFrame([(1, 1, 9.0, 0.0, 10.0), (1, 2, 5.0, 2.0, 12.0), (1, 3, 0.0, 30.0, 40.0), (1, 4, 50.0, 30.0, 40.0), (1, 5, 0.0, 9.0, 19.0), (1, 6, 0.0, 9.0, 19.0)], "page long, word long, x1 double, y1 double, y2 double")
    got = {r.word: (r.line, r.place) for r in core.group_lines(words, "page").collect()}
    # The fifth word's centre is 14, within 4 of the first line's end; its twin joins the grown line behind it.
    assert got == {1: (1, 4), 2: (1, 3), 5: (1, 1), 6: (1, 2), 3: (2, 1), 4: (2, 2)}


def test_merge_phrases(spark):
    boxes = spark.createDataFrame([(1, 0, 0, 50, 20), (1, 60, 5, 100, 25), (1, 400, 0, 450, 20), (1, 10, 58, 30, 68), (1, 200, 50, 220, 66)], "page long, x1 long, y1 long, x2 long, y2 long")
    got = [(r.x1, r.y1, r.x2, r.y2) for r in core.merge_phrases(boxes, "page").orderBy("phrase").collect()]
    # The last box begins above row 60, but its centre lies under it... at 58, so it sorts with the first row.
    assert got == [(0, 0, 220, 66), (400, 0, 450, 20), (10, 58, 30, 68)]


def test_fold_saves(spark):
    log = spark.createDataFrame([(1, 1, None, "a"), (1, 2, "a", "b"), (1, 3, "a", "c"), (1, 4, "b", "b")], "page long, seq long, base string, body_hash string")
    got = [(r.outcome, r.archived, r.keeps_original, r.withdraws_approval) for r in core.fold_saves(log).orderBy("seq").collect()]
    assert got == [("saved", None, False, True), ("saved", "a", True, True), ("conflict", None, False, False), ("saved", None, False, False)]
    many = spark.range(3000).selectExpr("id % 3 as page", "id as seq", "case when id >= 3 then cast(id - 3 as string) end as base", "cast(id as string) as body_hash")
    assert {tuple(r) for r in core.fold_saves(many).groupBy("outcome").count().collect()} == {("saved", 3000)}


def test_block_numbers_grow(spark):
    df = spark.range(1, 1002).selectExpr("1 as p", "id as o")
    ids = {r.block_id for r in core.numbered(df, ["p"], ["o"], F.lit("p")).collect()}
    assert len(ids) == 1001 and {"p_001", "p_100", "p_1000", "p_1001"} <= ids


def test_status_precedence(spark):
    names = ("source_problems", "analysed", "content", "missing_pages", "missing_analysis", "unexpected_analysis", "flagged", "unverified", "unapproved", "missing_sections")
    cases = [
        ((1, 0, 0, 1, 1, 1, 1, 1, 1, 1), "source_incomplete"),
        ((0, 0, 0, 1, 1, 0, 0, 0, 0, 0), "not_analyzed"),
        ((0, 1, 0, 0, 0, 0, 0, 0, 0, 0), "incomplete"),
        ((0, 2, 2, 0, 0, 1, 0, 0, 0, 0), "incomplete"),
        ((0, 2, 2, 1, 0, 0, 1, 0, 0, 0), "incomplete"),
        ((0, 2, 2, 0, 0, 0, 0, 1, 1, 0), "needs_review"),
        ((0, 2, 2, 0, 0, 0, 0, 0, 1, 1), "awaiting_approval"),
        ((0, 2, 2, 0, 0, 0, 0, 0, 0, 1), "sectioning_incomplete"),
        ((0, 2, 2, 0, 0, 0, 0, 0, 0, 0), "ready"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], ", ".join(f"{n} int" for n in names))
    assert [r.status for r in quality.status(df).collect()] == [s for _, s in cases]


def test_equal_rows_stay(spark):
    words = spark.createDataFrame([(1, 5.0, 5.0, 6.0, 6.0)] * 3 + [(2, 0.0, 0.0, 1.0, 1.0)], "page int, x1 double, y1 double, x2 double, y2 double")
    boxes = spark.createDataFrame([(1, 2, 0.0, 0.0, 9.0, 9.0), (1, 1, 5.0, 5.0, 7.0, 7.0)], "page int, ord int, x1 double, y1 double, x2 double, y2 double")
    assert [r.region for r in core.inside(words, boxes, ["page"]).orderBy("page").collect()] == [1, 1, 1, None]
    pages = spark.createDataFrame([(3,), (3,), (99,)], "page int")
    assert [r.section_id for r in core.section_ranges(pages, [("b", 2, 1, 5), ("a", 1, 3, 4)], "page").orderBy("page").collect()] == ["a", "a", None]


def test_page_checks_and_flags(spark):
    block = "array<struct<type:string,verse_num_am:string,spans:array<struct<t:string,c:string>>>>"
    rows = [(1, [("verse", "", [("ሀለሐመ", "red"), ("ሠረ a1", "black")]), ("prayer", "", [(" ", "black")]), ("ornament", "", [])], "x Draft", "ሀለሐመሠረ", 0.1), (2, [], None, None, None), (3, None, None, "ሀለ", 0.5)]
    p = spark.createDataFrame(rows, f"page int, blocks {block}, source string, ocr_text string, mask_red double")
    c = transcripts.page_checks(p)
    got = {r.page: r for r in c.collect()}
    assert (got[1].latin, got[1].digits, got[1].script_chars, got[1].agreement, got[1].empty_type, got[1].draft, got[1].model_lines) == (1, 1, 6, 1.0, "prayer", True, 4)
    assert abs(got[1].model_red - 4 / 6) < 1e-12 and got[2].model_red == 0.0 and got[2].agreement is None and got[3].agreement is None
    lists = {"has_transcript": F.col("page") != 3, "uncertain": F.when(F.col("page") == 1, F.array(*[F.struct(F.lit(x).alias("text")) for x in "abcde"])), "clipped": F.expr("cast(array(named_struct('edge', 'top')) as array<struct<edge:string>>)"), "corrections": F.expr("cast(null as array<struct<printed:string,suggested:string,applied:boolean,dismissed:boolean>>)"), "has_layout": F.lit(False), "colour_from_mask": F.col("page") == 1, "has_image": F.lit(True), "ocr_lines": F.lit(9), "unresolved": F.lit(False)}
    f = {r.page: r.flags for r in transcripts.page_flags(c.withColumns(lists)).collect()}
    assert f[1] == ["1 Latin characters in Ethiopic text: 'a'", "1 ASCII digits (Ethiopic numerals expected)", "red coverage over-marked: model 0.67 vs mask 0.10", "empty prayer block", "5 uncertain word(s) to check: a, b, c, d (+1 more)", "TEXT CUT OFF at top of page — 1 line(s) missing"]
    assert f[2] == ["legacy transcript missing review field(s): uncertain", "missing colour-mask evidence; run split before verification", "missing word-layout evidence; run layout before verification", "model produced no text but Tesseract found lines", "transcript contains no Ethiopic text", "TEXT CUT OFF at top of page — 1 line(s) missing"]
    assert f[3] == ["no transcript"]
