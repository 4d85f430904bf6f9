"""A small book on disk: config, transcripts, evidence, reviews, assembly, saving and importing."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from folioflow.functions.udfs import canonical_hash
from folioflow.operators import book, revisions
from folioflow.sources import books, exports

SPAN = "array<struct<t:string,c:string>>"


def page(n, text="ቃል።", kind="prayer", **more):
    return {"page": n, "notes": "", "corrections": [], "uncertain": [], "clipped": [], "blocks": [{"type": kind, "verse_num_am": "", "spans": [{"t": text, "c": "black"}]}]} | more


@pytest.fixture
def root(tmp_path):
    home = tmp_path / "books" / "one"
    for f in ("work/transcripts", "work/page_images", "work/candidates", "source"):
        (home / f).mkdir(parents=True)
    (home / "book.json").write_text(json.dumps({"title_am": "መጽሐፍ", "sections": [{"section_id": "a", "order": 2, "required_any": [["ሰኞ"]]}, {"section_id": "b", "order": 1, "required_any": [["ማክሰኞ", ""]], "title_en": "B"}]}))
    (tmp_path / "books" / "none").mkdir()
    for n, t in ((1, page(1, "ሰኞ ጸሎት", "title")), (2, page(2, "ማክሰኞ", "title", _source="DRAFT x"))):
        (home / f"work/transcripts/page_00{n}.json").write_text(json.dumps(t, indent=1))
        (home / f"work/page_images/page_00{n}.png").write_bytes(b"image %d" % n)
    for name in ("page_001.original.json", "page_02.json", "page_001.youredit.json"):
        (home / "work/transcripts" / name).write_text("{}")
    (home / "source" / "b.pdf").write_bytes(b"b")
    (home / "source" / "a.pdf").write_bytes(b"a")
    (home / "work/page_stats.json").write_text(json.dumps({"1": {"is_blank": False, "is_illustration": False, "red_ink_ratio": 0.001, "red_components_dropped_ornament": 1, "red_components_kept": 4, "red_components_dropped_small": 2}, "2": {"is_blank": False}, "3": {"is_blank": True}}))
    return home


def test_sources(spark, root):
    assert [r.rsplit("/", 1)[1] for r in books.discover(spark, str(root.parent))] == ["one"]
    b = books.load(spark, [str(root)]).first()
    assert (b.book_id, b.title_en, b.dpi, b.blank_ink_ratio, b.tesseract_lang, b.provider, b.publish) == ("one", "one", 300, 0.01, "amh", "dots", False)
    with pytest.raises(FileNotFoundError):
        books.load(spark, [str(root.parent / "none")])
    assert books.source_pdf(spark, str(root)).endswith("/source/a.pdf") and books.source_pdf(spark, str(root), "source/b.pdf").endswith("b.pdf")
    at = books.paths(str(root), "one")
    t = books.load_transcripts(spark, at["transcripts"])
    assert [(r.file_page, r.reason) for r in t.orderBy("file_page").collect()] == [(1, None), (2, None)]
    assert books.load_transcripts(spark, at["transcripts"], spark.createDataFrame([(2,), (9,)], "page int")).count() == 1
    assert books.strict(t).count() == 2
    (root / "work/transcripts/page_003.json").write_text(json.dumps(page(4)))
    with pytest.raises(Exception, match="transcript page does not match its filename"):
        books.strict(books.load_transcripts(spark, at["transcripts"])).collect()
    assert {r.page: r.is_blank for r in books.page_stats(spark, at["stats"]).collect()} == {1: False, 2: False, 3: True}
    assert books.flags(spark, at["verification"]).count() == 0 and books.reviews(spark, at["review"]).count() == 0
    assert books.read_text_or(spark, f"{root}/nothing", "x") == "x"
    assert {r.name: r.page for r in books.file_table(spark, f"{at['page_images']}/page_*.png").collect()} == {"page_001.png": 1, "page_002.png": 2}
    assert {r.page: r.sha256 for r in books.file_hashes(spark, f"{at['page_images']}/page_*.png").collect()} == {n: hashlib.sha256(b"image %d" % n).hexdigest() for n in (1, 2)}


def test_newest_candidates_and_guards(spark):
    k = "0123456789abcdef"
    f = spark.createDataFrame([("p/1", f"page_001.{k}.json", 2), ("p/2", f"page_001.{k[::-1]}.json", 3), ("p/3", f"page_002.{k}.error.json", 9), ("p/4", "page_002.json", 9)], "path string, name string, modified long")
    assert [tuple(r) for r in books.latest_candidates(f).collect()] == [(1, "p/2")]
    r = spark.createDataFrame([(1, "approved"), (2, "needs_fix")], "page int, status string")
    o = spark.createDataFrame([(1,), (3,)], "page int")
    assert {tuple(x) for x in books.protected_pages(r, o).collect()} == {(1, "approved"), (3, "edited by hand")}
    known = books.known_pages(spark.createDataFrame([("b", 3)], "book string, max_page int"), spark.createDataFrame([("b", 2, "x")], "book string, page long, body string"), ["book"])
    assert [(x.page, x.body) for x in known.orderBy("page").collect()] == [(1, None), (2, "x"), (3, None)]


def evidence(spark, rows):
    return spark.createDataFrame(rows, "page int, raw_json string, page_images string, red_mask string, black_layer string, red_layer string, layout string, stats_json string, source_sha256 string")


def test_revisions(spark):
    raw = '{"page": 1, "b": "ሀ", "a": 1.0}'
    r = revisions.revisions(evidence(spark, [(1, raw, "aa", None, "bb", None, None, '{"y":1,"x":2}', "cc"), (2, raw, None, None, None, None, None, None, None)])).orderBy("page").collect()
    digest = lambda v: hashlib.sha256(json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert r[0].transcript_sha256 == canonical_hash(raw) == digest(json.loads(raw))
    base = dict.fromkeys(revisions.EVIDENCE)
    assert r[0].evidence_sha256 == digest(base | {"page_images": "aa", "black_layer": "bb", "classification": digest({"x": 2, "y": 1}), "source_sha256": "cc"})
    assert r[1].evidence_sha256 == digest(base | {"classification": digest(None), "source_sha256": None})


def test_source_problems(spark):
    m = "struct<source_sha256:string,pages:int,dpi:int>"
    b = spark.createDataFrame([("ok", "s", ("s", 2, 300), 300, 2), ("gone", None, None, 300, 2), ("new", "s", ("t", 3, 200), 300, 2), ("lost", None, ("t", 2, 300), 300, 2)], f"book_id string, source_sha256 string, manifest {m}, dpi int, total_pages int")
    r = spark.createDataFrame([("ok", 1, "x", "x"), ("ok", 2, "y", "y"), ("new", 1, "x", "z"), ("new", 2, "y", None), ("lost", 2, "y", "y")], "book_id string, page int, recorded string, actual string")
    got = {x.book_id: x.issues for x in revisions.source_problems(b, r).collect()}
    assert got["ok"] == []
    assert got["gone"] == ["original PDF is missing", "source manifest is missing; render the original PDF"]
    assert got["new"] == ["source PDF does not match the render manifest", "source page count does not match the render manifest", "render resolution changed", "page 1: original render is missing or changed", "page 2: original render is missing or changed"]
    assert got["lost"] == ["original PDF is missing", "source PDF does not match the render manifest", "page 1: original render is missing or changed"]


def built(spark, root, sections=None, approve=(1, 2), total=3, issues=(), flagged=()):
    b = books.load(spark, [str(root)]).withColumn("total_pages", F.lit(total))
    rules = books.section_rules(b) if sections is None else spark.createDataFrame(sections, books.section_rules(b).schema)
    at = books.paths(str(root), "one")
    t = books.load_transcripts(spark, at["transcripts"]).where("reason IS NULL").withColumn("book_id", F.lit("one"))
    rev = [("one", p, f"t{p}", f"e{p}") for p in (1, 2)]
    hashes = "book_id string, page int, transcript_sha256 string, evidence_sha256 string"
    texts = spark.createDataFrame(rev, hashes)
    reports = texts.withColumn("review_flags", F.when(F.col("page").isin(*flagged, 0), F.array(F.lit("bad"))).otherwise(F.expr("cast(array() as array<string>)")))
    reviews_ = spark.createDataFrame([(*rev[p - 1], "approved") for p in approve] or [("one", 9, "x", "x", "approved")], hashes + ", status string")
    stats = books.page_stats(spark, at["stats"]).withColumn("book_id", F.lit("one"))
    iss = spark.createDataFrame([("one", list(issues))], "book_id string, issues array<string>")
    return book.build(b, book.transcript_blocks(t, ["book_id"]), rules, stats, texts, reports, reviews_, iss, ["book_id"]).first()


def test_build(spark, root):
    got = built(spark, root)
    assert (got.quality.status, got.quality.production_ready, got.sections_count) == ("ready", True, 2)
    # Sorted by order; the nested keyword falls through to the section that is not open yet.
    assert [(s.section_id, s.order, s.title_en, s.start_page, s.end_page) for s in got.sections] == [("b", 1, "B", 2, 2), ("a", 2, "", 1, 1)]
    assert got.sections[1].blocks[0].block_id == "a_001" and got.sections[1].blocks[0].review_status == "approved"
    assert got.extraction.pages_blank == 1 and got.extraction.pages_expected == 2 and got.extraction.pages_approved == 2
    assert built(spark, root, approve=(1,)).quality.status == "awaiting_approval"
    assert built(spark, root, flagged=(2,)).quality.status == "needs_review"
    late = built(spark, root, total=4)
    assert (late.quality.status, late.quality.missing_analysis_pages) == ("incomplete", [4])
    assert built(spark, root, issues=("x",)).quality.status == "source_incomplete"


def test_build_by_pages_and_without_sections(spark, root):
    fields = lambda s, pos, a, b: ("one", pos, s, pos, "", "", None, None, None, None, None, a, b)
    got = built(spark, root, [fields("x", 0, 1, 1), fields("y", 1, 2, 2), fields("z", 2, 3, 3)])
    assert [(s.section_id, s.start_page, s.end_page) for s in got.sections] == [("x", 1, 1), ("y", 2, 2)]
    assert (got.quality.status, got.quality.missing_sections) == ("sectioning_incomplete", ["z"])
    whole = built(spark, root, [])
    assert [(s.section_id, s.title_am, s.start_page, s.end_page, len(s.blocks)) for s in whole.sections] == [("one", "መጽሐፍ", 1, 2, 2)]


def test_saving_and_reviewing(spark):
    cur = spark.createDataFrame([(1, "old", "h1"), (2, "two", "h2"), (4, "four", "h4")], "page int, body string, sha256 string")
    edits = spark.createDataFrame([(1, "new", "n1", "h1"), (2, "x", "n2", "stale"), (3, "first", "n3", None), (4, "four", "h4", "h4"), (5, "y", "n5", "h5")], "page int, body string, sha256 string, base string")
    rev = spark.createDataFrame([(1, "approved", "", None), (4, "approved", "", None)], "page int, status string, note string, invalidated_at string")
    out = revisions.saved_transcripts(cur, edits, rev, spark.createDataFrame([], "page int, body string"), F.lit("now"))
    assert {r.page: r.outcome[:5] for r in out["outcomes"].collect()} == {1: "saved", 2: "This ", 3: "saved", 4: "saved", 5: "The s"}
    assert {tuple(r) for r in out["transcripts"].collect()} == {(1, "new", "n1"), (2, "two", "h2"), (3, "first", "n3"), (4, "four", "h4")}
    assert [tuple(r) for r in out["history"].collect()] == [(1, "h1", "old")] and [tuple(r) for r in out["originals"].collect()] == [(1, "old")]
    assert {tuple(r) for r in out["reviews"].collect()} == {(1, None, "", "now"), (4, "approved", "", None)}

    h = "page int, status string, note string, transcript_sha256 string, evidence_sha256 string"
    present = spark.createDataFrame([(1, "t", "e")], "page int, transcript_sha256 string, evidence_sha256 string")
    stored = spark.createDataFrame([(9, "needs_fix", "n", None, None, None)], h + ", reviewed_at string")
    ok, refused = revisions.saved_reviews(stored, spark.createDataFrame([(1, "approved", " x ", "t", "e"), (2, "needs_fix", None, None, None)], h), present, F.lit("now"))
    assert {(r.page, r.status, r.note, r.reviewed_at) for r in ok.collect()} == {(1, "approved", "x", "now"), (2, "needs_fix", "", None), (9, "needs_fix", "n", None)} and refused.count() == 0
    kept, refused = revisions.saved_reviews(stored, spark.createDataFrame([(1, "approved", "", "old", "e"), (3, "approved", "", "t", "e"), (2, "maybe", "", None, None), (4, "needs_fix", "", None, None)], h), present, F.lit("now"))
    assert [r.page for r in kept.collect()] == [9]
    assert {r.page: r.reason.split(".")[0] for r in refused.collect()} == {1: "Approval refers to an older transcript or scan", 3: "cannot approve a page without a transcript", 2: "invalid review decision"}


def test_importing(spark):
    cur = spark.createDataFrame([(3, "base", "h3")], "page int, body string, sha256 string")
    texts = spark.createDataFrame([(3, "edited", "n3")], "page int, body string, sha256 string")
    entries = spark.createDataFrame([(3, "approved", ""), (5, "approved", "ok"), (6, "needs_fix", None)], "page int, status string, note string")
    present = spark.createDataFrame([(3, "n3", "e3")], "page int, transcript_sha256 string, evidence_sha256 string")
    out = revisions.imported(cur, spark.createDataFrame([], "page int, body string"), texts, entries, present, F.lit("2020"))
    s = out["summary"].first()
    assert (s.transcripts_imported, s.approvals_kept, s.approvals_withdrawn, s.review_entries) == ([3], [3], [5], 3)
    assert [tuple(r) for r in out["originals"].collect()] == [(3, "base")] and [r.body for r in out["transcripts"].collect()] == ["edited"]
    r = {x.page: x for x in out["reviews"].collect()}
    assert (r[3].transcript_sha256, r[3].reviewed_by) == ("n3", "hosted reviewer") and r[5].status is None and r[5].note.startswith("ok [approval withdrawn on import")


def test_hosted_reviews_and_runs(spark):
    e = "page int, status string, note string"
    prev = spark.createDataFrame([(1, "approved", "a", "t0", "x"), (2, None, "", "t0", "x"), (3, "needs_fix", "", "t0", "x")], e + ", decided_at string, decided_by string")
    got = revisions.hosted_reviews(prev, spark.createDataFrame([(1, "approved", "a"), (2, "approved", ""), (4, None, None)], e), F.lit("t1"), F.lit("y"))
    assert {(r.page, r.status, r.decided_at, r.decided_by) for r in got.collect()} == {(1, "approved", "t0", "x"), (2, "approved", "t1", "y"), (3, "needs_fix", "t0", "x"), (4, None, "t1", "y")}
    pages = spark.createDataFrame([(1, "i1", None), (2, "i2", "l2"), (3, None, None), (4, "i4", None)], "page int, image_sha256 string, layout_sha256 string")
    keys = revisions.cache_keys(pages, '{"model": "m"}')
    k = {r.page: r for r in keys.collect()}
    assert k[2].cache_key == canonical_hash('{"parameters":{"model":"m"},"image":"i2","layout":"l2"}') and k[2].file == f"page_002.{k[2].cache_key[:16]}.json"
    plan = revisions.run_plan(keys, spark.createDataFrame([(k[1].file,)], "file string"))
    res = spark.createDataFrame([(2, "stop", None), (4, "length", None)], "page int, finish_reason string, error string")
    s = revisions.run_summary(plan, res).first()
    assert (s.requested, s.completed, s.cached, s.failed) == ([1, 2, 3, 4], [2], [1], {"3": "page image is missing", "4": "model did not finish normally; output may be truncated"})
    assert {r.todo for r in revisions.run_plan(keys, spark.createDataFrame([(k[1].file,)], "file string"), force=True).where("page = 1").collect()} == {"run"}


def test_files_and_reports(spark, root, tmp_path):
    docs = exports.page_documents(spark.createDataFrame([(1, [("ሀ", None)]), (1000, None)], "page int, words array<struct<t:string,c:string>>"))
    assert exports.write_files(docs, str(tmp_path / "out")) == 2
    assert json.loads((tmp_path / "out/page_001.json").read_text()) == {"page": 1, "words": [{"t": "ሀ", "c": None}]} and (tmp_path / "out/page_1000.json").exists()
    assert exports.write_files(docs, str(tmp_path / "out")) == 2 and not list((tmp_path / "out").glob("*.part"))
    md = exports.audit_markdown(books.page_stats(spark, f"{root}/work/page_stats.json"))
    assert "- Pages analysed: 3\n- Content pages: 2\n- Blank scans excluded: 1" in md and "### No red detected — 1 page(s)\n\np.1\n" in md and "| 1 | 0.1% | 4 | 1 | 2 |" in md
    texts = spark.createDataFrame([(2, "b"), (1, "a")], "page int, body string")
    assert exports.combined_text(texts).first().body == "===== Page 1 =====\n\na\n\n===== Page 2 =====\n\nb\n"
    run = spark.createDataFrame([(1, "k" * 64, "{}", "[]", "{}", None), (2, "k" * 64, None, None, None, "bad")], "page int, cache_key string, raw_response string, layout string, transcript string, error string")
    assert sorted(r.name for r in exports.candidate_documents(run, "{}").collect()) == [f"page_001.{'k' * 16}.json", f"page_002.{'k' * 16}.error.json"]
    old = spark.createDataFrame([(1, ["x"]), (2, [])], "page int, review_flags array<string>")
    new = spark.createDataFrame([(2, ["y"]), (3, [])], "page int, review_flags array<string>")
    r = exports.report_document(old, new).first()
    assert (r.pages_checked, r.pages_flagged, r.flagged_pages, [x.page for x in r.reports]) == (3, 2, [1, 2], [1, 2, 3])
    s = exports.stats_document(old, new).first().stats
    assert list(s) == ["1", "2", "3"] and s["2"].review_flags == ["y"]


def test_paths_of_pages_over_999_are_those_of_the_sql(spark, tmp_path):
    import datetime

    import duckdb

    from folioflow.plans import ORACLE_SQL, QUERIES

    rows = [(i, p, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=i)) for i, p in [(4, 7), (8, 7), (12, 1000), (16, 1000), (20, 1001), (21, 1001), (24, 100)]]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got = QUERIES["candidate_files"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.select("page", "path").collect()) == sorted(c.execute(ORACLE_SQL["candidate_files"]).fetchall())
