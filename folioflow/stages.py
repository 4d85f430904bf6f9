"""The stages of a book on disk, each a composition of operators that reads files and writes files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.sqlparts import rounded
from .functions.udfs import json_hash
from .operators import book, drafts, rasters, reports, revisions, transcripts, validate
from .sources import books, exports
from .sources.pages import select_pages

KEY = "book_id"
_WORDS = "lines array<struct<`order`:long,looks_like_title:boolean,bbox:array<double>,words:array<struct<text:string,bbox:array<double>,conf:double,is_red:boolean>>>>, width int, height int, line_count int, word_count int"
_CELLS = "layout array<struct<`order`:int,category:string,text:string,bbox:array<double>>>"
_RED = "regions array<struct<bbox:array<double>,text:string>>"


def _documents(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """page, raw_json, x of the page files that match."""
    found = books.listed(spark, pattern)
    if not found:
        return spark.createDataFrame([], "page int, raw_json string").withColumn("x", F.from_json("raw_json", schema))
    raw = spark.read.text(found, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"page_(\d+)[^/]*\z", 1).cast("int").alias("page"), F.col("value").alias("raw_json"))
    return raw.withColumn("x", F.from_json("raw_json", schema))


def _truthy(path: str):
    """Whether a field of raw_json holds anything: not missing, null, empty, zero or false."""
    v = F.get_json_object("raw_json", path)
    return F.coalesce(~v.isin("", "null", "[]", "{}", "0", "false"), F.lit(False))


def evidence(spark: SparkSession, at: dict[str, str], pages: DataFrame) -> DataFrame:
    """page, raw_json, the hashes of its files, its analysis and the source's hash, for pages with a transcript."""
    out = pages
    for folder in revisions.EVIDENCE:
        end = "json" if folder == "layout" else "png"
        out = out.join(books.file_hashes(spark, f"{at[folder] if folder in at else at['work'] + '/' + folder}/page_*.{end}").withColumnRenamed("sha256", folder), "page", "left")
    stats = spark.createDataFrame([(books.read_text_or(spark, at["stats"], "{}"),)], "j string").select(F.explode(F.from_json("j", "map<string,string>")).alias("k", "stats_json"))
    source = json.loads(books.read_text_or(spark, at["manifest"], "{}")).get("source_sha256")
    return out.join(stats.select(F.col("k").cast("int").alias("page"), "stats_json"), "page", "left").withColumn("source_sha256", F.lit(source).cast("string"))


def _transcripts(spark: SparkSession, at: dict[str, str]) -> DataFrame:
    return books.load_transcripts(spark, at["transcripts"]).drop("page").withColumnRenamed("file_page", "page")


def present(spark: SparkSession, at: dict[str, str]) -> DataFrame:
    """The revision of every page with a transcript."""
    return revisions.revisions(evidence(spark, at, _transcripts(spark, at).select("page", "raw_json")))


def _dark(spark: SparkSession, folder: str, name: str) -> DataFrame:
    found = books.listed(spark, f"{folder}/page_*.png")
    if not found:
        return spark.createDataFrame([], f"page int, {name} long")
    i = spark.read.format("image").load(found).select("image.origin", "image.height", "image.width", "image.nChannels", "image.data")
    d = rasters.dark_pixels(i)
    return d.select(F.regexp_extract("origin", r"page_(\d+)\.png\z", 1).cast("int").alias("page"), F.col("dark").alias(name))


def verify(spark: SparkSession, root: str, pages: str = "all") -> dict:
    """Checks the asked pages, merges them into verification.json and returns its totals."""
    at = books.paths(root, "")
    asked = _asked(spark, at, pages)
    layout = _documents(spark, f"{at['layout']}/page_*.json", _WORDS)
    words = layout.select("page", F.posexplode("x.lines").alias("line", "l")).select("page", "line", F.posexplode("l.words").alias("word", "w")).select("page", "line", "word", "w.text")
    ocr = transcripts.layout_text(words).select("page", "ocr_text").join(layout.select("page", F.col("x.line_count").alias("ocr_lines")), "page", "right")
    ink = reports.red_ink_share(_dark(spark, at["red_layer"], "red_px").join(_dark(spark, at["black_layer"], "black_px"), "page"), ["page"])
    t = _transcripts(spark, at).withColumn("colour_from_mask", _truthy("$._provenance.red")).withColumn("unresolved", _truthy("$._colour_unresolved"))
    images = books.file_hashes(spark, f"{at['page_images']}/page_*.png").select("page", F.lit(True).alias("has_image"))
    p = asked.join(t, "page", "left").join(ocr.withColumn("has_layout", F.lit(True)), "page", "left").join(ink, "page", "left").join(images, "page", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    p = p.withColumns({"has_transcript": F.col("raw_json").isNotNull(), "source": F.col("_source"), **{c: yes(F.col(c)) for c in ("has_layout", "has_image", "colour_from_mask", "unresolved")}})
    c = transcripts.page_checks(p)
    three = lambda name: F.expr(rounded(name, 3))
    checks = c.select("page", F.struct(F.col("draft").alias("draft_transcript"), F.col("latin").alias("latin_chars"), F.col("digits").alias("ascii_digits"), three("model_red").alias("model_red_ratio"), three("mask_red").alias("mask_red_ratio"), F.col("ocr_lines").alias("tesseract_lines"), F.size("blocks").alias("model_blocks"), three("agreement").alias("text_agreement"), F.greatest(F.lit(0), F.size("uncertain")).alias("uncertain_words"), F.greatest(F.lit(0), F.size("clipped")).alias("clipped_lines")).alias("checks"))
    now = transcripts.page_flags(c).withColumnRenamed("flags", "review_flags").join(checks, "page").join(present(spark, at), "page", "left")
    kinds = now.select("review_flags", "checks", "transcript_sha256", "evidence_sha256").schema
    old = spark.createDataFrame([(books.read_text_or(spark, at["verification"], "{}"),)], "j string")
    row = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in kinds.fields)
    old = old.select(F.explode(F.from_json("j", f"reports array<struct<page:int,{row}>>")["reports"]).alias("r")).select("r.*")
    out = exports.report_document(old, now)
    exports.write_files(out.select(F.lit("verification.json").alias("name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("body")), at["work"])
    return out.select("pages_checked", "pages_flagged", "flagged_pages").first().asDict()


def _asked(spark: SparkSession, at: dict[str, str], pages: str) -> DataFrame:
    """The asked pages that have text: from the inventory of the source, without blank and illustrated ones."""
    total = total_pages(spark, at)
    own = spark.createDataFrame([(p,) for p in select_pages(pages, total)], "page int")
    return reports.pages_with_text(own, books.page_stats(spark, at["stats"]))


def total_pages(spark: SparkSession, at: dict[str, str]) -> int:
    known = json.loads(books.read_text_or(spark, at["manifest"], "{}")).get("pages")
    return int(known or books.page_stats(spark, at["stats"]).agg(F.max("page")).first()[0] or 0)


def audit(spark: SparkSession, root: str) -> str:
    """Writes red_audit.md and returns its text."""
    at = books.paths(root, "")
    text = exports.audit_markdown(books.page_stats(spark, at["stats"]))
    exports.write_files(spark.createDataFrame([("red_audit.md", text)], "name string, body string"), at["work"])
    return text


def adopt(spark: SparkSession, root: str, pages: str = "all", ignore: tuple[str, ...] = ()) -> dict:
    """Writes transcripts from the newest candidates and their red readings, keeps what they replace, and returns the summary."""
    at = books.paths(root, "")
    asked = _asked(spark, at, pages)
    files = books.latest_candidates(books.file_table(spark, f"{at['candidates']}/dots/page_*.json"))
    names = [r.path for r in files.collect()]  # one path per page of a book
    cells = spark.read.text(names, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"page_(\d+)\.", 1).cast("int").alias("page"), F.from_json("value", _CELLS).alias("x")) if names else spark.createDataFrame([], "page int, v string").select("page", F.from_json("v", _CELLS).alias("x"))
    red = _documents(spark, f"{at['candidates']}/dots-red/page_*.json", _RED)
    box = [F.col("c.bbox")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))]
    regions = cells.select("page", F.posexplode("x.layout").alias("ord", "c")).select("page", "ord", "c.category", "c.text", *box)
    readings = red.select("page", F.posexplode("x.regions").alias("ord", "c")).select("page", "ord", "c.text", *box)
    made = drafts.red_drafts(regions, readings, ignore).where("error IS NULL")
    kept = books.file_table(spark, f"{at['transcripts']}/page_*.json")
    texts = spark.read.text([r.path for r in kept.collect()], wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), F.col("value").alias("body")) if not kept.isEmpty() else spark.createDataFrame([], "name string, body string")
    existing = kept.select("page", "name").join(texts, "name")
    legacy = books.file_table(spark, f"{at['work']}/transcripts-legacy/page_*.json").select("name")
    outcomes, base, old = drafts.adopted(asked, files, red.select("page"), made, existing, legacy)
    summary = drafts.adopt_summary(outcomes).first().asDict()
    exports.write_files(old, f"{at['work']}/transcripts-legacy")
    fields = ["page", "page_header", "blocks", "notes", "corrections", "uncertain", "clipped", F.col("source").alias("_source"), F.struct(F.struct("red_regions").alias("red"), "red_regions", "red_located").alias("_provenance"), F.col("legacy").alias("_legacy")]
    exports.write_files(exports.page_documents(base.select(*fields)), at["transcripts"])
    # Sidecars of the replaced texts go, so that reverting restores the new baseline.
    fs = spark._jvm.org.apache.hadoop.fs.Path(at["transcripts"]).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in existing.where(F.col("name").endswith(".original.json")).join(outcomes.where("outcome = 'adopted'"), "page", "left_semi").select("name").collect():
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(at["transcripts"], r.name), False)
    return summary


def build(spark: SparkSession, root: str, pages: str = "all", require_ready: bool = False) -> dict:
    """Assembles the book, writes it pretty and compact, and returns its quality; refuses where a finished book is asked for and this is none."""
    b = books.load(spark, [root])
    own = b.first()
    at = books.paths(root, own.book_id)
    total = total_pages(spark, at)
    b = b.withColumn("total_pages", F.lit(total))
    keyed = lambda df: df.withColumn(KEY, F.lit(own.book_id))
    t = books.strict(_transcripts(spark, at).join(_asked(spark, at, pages), "page", "left_semi"))
    m = json.loads(books.read_text_or(spark, at["manifest"], "null") or "null")
    pdf = books.listed(spark, f"{root}/{own.source_pdf}") if own.source_pdf else books.listed(spark, f"{root}/source/*.pdf")
    digest = spark.read.format("binaryFile").load(pdf[0]).select(F.sha2("content", 256)).first()[0] if pdf else None
    manifest = spark.createDataFrame([(own.book_id, digest, (m.get("source_sha256"), m.get("pages"), m.get("dpi")) if m else None, own.dpi, total)], f"{KEY} string, source_sha256 string, manifest struct<source_sha256:string,pages:int,dpi:int>, dpi int, total_pages int")
    recorded = spark.createDataFrame([(own.book_id, int(k), v) for k, v in ((m or {}).get("rendered") or {}).items()], f"{KEY} string, page int, recorded string")
    renders = recorded.join(keyed(books.file_hashes(spark, f"{at['page_images']}/page_*.png")).withColumnRenamed("sha256", "actual"), [KEY, "page"], "full")
    out = book.build(b, book.transcript_blocks(keyed(t), [KEY]), books.section_rules(b), keyed(books.page_stats(spark, at["stats"])), keyed(present(spark, at)).join(keyed(t.select("page")), [KEY, "page"], "left_semi"), keyed(books.flags(spark, at["verification"])), keyed(books.reviews(spark, at["review"])), revisions.source_problems(manifest, renders), [KEY])
    row = out.first()
    quality = row.quality.asDict(True)
    if require_ready and not quality["production_ready"]:
        raise ValueError(f"output is not production-ready (status={quality['status']})")
    value = json.loads(out.select(F.to_json(F.struct(KEY, F.lit("2.1").alias("schema_version"), "title_am", "title_en", "tradition", "language", "script", "extraction", "quality", "front_matter", "sections_count", "sections"), {"ignoreNullFields": "false"})).first()[0])
    value["front_matter"], value["sections"] = value["front_matter"] or [], value["sections"] or []
    files = [(f"{own.book_id}.json", json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False) + "\n"), (f"{own.book_id}.min.json", json.dumps(value, ensure_ascii=False, separators=(",", ":"), allow_nan=False) + "\n")]
    exports.write_files(spark.createDataFrame(files, "name string, body string"), at["out"])
    return quality


def import_export(spark: SparkSession, root: str, path: str) -> dict:
    """Merges a hosted export into a book: texts, originals, history and decisions; returns the summary."""
    own = books.load(spark, [root]).first()
    at = books.paths(root, own.book_id)
    export = json.loads(books.read_text_or(spark, path, "{}"))
    if export.get("book_id") != own.book_id:
        raise ValueError(f"export is for {export.get('book_id')!r}, not {own.book_id!r}")
    pages, entries = exports.read_export(spark, path)
    history = export.get("edit_history", {})
    marks = spark.createDataFrame([(int(k.removeprefix("page_")), json.dumps(v, ensure_ascii=False)) for k, v in history.items()], "page int, mark string")
    body = F.concat(F.regexp_replace("raw_json", r"\}\s*\z", ""), F.lit(',"_review_edit":'), F.coalesce("mark", F.lit("{}")), F.lit("}"))
    texts = books.strict(pages.join(marks, "page", "left").withColumn("reason", validate.transcript_error("raw_json", "page", legacy=True)).select("page", body.alias("body"), "reason")).withColumn("sha256", json_hash(F.col("body")))
    saved = _transcripts(spark, at).select("page", F.col("raw_json").alias("body"), json_hash(F.col("raw_json")).alias("sha256"))
    first = books.file_table(spark, f"{at['transcripts']}/page_*.original.json").select("page", F.lit("").alias("body"))
    after = saved.join(texts.select("page"), "page", "left_anti").unionByName(texts).select("page", F.col("body").alias("raw_json"))
    out = revisions.imported(saved, first, texts, entries, revisions.revisions(evidence(spark, at, after)), F.lit(export.get("exported_at")).cast("string"))
    summary = out["summary"].first().asDict()
    name = lambda end: F.concat(F.format_string("page_%03d", F.col("page")), F.lit(end)).alias("name")
    # What is replaced is kept before anything is replaced.
    exports.write_files(out["history"].select(F.concat(F.col("page").cast("string"), F.lit("/"), "sha256", F.lit(".json")).alias("name"), "body"), f"{at['work']}/history")
    exports.write_files(out["originals"].where("body <> ''").select(name(".original.json"), "body"), at["transcripts"])
    stored = json.loads(books.read_text_or(spark, at["review"], '{"entries": {}}'))
    for r in out["reviews"].collect():  # the decisions of one book
        kept = {k: v for k, v in r.asDict().items() if k not in ("page", "withdrawn") and (v is not None or k == "status")}
        stored["entries"][str(r.page)] = kept
    exports.write_files(texts.select(name(".json"), "body"), at["transcripts"])
    exports.write_files(spark.createDataFrame([("review.json", json.dumps(stored, ensure_ascii=False, indent=2) + "\n")], "name string, body string"), at["work"])
    stamp = (export.get("exported_at") or "")[:19].replace(":", "")
    exports.write_files(spark.createDataFrame([(f"{own.book_id}_review_export_{stamp}.json", json.dumps(export, ensure_ascii=False) + "\n")], "name string, body string"), f"{at['work']}/review-exports")
    return summary


def library(spark: SparkSession, folder: str) -> list[dict]:
    """The books of a folder: titles, sections, pages rendered and transcribed. All books are read together."""
    b = books.load(spark, books.discover(spark, folder))
    name = lambda path, part: F.element_at(F.split(F.split(path, part)[0], "/"), -1)
    own = b.select(KEY, name("root", r"/\z").alias("_f"))
    of = lambda part: books.file_table(spark, f"{folder}/*/work/{part}").withColumn("_f", name("path", "/work/")).join(own, "_f")
    texts = of("transcripts/page_*.json").where(F.col("name").rlike(r"^page_\d{3,}\.json\z"))
    rows = reports.library(b, books.section_rules(b), of("page_images/page_*.png"), texts).collect()  # a row per book
    return [r.asDict() for r in sorted(rows, key=lambda r: r[KEY])]


def doctor(spark: SparkSession, root: str) -> dict:
    """What there is of a book; nothing is changed."""
    b = books.load(spark, [root])
    own = b.first()
    at = books.paths(root, own.book_id)
    keyed = lambda df: df.withColumn(KEY, F.lit(own.book_id))
    pdf = books.listed(spark, f"{root}/{own.source_pdf}") if own.source_pdf else books.listed(spark, f"{root}/source/*.pdf")
    table = spark.createDataFrame([(own.book_id, pdf[0] if pdf else None, books.read_text_or(spark, at["manifest"]))], f"{KEY} string, source_sha256 string, manifest string")
    texts = _transcripts(spark, at).select("page", F.col("_source").alias("source"))
    return reports.inventory(table, keyed(books.page_stats(spark, at["stats"])), keyed(texts), keyed(books.file_table(spark, f"{at['page_images']}/page_*.png"))).first().asDict()
