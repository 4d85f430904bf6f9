"""Books on a file system that Spark reads: their configs, files, transcripts and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import validate
from .pages import read_transcripts

CONFIG = "book.json"
_SECTION = "struct<section_id:string,`order`:int,title_am:string,title_en:string,category:string,weekday_am:string,weekday_en:string,keywords:array<string>,required_any:array<array<string>>,pages:array<int>>"
_CONFIG = f"book_id string, title_am string, title_en string, source_pdf string, tradition string, language array<string>, script string, publish boolean, sections array<{_SECTION}>, render struct<dpi:int>, split struct<blank_ink_ratio:double>, ocr struct<tesseract_lang:string,model:string,effort:string,provider:string>"
#: What a config that does not say otherwise means (fixed values).
DEFAULTS = {"dpi": 300, "blank_ink_ratio": 0.01, "tesseract_lang": "amh", "effort": "high", "provider": "dots"}
#: Folders of a book's work, and its files there (fixed values).
FOLDERS = ("page_images", "red_mask", "black_layer", "red_layer", "debug", "layout", "transcripts", "candidates")
FILES = {"stats": "page_stats.json", "verification": "verification.json", "review": "review.json", "manifest": "source_manifest.json"}


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order, on whatever file system it names; a few per book."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found is not None else []


def discover(spark: SparkSession, folder: str) -> list[str]:
    """The book folders under a folder: those with a config, in order."""
    return [p.rsplit("/", 1)[0] for p in listed(spark, f"{folder}/*/{CONFIG}")]


def read_text_or(spark: SparkSession, path: str, default: str | None = None) -> str | None:
    """A small file's text, or the default where there is none."""
    if not listed(spark, path):
        return default
    return spark.read.text(path, wholetext=True).first()[0]


def load(spark: SparkSession, roots: list[str]) -> DataFrame:
    """One row per book: root, its config with the defaults in place, sections as they stand. A folder without a config is an error."""
    missing = [r for r in roots if not listed(spark, f"{r}/{CONFIG}")]
    if missing:
        raise FileNotFoundError(f"{missing[0]}/{CONFIG} not found")
    if not roots:
        raw = spark.createDataFrame([], "value string, path string")
    else:
        raw = spark.read.text([f"{r}/{CONFIG}" for r in roots], wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    x = raw.select(F.regexp_replace("path", r"/[^/]*\z", "").alias("root"), F.from_json("value", _CONFIG).alias("c"))
    name = F.coalesce("c.book_id", F.element_at(F.split("root", "/"), -1))
    either = lambda field, key: F.coalesce(f"c.{field}", F.lit(DEFAULTS[key])).alias(key)
    return x.select(
        name.alias("book_id"), "root", F.coalesce("c.title_am", F.lit("")).alias("title_am"), F.coalesce("c.title_en", name).alias("title_en"),
        "c.tradition", "c.language", "c.script", F.coalesce("c.publish", F.lit(False)).alias("publish"), "c.source_pdf",
        F.coalesce("c.sections", F.expr(f"cast(array() as array<{_SECTION}>)")).alias("sections"),
        either("render.dpi", "dpi"), either("split.blank_ink_ratio", "blank_ink_ratio"), "c.ocr.model", *[either(f"ocr.{k}", k) for k in ("tesseract_lang", "effort", "provider")],
    )


def section_rules(books: DataFrame) -> DataFrame:
    """book_id, pos (place in the table), section_id, ord, titles, category, weekdays, keywords, required_any, first_page, last_page."""
    s = books.select("book_id", F.posexplode("sections").alias("pos", "s"))
    fields = ("title_am", "title_en", "category", "weekday_am", "weekday_en", "keywords", "required_any")
    return s.select("book_id", "pos", "s.section_id", F.coalesce("s.order", F.lit(0)).alias("ord"), *[F.col(f"s.{f}").alias(f) for f in fields], F.try_element_at("s.pages", F.lit(1)).alias("first_page"), F.try_element_at("s.pages", F.lit(2)).alias("last_page"))


def source_pdf(spark: SparkSession, root: str, config: str | None = None) -> str:
    """A book's original: the one its config names, else the first PDF of its source folder."""
    if config:
        return f"{root}/{config}"
    found = listed(spark, f"{root}/source/*.pdf")
    if not found:
        raise FileNotFoundError(f"no PDF in {root}/source")
    return found[0]


def paths(root: str, book_id: str) -> dict[str, str]:
    """Where a book's tables and files are."""
    work = f"{root}/work"
    return {"work": work, "out": f"{root}/out", **{f: f"{work}/{f}" for f in FOLDERS}, **{k: f"{work}/{v}" for k, v in FILES.items()}, "book_json": f"{root}/out/{book_id}.json", "book_json_min": f"{root}/out/{book_id}.min.json"}


def load_transcripts(spark: SparkSession, folder: str, pages: DataFrame | None = None) -> DataFrame:
    """Canonical transcripts with `reason`, null for valid ones (legacy files may lack review lists); of the asked pages (page) only, absent ones left out."""
    t = read_transcripts(spark, folder)
    t = t.withColumn("reason", validate.transcript_error("raw_json", "file_page", legacy=True))
    return t if pages is None else t.join(pages.select(F.col("page").alias("file_page")).distinct(), "file_page", "left_semi")


def strict(df: DataFrame) -> DataFrame:
    """df without its `reason`; a row that has one fails the query with it."""
    checked = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("boolean")).otherwise(F.lit(True))
    return df.where(checked).drop("reason")


_MEASURES = "width int, height int, red_ink_pixels long, black_ink_pixels long, red_components_kept int, red_components_dropped_small int, red_components_dropped_ornament int, red_ink_ratio double, ink_coverage double, colour_area double, is_blank boolean, is_illustration boolean"


def stats_of(raw: DataFrame, column: str = "value") -> DataFrame:
    """page and its measures of page-keyed JSON maps."""
    fields = ", ".join(":".join(m.split()) for m in _MEASURES.split(", "))
    s = raw.select(F.explode(F.from_json(column, f"map<string, struct<{fields}>>")).alias("k", "s"))
    return s.select(F.col("k").cast("int").alias("page"), "s.*")


def flags_of(raw: DataFrame, column: str = "value") -> DataFrame:
    """page, review_flags, transcript_sha256, evidence_sha256 of reports in JSON."""
    x = raw.select(F.from_json(column, "reports array<struct<page:int,review_flags:array<string>,transcript_sha256:string,evidence_sha256:string>>").alias("x"))
    return x.select(F.explode("x.reports").alias("r")).select("r.*")


def reviews_of(raw: DataFrame, column: str = "value") -> DataFrame:
    """page, status, note, hashes and stamps of reviews in JSON, whose entries are keyed by page."""
    x = raw.select(F.from_json(column, "entries map<string,struct<status:string,note:string,transcript_sha256:string,evidence_sha256:string,reviewed_at:string,invalidated_at:string>>").alias("x"))
    return x.select(F.explode("x.entries").alias("k", "e")).select(F.col("k").cast("int").alias("page"), "e.*")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame([(read_text_or(spark, path, "{}"),)], "value string")


def page_stats(spark: SparkSession, path: str) -> DataFrame:
    """stats_of a file; no file, no rows."""
    return stats_of(_stored(spark, path))


def flags(spark: SparkSession, path: str) -> DataFrame:
    """flags_of a file; no file, no rows."""
    return flags_of(_stored(spark, path))


def reviews(spark: SparkSession, path: str) -> DataFrame:
    """reviews_of a file; no file, no rows."""
    return reviews_of(_stored(spark, path))


def read_page_map(spark: SparkSession, path: str) -> DataFrame:
    """An earlier page map (CSV with a header): page as a number, all else as text; no file, no rows."""
    names = ("section_id", "ocr_source", "ocr_language", "psm", "confidence", "variants_tried", "notes")
    if not listed(spark, path):
        return spark.createDataFrame([], "page int, " + ", ".join(f"{n} string" for n in names))
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return raw.select(F.col("page").cast("int").alias("page"), *[F.col(n) if n in raw.columns else F.lit(None).cast("string").alias(n) for n in names])


def file_table(spark: SparkSession, pattern: str) -> DataFrame:
    """path, name, page (null without a page name), modified, size of the files that match; contents are not read."""
    found = listed(spark, pattern)
    if not found:
        return spark.createDataFrame([], "path string, name string, page int, modified timestamp, size long")
    f = spark.read.format("binaryFile").load(found).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    return f.select("path", "name", F.expr(r"try_cast(nullif(regexp_extract(name, '^page_(\\d+)\\.', 1), '') as int)").alias("page"), "modified", "size")


def file_hashes(spark: SparkSession, pattern: str) -> DataFrame:
    """page, sha256 of every page file that matches."""
    found = listed(spark, pattern)
    if not found:
        return spark.createDataFrame([], "page int, sha256 string")
    f = spark.read.format("binaryFile").load(found)
    return f.select(F.regexp_extract("path", r"page_(\d+)\.[^/]*\z", 1).cast("int").alias("page"), F.sha2("content", 256).alias("sha256"))


def latest_candidates(files: DataFrame) -> DataFrame:
    """page, path of the newest candidate file of each page; names are page_N.KEY.json with 16 hex digits."""
    c = files.withColumn("_p", F.regexp_extract("name", r"^page_(\d+)\.[0-9a-f]{16}\.json\z", 1)).where("_p <> ''")
    return c.groupBy(F.col("_p").cast("int").alias("page")).agg(F.max_by("path", F.struct("modified", "path")).alias("path"))


def known_pages(totals: DataFrame, stored: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """Every page of each book from 1 to its max_page, with what is stored for it (null where nothing is)."""
    every = totals.where("max_page >= 1").select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), F.col("max_page").cast("long"))).alias(page))
    return every.join(stored, [*keys, page], "left")


def protected_pages(reviews_: DataFrame, originals: DataFrame, page: str = "page") -> DataFrame:
    """page, why: pages a person worked on, approved ones before those with a copy of their first text."""
    a = reviews_.where("status = 'approved'").select(page, F.struct(F.lit(0).alias("o"), F.lit("approved").alias("why")).alias("w"))
    o = originals.select(page, F.struct(F.lit(1).alias("o"), F.lit("edited by hand").alias("why")).alias("w"))
    return a.unionByName(o).groupBy(page).agg(F.min("w")["why"].alias("why"))
