"""Sinks of a book and the reader of a hosted export."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import archive, core, reports, transcripts


def write_json(path: str, value, compact: bool = False) -> None:
    """One JSON file, whole or not at all; NaN is refused."""
    text = json.dumps(value, ensure_ascii=False, allow_nan=False, **({"separators": (",", ":")} if compact else {"indent": 2})) + "\n"
    fd, part = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, path)
    except BaseException:
        os.unlink(part)
        raise


def write_book(book: DataFrame, folder: str, name: str) -> list[str]:
    """The row of a book as NAME.json and NAME.min.json."""
    rows = book.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a book is one row")
    paths = [os.path.join(folder, f"{name}.json"), os.path.join(folder, f"{name}.min.json")]
    for path, compact in zip(paths, (False, True), strict=True):
        write_json(path, json.loads(rows[0].j), compact)
    return paths


def page_texts(regions: DataFrame, page: str, order: str, text: str = "text") -> DataFrame:
    """Each page's non-empty region texts in order, a blank line between them."""
    some = F.when(F.coalesce(text, F.lit("")) != "", F.struct(F.col(order).alias("o"), F.col(text).alias("t")))
    parts = F.sort_array(F.collect_list(some))
    return regions.groupBy(page).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n\n").alias("body"))


def write_page_csv(pages: DataFrame, path: str) -> None:
    pages.write.option("header", True).mode("overwrite").csv(path)


def write_files(files: DataFrame, folder: str) -> int:
    """Writes rows (name, body) as files of a folder on any file system Spark knows, each replaced in one step; how many.

    A name may hold folders below it.  A file is written beside its target and
    renamed over it, so a reader, or a crash, finds the old text or the new one.
    A book's pages come through one at a time; tables of files go through
    write.format("book"), whose tasks write them.
    """
    spark = files.sparkSession
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(root)
    context = hadoop.FileContext.getFileContext(root.toUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    n = 0
    for r in files.select("name", "body").toLocalIterator():
        target = hadoop.Path(root, r.name)
        part = hadoop.Path(target.getParent(), f".{target.getName()}.part")
        fs.mkdirs(target.getParent())
        out = fs.create(part, True)
        try:
            out.write(bytearray(r.body.encode()))
        finally:
            out.close()
        context.rename(part, target, over)
        n += 1
    return n


def page_documents(df: DataFrame, page: str = "page", suffix: str = "json") -> DataFrame:
    """name, body of one JSON document per row (layouts, transcripts): page_NNN.json, nulls kept."""
    body = F.concat(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), F.lit("\n"))
    return df.select(F.concat(tx.page_stem(F.col(page)), F.lit(f".{suffix}")).alias("name"), body.alias("body"))


def candidate_documents(results: DataFrame, parameters: str, page: str = "page") -> DataFrame:
    """name, body of the records of a run: accepted candidates, and errors under a name of their own, so neither replaces the other.

    results: page, cache_key, raw_response, layout, transcript, error.
    """
    failed = F.col("error").isNotNull()
    good = F.to_json(F.struct(F.lit("draft").alias("status"), "raw_response", "layout", "transcript"), {"ignoreNullFields": "false"})
    bad = F.to_json(F.struct(F.lit("failed").alias("status"), page, "error", "raw_response", F.lit(parameters).alias("parameters")), {"ignoreNullFields": "false"})
    stem = F.concat(tx.page_stem(F.col(page)), F.lit("."), F.substring("cache_key", 1, 16))
    return results.select(F.concat(stem, F.when(failed, ".error.json").otherwise(".json")).alias("name"), F.when(failed, bad).otherwise(good).alias("body"))


def combined_text(texts: DataFrame, page: str = "page", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, body: every page's text under a banner, in page order. A book's text is one file, so it is one row; keys name the book."""
    one = F.concat(F.lit("===== Page "), F.col(page).cast("string"), F.lit(" =====\n\n"), F.col("body"), F.lit("\n"))
    return texts.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(page, one.alias("t")))), lambda x: x["t"]), "\n").alias("body"))


def text_files(pages: DataFrame, column: str, page: str = "page") -> DataFrame:
    """name, body of a text column (raw or clean) as one file per page."""
    return pages.select(F.concat(tx.page_stem(F.col(page)), F.lit(".txt")).alias("name"), F.coalesce(column, F.lit("")).alias("body"))


def _pages(numbers) -> str:
    return ", ".join(f"p.{n}" for n in numbers) if numbers else "_none_"


def audit_markdown(stats: DataFrame, page: str = "page") -> str:
    """The red-ink audit of one book as Markdown: counts, the three lists, a line per page with text. A book's pages are a file's lines."""
    book = [F.lit(0).alias("_b")]
    own = stats.select("*", *book)
    n = own.agg(F.count("*").alias("n"), F.count_if(F.coalesce("is_blank", F.lit(False))).alias("blank"), F.count_if(F.coalesce("is_illustration", F.lit(False))).alias("pictures")).first()
    found = reports.audit_lists(own, ["_b"], page).first()
    rows = reports.content_pages(stats).orderBy(page)
    out = ["# Red-ink coverage audit", "", f"- Pages analysed: {n.n}", f"- Content pages: {rows.count()}", f"- Blank scans excluded: {n.blank}", f"- Colour illustrations excluded: {n.pictures}", "", "## Pages to check by eye", ""]
    for title, key in (("No red detected", "no_red"), ("Red over 70% of ink", "too_much_red"), ("Ornament dropped", "ornaments")):
        pages = found[key] if found else []
        out += [f"### {title} — {len(pages)} page(s)", "", _pages(pages), ""]
    out += ["## Every content page", "", "| Page | Red % of ink | Glyph groups | Ornaments dropped | Speckle dropped |", "| ---: | ---: | ---: | ---: | ---: |"]
    for r in rows.toLocalIterator():
        out.append(f"| {r[page]} | {(r.red_ink_ratio or 0.0) * 100:.1f}% | {r.red_components_kept} | {r.red_components_dropped_ornament} | {r.red_components_dropped_small} |")
    return "\n".join(out) + "\n"


def extraction_markdown(title: str, facts: dict, sections: DataFrame, confidence, quality, rows: DataFrame, shown: int = 120) -> str:
    """The archived extraction report of one book: facts of the run, sections found, confidence, pages to look at (`shown` of the doubtful ones, and how many more), unassigned pages.

    confidence and quality: rows of confidence_summary and quality_report.
    """
    found = sections.orderBy("ord").collect()  # a book's section table
    low, review = quality.pages_with_low_confidence, quality.pages_requiring_manual_review
    free = [r.page for r in rows.where(F.col("section_id") == archive.UNASSIGNED).orderBy("page").select("page").toLocalIterator()]
    known = sum(r.start_page is not None for r in found)
    out = [f"# {title}", "", *[f"- {k}: {v}" for k, v in facts.items()], "", "## Sections", "", f"- Found: {known} / {len(found)}", "", "| Order | Section | Start | End | Score |", "| ---: | --- | ---: | ---: | ---: |"]
    out += [f"| {r.ord} | `{r.section_id}` | {r.start_page or ''} | {r.end_page or ''} | {r.score} |" for r in found]
    out += ["", "## Confidence", "", *[f"- {k.capitalize()}: {confidence[k]}" for k in ("min", "median", "mean", "max")], f"- Pages requiring manual review: {len(review)}", f"- Low-confidence or low-text pages: {', '.join(map(str, low[:shown])) or 'none'}"]
    if len(low) > shown:
        out.append(f"- Further low-confidence pages: {len(low) - shown}")
    out += ["", "## Page coverage", "", f"- Unassigned/front-matter pages: {', '.join(map(str, free)) or 'none'}", "", "## Sections to check", "", *[f"- {w}" for w in quality.missing_or_uncertain_sections or ["none"]]]
    return "\n".join(out) + "\n"


def report_document(old: DataFrame, new: DataFrame, page: str = "page", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per book (keys): pages_checked, pages_flagged, flagged_pages, reports, after new reports (page, review_flags, ...) replaced old ones of their page."""
    fields = [c for c in new.columns if c not in (page, *keys)]
    merged = core.upsert(old, new, [*keys, page], fields)
    totals = transcripts.report_totals(merged, page, "review_flags", keys)
    every = merged.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(page, *fields))).alias("reports"))
    return totals.join(every, list(keys)) if keys else totals.join(every, F.lit(True))


def stats_document(old: DataFrame, new: DataFrame, page: str = "page", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per book (keys), stats: page strings to measures in page order, after new pages replaced old ones."""
    fields = [c for c in new.columns if c not in (page, *keys)]
    merged = core.upsert(old, new, [*keys, page], fields)
    rows = F.sort_array(F.collect_list(F.struct(F.col(page).alias("k"), F.struct(*fields).alias("v"))))
    return merged.groupBy(*keys).agg(F.map_from_entries(F.transform(rows, lambda x: F.struct(x["k"].cast("string"), x["v"]))).alias("stats"))


def export_of(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(transcripts: page, raw_json; review entries: page, status, note) of hosted exports in JSON."""
    x = raw.select(F.from_json(column, "transcripts map<string,string>, review struct<entries:map<string,struct<status:string,note:string>>>").alias("x"))
    pages = x.select(F.explode("x.transcripts").alias("k", "raw_json")).select(F.regexp_extract("k", r"(\d+)$", 1).cast("int").alias("page"), "raw_json")
    entries = x.select(F.explode("x.review.entries").alias("k", "v")).select(F.col("k").cast("int").alias("page"), "v.*")
    return pages, entries


def read_export(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """export_of a file."""
    return export_of(spark.read.text(path, wholetext=True))
