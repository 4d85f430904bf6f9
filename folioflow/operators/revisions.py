"""Revisions of pages, the integrity of their evidence, and what saving and importing change.

A revision is two hashes: of the transcript's canonical JSON, and of the page's
evidence (five files, its classification, the source).  Both are expressions over
a row; stored tables change by joins on the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.udfs import json_hash
from . import transcripts

#: The files of a page that count as evidence (fixed values).
EVIDENCE = ("page_images", "red_mask", "black_layer", "red_layer", "layout")


def _quoted(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))


def evidence_hash(files: dict[str, Column], classification: Column, source: Column) -> Column:
    """SHA-256 of the canonical JSON of a page's evidence; hashes are hex strings or null, and a null one counts.

    The text is put together with sorted keys, which for hex strings is canonical.
    """
    values = {**files, "classification": classification, "source_sha256": source}
    pieces = [F.concat(F.lit(f'{"," if i else ""}"{k}":'), _quoted(values[k])) for i, k in enumerate(sorted(values))]
    return F.sha2(F.concat(F.lit("{"), *pieces, F.lit("}")), 256)


def revisions(pages: DataFrame, page: str = "page") -> DataFrame:
    """page, transcript_sha256, evidence_sha256.

    Columns of pages: raw_json (of the transcript), a hash per file of EVIDENCE,
    stats_json (the page's analysis, null without one), source_sha256.
    """
    # A missing analysis is hashed as the JSON null.
    kind = json_hash(F.coalesce("stats_json", F.lit("null")))
    return pages.select(page, json_hash(F.col("raw_json")).alias("transcript_sha256"), evidence_hash({k: F.col(k) for k in EVIDENCE}, kind, F.col("source_sha256")).alias("evidence_sha256"))


def matching(records: DataFrame, present: DataFrame, *keys: str) -> DataFrame:
    """records with `matches`: both of a record's hashes are those of its page's present revision; a missing hash, or page, never is."""
    keys = keys or ("page",)
    r = present.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("transcript_sha256").alias("_t"), F.col("evidence_sha256").alias("_e"), F.lit(True).alias("_known"))
    on = None
    for k in keys:
        one = F.col(k) == F.col(f"_{k}")
        on = one if on is None else on & one
    same = F.col("_known") & (F.col("transcript_sha256") == F.col("_t")) & (F.col("evidence_sha256") == F.col("_e"))
    return records.join(r, on, "left").withColumn("matches", F.coalesce(same, F.lit(False))).drop(*[f"_{k}" for k in keys], "_t", "_e", "_known")


def loaded(saved: DataFrame, present: DataFrame, page: str = "page") -> DataFrame:
    """A page's transcript with the revision that a later save or approval has to name."""
    return saved.join(present.select(page, F.col("transcript_sha256").alias("revision"), F.col("evidence_sha256").alias("evidence_revision")), page)


def source_problems(books: DataFrame, renders: DataFrame, key: str = "book_id") -> DataFrame:
    """key, issues: what is wrong with a book's source, in order.

    books: key, source_sha256 (of the file, null if it is gone), manifest (struct
    source_sha256, pages, dpi; null without one), dpi, total_pages.  renders: key,
    page, recorded, actual (hash of the page image in the manifest and on disk).
    Without a manifest nothing after it is checked.
    """
    m = F.col("manifest")
    # A page that neither side lists is missing too.
    every = books.where("total_pages >= 1 AND manifest IS NOT NULL").select(key, F.explode(F.sequence(F.lit(1), F.col("total_pages").cast("int"))).alias("page"))
    bad = every.join(renders, [key, "page"], "left").where("actual IS NULL OR recorded IS NULL OR recorded <> actual")
    listed = F.transform(F.sort_array(F.collect_list("page")), lambda p: F.concat(F.lit("page "), p.cast("string"), F.lit(": original render is missing or changed")))
    pages = bad.groupBy(key).agg(listed.alias("_pages"))
    say = lambda cond, text: F.when(cond, F.lit(text))
    gone = F.col("source_sha256").isNull()
    head = F.array_compact(F.array(say(gone, "original PDF is missing"), say(m.isNull(), "source manifest is missing; render the original PDF")))
    rest = F.array_compact(
        F.array(
            say(gone | ~m["source_sha256"].eqNullSafe(F.col("source_sha256")), "source PDF does not match the render manifest"),
            say(~m["pages"].eqNullSafe(F.col("total_pages")) | (F.col("total_pages") < 1), "source page count does not match the render manifest"),
            say(~m["dpi"].eqNullSafe(F.col("dpi")), "render resolution changed"),
        )
    )
    none = F.expr("cast(array() as array<string>)")
    return books.join(pages, key, "left").select(key, F.when(m.isNull(), head).otherwise(F.concat(head, rest, F.coalesce("_pages", none))).alias("issues"))


# ---- stored reviews and transcripts -------------------------------------------


def saved_reviews(stored: DataFrame, decisions: DataFrame, present: DataFrame, stamp: Column, page: str = "page") -> tuple[DataFrame, DataFrame]:
    """(entries, refused) after merging decisions into the stored review.

    All tables: page, status, note, transcript_sha256, evidence_sha256; stored
    and entries also reviewed_at.  An approval needs the page's transcript and
    names the revision that is present; one that does not is refused, and with it
    the whole merge, as none may be half done.  Notes are stripped; other
    decisions replace what was stored.
    """
    d = matching(decisions.withColumn("note", tx.strip(F.coalesce("note", F.lit("")))), present, page)
    known = present.select(F.col(page).alias("_k"))
    d = d.join(known, F.col(page) == F.col("_k"), "left")
    wrong = (F.when(F.col(page) < 1, "invalid review page")
             .when(F.col("status").isNotNull() & ~F.col("status").isin("approved", "needs_fix"), "invalid review decision")
             .when((F.col("status") == "approved") & F.col("_k").isNull(), "cannot approve a page without a transcript")
             .when((F.col("status") == "approved") & ~F.col("matches"), "Approval refers to an older transcript or scan. Reload the page."))
    d = d.withColumn("reason", wrong)
    refused = d.where("reason IS NOT NULL").select(page, "reason")
    fields = ["status", "note", "transcript_sha256", "evidence_sha256"]
    any_ = refused.agg((F.count("*") > 0).alias("_stop"))
    new = d.withColumn("reviewed_at", F.when(F.col("status") == "approved", stamp)).select(page, *fields, "reviewed_at")
    new = new.join(F.broadcast(any_), F.lit(True)).where("NOT _stop").drop("_stop")
    kept = stored.join(new.select(page), page, "left_anti").select(page, *fields, "reviewed_at")
    return kept.unionByName(new), refused


def saved_transcripts(current: DataFrame, edits: DataFrame, reviews: DataFrame, originals: DataFrame, stamp: Column, page: str = "page") -> dict[str, DataFrame]:
    """What one save per page changes: outcomes, transcripts, originals, history, reviews.

    current: page, body, sha256; edits: page, body, sha256, base (the revision the
    edit started from, null for a new page).  An edit is saved where its base is
    the present hash.  A changed text goes to the history under its hash, the
    first one ever also to the originals; an approval of a changed page is
    withdrawn and stamped.
    """
    c = current.select(F.col(page).alias("_p"), F.col("body").alias("_body"), F.col("sha256").alias("_sha"))
    e = edits.join(c, F.col(page) == F.col("_p"), "left")
    e = e.withColumn("outcome", F.when(F.col("base").eqNullSafe(F.col("_sha")), "saved").when(F.col("_sha").isNull(), "The saved transcript no longer exists.").otherwise("This page changed since it was opened. Reload before saving."))
    done = e.where("outcome = 'saved'")
    changed = done.where("_sha IS NOT NULL AND _sha <> sha256")
    moved = done.where("_sha IS NULL OR _sha <> sha256").select(F.col(page).alias("_p"))
    first = changed.join(originals.select(page), page, "left_anti").select(page, F.col("_body").alias("body"))
    r = reviews.join(moved, F.col(page) == F.col("_p"), "left")
    hit = F.col("_p").isNotNull() & (F.col("status") == "approved")
    hit = F.coalesce(hit, F.lit(False))
    kept = current.join(done.select(page), page, "left_anti").select(page, "body", "sha256")
    return {
        "outcomes": e.select(page, "outcome"),
        "transcripts": kept.unionByName(done.select(page, "body", "sha256")),
        "originals": originals.select(page, "body").unionByName(first),
        "history": changed.select(page, F.col("_sha").alias("sha256"), F.col("_body").alias("body")),
        "reviews": r.select(page, F.when(~hit, F.col("status")).alias("status"), "note", F.when(hit, stamp).otherwise(F.col("invalidated_at")).alias("invalidated_at")),
    }


def imported(current: DataFrame, originals: DataFrame, texts: DataFrame, entries: DataFrame, present: DataFrame, exported_at: Column, page: str = "page") -> dict[str, DataFrame]:
    """What a hosted export changes: transcripts, originals, history, reviews, summary.

    texts: page, body, sha256 of the export; entries: its decisions; present: the
    revisions of the pages after the import, which surviving approvals adopt.
    """
    c = current.select(F.col(page).alias("_p"), F.col("body").alias("_body"), F.col("sha256").alias("_sha"))
    t = texts.join(c, F.col(page) == F.col("_p"), "left")
    changed = t.where("_sha IS NOT NULL AND _sha <> sha256")
    first = changed.join(originals.select(page), page, "left_anti").select(page, F.col("_body").alias("body"))
    r = transcripts.imported_reviews(entries, texts, page)
    r = r.join(present.select(page, "transcript_sha256", "evidence_sha256"), page, "left")
    ok = F.coalesce(F.col("status") == "approved", F.lit(False))
    hashes = [F.when(ok, F.col(c)).alias(c) for c in ("transcript_sha256", "evidence_sha256")]
    reviews = r.select(page, "status", "note", "withdrawn", *hashes, F.when(ok, exported_at).alias("reviewed_at"), F.when(ok, "hosted reviewer").alias("reviewed_by"))
    listed = lambda cond: F.sort_array(F.collect_list(F.when(cond, F.col(page))))
    kept = reviews.agg(listed(F.col("status") == "approved").alias("approvals_kept"), listed(F.col("withdrawn")).alias("approvals_withdrawn"), F.count("*").alias("review_entries"))
    pages = texts.agg(F.sort_array(F.collect_list(page)).alias("transcripts_imported"))
    return {
        "transcripts": current.join(texts.select(page), page, "left_anti").select(page, "body", "sha256").unionByName(texts.select(page, "body", "sha256")),
        "originals": originals.select(page, "body").unionByName(first),
        "history": changed.select(page, F.col("_sha").alias("sha256"), F.col("_body").alias("body")),
        "reviews": reviews,
        # Two tables of one row each.
        "summary": pages.join(kept, F.lit(True)),
    }


def hosted_reviews(previous: DataFrame, decisions: DataFrame, stamp: Column, by: Column, page: str = "page") -> DataFrame:
    """page, status, note, decided_at, decided_by: a decision that changes something is stamped, others stay as they were, and pages that nobody decided stay."""
    p = previous.select(F.col(page).alias("_p"), *[F.col(c).alias(f"_{c}") for c in ("status", "note", "decided_at", "decided_by")])
    j = decisions.select(page, "status", F.coalesce("note", F.lit("")).alias("note")).join(p, F.col(page) == F.col("_p"), "full")
    new = F.col(page).isNotNull() & (F.col("_p").isNull() | ~F.col("status").eqNullSafe(F.col("_status")) | ~F.col("note").eqNullSafe(F.col("_note")))
    pick = lambda c, value: F.when(new, value).otherwise(F.col(f"_{c}")).alias(c)
    return j.select(F.coalesce(page, "_p").alias(page), pick("status", F.col("status")), pick("note", F.col("note")), pick("decided_at", stamp), pick("decided_by", by))


def hosted_outcomes(saves: DataFrame) -> DataFrame:
    """saves with outcome: saved where the save time it began with (base, null for the first text) is that of the present version (cur), else who saved in between (by)."""
    return saves.withColumn("outcome", F.when(F.col("base").eqNullSafe(F.col("cur")), "saved").otherwise(F.concat(F.coalesce("by", F.lit("Someone")), F.lit(" saved this page"))))


def cache_keys(pages: DataFrame, parameters: str, page: str = "page") -> DataFrame:
    """page, cache_key, file: the key of a candidate from the run's parameters (JSON) and the hashes of image and layout, and its file name."""
    value = F.concat(F.lit('{"image":'), _quoted(F.col("image_sha256")), F.lit(',"layout":'), _quoted(F.col("layout_sha256")), F.lit(f',"parameters":{parameters}}}'))
    key = json_hash(value)
    out = pages.select(page, "image_sha256", key.alias("cache_key"))
    return out.select(page, "cache_key", F.concat(tx.page_stem(F.col(page)), F.lit("."), F.substring("cache_key", 1, 16), F.lit(".json")).alias("file"), F.col("image_sha256").isNull().alias("missing_image"))


def run_plan(keys: DataFrame, done: DataFrame, force: bool = False, page: str = "page") -> DataFrame:
    """page, todo: failed (its image is missing), cached (a candidate of its key is there) or run. keys: of cache_keys; done: file."""
    have = done.select("file", F.lit(True).alias("_have")).distinct()
    cached = F.lit(False) if force else F.col("_have").isNotNull()
    return keys.join(have, "file", "left").select(page, F.when(F.col("missing_image"), "failed").when(cached, "cached").otherwise("run").alias("todo"))


def run_summary(plan: DataFrame, results: DataFrame, page: str = "page", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per book (keys): requested, completed, cached (sorted pages), failed (page to error).

    plan: of run_plan; results: page, finish_reason, error of the pages that ran.
    A page whose reading did not stop by itself failed, whatever it says.
    """
    j = plan.join(results, [*keys, page], "left")
    error = F.when(F.col("todo") == "failed", "page image is missing").when((F.col("todo") == "run") & F.col("error").isNotNull(), F.col("error")).when((F.col("todo") == "run") & ~F.col("finish_reason").eqNullSafe("stop"), "model did not finish normally; output may be truncated")
    j = j.withColumn("_error", error)
    listed = lambda cond, name: F.sort_array(F.collect_list(F.when(cond, F.col(page)))).alias(name)
    bad = F.sort_array(F.collect_list(F.when(F.col("_error").isNotNull(), F.struct(F.col(page).cast("string").alias("key"), F.col("_error").alias("value")))))
    return j.groupBy(*keys).agg(F.sort_array(F.collect_list(page)).alias("requested"), listed((F.col("todo") == "run") & F.col("_error").isNull(), "completed"), listed(F.col("todo") == "cached", "cached"), F.map_from_entries(bad).alias("failed"))
