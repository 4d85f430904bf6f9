"""Queries on revisions, reviews, saving, importing, validation and runs, with their SQL.

Documents stand for pages with their texts, labels for review decisions (quality 1:
approved, 0: needs_fix), events for a log of edits.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import storage
from ..functions import text as tx
from ..operators import drafts, revisions, transcripts, validate
from ..sources import book_format, books, exports
from ..sources.pages import canonical_page, page_map
from .catalogue import L, query, t

# ---- revisions ----------------------------------------------------------------

_Q = "coalesce(chr(34) || {x} || chr(34), 'null')"
_FILES = {"page_images": "sha256(lang)", "red_mask": "CASE WHEN n_chars % 3 > 0 THEN sha256(source) END", "black_layer": "sha256(source || lang)", "red_layer": "CASE WHEN lang <> 'de' THEN sha256('r' || doc_id) END", "layout": "sha256(text)"}
_STATS = "CASE WHEN n_chars % 5 > 0 THEN sha256('{\"is_blank\":' || CASE WHEN n_chars < 50 THEN 'true' ELSE 'false' END || ',\"n\":' || n_chars || '}') ELSE sha256('null') END"
_EVIDENCE = "sha256('{' || " + " || ',' || ".join(f"'\"{k}\":' || {_Q.format(x=x)}" for k, x in sorted({**_FILES, "classification": _STATS, "source_sha256": "CASE WHEN source <> 'src1' THEN sha256(source) END"}.items())) + " || '}')"
_RAW = "'{\"doc\":' || doc_id || ',\"lang\":\"' || lang || '\",\"page\":1.0}'"
_REV = f"SELECT doc_id AS page, sha256({_RAW}) AS transcript_sha256, {_EVIDENCE} AS evidence_sha256 FROM documents"


def _present(spark, d):
    """Raw texts with their keys out of order and blanks in them."""
    x = t(spark, d, "documents")
    sha = lambda c: F.sha2(c, 256)
    raw = F.concat(F.lit('{"page": 1.0, "lang": "'), "lang", F.lit('",\n "doc": '), F.col("doc_id").cast("string"), F.lit("}"))
    stats = F.concat(F.lit('{"n": '), F.col("n_chars").cast("string"), F.lit(', "is_blank": '), F.when(F.col("n_chars") < 50, "true").otherwise("false"), F.lit("}"))
    p = x.select(
        F.col("doc_id").alias("page"), raw.alias("raw_json"), sha("lang").alias("page_images"), F.when(F.col("n_chars") % 3 > 0, sha("source")).alias("red_mask"), sha(F.concat("source", "lang")).alias("black_layer"),
        F.when(F.col("lang") != "de", sha(F.concat(F.lit("r"), F.col("doc_id").cast("string")))).alias("red_layer"), sha("text").alias("layout"), F.when(F.col("n_chars") % 5 > 0, stats).alias("stats_json"), F.when(F.col("source") != "src1", sha("source")).alias("source_sha256"),
    )
    return revisions.revisions(p)


@query(_REV)
def page_revisions(spark, d):
    return _present(spark, d)


@query(f"""WITH r AS ({_REV}), k AS (SELECT l.doc_id AS page, CASE WHEN quality = 1 THEN 'approved' ELSE 'needs_fix' END AS status, CASE WHEN toxic = 0 THEN r.transcript_sha256 ELSE 'old' END AS t, CASE WHEN l.doc_id % 3 > 0 THEN r.evidence_sha256 END AS e FROM labels l LEFT JOIN r ON r.page = l.doc_id)
SELECT k.page, status, coalesce(k.t = r.transcript_sha256 AND k.e = r.evidence_sha256, false) AS matches FROM k LEFT JOIN r USING (page)""")
def revision_matches(spark, d):
    """Decisions whose two hashes are those of the page as it is; some are stale, some lack a hash."""
    return revisions.matching(_decisions(spark, d), _present(spark, d)).select("page", "status", "matches")


def _decisions(spark, d):
    p = _present(spark, d)
    l = t(spark, d, "labels").join(p, F.col("doc_id") == F.col("page"), "left")
    return l.select(F.col("doc_id").alias("page"), F.when(F.col("quality") == 1, "approved").otherwise("needs_fix").alias("status"), F.concat(F.lit(" n "), F.col("doc_id").cast("string")).alias("note"), F.when(F.col("toxic") == 0, F.col("transcript_sha256")).otherwise("old").alias("transcript_sha256"), F.when(F.col("doc_id") % 3 > 0, F.col("evidence_sha256")).alias("evidence_sha256"))


@query("""WITH b AS (SELECT n_nationkey AS book_id, n_regionkey AS r, CASE WHEN n_regionkey <> 1 THEN sha256(n_name) END AS src, n_regionkey <> 2 AS has, CASE WHEN n_regionkey = 3 THEN sha256('x') ELSE sha256(n_name) END AS msrc, CASE WHEN n_regionkey = 4 THEN 3 ELSE 4 END AS mpages, CASE WHEN n_nationkey % 2 = 0 THEN 300 ELSE 200 END AS dpi FROM nation),
s AS (SELECT s_nationkey AS book_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS page, sha256(s_name) AS recorded, CASE WHEN s_acctbal > 0 THEN sha256(s_name) WHEN s_acctbal > -500 THEN sha256('y') END AS actual FROM supplier),
p AS (SELECT b.book_id, string_agg('page ' || i || ': original render is missing or changed', '|' ORDER BY i) AS pages FROM b, range(1, 5) AS z(i) LEFT JOIN s ON s.book_id = b.book_id AND s.page = i WHERE s.actual IS NULL OR s.recorded <> s.actual GROUP BY 1)
SELECT b.book_id, concat_ws('|', CASE WHEN src IS NULL THEN 'original PDF is missing' END, CASE WHEN NOT has THEN 'source manifest is missing; render the original PDF' END, CASE WHEN has AND (src IS NULL OR src <> msrc) THEN 'source PDF does not match the render manifest' END,
  CASE WHEN has AND mpages <> 4 THEN 'source page count does not match the render manifest' END, CASE WHEN has AND dpi <> 300 THEN 'render resolution changed' END, CASE WHEN has THEN pages END) AS issues FROM b LEFT JOIN p USING (book_id)""")
def source_problems(spark, d):
    """Nations stand for books of four pages, suppliers for their renders."""
    n = t(spark, d, "nation")
    r = F.col("n_regionkey")
    m = F.struct(F.sha2(F.when(r == 3, "x").otherwise(F.col("n_name")), 256).alias("source_sha256"), F.when(r == 4, 3).otherwise(4).alias("pages"), F.when(F.col("n_nationkey") % 2 == 0, 300).otherwise(200).alias("dpi"))
    b = n.select(F.col("n_nationkey").alias("book_id"), F.when(r != 1, F.sha2("n_name", 256)).alias("source_sha256"), F.when(r != 2, m).alias("manifest"), F.lit(300).alias("dpi"), F.lit(4).alias("total_pages"))
    place = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    s = t(spark, d, "supplier").select(F.col("s_nationkey").alias("book_id"), place.alias("page"), F.sha2("s_name", 256).alias("recorded"), F.when(F.col("s_acctbal") > 0, F.sha2("s_name", 256)).when(F.col("s_acctbal") > -500, F.sha2(F.lit("y"), 256)).alias("actual"))
    return revisions.source_problems(b, s).select("book_id", F.array_join("issues", "|").alias("issues"))


# ---- saving -------------------------------------------------------------------


@query(f"""WITH r AS ({_REV}), k AS (SELECT l.doc_id AS page, CASE WHEN quality = 1 THEN 'approved' ELSE 'needs_fix' END AS status, CASE WHEN toxic = 0 THEN r.transcript_sha256 ELSE 'old' END AS t, CASE WHEN l.doc_id % 3 > 0 THEN r.evidence_sha256 END AS e, r.transcript_sha256 AS pt, r.evidence_sha256 AS pe, r.page IS NOT NULL AS known FROM labels l LEFT JOIN r ON r.page = l.doc_id),
w AS (SELECT *, CASE WHEN page < 1 THEN 'invalid review page' WHEN status = 'approved' AND NOT known THEN 'cannot approve a page without a transcript' WHEN status = 'approved' AND NOT coalesce(t = pt AND e = pe, false) THEN 'Approval refers to an older transcript or scan. Reload the page.' END AS reason FROM k)
SELECT 'refused' AS part, page, reason AS said FROM w WHERE reason IS NOT NULL
UNION ALL SELECT 'good', page, status || '/n ' || page || '/' || CASE WHEN status = 'approved' THEN 'now' ELSE '-' END FROM w WHERE reason IS NULL AND page >= 1
UNION ALL SELECT 'kept', doc_id, 'needs_fix/old/-' FROM documents WHERE doc_id NOT IN (SELECT page FROM w WHERE reason IS NULL AND page >= 1)""")
def review_saves(spark, d):
    """All decisions at once are refused for the stale ones among them; the good ones alone are merged into what was stored."""
    present, dec = _present(spark, d), _decisions(spark, d)
    stored = t(spark, d, "documents").select(F.col("doc_id").alias("page"), F.lit("needs_fix").alias("status"), F.lit("old").alias("note"), *[F.lit(None).cast("string").alias(c) for c in ("transcript_sha256", "evidence_sha256", "reviewed_at")])
    kept, refused = revisions.saved_reviews(stored, dec, present, F.lit("now"))
    good = dec.join(refused.select("page"), "page", "left_anti")
    entries, _ = revisions.saved_reviews(stored, good, present, F.lit("now"))
    said = F.concat_ws("/", "status", "note", F.coalesce("reviewed_at", F.lit("-")))
    new = entries.where("note <> 'old'").select(F.lit("good").alias("part"), "page", said.alias("said"))
    old = entries.where("note = 'old'").select(F.lit("kept").alias("part"), "page", said.alias("said"))
    # A refusal leaves everything as it was, so it adds no rows here.
    left = kept.where("note <> 'old'").select(F.lit("wrong").alias("part"), "page", said.alias("said"))
    return refused.select(F.lit("refused").alias("part"), "page", F.col("reason").alias("said")).unionByName(new).unionByName(old).unionByName(left)


@query("""WITH c AS (SELECT doc_id AS page, sha256(text) AS sha FROM documents WHERE lang <> 'de'), e AS (SELECT doc_id AS page, CASE WHEN n_chars % 4 = 0 THEN sha256(text) ELSE sha256(text || '!') END AS sha, CASE WHEN n_chars % 3 = 0 THEN sha256('stale') WHEN lang = 'de' AND n_chars % 3 = 1 THEN NULL ELSE sha256(text) END AS base FROM documents),
o AS (SELECT e.page, e.sha, c.sha AS cur, CASE WHEN e.base IS NOT DISTINCT FROM c.sha THEN 'saved' WHEN c.sha IS NULL THEN 'gone' ELSE 'conflict' END AS outcome FROM e LEFT JOIN c USING (page)), m AS (SELECT * FROM o WHERE outcome = 'saved')
SELECT o.page, outcome, CASE WHEN outcome = 'saved' THEN o.sha ELSE o.cur END AS stored, CASE WHEN outcome = 'saved' AND cur <> o.sha THEN cur END AS archived, outcome = 'saved' AND coalesce(cur <> o.sha, false) AND l.quality IS DISTINCT FROM 0 AS original, CASE WHEN l.quality = 1 AND NOT (outcome = 'saved' AND cur IS DISTINCT FROM o.sha) THEN 'approved' END AS status FROM o LEFT JOIN labels l ON l.doc_id = o.page""")
def transcript_saves(spark, d):
    """One edit per page: what is stored, archived and kept as an original, and which approvals are left."""
    x = t(spark, d, "documents").withColumn("sha", F.sha2("text", 256)).withColumnRenamed("doc_id", "page")
    cur = x.where("lang <> 'de'").select("page", F.col("text").alias("body"), F.col("sha").alias("sha256"))
    body = F.when(F.col("n_chars") % 4 == 0, F.col("text")).otherwise(F.concat("text", F.lit("!")))
    base = F.when(F.col("n_chars") % 3 == 0, F.sha2(F.lit("stale"), 256)).when((F.col("lang") == "de") & (F.col("n_chars") % 3 == 1), F.lit(None)).otherwise(F.col("sha"))
    edits = x.select("page", body.alias("body"), F.sha2(body, 256).alias("sha256"), base.alias("base"))
    l = t(spark, d, "labels").withColumnRenamed("doc_id", "page")
    rev = x.select("page").join(l, "page", "left").select("page", F.when(F.col("quality") == 1, "approved").alias("status"), F.lit("").alias("note"), F.lit(None).cast("string").alias("invalidated_at"))
    out = revisions.saved_transcripts(cur, edits, rev, l.where("quality = 0").select("page", F.lit("first").alias("body")), F.lit("now"))
    said = F.when(F.col("outcome") == "saved", "saved").when(F.col("outcome").startswith("The saved"), "gone").otherwise("conflict")
    j = out["outcomes"].select("page", said.alias("outcome")).join(out["transcripts"].select("page", F.col("sha256").alias("stored")), "page", "left")
    j = j.join(out["history"].select("page", F.col("sha256").alias("archived")), "page", "left").join(out["originals"].where("body <> 'first'").select("page", F.lit(True).alias("original")), "page", "left")
    return j.join(out["reviews"].select("page", "status"), "page", "left").select("page", "outcome", "stored", "archived", F.coalesce("original", F.lit(False)).alias("original"), "status")


@query("""WITH n AS (SELECT l.doc_id AS page, CASE WHEN l.quality = 1 THEN 'approved' ELSE 'needs_fix' END AS status, d.doc_id IS NOT NULL AS has, sha256(d.text) AS t FROM labels l LEFT JOIN (SELECT * FROM documents WHERE n_chars > 300) d ON d.doc_id = l.doc_id)
SELECT page, CASE WHEN status = 'approved' AND NOT has THEN NULL ELSE status END AS status, CASE WHEN status = 'approved' AND has THEN t END AS transcript_sha256, CASE WHEN status = 'approved' AND has THEN '2020' END AS reviewed_at, CASE WHEN status = 'approved' AND has THEN 'hosted reviewer' END AS reviewed_by,
  (SELECT count(*) FROM documents WHERE n_chars > 300) AS imported, (SELECT count(*) FROM n WHERE status = 'approved' AND has) AS kept, (SELECT count(*) FROM n WHERE status = 'approved' AND NOT has) AS withdrawn, (SELECT count(*) FROM n) AS entries,
  (SELECT count(*) FROM documents WHERE n_chars > 300 AND lang <> 'de') AS replaced FROM n""")
def export_import(spark, d):
    """Long documents came with the export, German ones are new to the book; every text differs from what was stored."""
    x = t(spark, d, "documents").withColumnRenamed("doc_id", "page")
    texts = x.where("n_chars > 300").select("page", F.col("text").alias("body"), F.sha2("text", 256).alias("sha256"))
    cur = x.where("lang <> 'de'").select("page", F.lit("old").alias("body"), F.sha2(F.lit("old"), 256).alias("sha256"))
    entries = t(spark, d, "labels").select(F.col("doc_id").alias("page"), F.when(F.col("quality") == 1, "approved").otherwise("needs_fix").alias("status"), F.lit(None).cast("string").alias("note"))
    present = texts.select("page", F.col("sha256").alias("transcript_sha256"), F.lit("e").alias("evidence_sha256"))
    out = revisions.imported(cur, x.where("false").select("page", F.col("text").alias("body")), texts, entries, present, F.lit("2020"))
    size = lambda c: F.size(c).cast("long")
    s = out["summary"].select(size("transcripts_imported").alias("imported"), size("approvals_kept").alias("kept"), size("approvals_withdrawn").alias("withdrawn"), F.col("review_entries").alias("entries"))
    return out["reviews"].select("page", "status", "transcript_sha256", "reviewed_at", "reviewed_by").join(s, F.lit(True)).join(out["originals"].agg(F.count("*").alias("replaced")), F.lit(True))


@query("""WITH p AS (SELECT doc_id AS page, CASE WHEN n_chars > 500 THEN 'approved' END AS status, lang AS note FROM documents WHERE lang <> 'de'), n AS (SELECT doc_id AS page, CASE WHEN quality = 1 THEN 'approved' ELSE 'needs_fix' END AS status, 'en' AS note FROM labels),
j AS (SELECT coalesce(n.page, p.page) AS page, n.page IS NOT NULL AND (p.page IS NULL OR n.status IS DISTINCT FROM p.status OR n.note <> p.note) AS new, n.status AS ns, n.note AS nn, p.status AS ps, p.note AS pn, p.page IS NOT NULL AS old FROM n FULL JOIN p ON n.page = p.page)
SELECT page, CASE WHEN new THEN ns ELSE ps END AS status, CASE WHEN new THEN nn ELSE pn END AS note, CASE WHEN new THEN 't1' ELSE 't0' END AS decided_at, CASE WHEN new THEN 'me' ELSE 'x' END AS decided_by FROM j""")
def hosted_review_merge(spark, d):
    p = t(spark, d, "documents").where("lang <> 'de'").select(F.col("doc_id").alias("page"), F.when(F.col("n_chars") > 500, "approved").alias("status"), F.col("lang").alias("note"), F.lit("t0").alias("decided_at"), F.lit("x").alias("decided_by"))
    n = t(spark, d, "labels").select(F.col("doc_id").alias("page"), F.when(F.col("quality") == 1, "approved").otherwise("needs_fix").alias("status"), F.lit("en").alias("note"))
    return revisions.hosted_reviews(p, n, F.lit("t1"), F.lit("me"))


@query("""WITH p AS (SELECT doc_id AS page FROM documents), c AS (SELECT doc_id AS page FROM documents WHERE lang <> 'de'), r AS (SELECT doc_id AS page FROM labels), o AS (SELECT p.page, CASE WHEN c.page IS NULL THEN 'missing_candidate' WHEN r.page IS NULL THEN 'missing_red' ELSE 'adopted' END AS outcome FROM p LEFT JOIN c USING (page) LEFT JOIN r USING (page))
SELECT outcome, count(*) AS pages, CAST(sum(CASE WHEN outcome = 'adopted' THEN page % 3 ELSE 0 END) AS BIGINT) AS uncertain, CAST(sum(CASE WHEN outcome = 'adopted' AND page % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN outcome = 'adopted' AND page % 4 <> 0 AND page % 2 = 0 OR outcome = 'adopted' AND page % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS linked FROM o GROUP BY 1""")
def adopt_candidates(spark, d):
    """Every second page has an earlier transcript (every fourth a sidecar), every fifth one a legacy copy of an earlier adoption."""
    x = t(spark, d, "documents").select(F.col("doc_id").alias("page"), "lang", F.array_repeat(F.struct(F.lit("u").alias("text")), (F.col("doc_id") % 3).cast("int")).alias("uncertain"))
    stem = tx.page_stem(F.col("page"))
    ex = x.where("page % 2 = 0").select("page", F.concat(stem, F.when(F.col("page") % 4 == 0, ".original.json").otherwise(".json")).alias("name"), F.lit("b").alias("body"))
    legacy = x.where("page % 5 = 0 AND (page % 2 = 1 OR page % 4 = 0)").select(F.concat(stem, F.lit(".json")).alias("name"))
    outcomes, base, kept = drafts.adopted(x.select("page"), x.where("lang <> 'de'").select("page"), t(spark, d, "labels").select(F.col("doc_id").alias("page")), x.select("page", "uncertain"), ex, legacy)
    j = outcomes.join(kept.select("page", F.lit(1).alias("k")), "page", "left").join(base.where("legacy IS NOT NULL").select("page", F.lit(1).alias("b")), "page", "left")
    return j.groupBy("outcome").agg(F.count("*").alias("pages"), F.sum("uncertain").cast("long").alias("uncertain"), F.sum(F.coalesce("k", F.lit(0))).cast("long").alias("kept"), F.sum(F.coalesce("b", F.lit(0))).cast("long").alias("linked"))


_KEY = "sha256('{\"image\":' || coalesce('\"' || i || '\"', 'null') || ',\"layout\":' || coalesce('\"' || l || '\"', 'null') || ',\"parameters\":{\"model\":\"m\",\"top_p\":0.9}}')"


@query(f"""WITH p AS (SELECT doc_id AS page, CASE WHEN lang <> 'de' THEN sha256(text) END AS i, CASE WHEN n_chars % 2 = 0 THEN sha256(lang) END AS l FROM documents), k AS (SELECT page, i IS NULL AS gone, {_KEY} AS cache_key FROM p)
SELECT page, cache_key, 'page_' || CASE WHEN page < 1000 THEN lpad(CAST(page AS VARCHAR), 3, '0') ELSE CAST(page AS VARCHAR) END || '.' || substr(cache_key, 1, 16) || '.json' AS file, CASE WHEN gone THEN 'failed' WHEN page IN (SELECT doc_id FROM labels) THEN 'cached' ELSE 'run' END AS todo FROM k""")
def run_plan(spark, d):
    """Which pages a run reads: those with an image whose candidate is not there yet (labelled ones are)."""
    x = t(spark, d, "documents").select(F.col("doc_id").alias("page"), F.when(F.col("lang") != "de", F.sha2("text", 256)).alias("image_sha256"), F.when(F.col("n_chars") % 2 == 0, F.sha2("lang", 256)).alias("layout_sha256"))
    keys = revisions.cache_keys(x, '{"top_p": 0.9, "model": "m"}')
    done = keys.join(t(spark, d, "labels").select(F.col("doc_id").alias("page")), "page", "left_semi").select("file")
    return keys.join(revisions.run_plan(keys, done), "page").select("page", "cache_key", "file", "todo")


@query("""WITH r AS (SELECT conv_id, turn AS page, CASE WHEN role = 'system' THEN 'failed' WHEN length(text) % 2 = 0 THEN 'cached' ELSE 'run' END AS todo, CASE WHEN length(text) % 3 = 0 THEN 'length' ELSE 'stop' END AS finish, CASE WHEN length(text) % 5 = 0 THEN 'broken ' || turn END AS err FROM conversations),
f AS (SELECT *, CASE WHEN todo = 'failed' THEN 'page image is missing' WHEN todo = 'run' AND err IS NOT NULL THEN err WHEN todo = 'run' AND finish <> 'stop' THEN 'model did not finish normally; output may be truncated' END AS error FROM r)
SELECT conv_id, count(*) AS requested, CAST(count(*) FILTER (todo = 'run' AND error IS NULL) AS BIGINT) AS completed, CAST(count(*) FILTER (todo = 'cached') AS BIGINT) AS cached, coalesce(string_agg(page || '=' || error, ';' ORDER BY CAST(page AS VARCHAR)) FILTER (error IS NOT NULL), '') AS failed FROM f GROUP BY 1""")
def run_summary(spark, d):
    """What became of the pages of each run: a conversation is one, its turns are the pages."""
    x = t(spark, d, "conversations").withColumnRenamed("turn", "page").withColumn("n", F.length("text"))
    plan = x.select("conv_id", "page", F.when(F.col("role") == "system", "failed").when(F.col("n") % 2 == 0, "cached").otherwise("run").alias("todo"))
    res = x.select("conv_id", "page", F.when(F.col("n") % 3 == 0, "length").otherwise("stop").alias("finish_reason"), F.when(F.col("n") % 5 == 0, F.concat(F.lit("broken "), F.col("page").cast("string"))).alias("error"))
    s = revisions.run_summary(plan, res, keys=("conv_id",))
    said = F.array_join(F.transform(F.sort_array(F.map_entries("failed")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    size = lambda c: F.size(c).cast("long").alias(c)
    return s.select("conv_id", size("requested"), size("completed"), size("cached"), said.alias("failed"))


# ---- the hosted store --------------------------------------------------------------


@query("""WITH o AS (SELECT conv_id, turn, CASE WHEN length(text) % 3 = 0 THEN 'missing_candidate' WHEN length(text) % 3 = 1 THEN 'missing_red' ELSE 'adopted' END AS outcome FROM conversations)
SELECT conv_id, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (outcome = 'adopted'), '') AS adopted, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (outcome = 'missing_candidate'), '') AS missing_candidate, coalesce(string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (outcome = 'missing_red'), '') AS missing_red, CAST(coalesce(sum(turn) FILTER (outcome = 'adopted'), 0) AS BIGINT) AS uncertain FROM o GROUP BY 1""")
def adopt_summary(spark, d):
    """What adopting came to in each book (a conversation)."""
    n = F.length("text") % 3
    x = t(spark, d, "conversations").withColumn("outcome", F.when(n == 0, "missing_candidate").when(n == 1, "missing_red").otherwise("adopted"))
    x = x.select("conv_id", F.col("turn").alias("page"), "outcome", F.when(F.col("outcome") == "adopted", F.col("turn")).otherwise(0).cast("long").alias("uncertain"))
    s = drafts.adopt_summary(x, keys=("conv_id",))
    return s.select("conv_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("adopted", "missing_candidate", "missing_red")], "uncertain")


@query("""WITH s AS (SELECT user_id AS page, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cur, lag(ts, 1 + CAST(event_id % 4 = 0 AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS base, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS who FROM events)
SELECT page, event_id, CASE WHEN base IS NOT DISTINCT FROM cur THEN 'saved' ELSE coalesce(who, 'Someone') || ' saved this page' END AS outcome FROM s""")
def hosted_saves(spark, d):
    """Each save names the time of the version it began with; a quarter name the one before it."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t(spark, d, "events").select(F.col("user_id").alias("page"), "event_id", F.lag("ts").over(w).alias("cur"), F.when(F.col("event_id") % 4 == 0, F.lag("ts", 2).over(w)).otherwise(F.lag("ts").over(w)).alias("base"), F.lag("event_type").over(w).alias("by"))
    return revisions.hosted_outcomes(e).select("page", "event_id", "outcome")


#: Faulty fields of a block and what the validator says of them (fixed values).
_BAD = {1: ('"type":"song"', "invalid block type"), 2: ('"verse_num_am":3', "verse number must be a string"), 3: ('"spans":{}', "spans must be an array"), 4: ('"spans":[{"t":"a","c":"blue"}]', "invalid text/colour span"), 5: ('"spans":[{"t":"a","c":"red"},7]', "invalid text/colour span")}


def _block(fault: str) -> str:
    """A block's JSON with one of its fields replaced."""
    fields = {'"type"': '"type":"verse"', '"verse_num_am"': '"verse_num_am":"v"', '"spans"': '"spans":[{"t":"x","c":"red"}]'}
    fields[fault.split(":")[0]] = fault
    return "{" + ",".join(fields.values()) + "}"


#: A transcript's JSON with a fault by k (Spark SQL).
_GOOD = '{"type":"prayer","spans":[{"t":"a","c":"black"}]}'
_FAULTY = (
    "concat('{\"page\":', CASE WHEN k = 6 THEN '\"1\"' WHEN k = 7 THEN cast(p + 1 as string) ELSE cast(p as string) END, ',', CASE WHEN k = 8 THEN '\"notes\":null,' WHEN k = 9 THEN '' ELSE '\"notes\":\"n\",' END, "
    + f"'\"blocks\":[{_GOOD},', CASE k {' '.join(f'WHEN {k} THEN {chr(39)}{_block(f)}{chr(39)}' for k, (f, _) in _BAD.items())} ELSE '{_GOOD}' END, '],', "
    + "CASE WHEN k = 10 THEN '\"corrections\":[],\"clipped\":[]' WHEN k = 11 THEN '\"corrections\":[{\"printed\":\"a\",\"suggested\":\"b\"}],\"uncertain\":3,\"clipped\":[]' ELSE '\"corrections\":[],\"uncertain\":[{\"text\":\"a\",\"why\":\"b\"}],\"clipped\":[]' END, '}')"
)
_REASON = "CASE WHEN k IN (6, 7) THEN 'transcript page does not match its filename' " + " ".join(f"WHEN k = {k} THEN '{m}'" for k, (_, m) in _BAD.items()) + " WHEN k = 8 THEN 'notes must be text' {x} WHEN k = 11 THEN 'invalid corrections entry' END"


@query("WITH p AS (SELECT doc_id, doc_id % 12 AS k, doc_id + 1 AS p FROM documents) SELECT doc_id, " + _REASON.format(x="WHEN k = 10 THEN 'uncertain must be an array'") + " AS reason, " + _REASON.format(x="") + " AS legacy FROM p")
def transcript_validation(spark, d):
    """Transcripts with one fault each, by their number."""
    x = t(spark, d, "documents").selectExpr("doc_id", "doc_id % 12 as k", "doc_id + 1 as p").selectExpr("doc_id", "p", _FAULTY + " as raw_json")
    return x.select("doc_id", validate.transcript_error("raw_json", "p").alias("reason"), validate.transcript_error("raw_json", "p", legacy=True).alias("legacy"))


@query("""SELECT conv_id, turn, CASE WHEN NOT regexp_matches(p, '^[0-9]{1,4}$') THEN 'page must be a number' WHEN CAST(p AS INT) NOT BETWEEN 1 AND 4 THEN 'page must be between 1 and 4' WHEN length(text) > 900 THEN 'invalid span 1 in block 2' WHEN role = 'user' AND length(text) > 300 THEN 'invalid verse number in block 1' WHEN length(text) % 7 = 0 THEN '''clipped'' must be an array' END AS reason
FROM (SELECT *, CASE WHEN turn = 1 THEN 'x' ELSE CAST(turn AS VARCHAR) END AS p FROM conversations)""")
def hosted_validation(spark, d):
    """Messages as transcripts sent to the hosted store; limits are reached by repeating them."""
    esc = F.replace(F.to_json(F.struct(F.col("text").alias("t"))), F.lit('{"t":'), F.lit(""))
    text = F.substr(esc, F.lit(1), F.length(esc) - 1)
    verse = F.when((F.col("role") == "user") & (F.length("text") > 300), F.repeat(F.lit("v"), F.lit(101))).otherwise("v")
    long_ = F.when(F.length("text") > 900, F.concat(F.lit('"'), F.repeat(F.lit("a"), F.lit(100_001)), F.lit('"'))).otherwise(text)
    block = lambda v, s: F.concat(F.lit('{"type":"verse","verse_num_am":"'), v, F.lit('","spans":[{"t":'), s, F.lit(',"c":"red"}]}'))
    body = F.concat(F.lit('{"blocks":['), block(F.when(F.length("text") > 900, F.lit("v")).otherwise(verse), text), F.lit(","), block(F.lit(""), long_), F.lit('],"clipped":'), F.when(F.length("text") % 7 == 0, "{}").otherwise("[]"), F.lit("}"))
    x = t(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") == 1, "x").otherwise(F.col("turn").cast("string")).alias("page"), body.alias("body"), F.lit(4).alias("max_page"))
    return x.select("conv_id", "turn", validate.hosted_error().alias("reason"))


@query("""WITH e AS (SELECT doc_id, CAST(doc_id % 300 AS VARCHAR) AS page, lang, n_chars FROM documents)
SELECT doc_id, CASE WHEN CAST(page AS INT) NOT BETWEEN 1 AND 250 THEN 'page must be between 1 and 250' WHEN lang = 'de' THEN 'invalid status for page ' || page WHEN n_chars > 1500 THEN 'note for page ' || page || ' must be at most 4000 characters' WHEN lang = 'fr' AND n_chars % 2 = 0 THEN 'review entry ' || page || ' must be an object' END AS reason, CASE WHEN lang = 'de' THEN 'maybe' WHEN lang = 'en' THEN 'approved' END AS status, sha256(CASE WHEN lang = 'fr' AND n_chars % 2 = 0 AND n_chars <= 1500 THEN '' ELSE repeat('n', CASE WHEN n_chars > 1500 THEN 4001 ELSE 3 END) END) AS note FROM e""")
def review_validation(spark, d):
    n = F.col("n_chars")
    note = F.when(n > 1500, F.concat(F.lit('"note":"'), F.repeat(F.lit("n"), F.lit(4001)), F.lit('"'))).otherwise('"note":" nnn "')
    body = F.when((F.col("lang") == "fr") & (n % 2 == 0) & (n <= 1500), "[]").otherwise(F.concat(F.lit("{"), note, F.when(F.col("lang") == "de", ',"status":"maybe"').when(F.col("lang") == "en", ',"status":"approved"').otherwise(',"status":null,"x":1'), F.lit("}")))
    x = t(spark, d, "documents").select("doc_id", (F.col("doc_id") % 300).cast("string").alias("page"), body.alias("raw_json"), F.lit(250).alias("max_page"))
    return validate.review_entries(x).select("doc_id", "reason", "status", F.sha2("note", 256).alias("note"))


@query("""WITH c AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS i, l_partkey % 500 AS x1, l_suppkey % 700 AS y1, l_quantity AS w, CASE WHEN l_partkey % 97 = 0 THEN 'Footer' WHEN l_partkey % 3 = 0 THEN 'Picture' ELSE 'Text' END AS category, CASE WHEN l_suppkey % 89 = 0 THEN ' ' ELSE 't' || l_returnflag END AS text FROM lineitem),
e AS (SELECT *, CASE WHEN category = 'Footer' THEN 'invalid layout category' WHEN x1 + w > 520 OR y1 + 20 > 700 THEN 'bounding box lies outside the submitted image' WHEN category <> 'Picture' AND trim(text) = '' THEN 'text region contains no text' WHEN row_number() OVER (PARTITION BY page, x1, y1, w, category, text ORDER BY i) > 1 THEN 'duplicate layout region' END AS err FROM c),
p AS (SELECT page, arg_min(err, i) FILTER (err IS NOT NULL) AS reason, count(*) AS n, sum(x1 * 2.0::DOUBLE + y1 * 3.0::DOUBLE) AS s FROM e GROUP BY 1)
SELECT page, reason, CASE WHEN reason IS NULL THEN n END AS cells, CASE WHEN reason IS NULL THEN round(s, 4) END AS total FROM p""")
def layout_validation(spark, d):
    """Order lines as regions of an answer in an image of 520 x 700, the scan being twice as wide and three times as high."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    x1, y1 = F.col("l_partkey") % 500, F.col("l_suppkey") % 700
    cell = F.struct(F.array(*[c.cast("double") for c in (x1, y1, x1 + F.col("l_quantity"), y1 + 20)]).alias("bbox"), F.when(F.col("l_partkey") % 97 == 0, "Footer").when(F.col("l_partkey") % 3 == 0, "Picture").otherwise("Text").alias("category"), F.when(F.col("l_suppkey") % 89 == 0, " ").otherwise(F.concat(F.lit("t"), "l_returnflag")).alias("text"))
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    g = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.struct(n.alias("n"), cell.alias("c")).alias("s")).groupBy("page").agg(F.to_json(F.transform(F.sort_array(F.collect_list("s")), lambda s: s["c"])).alias("content"))
    size = lambda w, h: F.struct(F.lit(w).alias("w"), F.lit(h).alias("h"))
    v = validate.layouts(g.withColumn("original", size(1040.0, 2100.0)).withColumn("sent", size(520.0, 700.0)))
    total = F.aggregate("cells", F.lit(0.0), lambda s, c: s + c["x1"] + c["y1"])
    return v.select("page", "reason", L(F.when(F.col("reason").isNull(), F.size("cells"))).alias("cells"), F.when(F.col("reason").isNull(), F.round(total, 4)).alias("total"))


@query("SELECT s_suppkey, lower(n_name) AS book_id, CASE WHEN n_regionkey <> 1 THEN CAST(s_nationkey + 10 AS BIGINT) END AS max_page, CASE WHEN n_regionkey = 1 THEN 'unknown book' END AS reason FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def book_lookup(spark, d):
    n = t(spark, d, "nation").withColumn("book_id", F.lower("n_name"))
    ids = t(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "book_id")
    return validate.known_books(ids, n.where("n_regionkey <> 1").select("book_id", (F.col("n_nationkey") + 10).cast("long").alias("max_page")))


# ---- maps and merged files ---------------------------------------------------------


@query("SELECT doc_id AS page, lang AS value FROM documents WHERE doc_id > 0")
def page_maps(spark, d):
    """Rows to a map keyed by page strings, and back."""
    e = F.struct(tx.page_stem(F.col("doc_id")).alias("key"), F.col("lang").alias("value"))
    m = t(spark, d, "documents").where("doc_id > 0").groupBy("source").agg(F.map_from_entries(F.collect_list(e)).alias("m"))
    return page_map(m, "m").select(F.col("page").cast("long").alias("page"), "value")


_RERUN = "SELECT conv_id, CASE WHEN length(text) % 5 = 0 THEN turn + 1000 ELSE turn END AS page, role, text FROM conversations WHERE length(text) % 2 = 1"


def _rerun(spark, d):
    """Every second turn again, some under numbers of their own."""
    x = t(spark, d, "conversations").where(F.length("text") % 2 == 1)
    return x.withColumn("page", F.when(F.length("text") % 5 == 0, F.col("turn") + 1000).otherwise(F.col("turn")))


@query(f"""WITH o AS (SELECT conv_id, turn AS page, ['x'] AS f FROM conversations), n AS (SELECT conv_id, page, CASE WHEN role = 'user' THEN ['y'] ELSE [] END AS f FROM ({_RERUN})), m AS (SELECT coalesce(n.conv_id, o.conv_id) AS conv_id, coalesce(n.page, o.page) AS page, CASE WHEN n.page IS NOT NULL THEN n.f ELSE o.f END AS f FROM o FULL JOIN n ON n.conv_id = o.conv_id AND n.page = o.page)
SELECT conv_id, count(*) AS pages_checked, CAST(count(*) FILTER (len(f) > 0) AS BIGINT) AS pages_flagged, coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (len(f) > 0), '') AS flagged, string_agg(page || array_to_string(f, ''), ',' ORDER BY page) AS reports FROM m GROUP BY 1""")
def report_merge(spark, d):
    """The merged report of each book (a conversation) after a run over some of its pages."""
    none = F.expr("cast(array() as array<string>)")
    old = t(spark, d, "conversations").select("conv_id", F.col("turn").alias("page"), F.array(F.lit("x")).alias("review_flags"))
    new = _rerun(spark, d).select("conv_id", "page", F.when(F.col("role") == "user", F.array(F.lit("y"))).otherwise(none).alias("review_flags"))
    r = exports.report_document(old, new, keys=("conv_id",))
    each = F.array_join(F.transform("reports", lambda x: F.concat(x["page"].cast("string"), F.array_join(x["review_flags"], ""))), ",")
    return r.select("conv_id", "pages_checked", "pages_flagged", F.array_join(F.col("flagged_pages").cast("array<string>"), ",").alias("flagged"), each.alias("reports"))


@query("""SELECT conv_id, sha256(string_agg('===== Page ' || turn || ' =====' || chr(10) || chr(10) || coalesce(text, '') || chr(10), chr(10) ORDER BY turn)) AS body FROM conversations GROUP BY 1""")
def combined_text(spark, d):
    """Each conversation as a book, a page a turn, with banners."""
    texts = t(spark, d, "conversations").select("conv_id", F.col("turn").alias("page"), F.coalesce("text", F.lit("")).alias("body"))
    return exports.combined_text(texts, keys=("conv_id",)).select("conv_id", F.sha2("body", 256).alias("body"))


@query("""SELECT conv_id AS page, 'page_' || CASE WHEN conv_id < 1000 THEN lpad(CAST(conv_id AS VARCHAR), 3, '0') ELSE CAST(conv_id AS VARCHAR) END || '.txt' AS name, CAST(strlen(body) AS BIGINT) AS size, sha256(body) AS body FROM (SELECT CAST(conv_id AS INTEGER) AS conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> '') AS body FROM conversations GROUP BY 1) WHERE conv_id >= 10""")
def book_files(spark, d):
    """Conversations written as files of a folder, and read back from page 10 on without opening the others."""
    texts = exports.page_texts(t(spark, d, "conversations"), "conv_id", "turn")
    folder = storage.scratch(book_format.register(spark), "files")
    exports.text_files(texts, "body", "conv_id").write.format("book").mode("append").save(folder)
    files = spark.read.format("book").load(folder).where("page >= 10")
    return files.select("page", "name", "size", F.sha2("body", 256).alias("body"))


@query("""SELECT CAST(conv_id AS INTEGER) AS page, sha256(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> ''), '')) AS sha256 FROM conversations GROUP BY conv_id""")
def file_hashes(spark, d):
    """Hashes of files as they lie in a folder, written from the conversations."""
    texts = exports.page_texts(t(spark, d, "conversations"), "conv_id", "turn")
    folder = storage.scratch(book_format.register(spark), "hashed")
    exports.text_files(texts, "body", "conv_id").write.format("book").mode("append").save(folder)
    return books.file_hashes(spark, f"{folder}/page_*.txt")


# ---- what is stored -------------------------------------------------------------------


@query("""WITH n AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'page_' || CASE WHEN doc_id < 1000 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE CAST(doc_id AS VARCHAR) END || '.json' WHEN 'de' THEN 'page_' || doc_id || '.json' WHEN 'fr' THEN 'page_' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '.original.json' ELSE 'xpage_' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') || '.json' END AS name FROM documents)
SELECT doc_id, CAST(nullif(regexp_extract(name, '^page_([0-9]{3,})[.]json$', 1), '') AS INTEGER) AS page FROM n WHERE regexp_matches(name, '^page_[0-9]{3,}[.]json$')""")
def canonical_transcripts(spark, d):
    """Documents as files: only canonical names are transcripts."""
    i, bare = F.format_string("%03d", F.col("doc_id")), F.col("doc_id").cast("string")
    short = F.format_string("%03d", F.col("doc_id") % 1000)
    name = F.when(F.col("lang") == "en", F.concat(F.lit("page_"), i, F.lit(".json"))).when(F.col("lang") == "de", F.concat(F.lit("page_"), bare, F.lit(".json"))).when(F.col("lang") == "fr", F.concat(F.lit("page_"), short, F.lit(".original.json"))).otherwise(F.concat(F.lit("xpage_"), short, F.lit(".json")))
    return t(spark, d, "documents").select("doc_id", canonical_page(name).alias("page")).where("page IS NOT NULL")


def _by_source(spark, d, entry, key):
    """JSON objects of the documents of each source, keyed by `key`."""
    e = F.concat(F.lit('"'), key, F.lit('":'), entry)
    return t(spark, d, "documents").groupBy("source").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(e), ","), F.lit("}")).alias("j"))


@query("SELECT CAST(doc_id AS INTEGER) AS page, n_chars < 50 AS is_blank, CASE WHEN lang = 'de' THEN NULL ELSE false END AS is_illustration, n_chars::DOUBLE / 4 AS red_ink_ratio FROM documents")
def stored_stats(spark, d):
    """Page statistics in JSON, a file per source; a field that a page lacks is null."""
    entry = F.concat(F.lit('{"is_blank":'), F.when(F.col("n_chars") < 50, "true").otherwise("false"), F.when(F.col("lang") == "de", "").otherwise(',"is_illustration":false'), F.lit(',"red_ink_ratio":'), (F.col("n_chars") / 4.0).cast("string"), F.lit("}"))
    return books.stats_of(_by_source(spark, d, entry, F.col("doc_id").cast("string")), "j").select("page", "is_blank", "is_illustration", "red_ink_ratio")


@query("SELECT CAST(doc_id AS INTEGER) AS page, CASE WHEN quality = 0 THEN 'a|b' ELSE '' END AS flags, CASE WHEN toxic = 0 THEN 't' || doc_id END AS transcript_sha256 FROM labels")
def stored_flags(spark, d):
    one = F.concat(F.lit('{"page":'), F.col("doc_id").cast("string"), F.lit(',"review_flags":'), F.when(F.col("quality") == 0, '["a","b"]').otherwise("[]"), F.when(F.col("toxic") == 0, F.concat(F.lit(',"transcript_sha256":"t'), F.col("doc_id").cast("string"), F.lit('"'))).otherwise(""), F.lit("}"))
    j = t(spark, d, "labels").groupBy((F.col("doc_id") % 7).alias("b")).agg(F.concat(F.lit('{"pages_checked":1,"reports":['), F.array_join(F.collect_list(one), ","), F.lit("]}")).alias("j"))
    return books.flags_of(j, "j").select("page", F.array_join("review_flags", "|").alias("flags"), "transcript_sha256")


@query("SELECT CAST(doc_id AS INTEGER) AS page, CASE WHEN lang = 'en' THEN 'approved' WHEN lang = 'de' THEN 'needs_fix' END AS status, source AS note FROM documents")
def stored_reviews(spark, d):
    status = F.when(F.col("lang") == "en", '"approved"').when(F.col("lang") == "de", '"needs_fix"').otherwise("null")
    entry = F.concat(F.lit('{"status":'), status, F.lit(',"note":"'), "source", F.lit('","other":[1]}'))
    j = _by_source(spark, d, entry, F.col("doc_id").cast("string")).withColumn("j", F.concat(F.lit('{"entries":'), "j", F.lit("}")))
    return books.reviews_of(j, "j").select("page", "status", "note")


@query("SELECT 'text' AS part, CAST(doc_id AS INTEGER) AS page, lang AS said FROM documents UNION ALL SELECT 'entry', CAST(doc_id AS INTEGER), source FROM documents")
def hosted_export(spark, d):
    """Exports in JSON: texts by page name, decisions by page number."""
    name = tx.page_stem(F.col("doc_id"))
    texts = _by_source(spark, d, F.concat(F.lit('{"lang":"'), "lang", F.lit('"}')), name).withColumnRenamed("j", "a")
    entries = _by_source(spark, d, F.concat(F.lit('{"status":null,"note":"'), "source", F.lit('"}')), F.col("doc_id").cast("string")).withColumnRenamed("j", "b")
    j = texts.join(entries, "source").select(F.concat(F.lit('{"transcripts":'), "a", F.lit(',"review":{"entries":'), "b", F.lit("}}")).alias("j"))
    pages, e = exports.export_of(j, "j")
    return pages.select(F.lit("text").alias("part"), "page", F.get_json_object("raw_json", "$.lang").alias("said")).unionByName(e.select(F.lit("entry").alias("part"), "page", F.col("note").alias("said")))


@query(f"""WITH o AS (SELECT conv_id, turn AS page, length(text) AS v FROM conversations), n AS (SELECT conv_id, page, length(role) AS v FROM ({_RERUN})), m AS (SELECT coalesce(n.conv_id, o.conv_id) AS conv_id, coalesce(n.page, o.page) AS page, CASE WHEN n.page IS NOT NULL THEN n.v ELSE o.v END AS v FROM o FULL JOIN n ON n.conv_id = o.conv_id AND n.page = o.page) SELECT conv_id, string_agg(page || '=' || v, ',' ORDER BY page) AS stats, count(*) AS pages FROM m GROUP BY 1""")
def stats_merge(spark, d):
    """The statistics of each book (a conversation) after a run over some of its pages, as one map in page order."""
    old = t(spark, d, "conversations").select("conv_id", F.col("turn").alias("page"), F.length("text").cast("long").alias("v"))
    new = _rerun(spark, d).select("conv_id", "page", F.length("role").cast("long").alias("v"))
    s = exports.stats_document(old, new, keys=("conv_id",))
    each = F.array_join(F.transform(F.map_entries("stats"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["v"].cast("string"))), ",")
    return s.select("conv_id", each.alias("stats"), F.size("stats").cast("long").alias("pages"))


@query("""SELECT 'page_' || CASE WHEN conv_id < 1000 THEN lpad(CAST(conv_id AS VARCHAR), 3, '0') ELSE CAST(conv_id AS VARCHAR) END || '.json' AS name, sha256('{"page":' || conv_id || ',"lines":[' || string_agg('{"order":' || turn || ',"role":"' || role || '","note":null}', ',' ORDER BY turn) || ']}' || chr(10)) AS body FROM conversations GROUP BY conv_id""")
def layout_documents(spark, d):
    """A JSON document per page, nulls kept."""
    line = F.struct(F.col("turn").alias("order"), "role", F.lit(None).cast("string").alias("note"))
    p = t(spark, d, "conversations").groupBy(F.col("conv_id").alias("page")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    return exports.page_documents(p).select("name", F.sha2("body", 256).alias("body"))


@query("""SELECT doc_id, 'page_' || CASE WHEN doc_id < 1000 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE CAST(doc_id AS VARCHAR) END || '.' || substr(sha256(text), 1, 16) || CASE WHEN lang = 'de' THEN '.error.json' ELSE '.json' END AS name, CASE WHEN lang = 'de' THEN 'failed' ELSE 'draft' END AS status FROM documents""")
def candidate_records(spark, d):
    """What a run leaves of each page: a candidate, or an error beside it."""
    r = t(spark, d, "documents").select(F.col("doc_id").alias("page"), F.sha2("text", 256).alias("cache_key"), F.lit("{}").alias("raw_response"), F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("]")).alias("layout"), F.lit("{}").alias("transcript"), F.when(F.col("lang") == "de", F.concat(F.lit("e"), F.col("doc_id").cast("string"))).alias("error"))
    c = exports.candidate_documents(r, "{}")
    own = F.coalesce(F.get_json_object("body", "$.page"), F.regexp_extract(F.get_json_object("body", "$.layout"), r"(\d+)", 1)).cast("long")
    return c.select(own.alias("doc_id"), "name", F.get_json_object("body", "$.status").alias("status"))


@query(f"""WITH r AS ({_REV}) SELECT r.page, sha256(d.text) AS body, transcript_sha256 AS revision, evidence_sha256 AS evidence_revision FROM r JOIN documents d ON d.doc_id = r.page WHERE d.lang <> 'de'""")
def loaded_transcripts(spark, d):
    """Saved texts with the revision that a save of them has to name."""
    saved = t(spark, d, "documents").where("lang <> 'de'").select(F.col("doc_id").alias("page"), F.sha2("text", 256).alias("body"))
    return revisions.loaded(saved, _present(spark, d))


@query("""WITH c AS (SELECT user_id, event_id, event_type, CASE event_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS applied, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS dismissed FROM events) SELECT user_id, count(*) AS corrections, CAST(count(*) FILTER (NOT coalesce(applied, false) AND NOT coalesce(dismissed, false)) AS BIGINT) AS undecided FROM c GROUP BY 1""")
def undecided_corrections(spark, d):
    mark = lambda n: F.when(F.col("event_id") % n == 0, True).when(F.col("event_id") % n == 1, False)
    c = F.struct(F.col("event_type").alias("printed"), mark(3).alias("applied"), mark(4).alias("dismissed"))
    g = t(spark, d, "events").groupBy("user_id").agg(F.collect_list(c).alias("c"))
    return g.select("user_id", L(F.size("c")).alias("corrections"), L(F.size(transcripts.undecided(F.col("c")))).alias("undecided"))
