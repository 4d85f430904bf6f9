"""More queries over the driver's tables: transcripts, imports, checks and assembly, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import archive, book, core, layout, reports, transcripts, validate
from ..sources import books, exports
from .catalogue import L, query, t

# ---- regions and words -----------------------------------------------------


@query("SELECT doc_id, lang FROM documents WHERE lang <> 'de' AND coalesce(text, '') <> '' AND NOT regexp_matches(text, 'https?://') AND NOT regexp_matches(text, '[0-9]{4}')")
def ignore_filter(spark, d):
    x = t(spark, d, "documents").where("lang <> 'de'")
    return transcripts.body_regions(x, ["https?://", "[0-9]{4}"], "lang").select("doc_id", "lang")


@query("""SELECT conv_id, coalesce(sha256(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'system')), sha256('')) AS header, CAST(count(*) FILTER (role <> 'system') AS BIGINT) AS body FROM conversations GROUP BY 1""")
def page_header_split(spark, d):
    h = transcripts.page_headers(t(spark, d, "conversations"), ["conv_id"], "turn", F.col("role") == "system")
    return h.select("conv_id", F.sha2("page_header", 256).alias("header"), "body")


_PRINTED = "CASE l_linenumber % 4 WHEN 0 THEN 'SPACE' WHEN 1 THEN 'LINE_BREAK' WHEN 2 THEN 'HYPHEN' ELSE 'NONE' END"


@query(f"""WITH w AS (SELECT l_orderkey AS page, l_linenumber AS word, l_partkey, l_returnflag AS c, CAST(l_partkey AS VARCHAR) || CASE WHEN {_PRINTED} <> 'NONE' THEN ' ' ELSE '' END AS piece FROM lineitem),
n AS (SELECT *, CASE WHEN lag(c) OVER o IS DISTINCT FROM c OR row_number() OVER o = 1 THEN 1 ELSE 0 END AS s FROM w WINDOW o AS (PARTITION BY page ORDER BY word, l_partkey, c)), r AS (SELECT *, sum(s) OVER (PARTITION BY page ORDER BY word, l_partkey, c ROWS UNBOUNDED PRECEDING) AS run FROM n)
SELECT page, CAST(run AS BIGINT) AS run, c, replace(string_agg(piece, '' ORDER BY word, l_partkey, c), '  ', ' ') AS text, count(*) AS parts FROM r GROUP BY 1, 2, 3""")
def break_runs(spark, d):
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("word"), "l_partkey", F.col("l_returnflag").alias("c"), F.col("l_partkey").cast("string").alias("word_text"), F.expr(_PRINTED).alias("after"))
    return transcripts.broken_runs(w, ["page"], ["word", "l_partkey", "c"], "c", "word_text", "after").select("page", L("run").alias("run"), "c", "text", "parts")


@query("""WITH n AS (SELECT user_id, ts, event_id, event_type, CASE WHEN lag(event_type) OVER o IS DISTINCT FROM event_type OR row_number() OVER o = 1 THEN 1 ELSE 0 END AS s FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM n)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS parts FROM r GROUP BY 1, 2, 3""")
def region_blocks(spark, d):
    e = t(spark, d, "events").withColumn("word_text", F.col("event_id").cast("string"))
    return transcripts.parent_blocks(e, ["user_id"], ["ts", "event_id"], "event_type", "word_text").select("user_id", L("run").alias("run"), "event_type", "parts")


@query("""WITH x AS (SELECT user_id, ts, event_id, event_type = 'signup' AS title, event_type <> 'signup' AND event_id % 5 = 0 AS num FROM events),
s AS (SELECT *, CASE WHEN title OR num OR coalesce(lag(title) OVER (PARTITION BY user_id ORDER BY ts, event_id), true) THEN 1 ELSE 0 END AS st FROM x)
SELECT user_id, event_id, CAST(sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block, CASE WHEN title THEN 'title' WHEN num THEN 'verse' END AS kind FROM s""")
def line_blocks(spark, d):
    b = transcripts.line_blocks(t(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", F.col("event_id") % 5 == 0)
    return b.select("user_id", "event_id", L("block").alias("block"), "kind")


@query("""WITH l AS (SELECT l_orderkey AS page, min(l_linenumber * 100000 + l_partkey) AS f, max(l_linenumber * 100000 + l_partkey) AS g, 1000 AS h FROM lineitem GROUP BY 1)
SELECT page, concat_ws(',', CASE WHEN f % 1000 <= 30 THEN 'top' END, CASE WHEN g % 1000 >= 970 THEN 'bottom' END) AS edges FROM l""")
def clipped_edges(spark, d):
    x = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("o")).withColumn("y", F.col("o") % 1000)
    return transcripts.clipped_edges(x, ["page"], "o", "y", "y", F.lit(1000)).select("page", F.array_join("edges", ",").alias("edges"))


@query("""WITH a AS (SELECT conv_id, turn, string_split(text, ' ') AS tokens FROM conversations), b AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN list_append(tokens, 'x') ELSE tokens END AS words FROM a WHERE turn % 4 <> 3)
SELECT a.conv_id, a.turn, coalesce(a.tokens <> b.words, true) AS unaligned, CAST(CASE WHEN a.tokens = b.words THEN len(list_filter(b.words, lambda w: length(w) > 4)) ELSE 0 END AS BIGINT) AS red FROM a LEFT JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn""")
def colour_alignment(spark, d):
    a = t(spark, d, "conversations").select("conv_id", "turn", F.split("text", " ").alias("tokens"))
    words = F.when(F.col("turn") % 3 == 1, F.array_append("tokens", F.lit("x"))).otherwise(F.col("tokens"))
    b = a.where("turn % 4 <> 3").select("conv_id", "turn", words.alias("words")).withColumn("colours", F.transform("words", lambda w: F.when(F.length(w) > 4, "red").otherwise("black")))
    r = transcripts.coloured_regions(a, b, ["conv_id", "turn"])
    return r.select("conv_id", "turn", "unaligned", L(F.size(F.filter("colours", lambda c: c == "red"))).alias("red"))


@query("SELECT conv_id, sha256(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> ''), '')) AS body FROM conversations GROUP BY 1")
def region_text_export(spark, d):
    return exports.page_texts(t(spark, d, "conversations"), "conv_id", "turn").select("conv_id", F.sha2("body", 256).alias("body"))


# ---- assembly ---------------------------------------------------------------

_BOOK = """WITH b AS (SELECT user_id AS book, CAST(epoch(date_trunc('day', ts)) AS BIGINT) // 86400 AS page, event_id AS o, CASE WHEN event_id % 3 = 0 THEN 'ornament' ELSE 'verse' END AS kind, CASE WHEN event_id % 3 <> 0 AND event_id % 4 = 0 THEN event_type END AS opens FROM events),
f AS (SELECT *, CASE WHEN opens IS NOT NULL AND row_number() OVER (PARTITION BY book, opens ORDER BY page, o) = 1 THEN opens END AS op FROM b),
s AS (SELECT *, last_value(op IGNORE NULLS) OVER (PARTITION BY book ORDER BY page, o ROWS UNBOUNDED PRECEDING) AS fs, min(CASE WHEN kind <> 'ornament' THEN o END) OVER (PARTITION BY book, page ORDER BY o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM f),
m AS (SELECT s.*, s.kind = 'ornament' AND n.op IS NOT NULL AS moved, CASE WHEN s.kind = 'ornament' AND n.op IS NOT NULL THEN n.op ELSE s.fs END AS section FROM s LEFT JOIN f n ON s.book = n.book AND s.nx = n.o),
k AS (SELECT *, row_number() OVER (PARTITION BY book, fs ORDER BY page, o) AS a, row_number() OVER (PARTITION BY book, section ORDER BY page, o) AS z FROM m)
"""
_ID = "CASE WHEN {n} < 1000 THEN lpad(CAST({n} AS VARCHAR), 3, '0') ELSE CAST({n} AS VARCHAR) END"


def _assembled(spark, d):
    e = t(spark, d, "events")
    b = e.select(F.col("user_id").alias("book"), F.unix_date(F.to_date("ts")).cast("long").alias("page"), F.col("event_id").alias("block_ord"), F.when(F.col("event_id") % 3 == 0, "ornament").otherwise("verse").alias("type"), F.when((F.col("event_id") % 3 != 0) & (F.col("event_id") % 4 == 0), F.col("event_type")).alias("opens"))
    return book.assemble(b, ["book"])


@query(_BOOK + f"SELECT book, o AS block_ord, section, moved, CASE WHEN moved THEN coalesce(fs, 'front_matter') || '_' || {_ID.format(n='a')} ELSE coalesce(section, 'front_matter') || '_' || {_ID.format(n='z')} END AS block_id FROM k")
def book_assembly(spark, d):
    return _assembled(spark, d).select("book", "block_ord", "section", "moved", "block_id")


@query(_BOOK + """SELECT x.book, x.section, x.start_page, x.end_page, coalesce(y.n, 0) AS blocks FROM (SELECT book, fs AS section, min(page) AS start_page, max(page) AS end_page FROM k WHERE fs IS NOT NULL GROUP BY 1, 2) x
LEFT JOIN (SELECT book, section, count(*) AS n FROM k WHERE section IS NOT NULL GROUP BY 1, 2) y ON x.book = y.book AND x.section = y.section""")
def book_spans(spark, d):
    return book.section_spans(_assembled(spark, d), ["book"])


@query(_BOOK + "SELECT book, CAST(count(*) FILTER (section IS NULL) AS BIGINT) AS front, count(DISTINCT section) AS sections_count, count(*) AS blocks FROM k GROUP BY 1")
def book_payload(spark, d):
    a = _assembled(spark, d)
    rules = a.where("opens IS NOT NULL").select(F.col("opens").alias("section")).distinct().withColumn("ord", F.length("section"))
    p = book.payload(a, rules, ["book"], ["type"])
    inner = F.coalesce(F.aggregate("sections", F.lit(0), lambda n, s: n + F.size(s["blocks"])), F.lit(0))
    front = F.coalesce(F.size(F.when(F.col("front_matter").isNotNull(), F.col("front_matter"))), F.lit(0))
    return p.select("book", L(front).alias("front"), L("sections_count").alias("sections_count"), L(front + inner).alias("blocks"))


# ---- reviews, checks, exports -------------------------------------------------


@query("""SELECT l.doc_id, CASE WHEN l.quality = 1 AND b.doc_id IS NULL THEN NULL WHEN l.quality = 1 THEN 'approved' ELSE 'needs_fix' END AS status, CASE WHEN l.quality = 1 AND b.doc_id IS NULL THEN 'n' || l.doc_id || ' [approval withdrawn on import: it referred to an older baseline text]' ELSE 'n' || l.doc_id END AS note, l.quality = 1 AND b.doc_id IS NULL AS withdrawn
FROM labels l LEFT JOIN (SELECT DISTINCT doc_id FROM documents WHERE n_chars > 300) b ON l.doc_id = b.doc_id""")
def import_approvals(spark, d):
    e = t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "approved").otherwise("needs_fix").alias("status"), F.concat(F.lit(" n"), "doc_id").alias("note"))
    return transcripts.imported_reviews(e, t(spark, d, "documents").where("n_chars > 300"), "doc_id")



_WORDS = "array_to_string(list_slice(u, 1, 4), ', ') || CASE WHEN len(u) > 4 THEN ' (+' || (len(u) - 4) || ' more)' ELSE '' END"


@query(f"""WITH p AS (SELECT d.doc_id, l.doc_id IS NOT NULL AS has, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]')) AS latin, substr(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'), 1, 20) AS shown, len(regexp_extract_all(coalesce(text, ''), '[0-9]')) AS digits, d.doc_id % 7 AS k,
  CASE WHEN d.doc_id % 7 = 5 THEN string_split(coalesce(text, ''), ' ') WHEN d.doc_id % 7 <> 0 THEN CAST([] AS VARCHAR[]) END AS u, (d.n_chars % 97)::DOUBLE / 97 AS model, CASE WHEN d.doc_id % 7 <> 1 THEN (d.doc_id % 89)::DOUBLE / 89 END AS mask, CASE WHEN d.doc_id % 7 <> 6 THEN (d.n_chars % 83)::DOUBLE / 83 END AS agreement FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, CASE WHEN NOT has THEN 'no transcript' ELSE concat_ws(';',
  CASE WHEN round(agreement, 3) < 0.35 AND len(u) >= 4 THEN 'REJECT — likely not a real transcription (agreement ' || printf('%.2f', round(agreement, 3)) || ', ' || len(u) || ' uncertain). Check this page against its scan before reviewing it.' END,
  CASE WHEN k = 0 THEN 'legacy transcript missing review field(s): uncertain' END,
  CASE WHEN latin > 0 THEN latin || ' Latin characters in Ethiopic text: ' || chr(39) || shown || chr(39) END, CASE WHEN digits > 0 THEN digits || ' ASCII digits (Ethiopic numerals expected)' END,
  CASE WHEN k = 1 THEN 'missing colour-mask evidence; run split before verification' END, CASE WHEN k = 2 THEN 'missing word-layout evidence; run layout before verification' END, CASE WHEN k = 3 THEN 'missing original page image' END,
  CASE WHEN abs(model - mask) > 0.18 THEN 'red coverage ' || CASE WHEN model > mask THEN 'over' ELSE 'under' END || '-marked: model ' || printf('%.2f', model) || ' vs mask ' || printf('%.2f', mask) END,
  CASE WHEN k = 6 THEN 'model produced no text but Tesseract found lines' END, CASE WHEN agreement < 0.25 THEN 'text agreement with Tesseract only ' || printf('%.2f', agreement) END, CASE WHEN k = 6 THEN 'transcript contains no Ethiopic text' END,
  CASE WHEN k = 4 THEN 'empty verse block' END, CASE WHEN len(u) > 0 THEN len(u) || ' uncertain word(s) to check: ' || {_WORDS} END, CASE WHEN k = 3 THEN 'TEXT CUT OFF at top of page — 1 line(s) missing' END,
  CASE WHEN k = 2 THEN '1 spelling suggestion(s) to review: a→b' END, CASE WHEN k = 1 THEN 'OCR candidate has unresolved colour alignment' END) END AS flags FROM p""")
def page_flags(spark, d):
    l = t(spark, d, "labels").select(F.col("doc_id").alias("_k"))
    k, text = F.col("doc_id") % 7, F.coalesce("text", F.lit(""))
    kind = lambda s: F.expr(f"cast(array() as array<struct<{s}>>)")
    word = F.transform(F.split(text, " "), lambda w: F.struct(w.alias("text")))
    p = t(spark, d, "documents").join(l, F.col("doc_id") == F.col("_k"), "left").select(
        "doc_id",
        F.col("_k").isNotNull().alias("has_transcript"),
        F.when(k == 5, word).when(k != 0, kind("text:string")).alias("uncertain"),
        F.when(k == 3, F.array(F.struct(F.lit("top").alias("edge")))).otherwise(kind("edge:string")).alias("clipped"),
        F.when(k == 2, F.array(F.struct(F.lit("a").alias("printed"), F.lit("b").alias("suggested"), F.lit(False).alias("applied"), F.lit(None).cast("boolean").alias("dismissed")))).alias("corrections"),
        tx.count_in(text, tx.ALPHABETS["latin"]).alias("latin"),
        tx.first_in(text, tx.ALPHABETS["latin"]).alias("latin_shown"),
        tx.count_in(text, tx.ALPHABETS["digit"]).alias("digits"),
        (F.col("n_chars") % 97 / F.lit(97.0)).alias("model_red"),
        F.when(k != 1, F.col("doc_id") % 89 / F.lit(89.0)).alias("mask_red"),
        (k != 2).alias("has_layout"),
        F.lit(False).alias("colour_from_mask"),
        (k != 3).alias("has_image"),
        F.when(k != 6, F.col("n_chars") % 83 / F.lit(83.0)).alias("agreement"),
        F.when(k == 6, 0).otherwise(10).alias("script_chars"),
        F.lit(4).alias("ocr_lines"),
        F.lit(9).alias("model_lines"),
        F.when(k == 4, "verse").alias("empty_type"),
        (k == 1).alias("unresolved"),
    )
    return transcripts.page_flags(p, "doc_id").select("doc_id", F.array_join("flags", ";").alias("flags"))


@query("""SELECT l_orderkey AS page, l_linenumber AS word, l_partkey, round(l_partkey * 2550.0::DOUBLE / 1568.0::DOUBLE, 6) AS x1, round(l_suppkey * 3300.0::DOUBLE / 2016.0::DOUBLE, 6) AS y1 FROM lineitem""")
def bbox_rescale(spark, d):
    at = lambda c, a, b: F.round(layout.rescaled(F.col(c), F.lit(a), F.lit(b)), 6)
    return t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("word"), "l_partkey", at("l_partkey", 2550.0, 1568.0).alias("x1"), at("l_suppkey", 3300.0, 2016.0).alias("y1"))


@query("SELECT event_id, replace(strftime(ts, '%Y-%m-%dT%H:%M:%S'), ':', '') AS stamp FROM events")
def export_stamp(spark, d):
    return t(spark, d, "events").select("event_id", reports.export_stamp(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")).alias("stamp"))


@query("""SELECT doc_id, CASE WHEN NOT regexp_matches(x, '^[0-9]{1,4}$') THEN 'page must be a number' WHEN CAST(x AS BIGINT) NOT BETWEEN 1 AND 166 THEN 'page must be between 1 and 166' END AS reason FROM (SELECT doc_id, CASE WHEN lang = 'de' THEN 'p' || doc_id ELSE CAST(doc_id * 3 AS VARCHAR) END AS x FROM documents)""")
def page_number_check(spark, d):
    x = F.when(F.col("lang") == "de", F.concat(F.lit("p"), "doc_id")).otherwise((F.col("doc_id") * 3).cast("string"))
    return t(spark, d, "documents").select("doc_id", validate.page_error(x, F.lit(166)).alias("reason"))


@query(f"""WITH x AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text WHEN doc_id % 5 = 1 THEN '{{"n": ' || n_chars || '}}' WHEN doc_id % 5 = 2 THEN '' ELSE '"' || lang || '"' END AS body, CASE WHEN doc_id % 97 = 3 THEN {validate.MOST_BODY} - 4 WHEN doc_id % 97 = 4 THEN {validate.MOST_BODY} - 3 ELSE 0 END AS more FROM documents)
SELECT doc_id, CASE WHEN body = '' AND more = 0 OR strlen(body) + more > {validate.MOST_BODY} THEN 'request body is empty or too large' WHEN NOT json_valid(body) THEN 'request body is not valid JSON' END AS reason FROM x""")
def body_limit(spark, d):
    """Bodies of requests: some are empty, some no JSON, some blown up by blanks to the limit and one byte beyond."""
    k = F.col("doc_id")
    body = F.when(k % 5 == 0, F.col("text")).when(k % 5 == 1, F.concat(F.lit('{"n": '), F.col("n_chars").cast("string"), F.lit("}"))).when(k % 5 == 2, "").otherwise(F.concat(F.lit('"'), "lang", F.lit('"')))
    more = F.when(k % 97 == 3, validate.MOST_BODY - 4).when(k % 97 == 4, validate.MOST_BODY - 3).otherwise(0)
    x = t(spark, d, "documents").select("doc_id", F.concat(body, F.repeat(F.lit(" "), more)).alias("body"))
    return x.select("doc_id", F.expr(validate.body_error("body")).alias("reason"))


@query("""WITH e AS (SELECT event_type, CAST(floor(value) AS BIGINT) % 100 - 20 AS c, CASE WHEN event_id % 4 = 0 THEN ' ' ELSE 'x' END AS x FROM events)
SELECT event_type, round(coalesce(avg(c) FILTER (c > 0), 0), 6) AS mean_conf, round(avg(c) FILTER (c >= 0 AND trim(x) <> ''), 6) AS confidence, CAST(count(*) FILTER (c >= 0 AND trim(x) <> '') AS BIGINT) AS word_count FROM e GROUP BY 1""")
def mean_confidence(spark, d):
    e = t(spark, d, "events").select("event_type", (F.floor("value") % 100 - 20).alias("c"), F.when(F.col("event_id") % 4 == 0, " ").otherwise("x").alias("x"))
    mean = reports.mean_confidence(e, ["event_type"], F.col("c")).withColumn("mean_conf", F.round("mean_conf", 6))
    return mean.join(reports.token_confidence(e, ["event_type"], F.col("x"), F.col("c")).withColumn("confidence", F.round("confidence", 6)), "event_type")


@query("""WITH l AS (SELECT source, list_contains(list(DISTINCT lang), 'en') AS a, list_contains(list(DISTINCT lang), 'de') AS b FROM documents GROUP BY source),
n AS (SELECT source, list_filter([CASE WHEN a THEN 'en' END, CASE WHEN a AND b THEN 'en+de' WHEN b THEN 'de' END], lambda x: x IS NOT NULL) AS langs FROM l),
p AS (SELECT source, 1 AS g, i, j, langs[i] AS language, 'processed' AS image, [6, 4, 3][j] AS mode FROM n, range(1, 3) AS x(i), range(1, 4) AS y(j) WHERE i <= len(langs) UNION ALL SELECT source, 2, 1, j, langs[-1], 'original', [4, 6][j] FROM n, range(1, 3) AS y(j) WHERE len(langs) > 0)
SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY g, i, j) AS INTEGER) AS seq, image, language, mode FROM p""")
def candidate_plan(spark, d):
    """Sources stand for pages, and the languages of their documents for the language data there is."""
    l = t(spark, d, "documents").groupBy("source").agg(F.collect_set("lang").alias("l"))
    p = l.select("source", F.posexplode(archive.candidate_plan(F.col("l"), "en", "de")).alias("i", "p"))
    return p.select("source", (F.col("i") + 1).alias("seq"), F.col("p.source").alias("image"), "p.language", "p.mode")


@query("""WITH b AS (SELECT n_nationkey, lower(n_name) AS book_id, n_regionkey <> 1 AS publish, n_name FROM nation)
SELECT book_id, n_name AS title_am, '' AS title_en, count(*) AS total_pages, CAST(count(*) FILTER (s_acctbal > 0 AND NOT s_suppkey % 5 = 0) AS BIGINT) AS text_pages, max(s_suppkey) AS max_page FROM b JOIN supplier ON s_nationkey = n_nationkey WHERE publish AND regexp_matches(book_id, '^[a-z0-9_]+$') GROUP BY 1, 2""")
def publish_registry(spark, d):
    """Nations stand for books, suppliers for their pages."""
    b = t(spark, d, "nation").select("n_nationkey", F.lower("n_name").alias("book_id"), (F.col("n_regionkey") != 1).alias("publish"), F.col("n_name").alias("title_am"), F.lit(None).cast("string").alias("title_en"))
    s = t(spark, d, "supplier").join(b.select("n_nationkey", "book_id"), F.col("s_nationkey") == F.col("n_nationkey")).select("book_id", F.col("s_suppkey").alias("page"), (F.col("s_acctbal") <= 0).alias("is_blank"), (F.col("s_suppkey") % 5 == 0).alias("is_illustration"))
    return reports.published(b, s)


@query("SELECT user_id, event_id, CASE WHEN p IS NOT NULL THEN 'changed' ELSE 'first' END AS kind, CAST(p AS VARCHAR) AS replaced FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)")
def version_history(spark, d):
    p = F.lag("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return t(spark, d, "events").select("user_id", "event_id", p.alias("replaced")).select("user_id", "event_id", F.when(F.col("replaced").isNotNull(), "changed").otherwise("first").alias("kind"), F.col("replaced").cast("string").alias("replaced"))


@query("""WITH x AS (SELECT p_partkey, p_size * 50 AS w, p_partkey % 4000 + 1 AS h FROM part), f AS (SELECT *, 1500.0::DOUBLE / greatest(w, h) AS f FROM x)
SELECT p_partkey, CAST(CASE WHEN f < 1 THEN round_even(w * f, 0) ELSE w END AS BIGINT) AS w, CAST(CASE WHEN f < 1 THEN round_even(h * f, 0) ELSE h END AS BIGINT) AS h FROM f""")
def resize_bounds(spark, d):
    x = t(spark, d, "part").withColumn("r", layout.resize_bounds(F.col("p_size") * 50, F.col("p_partkey") % 4000 + 1, 1500))
    return x.select("p_partkey", "r.w", "r.h")


@query("SELECT i AS page, CAST(l.quality AS VARCHAR) AS quality FROM (SELECT unnest(range(1, (SELECT max(doc_id) FROM documents) + 1)) AS i) LEFT JOIN labels l ON l.doc_id = i")
def known_pages(spark, d):
    """Every page of a book from 1 on, with what is stored for it; the documents are one book."""
    total = t(spark, d, "documents").agg(F.max("doc_id").alias("max_page")).withColumn("book", F.lit("b"))
    stored = t(spark, d, "labels").select(F.lit("b").alias("book"), F.col("doc_id").alias("page"), F.col("quality").cast("string").alias("quality"))
    return books.known_pages(total, stored, ["book"]).select("page", "quality")


@query("SELECT doc_id, CASE WHEN max(k) = 1 THEN 'approved' ELSE 'edited by hand' END AS why FROM (SELECT doc_id, 1 AS k FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 0 FROM documents WHERE n_chars > 800) GROUP BY 1")
def protected_pages(spark, d):
    r = t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "approved").otherwise("needs_fix").alias("status"))
    return books.protected_pages(r, t(spark, d, "documents").where("n_chars > 800").select("doc_id"), "doc_id")