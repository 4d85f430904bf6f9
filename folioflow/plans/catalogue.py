"""Queries over the driver's tables, one per operator, with their SQL.

documents stand for pages, conversations for ordered coloured blocks (role is the
colour), lineitem for words or spans of a page (order is the page), orders for
pages at volume, events for an edit log, labels for review decisions (quality 1:
approved, 0: needs_fix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import matching
from ..functions import text as tx
from ..operators import archive, core, layout, quality, reports, validate
from ..sources import exports, pages

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
ACCENTED = ((0xC0, 0xFF),)
ASCII_WORD = ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def L(c):  # noqa: N802
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


_SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SPACES = "(SELECT string_agg(chr(c), '') FROM (SELECT unnest([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288]) AS c))"


def _strip(x):
    return f"trim({x}, {_SPACES})"


# ---- functions -------------------------------------------------------------


@query(r"""SELECT doc_id, CAST(len(string_split(x, chr(10))) AS BIGINT) AS lines,
  CAST((SELECT count(*) FROM (SELECT l, lag(l) OVER (ORDER BY i) AS p FROM (SELECT unnest(string_split(x, chr(10))) AS l, generate_subscripts(string_split(x, chr(10)), 1) AS i)) WHERE NOT regexp_matches(l, '^\s*$') AND (p IS NULL OR regexp_matches(p, '^\s*$'))) AS BIGINT) AS paragraphs,
  CAST(length(x) AS BIGINT) AS chars, CAST(len(regexp_extract_all(x, '[A-Za-z]')) AS BIGINT) AS latin_chars, CAST(len(regexp_extract_all(x, '[0-9]')) AS BIGINT) AS ascii_digits,
  CAST(length(regexp_replace(x, '[\x00-\x7F]', '', 'g')) AS BIGINT) AS other_chars,
  concat_ws('; ', CASE WHEN x = '' THEN 'empty' END, CASE WHEN NOT regexp_matches(x, '[A-Za-z]') THEN 'no latin letters' END, CASE WHEN regexp_matches(x, '[0-9]') THEN len(regexp_extract_all(x, '[0-9]')) || ' digits' END, CASE WHEN len(string_split(x, chr(10))) = 1 THEN 'one line' END) AS flags
FROM (SELECT doc_id, coalesce(text, '') AS x FROM documents)""")
def page_report(spark, d):
    return quality.page_report(t(spark, d, "documents"), "doc_id")


@query("""SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z]')) AS BIGINT) AS latin, CAST(len(regexp_extract_all(text, '[0-9]')) AS BIGINT) AS digits, CAST(len(regexp_extract_all(text, '[À-ÿ]')) AS BIGINT) AS accented, substr(regexp_replace(text, '[^A-Za-z]', '', 'g'), 1, 20) AS first_latin FROM documents""")
def script_counts(spark, d):
    x = F.col("text")
    return t(spark, d, "documents").select("doc_id", tx.count_in(x, tx.ALPHABETS["latin"]).alias("latin"), tx.count_in(x, tx.ALPHABETS["digit"]).alias("digits"), tx.count_in(x, ACCENTED).alias("accented"), tx.first_in(x, tx.ALPHABETS["latin"]).alias("first_latin"))


@query("""SELECT doc_id, sha256(regexp_replace(nfc_normalize(text), '[^0-9A-Za-zÀ-ÿ]', '', 'g')) AS verify_form, sha256(regexp_replace(nfc_normalize(text), '[^À-ÿ]', '', 'g')) AS build_form, sha256(regexp_replace(text, '[^A-Za-zÀ-ÿ]', '', 'g')) AS v1_form FROM documents""")
def alphabet_normalize(spark, d):
    x = F.col("text")
    kept = lambda c, r: F.sha2(tx.keep_alphabet(c, r), 256)
    return t(spark, d, "documents").withColumn("n", tx.composed(x)).select("doc_id", kept(F.col("n"), ASCII_WORD + ACCENTED).alias("verify_form"), kept(F.col("n"), ACCENTED).alias("build_form"), kept(x, tx.ALPHABETS["latin"] + ACCENTED).alias("v1_form"))


_CLEAN = "replace(replace(regexp_replace(text, '\\*\\*|、', '', 'g'), '<<', '«'), '>>', '»')"
for _old, _new in ((f"(?m)^{_SPACE}*#+{_SPACE}+", ""), (rf"{_SPACE}*\n{_SPACE}*", " "), (f"{_SPACE}*(?:::|፡፡|：：)", "።"), (r"[ \t]{2,}", " ")):
    _CLEAN = f"regexp_replace({_CLEAN}, '{_old}', '{_new}', 'g')"


@query(f"SELECT doc_id, sha256({_strip(_CLEAN)}) AS cleaned, sha256({_strip(_CLEAN.replace('(text,', '(marked,'))}) AS marked FROM (SELECT doc_id, text, '  ## ' || replace(replace(text, ', ', ' :: '), '. ', chr(10) || '#x ** ') AS marked FROM documents)")
def clean_text(spark, d):
    """Texts as they are, and with marks put into them."""
    marked = F.concat(F.lit("  ## "), F.replace(F.replace("text", F.lit(", "), F.lit(" :: ")), F.lit(". "), F.lit("\n#x ** ")))
    return t(spark, d, "documents").select("doc_id", F.sha2(tx.clean_text(F.col("text")), 256).alias("cleaned"), F.sha2(tx.clean_text(marked), 256).alias("marked"))


_MARK = tx.WATERMARK
_NUMBERS = tx.PAGE_NUMBER.replace("'", "''")
_LINE_REASON = f"CASE WHEN regexp_matches(l, '{_MARK}') THEN 'website/watermark: ' || substr(l, 1, 120) WHEN regexp_matches(l, '{_NUMBERS}') THEN 'page number: ' || substr(l, 1, 80) WHEN NOT regexp_matches(l, '[À-ÿ]') AND regexp_matches(l, '[A-Za-z]') THEN 'latin artifact: ' || substr(l, 1, 120) END"


@query(rf"""WITH l AS (SELECT doc_id, {_strip('x')} AS l, i FROM (SELECT doc_id, unnest(string_split(r, chr(10))) AS x, generate_subscripts(string_split(r, chr(10)), 1) AS i FROM (SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS r FROM documents))),
m AS (SELECT *, CASE WHEN l <> '' THEN {_LINE_REASON} END AS why FROM l)
SELECT doc_id, sha256(trim(regexp_replace(coalesce(string_agg(regexp_replace(l, '[ \t]+', ' ', 'g'), chr(10) ORDER BY i) FILTER (why IS NULL), ''), '\n\n\n+', chr(10) || chr(10), 'g'), chr(10))) AS cleaned,
  sha256(coalesce(string_agg(why, '|' ORDER BY i) FILTER (why IS NOT NULL), '')) AS removed, CAST(count(why) AS BIGINT) AS n FROM m GROUP BY doc_id""")
def clean_lines_removed(spark, d):
    """The archived cleaner; letters with marks stand for the script."""
    c = t(spark, d, "documents").select("doc_id", tx.clean_lines(F.col("text"), ACCENTED).alias("c"))
    return c.select("doc_id", F.sha2("c.text", 256).alias("cleaned"), F.sha2(F.array_join("c.removed", "|"), 256).alias("removed"), F.size("c.removed").cast("long").alias("n"))


_SCORE = f"""coalesce(c, 0.0) + least(25.0::DOUBLE, s / 35.0::DOUBLE) + s::DOUBLE / greatest(s + l, 1) * 20.0 + least(10.0::DOUBLE, n * 0.4::DOUBLE) + least(5.0::DOUBLE, w / 60.0::DOUBLE) - l::DOUBLE / greatest(s + l, 1) * 18.0 - m * 4.0 - CASE WHEN s < 20 THEN 10.0 ELSE 0.0 END"""


@query(rf"""WITH x AS (SELECT source, doc_id, CAST(n_chars % 100 AS DOUBLE) AS c, doc_id % 700 AS w, len(regexp_extract_all(text, '[À-ÿ]')) AS s, len(regexp_extract_all(text, '[A-Za-z]')) AS l,
  len(list_filter(string_split_regex(text, '\r\n|[\n\r\x0B\f\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]'), lambda y: {_strip('y').replace(_SPACES, 'p')} <> '')) AS n, len(list_filter(string_split_regex(text, '\r\n|[\n\r\x0B\f\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]'), lambda y: regexp_matches(y, '{_MARK}'))) AS m FROM documents, (SELECT {_SPACES} AS p)),
r AS (SELECT source, doc_id, {_SCORE} AS score FROM x)
SELECT source, doc_id, round(score, 6) AS score, CAST(variants AS BIGINT) AS variants_tried FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS i, count(*) OVER (PARTITION BY source) AS variants FROM r) WHERE i = 1""")
def ocr_score_best(spark, d):
    """Attempts stand as documents, pages as sources: the best attempt of each, by the archived score."""
    x = t(spark, d, "documents").withColumn("c", (F.col("n_chars") % 100).cast("double"))
    scored = x.select("source", F.col("doc_id").alias("seq"), "doc_id", tx.candidate_score(F.col("text"), F.col("c"), F.col("doc_id") % 700, ACCENTED).alias("score"))
    return archive.best_attempts(scored, ["source"]).select("source", "doc_id", F.round("score", 6).alias("score"), "variants_tried")


@query(rf"""WITH c AS (SELECT doc_id, text, CASE lang WHEN 'en' THEN 'Text' WHEN 'de' THEN 'List-item' ELSE 'Title' END AS category FROM documents),
v AS (SELECT *, CASE WHEN category <> 'Title' THEN length(regexp_extract(text, '^([A-Z]+)\.?{_SPACE}+')) ELSE 0 END AS cut FROM c)
SELECT doc_id, CASE WHEN category <> 'Title' THEN regexp_extract(text, '^([A-Z]+)\.?{_SPACE}+', 1) ELSE '' END AS num, sha256(substr(text, cut + 1)) AS rest, CAST(cut AS BIGINT) AS cut,
  concat_ws(';', CASE WHEN 2 > cut THEN greatest(0, 1 - cut) || '-' || (2 - cut) END, CASE WHEN 9 > cut THEN greatest(0, 1 - cut) || '-' || (9 - cut) END) AS runs, CASE WHEN category = 'Title' THEN 'title' WHEN cut > 0 THEN 'verse' ELSE 'prayer' END AS role FROM v""")
def verse_split(spark, d):
    """Capitals stand for numerals; the stretches 1-2 and 1-9 move with the text."""
    kind = F.when(F.col("lang") == "en", "Text").when(F.col("lang") == "de", "List-item").otherwise("Title")
    x = t(spark, d, "documents").withColumn("category", kind).withColumn("v", tx.verse_split(F.col("text"), F.col("category"), "[A-Z]"))
    runs = F.array(*[F.struct(F.lit(1).alias("s"), F.lit(e).alias("e")) for e in (2, 9)])
    shown = F.array_join(F.transform(tx.shift_runs(runs, F.col("v.cut")), lambda r: F.concat(r["s"].cast("string"), F.lit("-"), r["e"].cast("string"))), ";")
    return x.select("doc_id", F.col("v.verse").alias("num"), F.sha2("v.text", 256).alias("rest"), L(F.col("v.cut")).alias("cut"), shown.alias("runs"), tx.role_of(F.col("category"), F.col("v.verse")).alias("role"))


@query(r"""SELECT a.item_id AS a_id, b.item_id AS b_id, CAST(levenshtein(regexp_replace(a.text, '[^\x00-\x7F]', '', 'g'), regexp_replace(b.text, '[^\x00-\x7F]', '', 'g')) AS BIGINT) AS edits FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1""")
def edit_distance(spark, d):
    b = t(spark, d, "benchmark").select("item_id", F.regexp_replace("text", r"[^\x00-\x7F]", "").alias("x"))
    n = b.select((F.col("item_id") - 1).alias("a_id"), F.col("item_id").alias("b_id"), F.col("x").alias("y"))
    return b.join(n, F.col("item_id") == F.col("a_id")).select("a_id", "b_id", F.levenshtein("x", "y").cast("long").alias("edits"))


@query("SELECT doc_id, sha256(text) AS content_sha256 FROM documents")
def content_hash(spark, d):
    return t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_sha256"))


#: Letters that stand for letters, numerals and signs of the script, and for some outside it.
_LATIN, _SCRIPT_LIKE = "abcdefghijklmn", "ሀለሐመ፩፪፼፡ᎀⶀꬁꬡé፟"


@query(f"SELECT doc_id, regexp_replace(regexp_replace(translate(text, '{_LATIN}', '{_SCRIPT_LIKE}'), '{tx.char_class(tx.ALPHABETS['v1'], negate=True)}', '', 'g'), '[፩-፼]', '', 'g') AS form FROM documents")
def normalize_v1(spark, d):
    """The archived normaliser on texts some of whose letters are made the script's."""
    return t(spark, d, "documents").select("doc_id", tx.normalize_v1(F.translate("text", _LATIN, _SCRIPT_LIKE)).alias("form"))


@query("SELECT doc_id, 'page_' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') AS stem FROM documents")
def page_stems(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.page_stem(F.col("doc_id") % 1000).alias("stem"))


def _ornament(x):
    tokens = f"regexp_extract_all({x}, '[^{_SPACE[1:]}+')"
    return f"(len(regexp_extract_all({x}, '[A-Za-z]')) < 2 OR length({x}) > 200 OR coalesce(len({tokens}) >= 3 AND len(list_distinct({tokens})) = 1 AND len(regexp_extract_all({tokens}[1], '[A-Za-z]')) <= 2, false))"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents), w AS (SELECT doc_id, repeat(substr(x, 1, 2) || ' ', 4) AS x FROM l)
SELECT doc_id, {_ornament('text')} AS whole, lines, stutters FROM documents JOIN (SELECT doc_id, CAST(count(*) FILTER ({_ornament('x')}) AS BIGINT) AS lines FROM l GROUP BY 1) USING (doc_id) JOIN (SELECT doc_id, CAST(count(*) FILTER ({_ornament('x')}) AS BIGINT) AS stutters FROM w GROUP BY 1) USING (doc_id)""")
def ornament_readings(spark, d):
    """Whole texts, their lines, and for each line its first two characters four times over."""
    x = t(spark, d, "documents").withColumn("l", F.split("text", "\n"))
    n = lambda lines: F.size(F.filter(lines, lambda y: tx.is_ornament_reading(y, tx.ALPHABETS["latin"]))).cast("long")
    return x.select("doc_id", tx.is_ornament_reading(F.col("text"), tx.ALPHABETS["latin"]).alias("whole"), n(F.col("l")).alias("lines"), n(F.transform("l", lambda y: F.repeat(F.concat(F.substring(y, 1, 2), F.lit(" ")), F.lit(4)))).alias("stutters"))


@query("SELECT doc_id, coalesce(lower(x) LIKE '%draft%' OR lower(x) LIKE '%tesseract on cleaned layers%', false) AS draft FROM (SELECT doc_id, CASE lang WHEN 'en' THEN source || ' Draft' WHEN 'de' THEN 'TESSERACT on cleaned layers ' || source WHEN 'fr' THEN source END AS x FROM documents)")
def draft_predicate(spark, d):
    x = F.when(F.col("lang") == "en", F.concat("source", F.lit(" Draft"))).when(F.col("lang") == "de", F.concat(F.lit("TESSERACT on cleaned layers "), "source")).when(F.col("lang") == "fr", F.col("source"))
    return t(spark, d, "documents").select("doc_id", tx.is_draft(x).alias("draft"))


# ---- ordered computations --------------------------------------------------


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
m AS (SELECT *, regexp_matches(line, '^\s*$') AS b FROM l), s AS (SELECT *, (NOT b AND coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY pos), true)) AS st FROM m),
n AS (SELECT *, sum(CAST(st AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS p FROM s WHERE true)
SELECT doc_id, CAST(p AS BIGINT) AS paragraph, sha256(string_agg(line, chr(10) ORDER BY pos)) AS body, count(*) AS lines FROM n WHERE NOT b GROUP BY 1, 2""")
def paragraph_islands(spark, d):
    return core.paragraphs(t(spark, d, "documents"), "doc_id").select("doc_id", L("paragraph").alias("paragraph"), F.sha2("text", 256).alias("body"), "lines")


@query("""WITH c AS (SELECT conv_id, turn, CASE WHEN length(text) % 3 = 0 THEN 'red' ELSE 'black' END AS c, text FROM conversations), n AS (SELECT *, CASE WHEN lag(c) OVER w IS DISTINCT FROM c THEN 1 ELSE 0 END AS s FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), r AS (SELECT *, sum(s) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM n)
SELECT conv_id, CAST(run AS BIGINT) AS run, c, sha256(string_agg(text, ' ' ORDER BY turn)) AS body, count(*) AS parts FROM r GROUP BY 1, 2, 3""")
def colour_runs(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "turn", F.when(F.length("text") % 3 == 0, "red").otherwise("black").alias("c"), "text")
    return core.runs(c, ["conv_id"], ["turn"], "c", "text").select("conv_id", L("run").alias("run"), "c", F.sha2("text", 256).alias("body"), "parts")


_FILL = """WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_id % 7 = 0 THEN event_type END AS opens FROM events),
f AS (SELECT *, CASE WHEN opens IS NOT NULL AND row_number() OVER (PARTITION BY user_id, opens ORDER BY ts, event_id) = 1 THEN opens END AS o FROM e),
s AS (SELECT *, last_value(o IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS section FROM f)
"""


@query(_FILL + "SELECT user_id, event_id, section, section || '_' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS block_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, section ORDER BY ts, event_id) AS n FROM s) WHERE section IS NOT NULL")
def section_forward_fill(spark, d):
    e = t(spark, d, "events").select("user_id", "ts", "event_id", F.when(F.col("event_id") % 7 == 0, F.col("event_type")).alias("opens"))
    s = core.first_openings(e, ["user_id"], ["ts", "event_id"], "opens").where("section IS NOT NULL")
    return core.numbered(s, ["user_id", "section"], ["ts", "event_id"], F.col("section")).select("user_id", "event_id", "section", "block_id")


@query(_FILL + "SELECT user_id, section, min(event_id) AS first_page, max(event_id) AS last_page, count(*) AS blocks FROM s WHERE section IS NOT NULL GROUP BY 1, 2")
def section_page_span(spark, d):
    e = t(spark, d, "events").select("user_id", "ts", "event_id", F.when(F.col("event_id") % 7 == 0, F.col("event_type")).alias("opens"))
    s = core.first_openings(e, ["user_id"], ["ts", "event_id"], "opens").where("section IS NOT NULL")
    return s.groupBy("user_id", "section").agg(F.min("event_id").alias("first_page"), F.max("event_id").alias("last_page"), F.count("*").alias("blocks"))


@query("""SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - CASE WHEN lead(event_type = 'click') OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS end_page FROM events""")
def section_bounds_lead(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", (F.col("event_type") == "click").alias("mid"))
    return core.bounds(e, ["user_id"], "event_id", "mid").select("user_id", "event_id", "end_page")


@query("""SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS line FROM orders""")
def line_ordering(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", F.row_number().over(w).cast("long").alias("line"))


@query("""SELECT user_id, event_id, CAST(r AS BIGINT) AS rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 50""")
def history_top50(spark, d):
    return core.newest(t(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", L("rank").alias("rank"))


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events WHERE value < 70) WHERE r <= 30""")
def low_confidence_cap(spark, d):
    return core.newest(t(spark, d, "events").where("value < 70"), ["user_id"], [F.asc("event_id")], 30).select("user_id", "event_id", "value")


@query("""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE i IN (0, n // 2, n - 1)""")
def sample_pages(spark, d):
    return core.sample_pages(t(spark, d, "documents").select("source", "doc_id"), "doc_id", ["source"])


@query("""SELECT user_id, array_to_string(list_slice(ids, 1, 4), ', ') || CASE WHEN len(ids) > 4 THEN ' (+' || (len(ids) - 4) || ' more)' ELSE '' END AS shown FROM (SELECT user_id, list(CAST(event_id AS VARCHAR) ORDER BY event_id) AS ids FROM events GROUP BY 1)""")
def first_n_preview(spark, d):
    g = t(spark, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_list("event_id")).alias("ids"))
    return g.select("user_id", core.preview(F.col("ids").cast("array<string>"), 4).alias("shown"))


@query("""SELECT conv_id, role, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> '')) AS body FROM (SELECT conv_id, turn, role, CASE WHEN length(text) % 5 > 0 THEN text ELSE '' END AS text FROM conversations) GROUP BY 1, 2 HAVING count(*) FILTER (text <> '') > 0""")
def text_export(spark, d):
    """The texts of each page and role; regions without text leave no gap."""
    c = t(spark, d, "conversations").withColumn("text", F.when(F.length("text") % 5 > 0, F.col("text")).otherwise("")).withColumn("key", F.struct("conv_id", "role"))
    e = exports.page_texts(c, "key", "turn").where("body <> ''")
    return e.select("key.conv_id", "key.role", F.sha2("body", 256).alias("body"))


# ---- joins and sets --------------------------------------------------------

_RULES = [("a", 1, 1, 200), ("b", 2, 150, 400), ("c", 3, 401, 900), ("d", 4, 850, 100000)]
_RULES_SQL = "(VALUES " + ", ".join(f"('{s}', {o}, {a}, {b})" for s, o, a, b in _RULES) + ") AS r(section_id, ord, first_page, last_page)"


@query(f"SELECT o_orderkey, arg_min(section_id, ord) AS section_id FROM orders LEFT JOIN {_RULES_SQL} ON o_orderkey BETWEEN first_page AND last_page GROUP BY 1")
def section_range_join(spark, d):
    return core.section_ranges(t(spark, d, "orders").select("o_orderkey"), _RULES, "o_orderkey")


@query(f"SELECT o_orderkey, coalesce(string_agg(section_id, '|' ORDER BY ord), '') AS sections FROM orders LEFT JOIN {_RULES_SQL} ON o_orderkey BETWEEN first_page AND last_page GROUP BY 1")
def section_all_ranges(spark, d):
    return core.all_sections(t(spark, d, "orders").select("o_orderkey"), _RULES, "o_orderkey")


_KEYS = [("first", 1, [["the", "der"], ["and", "und"]]), ("second", 2, [["que", "die"]]), ("third", 3, [["les", "des", "the"], ["a"]]), ("none", 4, [])]


def _fits_sql(x):
    return ", ".join(f"CASE WHEN x <> '' AND {' AND '.join('(' + ' OR '.join(f'contains({x}, {chr(39)}{a}{chr(39)})' for a in g) + ')' for g in groups)} THEN '{name}' END" for name, _, groups in _KEYS if groups)


@query(f"""WITH RECURSIVE n AS (SELECT conv_id, turn, regexp_replace(nfc_normalize(text), '[^0-9A-Za-zÀ-ÿ]', '', 'g') AS x FROM conversations),
f AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, list_filter([{_fits_sql('x')}], lambda y: y IS NOT NULL) AS fits FROM n),
s(conv_id, i, seen, opens) AS (SELECT DISTINCT conv_id, 0::BIGINT, CAST([] AS VARCHAR[]), NULL::VARCHAR FROM f
  UNION ALL SELECT s.conv_id, f.i, CASE WHEN len(list_filter(f.fits, lambda y: NOT list_contains(s.seen, y))) > 0 THEN list_append(s.seen, list_filter(f.fits, lambda y: NOT list_contains(s.seen, y))[1]) ELSE s.seen END, list_filter(f.fits, lambda y: NOT list_contains(s.seen, y))[1]
  FROM s JOIN f ON f.conv_id = s.conv_id AND f.i = s.i + 1)
SELECT f.conv_id, f.turn, s.opens FROM s JOIN f USING (conv_id, i) WHERE s.opens IS NOT NULL""")
def keyword_sections(spark, d):
    """Messages stand for titles: each opens the first section it fits that is not open yet."""
    x = t(spark, d, "conversations").withColumn("x", tx.keep_alphabet(tx.composed(F.col("text")), ASCII_WORD + ACCENTED))
    return core.openings(x.withColumn("fits", core.fitting_rules(F.col("x"), _KEYS)), ["conv_id"], ["turn"], "fits")


@query("""WITH w AS (SELECT row_number() OVER () AS rid, l_orderkey AS page, l_linenumber AS word, l_partkey % 1000 AS x1, l_suppkey % 500 AS y1, l_partkey % 1000 + l_quantity AS x2, l_suppkey % 500 + 20 AS y2 FROM lineitem),
b AS (SELECT o_orderkey AS page, o AS ord, o * 250 AS x1, 0 AS y1, o * 250 + 300 AS x2, 400 AS y2 FROM orders, (VALUES (0), (1), (2), (3)) AS v(o))
SELECT w.page, w.word, CAST(min(b.ord) AS BIGINT) AS region FROM w LEFT JOIN b ON w.page = b.page AND (w.x1 + w.x2) / 2 BETWEEN b.x1 - 40 AND b.x2 + 40 AND (w.y1 + w.y2) / 2 BETWEEN b.y1 - 40 AND b.y2 + 40 GROUP BY rid, w.page, w.word""")
def containment_join(spark, d):
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("word"), (F.col("l_partkey") % 1000).alias("x1"), (F.col("l_suppkey") % 500).alias("y1"), (F.col("l_partkey") % 1000 + F.col("l_quantity")).alias("x2"), (F.col("l_suppkey") % 500 + 20).alias("y2"))
    b = t(spark, d, "orders").select(F.col("o_orderkey").alias("page"), F.explode(F.array(*map(F.lit, range(4)))).alias("ord"))
    b = b.select("page", "ord", (F.col("ord") * 250).alias("x1"), F.lit(0).alias("y1"), (F.col("ord") * 250 + 300).alias("x2"), F.lit(400).alias("y2"))
    return core.inside(w, b, ["page"], 40).select("page", "word", L("region").alias("region"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_pages(spark, d):
    return core.missing(t(spark, d, "documents").select("doc_id"), t(spark, d, "labels").select("doc_id"), ["doc_id"])


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels WHERE quality = 1")
def approved_pages(spark, d):
    return t(spark, d, "documents").select("doc_id").intersect(t(spark, d, "labels").where("quality = 1").select("doc_id"))


@query("SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'missing' ELSE 'unexpected' END AS side FROM (SELECT doc_id FROM documents WHERE n_chars > 200) a FULL JOIN (SELECT doc_id FROM labels) b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL")
def analysis_sym_diff(spark, d):
    return core.symmetric_difference(t(spark, d, "documents").where("n_chars > 200"), t(spark, d, "labels"), "doc_id")


@query("SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM labels WHERE quality = 0")
def union_low_unassigned(spark, d):
    x = t(spark, d, "labels")
    return x.where("toxic = 1").select("doc_id").union(x.where("quality = 0").select("doc_id")).distinct()


@query("SELECT text, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_regions(spark, d):
    return validate.repeated(t(spark, d, "documents"), ["text"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_ids(spark, d):
    """Lines that share their order and number, which should name one line."""
    return validate.repeated(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""WITH o AS (SELECT user_id, max(event_id) AS last, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1), w AS (SELECT user_id, max(event_id) AS last, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT coalesce(w.user_id, o.user_id) AS user_id, coalesce(w.last, o.last) AS last, coalesce(w.n, o.n) AS n FROM o FULL JOIN w ON o.user_id = w.user_id""")
def report_upsert(spark, d):
    e = t(spark, d, "events")
    per = lambda x: x.groupBy("user_id").agg(F.max("event_id").alias("last"), F.count("*").alias("n"))
    return core.upsert(per(e.where("event_type = 'view'")), per(e.where("event_type = 'click'")), "user_id", ["last", "n"])


@query("SELECT user_id, arg_max(event_id, ts::VARCHAR || lpad(event_id::VARCHAR, 12, '0')) AS event_id FROM events GROUP BY 1")
def latest_candidate(spark, d):
    return core.latest(t(spark, d, "events"), "user_id", "event_id", F.struct("ts", "event_id"))


@query("""WITH n AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'approved' ELSE 'needs_fix' END AS status FROM labels), o AS (SELECT doc_id, CASE WHEN n_chars > 500 THEN 'approved' WHEN n_chars > 100 THEN 'needs_fix' END AS status FROM documents WHERE lang <> 'de')
SELECT coalesce(n.doc_id, o.doc_id) AS doc_id, n.status AS status, CASE WHEN n.doc_id IS NULL THEN 'removed' WHEN o.doc_id IS NULL THEN 'added' WHEN n.status IS NOT DISTINCT FROM o.status THEN 'kept' ELSE 'changed' END AS change FROM n FULL JOIN o ON n.doc_id = o.doc_id""")
def review_merge_changed(spark, d):
    n = t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "approved").otherwise("needs_fix").alias("status"))
    o = t(spark, d, "documents").where("lang <> 'de'").select("doc_id", F.when(F.col("n_chars") > 500, "approved").when(F.col("n_chars") > 100, "needs_fix").alias("status"))
    return core.restamped(o, n, "doc_id", ["status"])


@query("""SELECT user_id, event_id, CASE WHEN p IS NULL OR p % 10 <> 3 THEN 'saved' ELSE 'conflict' END AS outcome FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""")
def save_conflicts(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    p = F.lag("event_id").over(w)
    return t(spark, d, "events").select("user_id", "event_id", p.alias("p")).select("user_id", "event_id", F.when(F.col("p").isNull() | (F.col("p") % 10 != 3), "saved").otherwise("conflict").alias("outcome"))


@query("SELECT doc_id + 1 AS page, lang FROM documents WHERE doc_id + 1 IN (3, 7) OR doc_id + 1 BETWEEN 10 AND 20 OR doc_id + 1 BETWEEN 100 AND 150")
def page_selector(spark, d):
    """The asked pages of the documents, which are one book."""
    p = t(spark, d, "documents").select((F.col("doc_id") + 1).alias("page"), "lang")
    return pages.selected(p, "7,3,10-20,12,100-150", p.agg(F.max("page")).first()[0])


# ---- aggregates ------------------------------------------------------------


@query("""WITH l AS (SELECT l_orderkey AS page, l_linenumber % 3 AS line, count(*) AS words, CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS red_words, min(l_partkey % 2000) AS x1, max(l_partkey % 2000 + 60) AS x2, min(l_suppkey % 300) AS y1, max(l_suppkey % 300 + 30) AS y2 FROM lineitem GROUP BY 1, 2)
SELECT *, red_words = words AS all_red, abs((x1 + x2) / 2.0 - 1000.0) / 2000 <= 0.06 AND (x2 - x1)::DOUBLE / 2000 <= 0.75 AND red_words = words AND words <= 6 AS looks_like_title FROM l""")
def line_totals(spark, d):
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") % 3).alias("line"), (F.col("l_partkey") % 2000).alias("x1"), (F.col("l_partkey") % 2000 + 60).alias("x2"), (F.col("l_suppkey") % 300).alias("y1"), (F.col("l_suppkey") % 300 + 30).alias("y2"), (F.col("l_returnflag") == "R").alias("is_red"))
    return layout.line_table(w, t(spark, d, "orders").select(F.col("o_orderkey").alias("page"), F.lit(2000).alias("width")))


@query("""SELECT page, CAST(count(*) AS BIGINT) AS line_count, CAST(sum(words) AS BIGINT) AS word_count, CAST(sum(red) AS BIGINT) AS red_word_count FROM (SELECT l_orderkey AS page, l_linenumber % 3 AS line, count(*) AS words, count(*) FILTER (l_returnflag = 'R' OR l_discount >= 0.05) AS red FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def layout_totals(spark, d):
    """Words of the red layer, or with enough red ink, are red."""
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") % 3).alias("line"), *[F.lit(0).alias(c) for c in ("x1", "y1", "x2", "y2")], layout.red_word(F.when(F.col("l_returnflag") == "R", "red").otherwise("black"), F.col("l_discount") * 10).alias("is_red"))
    return layout.layout_totals(layout.line_table(w, t(spark, d, "orders").select(F.col("o_orderkey").alias("page"), F.lit(2000).alias("width"))))


@query("""SELECT CAST(count(*) AS BIGINT) AS words, CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS red, round(count(*) FILTER (l_returnflag = 'R') * 100.0::DOUBLE / greatest(1, count(*)), 6) AS percent FROM lineitem""")
def red_percent(spark, d):
    totals = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("word_count"), F.count_if(F.col("l_returnflag") == "R").alias("red_word_count"))
    return layout.red_percent(totals).withColumn("percent", F.round("percent", 6))


@query("""SELECT l_orderkey AS page, round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS DOUBLE) / nullif(sum(CAST(l_quantity AS BIGINT)), 0), 6) AS red_share FROM lineitem GROUP BY 1""")
def red_share(spark, d):
    q = L("l_quantity")
    return t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.round(F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(0)) / F.nullif(F.sum(q), F.lit(0)), 6).alias("red_share"))


@query("""WITH c AS (SELECT count(*) AS analysed, CAST(count(*) FILTER (d.n_chars >= 50) AS BIGINT) AS content, CAST(count(*) FILTER (d.n_chars >= 50 AND l.doc_id IS NULL) AS BIGINT) AS missing_pages, CAST(count(*) FILTER (l.quality = 0) AS BIGINT) AS flagged, CAST(count(*) FILTER (l.toxic = 1) AS BIGINT) AS unverified, CAST(count(*) FILTER (l.quality IS DISTINCT FROM 1) AS BIGINT) AS unapproved, source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source),
x AS (SELECT c.*, k, CASE k WHEN 1 THEN 1 ELSE 0 END AS source_problems, CASE k WHEN 2 THEN 0 ELSE analysed END AS a, CASE WHEN k < 4 THEN missing_pages ELSE 0 END AS m, CASE WHEN k < 5 THEN flagged ELSE 0 END AS f, CASE WHEN k < 5 THEN unverified ELSE 0 END AS v, CASE WHEN k < 6 THEN unapproved ELSE 0 END AS u, CASE k WHEN 6 THEN 1 ELSE 0 END AS s FROM c, (VALUES (1), (2), (3), (4), (5), (6), (7)) AS z(k))
SELECT source, k, CASE WHEN source_problems > 0 THEN 'source_incomplete' WHEN a = 0 THEN 'not_analyzed' WHEN m > 0 OR content = 0 THEN 'incomplete' WHEN f > 0 OR v > 0 THEN 'needs_review' WHEN u > 0 THEN 'awaiting_approval' WHEN s > 0 THEN 'sectioning_incomplete' ELSE 'ready' END AS status,
  NOT (source_problems > 0 OR a = 0 OR m > 0 OR content = 0 OR f > 0 OR v > 0 OR u > 0 OR s > 0) AS production_ready FROM x""")
def quality_status(spark, d):
    """Sources stand for books; in turn a fault more of each is taken away."""
    l = t(spark, d, "labels").select(F.col("doc_id").alias("k_"), "quality", "toxic")
    c = t(spark, d, "documents").join(l, F.col("doc_id") == F.col("k_"), "left").groupBy("source").agg(F.count("*").alias("analysed"), F.count_if(F.col("n_chars") >= 50).alias("content"), F.count_if((F.col("n_chars") >= 50) & F.col("k_").isNull()).alias("missing_pages"), F.count_if(F.col("quality") == 0).alias("flagged"), F.count_if(F.col("toxic") == 1).alias("unverified"), F.count_if(~F.col("quality").eqNullSafe(1)).alias("unapproved"))
    c = c.withColumn("k", F.explode(F.array(*map(F.lit, range(1, 8)))))
    upto = lambda name, n: F.when(F.col("k") < n, F.col(name)).otherwise(0)
    c = c.withColumns({"source_problems": (F.col("k") == 1).cast("int"), "analysed": F.when(F.col("k") != 2, F.col("analysed")).otherwise(0), "missing_pages": upto("missing_pages", 4), "flagged": upto("flagged", 5), "unverified": upto("unverified", 5), "unapproved": upto("unapproved", 6), "missing_sections": (F.col("k") == 6).cast("int"), "missing_analysis": F.lit(0), "unexpected_analysis": F.lit(0)})
    return quality.status(c).select("source", "k", "status", "production_ready")


@query("""SELECT d.source, count(*) AS pages, CAST(count(l.doc_id) AS BIGINT) AS reviewed, CAST(count(*) FILTER (l.quality = 1) AS BIGINT) AS approved, CAST(count(*) FILTER (d.n_chars < 50) AS BIGINT) AS blank, max(d.doc_id) AS max_page FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def extraction_counters(spark, d):
    l = t(spark, d, "labels").select(F.col("doc_id").alias("k"), "quality")
    return t(spark, d, "documents").join(l, F.col("doc_id") == F.col("k"), "left").groupBy("source").agg(F.count("*").alias("pages"), F.count("k").alias("reviewed"), F.count_if(F.col("quality") == 1).alias("approved"), F.count_if(F.col("n_chars") < 50).alias("blank"), F.max("doc_id").alias("max_page"))


@query("""SELECT event_type, round(min(value), 2) AS min, round(median(value), 2) AS median, round(avg(value), 2) AS mean, round(max(value), 2) AS max FROM events GROUP BY 1""")
def confidence_summary(spark, d):
    return reports.confidence_summary(t(spark, d, "events"), ["event_type"], F.col("value"))


@query("""WITH p AS (SELECT l_orderkey AS page, o_orderpriority AS book, count(*) FILTER (l_returnflag = 'R')::DOUBLE / count(*) AS red, count(*) FILTER (l_linestatus = 'O') AS ornaments, bool_or(l_discount > 0.09) AS blank, bool_and(l_quantity > 45) AS picture FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
c AS (SELECT * FROM p WHERE NOT blank AND NOT picture)
SELECT book, sha256(coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (red < 0.005), '')) AS no_red, sha256(coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (red >= 0.005 AND red > 0.70), '')) AS too_much_red, sha256(coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (ornaments > 0), '')) AS ornaments FROM c GROUP BY 1""")
def audit_lists(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("book"))
    s = t(spark, d, "lineitem").join(o, "l_orderkey").groupBy(F.col("l_orderkey").alias("page"), "book").agg((F.count_if(F.col("l_returnflag") == "R") / F.count("*")).alias("red_ink_ratio"), F.count_if(F.col("l_linestatus") == "O").alias("red_components_dropped_ornament"), F.bool_or(F.col("l_discount") > 0.09).alias("is_blank"), F.bool_and(F.col("l_quantity") > 45).alias("is_illustration"))
    listed = lambda c: F.sha2(F.array_join(F.col(c).cast("array<string>"), ","), 256).alias(c)
    return reports.audit_lists(s, ["book"]).select("book", listed("no_red"), listed("too_much_red"), listed("ornaments"))


@query("""SELECT d.doc_id, CASE WHEN d.doc_id < 1 THEN 'bad page' WHEN text IS NULL OR text = '' THEN 'no text' WHEN length(text) > 10000 THEN 'too long' WHEN l.doc_id IS NOT NULL AND l.quality NOT IN (0, 1) THEN 'bad status' END AS problem FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id < 1 OR text IS NULL OR text = '' OR length(text) > 10000""")
def validation_rejects(spark, d):
    l = t(spark, d, "labels").select(F.col("doc_id").alias("k"), "quality")
    j = t(spark, d, "documents").join(l, F.col("doc_id") == F.col("k"), "left")
    problem = F.when(F.col("doc_id") < 1, "bad page").when(F.col("text").isNull() | (F.col("text") == ""), "no text").when(F.length("text") > 10000, "too long").when(F.col("k").isNotNull() & ~F.col("quality").isin(0, 1), "bad status")
    return j.select("doc_id", problem.alias("problem")).where("problem IS NOT NULL")


_MOST = 2_000_000
_FIT = "greatest(28, round_even({x} / 28.0::DOUBLE, 0) * 28)"


@query(f"""WITH s AS (SELECT DISTINCT l_partkey % 1500 * 2 + 1 AS w, (l_suppkey % 900 + 1) * 3 - 3 AS h FROM lineitem UNION SELECT p_size, p_partkey % 40 * 7 FROM part),
f AS (SELECT *, CASE WHEN least(w, h) <= 0 OR greatest(w, h)::DOUBLE / least(w, h) > 200 THEN 'unsupported image dimensions' END AS error, {_FIT.format(x='w')} AS fw, {_FIT.format(x='h')} AS fh FROM s),
a AS (SELECT *, CASE WHEN fw * fh > {_MOST} THEN greatest(28, floor(w * sqrt({_MOST}::DOUBLE / (w::DOUBLE * h)) / 28) * 28) ELSE fw END AS mw, CASE WHEN fw * fh > {_MOST} THEN greatest(28, floor(h * sqrt({_MOST}::DOUBLE / (w::DOUBLE * h)) / 28) * 28) ELSE fh END AS mh FROM f)
SELECT w, h, error, CAST(CASE WHEN error IS NULL THEN CASE WHEN mw * mh < 3136 THEN ceil(w * sqrt(3136::DOUBLE / (w::DOUBLE * h)) / 28) * 28 ELSE mw END END AS BIGINT) AS model_w, CAST(CASE WHEN error IS NULL THEN CASE WHEN mw * mh < 3136 THEN ceil(h * sqrt(3136::DOUBLE / (w::DOUBLE * h)) / 28) * 28 ELSE mh END END AS BIGINT) AS model_h FROM a""")
def model_dimensions(spark, d):
    s = t(spark, d, "lineitem").select((F.col("l_partkey") % 1500 * 2 + 1).alias("w"), ((F.col("l_suppkey") % 900 + 1) * 3 - 3).alias("h"))
    s = s.union(t(spark, d, "part").select("p_size", F.col("p_partkey") % 40 * 7)).distinct()
    m = s.withColumn("m", layout.model_dimensions(F.col("w"), F.col("h"), _MOST))
    return m.select("w", "h", "m.error", F.col("m.w").alias("model_w"), F.col("m.h").alias("model_h"))


# ---- what SQL cannot say ---------------------------------------------------


#: The ratio of pairs p (id, a, b): equal characters by diagonal; a round cuts each window at its longest stretch and deals the runs to both sides.
RATIO = """ra AS (SELECT id, unnest(string_split(a, '')) AS c, generate_subscripts(string_split(a, ''), 1) AS i FROM p WHERE a <> '' AND a <> b),
rb AS (SELECT id, unnest(string_split(b, '')) AS c, generate_subscripts(string_split(b, ''), 1) AS j FROM p WHERE b <> '' AND a <> b),
popular AS (SELECT id, c FROM rb JOIN p USING (id) WHERE length(b) >= 200 GROUP BY id, c, length(b) HAVING count(*) > length(b) // 100 + 1),
met AS (SELECT ra.id, i, i - j AS d, popular.c IS NOT NULL AS common FROM ra JOIN rb ON ra.id = rb.id AND ra.c = rb.c LEFT JOIN popular ON popular.id = ra.id AND popular.c = ra.c),
long_ AS (SELECT DISTINCT id FROM popular),
every AS (SELECT id, d, min(i) AS i0, count(*) AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY id, d ORDER BY i) AS g FROM met WHERE id IN (SELECT id FROM long_)) GROUP BY id, d, g),
rare AS (SELECT id, d, min(i) AS i0, count(*) AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY id, d ORDER BY i) AS g FROM met WHERE NOT common) GROUP BY id, d, g),
f(id, a1, a2, b1, b2, i0, n, d) AS (
  SELECT id, 1::BIGINT, length(a) + 1, 1::BIGINT, length(b) + 1, i0, n, d FROM p JOIN (SELECT id, i0, n, d FROM rare UNION ALL SELECT id, 1, 0, 0 FROM p) USING (id) WHERE a <> '' AND b <> '' AND a <> b
  UNION ALL
  SELECT id, a1, a2, b1, b2, CASE WHEN n = 0 THEN a1 ELSE greatest(i0, a1, b1 + d) END, CASE WHEN n = 0 THEN 0 ELSE least(i0 + n, a2, b2 + d) - greatest(i0, a1, b1 + d) END, CASE WHEN n = 0 THEN a1 - b1 ELSE d END
  FROM (SELECT id, i0, n, d, CASE WHEN s = 0 THEN a1 ELSE i + k END AS a1, CASE WHEN s = 0 THEN i ELSE a2 END AS a2, CASE WHEN s = 0 THEN b1 ELSE j + k END AS b1, CASE WHEN s = 0 THEN j ELSE b2 END AS b2
    FROM (SELECT id, a1, a2, b1, b2, i0, n, d, -best[2] - back AS i, -best[3] - back AS j, best[1] + back + greatest(0, least(a2 + best[2] - best[1], b2 + best[3] - best[1], e2 + best[2] - best[1])) AS k
      FROM (SELECT g.*, least(-best[2] - a1, -best[3] - b1, CASE WHEN e.id IS NULL THEN 0 ELSE -best[2] - e.i0 END) AS back, CASE WHEN e.id IS NULL THEN -best[2] + best[1] ELSE e.i0 + e.n END AS e2
        FROM (SELECT *, max([n, -i0, d - i0]) OVER (PARTITION BY id, a1, a2, b1, b2) AS best FROM f) g LEFT JOIN every e ON e.id = g.id AND e.d = best[3] - best[2] AND e.i0 <= -best[2] AND -best[2] < e.i0 + e.n)), (VALUES (0), (1)) t(s) WHERE k > 0)
  WHERE a1 < a2 AND b1 < b2 AND (n = 0 OR least(i0 + n, a2, b2 + d) > greatest(i0, a1, b1 + d))),
rect AS (SELECT id, a1, a2, b1, b2, max([n, -i0, d - i0]) AS best FROM f GROUP BY ALL),
block AS (SELECT r.id, best[1] + least(-best[2] - a1, -best[3] - b1, CASE WHEN e.id IS NULL THEN 0 ELSE -best[2] - e.i0 END) + greatest(0, least(a2 + best[2] - best[1], b2 + best[3] - best[1], CASE WHEN e.id IS NULL THEN 0 ELSE e.i0 + e.n + best[2] - best[1] END)) AS k
  FROM rect r LEFT JOIN every e ON e.id = r.id AND e.d = best[3] - best[2] AND e.i0 <= -best[2] AND -best[2] < e.i0 + e.n),
ratio AS (SELECT p.id, CASE WHEN p.a = p.b THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * coalesce(s.k, 0) / (length(p.a) + length(p.b)) END AS r FROM p LEFT JOIN (SELECT id, CAST(sum(k) AS BIGINT) AS k FROM block GROUP BY id) s USING (id) WHERE p.a IS NOT NULL AND p.b IS NOT NULL)"""


@query(f"""WITH RECURSIVE p AS (SELECT row_number() OVER () AS id, conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS a, text AS b FROM conversations), {RATIO}
SELECT conv_id, turn, r AS agreement FROM p LEFT JOIN ratio USING (id)""")
def similarity_ratio(spark, d):
    """Each message against the one before it, whole texts."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    c = t(spark, d, "conversations").select("conv_id", "turn", "text", before.alias("reading"))
    return c.select("conv_id", "turn", matching.ratio("reading", "text").alias("agreement"))


@query("""WITH RECURSIVE w AS (SELECT l_orderkey AS page, l_linenumber AS word, (l_partkey % 1000)::DOUBLE AS x1, (l_suppkey % 40 * 5)::DOUBLE AS y1, (l_suppkey % 40 * 5 + 12)::DOUBLE AS y2 FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY y1, word) AS i FROM w),
f(page, i, g, hit) AS (SELECT DISTINCT page, 0::BIGINT, CAST([] AS STRUCT(t DOUBLE, l DOUBLE, b DOUBLE)[]), 0::BIGINT FROM r
  UNION ALL SELECT page, i, CASE WHEN p = 0 THEN list_append(g, {'t': y1, 'l': x1, 'b': y2}) ELSE list_transform(g, lambda x, k: CASE WHEN k = p THEN {'t': least(x.t, y1), 'l': least(x.l, x1), 'b': greatest(x.b, y2)} ELSE x END) END, CASE WHEN p = 0 THEN len(g) + 1 ELSE p END
  FROM (SELECT r.page, r.i, r.x1, r.y1, r.y2, f.g, coalesce(list_position(list_transform(f.g, lambda x: x.t - 0.4 * (r.y2 - r.y1) <= (r.y1 + r.y2) / 2 AND (r.y1 + r.y2) / 2 <= x.b + 0.4 * (r.y2 - r.y1)), true), 0) AS p FROM f JOIN r ON r.page = f.page AND r.i = f.i + 1)),
last AS (SELECT page, arg_max(g, i) AS g FROM f GROUP BY page),
o AS (SELECT page, k, row_number() OVER (PARTITION BY page ORDER BY x.t, x.l, k) AS line FROM (SELECT page, unnest(g) AS x, generate_subscripts(g, 1) AS k FROM last))
SELECT r.page, r.word, o.line, row_number() OVER (PARTITION BY r.page, o.line ORDER BY r.x1, r.i) AS place FROM r JOIN f USING (page, i) JOIN o ON o.page = f.page AND o.k = f.hit""")
def line_grouping(spark, d):
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), L("l_linenumber").alias("word"), (F.col("l_partkey") % 1000).cast("double").alias("x1"), (F.col("l_suppkey") % 40 * 5).cast("double").alias("y1"), (F.col("l_suppkey") % 40 * 5 + 12).cast("double").alias("y2"))
    return core.group_lines(w, "page").select("page", "word", L("line").alias("line"), "place")


@query("""WITH RECURSIVE b AS (SELECT l_orderkey AS page, l_partkey % 1000 AS x1, l_suppkey % 200 AS y1, l_partkey % 1000 + 80 AS x2, l_suppkey % 200 + 30 AS y2 FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY (y1 + (y2 - y1) // 2) // 60, x1, y1, x2, y2) AS i FROM b),
f(page, i, phrase, x1, y1, x2, y2) AS (SELECT page, i, 1::BIGINT, x1, y1, x2, y2 FROM r WHERE i = 1
  UNION ALL SELECT r.page, r.i, CASE WHEN near THEN phrase ELSE phrase + 1 END, CASE WHEN near THEN least(px1, r.x1) ELSE r.x1 END, CASE WHEN near THEN least(py1, r.y1) ELSE r.y1 END, CASE WHEN near THEN greatest(px2, r.x2) ELSE r.x2 END, CASE WHEN near THEN greatest(py2, r.y2) ELSE r.y2 END
  FROM (SELECT r.*, f.phrase, f.x1 AS px1, f.y1 AS py1, f.x2 AS px2, f.y2 AS py2, abs((f.y1 + f.y2) / 2.0 - (r.y1 + r.y2) / 2.0) < 50 AND r.x1 - f.x2 < 140 AS near FROM f JOIN r ON r.page = f.page AND r.i = f.i + 1) r)
SELECT page, phrase, arg_max(x1, i) AS x1, arg_max(y1, i) AS y1, arg_max(x2, i) AS x2, arg_max(y2, i) AS y2 FROM f GROUP BY page, phrase""")
def phrase_merge(spark, d):
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_partkey") % 1000).alias("x1"), (F.col("l_suppkey") % 200).alias("y1"), (F.col("l_partkey") % 1000 + 80).alias("x2"), (F.col("l_suppkey") % 200 + 30).alias("y2"))
    return core.merge_phrases(w, "page")


@query("""WITH RECURSIVE e AS (SELECT user_id AS page, event_id AS seq, lag(event_type, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS base, event_type AS body FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY seq) AS i FROM e),
f(page, i, cur, edited, outcome, archived, keeps, withdraws) AS (SELECT DISTINCT page, 0::BIGINT, NULL::VARCHAR, false, NULL::VARCHAR, NULL::VARCHAR, false, false FROM r
  UNION ALL SELECT r.page, r.i, CASE WHEN ok THEN body ELSE cur END, edited OR (ok AND cur IS NOT NULL AND cur <> body), CASE WHEN ok THEN 'saved' ELSE 'conflict' END, CASE WHEN ok AND cur <> body THEN cur END, ok AND cur IS NOT NULL AND cur <> body AND NOT edited, ok AND cur IS DISTINCT FROM body
  FROM (SELECT r.*, f.cur, f.edited, r.base IS NOT DISTINCT FROM f.cur AS ok FROM f JOIN r ON r.page = f.page AND r.i = f.i + 1) r)
SELECT f.page, r.seq, outcome, archived, keeps AS keeps_original, withdraws AS withdraws_approval FROM f JOIN r USING (page, i)""")
def save_fold(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = t(spark, d, "events").select(F.col("user_id").alias("page"), F.col("event_id").alias("seq"), F.lag("event_type", 2).over(w).alias("base"), F.col("event_type").alias("body_hash"))
    return core.fold_saves(e)