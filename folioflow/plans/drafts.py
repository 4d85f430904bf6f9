"""Queries on draft transcripts, page texts and verification, with their SQL.

Conversations stand for pages: a message is a layout region (its turn the order),
its category follows from the turn, Latin letters stand for the script.  Two
readings of red ink are made of each message's words, one of them misspelt.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import book, core, drafts, transcripts
from ..sources import pages as sources
from .catalogue import _SPACE, ACCENTED, ASCII_WORD, L, _strip, query, t

LATIN = tx.ALPHABETS["latin"]
CAPITAL = ((0x41, 0x5A),)
IGNORE = [r"^Of ", "zz"]
_ASCII = r"regexp_replace(text, '[^\x00-\x7F]', '', 'g')"


def _cleaned(x):
    out = f"replace(replace(regexp_replace({x}, '\\*\\*|、', '', 'g'), '<<', '«'), '>>', '»')"
    for old, new in ((f"(?m)^{_SPACE}*#+{_SPACE}+", ""), (rf"{_SPACE}*\n{_SPACE}*", " "), (f"{_SPACE}*(?:::|፡፡|：：)", "።"), (r"[ \t]{2,}", " ")):
        out = f"regexp_replace({out}, '{old}', '{new}', 'g')"
    return _strip(out)


_KIND = "CASE WHEN length(text) % 11 = 0 THEN 'Picture' WHEN turn = 4 THEN 'Page-header' WHEN turn % 4 = 0 THEN 'Title' WHEN turn % 4 = 1 THEN 'Text' WHEN turn % 4 = 2 THEN 'List-item' ELSE 'Footnote' END"
_CELLS = rf"""WITH a AS (SELECT conv_id AS page, turn AS ord, {_KIND} AS category, {_ASCII} AS raw FROM conversations),
c AS (SELECT page, ord, category, {_cleaned("CASE WHEN ord % 4 = 2 THEN 'VII. ' || raw ELSE raw END")} AS x, raw, 100.0::DOUBLE AS x1, ord * 300.0::DOUBLE AS y1, 1100.0::DOUBLE AS x2, ord * 300 + 250.0::DOUBLE AS y2 FROM a),
body AS (SELECT * FROM c WHERE category <> 'Picture' AND x <> '' AND NOT regexp_matches(x, '^Of ') AND NOT regexp_matches(x, 'zz')),
reading AS (SELECT page, ord, r, CASE r WHEN 0 THEN string_split(raw, ' ')[3] || ' ' || coalesce(string_split(raw, ' ')[4], '') || 'q' ELSE coalesce(string_split(raw, ' ')[6], raw) END AS reading, 100 + 200 * r AS rx1, ord * 300 + 20 + 60 * r AS ry1, 400 + 200 * r AS rx2, ord * 300 + 70 + 60 * r AS ry2 FROM a, (VALUES (0), (1)) AS v(r)),
red AS (SELECT * FROM reading WHERE len(regexp_extract_all(reading, '[A-Za-z]')) >= 2),
own AS (SELECT red.page, red.ord, red.r, {_cleaned('reading')} AS reading, b.x AS t, greatest(1.0::DOUBLE, (ry2 - ry1) * 1.2::DOUBLE) AS pitch, (rx1 + rx2) / 2.0::DOUBLE AS cx, (ry1 + ry2) / 2.0::DOUBLE AS cy, b.x1, b.y1, b.x2, b.y2 FROM red JOIN body b ON b.page = red.page AND b.ord = red.ord AND b.category NOT IN ('Page-header', 'Page-footer')),
place AS (SELECT *, greatest(1, round_even((y2 - y1) / pitch, 0)) AS rows_ FROM own),
want AS (SELECT page, ord, r, t, reading, trim(reading, '። ') AS n, (least(rows_ - 1, greatest(0, floor((cy - y1) / pitch))) + (cx - x1) / greatest(1.0::DOUBLE, x2 - x1)) / rows_ AS expected FROM place),
lim AS (SELECT *, greatest(1, CAST(ceil(length(n) / 3.0) AS INT)) AS m FROM want WHERE n <> ''),
chars AS (SELECT page, ord, t, unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) - 1 AS i FROM (SELECT DISTINCT page, ord, t FROM want)),
starts AS (SELECT page, ord, i AS s FROM (SELECT *, lag(ch) OVER (PARTITION BY page, ord ORDER BY i) AS before FROM chars) WHERE NOT regexp_matches(ch, '{_SPACE}') AND (before IS NULL OR NOT regexp_matches(before, '[A-Za-z]'))),
cand AS (SELECT *, levenshtein(substr(t, s + 1, l), n) AS d, abs(s::DOUBLE / greatest(1, length(t)) - expected) AS far FROM (SELECT lim.*, s, CAST(unnest(range(greatest(1, length(n) - m), length(n) + m + 1)) AS INT) AS l FROM lim JOIN starts USING (page, ord)) WHERE s + l <= length(t)),
fit AS (SELECT page, ord, r, d, far, s, l FROM cand WHERE d <= m),
first AS (SELECT page, ord, r, arg_min(s, {{'d': d, 'f': far, 's': s, 'l': l}}) AS s, arg_min(s + l, {{'d': d, 'f': far, 's': s, 'l': l}}) AS e FROM fit WHERE r = 0 GROUP BY ALL),
second AS (SELECT fit.page, fit.ord, fit.r, arg_min(fit.s, {{'d': d, 'f': far, 's': fit.s, 'l': l}}) AS s, arg_min(fit.s + l, {{'d': d, 'f': far, 's': fit.s, 'l': l}}) AS e FROM fit LEFT JOIN first g ON g.page = fit.page AND g.ord = fit.ord WHERE fit.r = 1 AND (g.s IS NULL OR NOT (g.s < fit.s + l AND fit.s < g.e)) GROUP BY ALL),
hits AS (SELECT * FROM first UNION ALL SELECT * FROM second),
block AS (SELECT page, ord, category, x, CASE WHEN category IN ('Text', 'List-item') THEN length(regexp_extract(x, '^([A-Z]+)\.?{_SPACE}+')) ELSE 0 END AS cut, CASE WHEN category IN ('Text', 'List-item') THEN regexp_extract(x, '^([A-Z]+)\.?{_SPACE}+', 1) ELSE '' END AS verse FROM body WHERE category NOT IN ('Page-header', 'Page-footer')),
text_ AS (SELECT *, substr(x, cut + 1) AS y FROM block),
run AS (SELECT h.page, h.ord, greatest(0, s - cut) AS s, e - cut AS e, y FROM hits h JOIN text_ USING (page, ord) WHERE e > cut),
wide AS (SELECT page, ord, s - length(regexp_extract(substr(y, 1, s), '[A-Za-z]+$')) AS s, e + length(regexp_extract(substr(y, e + 1), '^[.,A-Za-z]*')) AS e FROM run),
flag AS (SELECT k.page, k.ord, k.i, k.ch, regexp_matches(k.ch, '[.,]|{_SPACE}') AS gap, count(w.s) > 0 AS red FROM (SELECT page, ord, unnest(string_split(y, '')) AS ch, generate_subscripts(string_split(y, ''), 1) - 1 AS i FROM text_ WHERE y <> '') k LEFT JOIN wide w ON w.page = k.page AND w.ord = k.ord AND w.s <= k.i AND k.i < w.e GROUP BY ALL),
side AS (SELECT *, last_value(CASE WHEN NOT gap THEN red END IGNORE NULLS) OVER (PARTITION BY page, ord ORDER BY i ROWS UNBOUNDED PRECEDING) AS p, first_value(CASE WHEN NOT gap THEN red END IGNORE NULLS) OVER (PARTITION BY page, ord ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM flag),
painted AS (SELECT page, ord, string_agg(CASE WHEN red OR (gap AND coalesce(p, false) AND coalesce(q, false)) THEN 'R' ELSE 'B' END, '' ORDER BY i) AS colours FROM side GROUP BY ALL)
"""


def _regions(spark, d):
    c = t(spark, d, "conversations").withColumn("category", F.expr(_KIND)).withColumn("text", F.regexp_replace("text", r"[^\x00-\x7F]", ""))
    box = {"x1": F.lit(100.0), "y1": F.col("turn") * 300.0, "x2": F.lit(1100.0), "y2": F.col("turn") * 300 + 250.0}
    return c.select(F.col("conv_id").alias("page"), F.col("turn").alias("ord"), "category", F.when(F.col("turn") % 4 == 2, F.concat(F.lit("VII. "), "text")).otherwise(F.col("text")).alias("text"), F.col("text").alias("raw"), *[v.alias(k) for k, v in box.items()])


def _readings(spark, d):
    r, w = F.col("r"), F.split("raw", " ")
    word = lambda i: F.try_element_at(w, F.lit(i))
    x = _regions(spark, d).withColumn("r", F.explode(F.array(F.lit(0), F.lit(1))))
    text = F.when(r == 0, F.concat(word(3), F.lit(" "), F.coalesce(word(4), F.lit("")), F.lit("q"))).otherwise(F.coalesce(word(6), F.col("raw")))
    y = F.col("ord") * 300 + 20 + 60 * r
    return x.select("page", (F.col("ord") * 2 + r).alias("ord"), text.alias("text"), *[c.cast("double").alias(n) for n, c in (("x1", 100 + 200 * r), ("y1", y), ("x2", 400 + 200 * r), ("y2", y + 50))])


def _red(spark, d):
    return drafts.red_drafts(_regions(spark, d).drop("raw"), _readings(spark, d), IGNORE, script=LATIN, letters=LATIN, numeral=CAPITAL, attached=".,")


def _colours(spans):
    return F.array_join(F.transform(spans, lambda s: F.repeat(F.when(s["c"] == "red", "R").otherwise("B"), F.length(s["t"]))), "")


@query(_CELLS + "SELECT want.page, want.ord, want.r, hits.s, hits.e FROM want LEFT JOIN hits USING (page, ord, r)")
def fuzzy_locate(spark, d):
    """Where the readings of a message lie in its text; the second keeps clear of the first."""
    cells = transcripts.body_regions(_regions(spark, d).withColumn("text", tx.clean_text(F.col("text"))), IGNORE).where("category <> 'Page-header'")
    r = _readings(spark, d).where(tx.count_in(F.col("text"), LATIN) >= 2)
    own = core.inside(r, cells, ["page"], drafts.NEAR).where("region IS NOT NULL")
    expected = (F.col("r") + (150 + 200 * F.col("r")) / 1000.0) / 4.0
    own = own.withColumn("r", F.col("ord") % 2).groupBy("page", F.col("region").alias("ord")).agg(F.sort_array(F.collect_list(F.struct("r", tx.clean_text(F.col("text")).alias("reading"), expected.alias("expected")))).alias("readings"))
    j = own.join(cells.select("page", "ord", "text"), ["page", "ord"]).withColumn("h", F.expr(drafts.all_located("text", "readings", tx.char_class(LATIN))))
    j = j.select("page", "ord", F.explode(F.arrays_zip("readings", "h")).alias("z"))
    return j.select("page", "ord", L("z.readings.r").alias("r"), L("z.h.s").alias("s"), L("z.h.e").alias("e"))


@query(_CELLS + "SELECT page, ord, verse AS verse_num_am, sha256(y) AS body, sha256(coalesce(colours, '')) AS colours FROM text_ LEFT JOIN painted USING (page, ord)")
def red_spans(spark, d):
    """The text and the colour of every character of each block."""
    b = _red(spark, d).select("page", F.explode("blocks").alias("b"))
    return b.select("page", (F.col("b.bbox")[1] / 300).cast("long").alias("ord"), "b.verse_num_am", F.sha2(F.array_join(F.transform("b.spans", lambda s: s["t"]), ""), 256).alias("body"), F.sha2(_colours(F.col("b.spans")), 256).alias("colours"))


_BORDER = f"(len(regexp_extract_all(reading, '[A-Za-z]')) < 2 OR length(reading) > 200 OR coalesce(len(regexp_extract_all(reading, '[^{_SPACE[1:]}+')) >= 3 AND len(list_distinct(regexp_extract_all(reading, '[^{_SPACE[1:]}+'))) = 1 AND len(regexp_extract_all(regexp_extract_all(reading, '[^{_SPACE[1:]}+')[1], '[A-Za-z]')) <= 2, false))"


@query(_CELLS + f""", role AS (SELECT page, ord, CASE WHEN category IN ('Title', 'Section-header') THEN 'title' WHEN category IN ('Footnote', 'Caption') THEN 'instruction' WHEN verse <> '' THEN 'verse' ELSE 'prayer' END AS kind FROM text_),
lost AS (SELECT page, string_agg(n, '|' ORDER BY ord, r) AS lost, count(*) AS n FROM want LEFT JOIN hits USING (page, ord, r) WHERE hits.s IS NULL AND NOT {_BORDER} GROUP BY 1)
SELECT p.page, coalesce(h.header, '') AS header, coalesce(b.blocks, '') AS blocks, coalesce(lost.lost, '') AS uncertain, coalesce(q.n, 0) AS red_regions, coalesce(z.n, 0) AS red_located, CASE WHEN b.blocks IS NULL THEN 'page ' || p.page || ': no text blocks after cleanup' END AS error
FROM (SELECT DISTINCT page FROM c) p LEFT JOIN (SELECT page, sha256(string_agg(x, ' ' ORDER BY ord)) AS header FROM body WHERE category IN ('Page-header', 'Page-footer') GROUP BY 1) h USING (page) LEFT JOIN (SELECT page, string_agg(kind, ',' ORDER BY ord) AS blocks FROM role GROUP BY 1) b USING (page)
LEFT JOIN lost USING (page) LEFT JOIN (SELECT page, count(*) AS n FROM red GROUP BY 1) q USING (page) LEFT JOIN (SELECT page, count(*) AS n FROM hits GROUP BY 1) z USING (page)""")
def red_drafts(spark, d):
    """Whole transcripts from regions and red readings."""
    r = _red(spark, d)
    kinds = F.coalesce(F.array_join(F.transform("blocks", lambda b: b["type"]), ","), F.lit(""))
    lost = F.coalesce(F.array_join(F.transform("uncertain", lambda u: u["text"]), "|"), F.lit(""))
    return r.select("page", F.when(F.col("page_header") != "", F.sha2("page_header", 256)).otherwise("").alias("header"), kinds.alias("blocks"), lost.alias("uncertain"), L("red_regions").alias("red_regions"), L("red_located").alias("red_located"), "error")


# ---- from regions and from words ------------------------------------------------


@query(rf"""WITH c AS (SELECT conv_id AS page, turn AS ord, {_KIND} AS category, text, regexp_extract_all(text, '[^{_SPACE[1:]}+') AS tokens, regexp_extract_all(text, '{_SPACE}*[^{_SPACE[1:]}+') AS pieces FROM conversations WHERE {_KIND} <> 'Picture'),
k AS (SELECT *, turn_ok FROM (SELECT *, ord % 3 <> 1 AND len(tokens) > 0 AS turn_ok FROM c)),
p AS (SELECT page, ord, string_agg(repeat(CASE WHEN length(tk) > 4 THEN 'R' ELSE 'B' END, length(piece)), '' ORDER BY i) AS colours, max(i) AS n FROM (SELECT page, ord, unnest(tokens) AS tk, unnest(pieces) AS piece, generate_subscripts(tokens, 1) AS i FROM k WHERE turn_ok) GROUP BY 1, 2)
SELECT page, count(*) AS blocks, coalesce(string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) FILTER (NOT turn_ok), '') AS unresolved, sha256(string_agg(CASE WHEN turn_ok THEN colours || repeat(right(colours, 1), length(text) - length(colours)) ELSE repeat('B', length(text)) END, '|' ORDER BY ord)) AS colours, string_agg(CASE WHEN category = 'Title' THEN 'title' ELSE 'prayer' END, ',' ORDER BY ord) AS kinds
FROM k LEFT JOIN p USING (page, ord) GROUP BY page""")
def region_drafts(spark, d):
    """Each word of a message is a word of the layout; long words are red, and every third message has one word more than its region."""
    c = t(spark, d, "conversations").withColumn("category", F.expr(_KIND))
    y = F.col("turn") * 300.0
    r = c.select(F.col("conv_id").alias("page"), F.col("turn").alias("ord"), "category", "text", F.lit(0.0).alias("x1"), y.alias("y1"), F.lit(1e7).alias("x2"), (y + 250).alias("y2"))
    tokens = F.regexp_extract_all("text", F.lit(f"{tx.NOT_SPACE}+"), F.lit(0))
    tokens = F.when(F.col("turn") % 3 == 1, F.array_append(tokens, F.lit("x"))).otherwise(tokens)
    w = c.select(F.col("conv_id").alias("page"), F.col("turn").cast("long").alias("line"), F.posexplode(tokens).alias("i", "text"), y.alias("y1"))
    w = w.select("page", "line", L("i").alias("word"), "text", (F.length("text") > 4).alias("is_red"), (F.col("i") * 10.0).alias("x1"), (F.col("y1") + 10).alias("y1"), (F.col("i") * 10.0 + 8).alias("x2"), (F.col("y1") + 40).alias("y2"))
    out = drafts.region_drafts(r, w).where("blocks IS NOT NULL")
    return out.select("page", L(F.size("blocks")).alias("blocks"), F.array_join(F.col("colour_unresolved").cast("array<string>"), ",").alias("unresolved"), F.sha2(F.array_join(F.transform("blocks", lambda b: _colours(b["spans"])), "|"), 256).alias("colours"), F.array_join(F.transform("blocks", lambda b: b["type"]), ",").alias("kinds"))


_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"
_LINES = f"""WITH w AS (SELECT l_orderkey AS page, l_linenumber // 2 AS line, row_number() OVER (PARTITION BY l_orderkey, l_linenumber // 2 ORDER BY {_ORDER}) AS word, CASE WHEN l_partkey % 3 = 0 THEN 'VI' ELSE 'w' || l_partkey END AS text, l_quantity * 2 AS conf, l_returnflag = 'R' AS red, l_suppkey % 1000 AS y FROM lineitem),
l AS (SELECT page, line, bool_and(red) AS title, min(y) AS top, max(y) AS bottom, arg_min(text, word) AS head FROM w GROUP BY 1, 2),
"""


def _layout(spark, d):
    w = t(spark, d, "lineitem").withColumn("line", F.floor(F.col("l_linenumber") / 2))
    n = F.row_number().over(Window.partitionBy("l_orderkey", "line").orderBy(*_ORDER.split(", ")))
    w = w.select(F.col("l_orderkey").alias("page"), "line", n.alias("word"), F.when(F.col("l_partkey") % 3 == 0, "VI").otherwise(F.concat(F.lit("w"), F.col("l_partkey").cast("string"))).alias("text"), (F.col("l_quantity") * 2).cast("double").alias("conf"), (F.col("l_returnflag") == "R").alias("is_red"), (F.col("l_suppkey") % 1000).alias("y"))
    lines = w.groupBy("page", "line").agg(F.bool_and("is_red").alias("looks_like_title"), F.min("y").alias("top"), F.max("y").alias("bottom"))
    pages = w.groupBy("page").agg(F.count("*").alias("word_count")).withColumn("height", F.lit(1000))
    return pages, lines, w


@query(_LINES + """k AS (SELECT *, CASE WHEN regexp_matches(head, '^[A-Z]+$') THEN head END AS num FROM l),
o AS (SELECT *, CASE WHEN title OR num IS NOT NULL OR coalesce(lag(title) OVER (PARTITION BY page ORDER BY line), true) THEN 1 ELSE 0 END AS st FROM k),
b AS (SELECT *, sum(st) OVER (PARTITION BY page ORDER BY line ROWS UNBOUNDED PRECEDING) AS block FROM o),
x AS (SELECT w.*, b.block FROM w JOIN b USING (page, line) WHERE NOT (b.num IS NOT NULL AND w.word = 1)),
s AS (SELECT *, CASE WHEN lag(red) OVER o IS DISTINCT FROM red THEN 1 ELSE 0 END AS n FROM x WINDOW o AS (PARTITION BY page, block ORDER BY line, word)),
r AS (SELECT *, sum(n) OVER (PARTITION BY page, block ORDER BY line, word ROWS UNBOUNDED PRECEDING) AS span FROM s),
p AS (SELECT page, block, span, CASE WHEN any_value(red) THEN 'red' ELSE 'black' END || ':' || string_agg(text, ' ' ORDER BY line, word) AS t FROM r GROUP BY 1, 2, 3),
g AS (SELECT page, block, string_agg(t, '/' ORDER BY span) AS spans FROM p GROUP BY 1, 2),
h AS (SELECT page, block, arg_min(CASE WHEN title THEN 'title' WHEN num IS NOT NULL THEN 'verse' ELSE 'prayer' END, line) AS kind, arg_min(CASE WHEN NOT title AND num IS NOT NULL THEN num ELSE '' END, line) AS num FROM b GROUP BY 1, 2),
u AS (SELECT page, list(text ORDER BY line, word) AS u FROM w WHERE conf < 70 GROUP BY 1),
e AS (SELECT page, arg_min(top, line) AS f, arg_max(bottom, line) AS z FROM l GROUP BY 1)
SELECT page, coalesce(string_agg(kind || ' ' || num || ' ' || spans, ';' ORDER BY block), '') AS blocks, coalesce(any_value(array_to_string(list_slice(u, 1, 3), ',')), '') AS uncertain, any_value(concat_ws(',', CASE WHEN f <= 30 THEN 'top' END, CASE WHEN z >= 970 THEN 'bottom' END)) AS clipped
FROM e LEFT JOIN g USING (page) LEFT JOIN h USING (page, block) LEFT JOIN u USING (page) GROUP BY page""")
def word_drafts(spark, d):
    """Order lines stand for words, two to a line; VI is a numeral."""
    out = drafts.word_drafts(*_layout(spark, d), numeral=CAPITAL, listed=3)
    one = lambda b: F.concat_ws(" ", b["type"], b["verse_num_am"], F.array_join(F.transform(b["spans"], lambda s: F.concat(s["c"], F.lit(":"), s["t"])), "/"))
    return out.select("page", F.array_join(F.transform("blocks", one), ";").alias("blocks"), F.array_join(F.transform("uncertain", lambda u: u["text"]), ",").alias("uncertain"), F.array_join(F.transform("clipped", lambda c: c["edge"]), ",").alias("clipped"))


@query(f"""WITH w AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS word, 'w' || l_partkey AS text, l_suppkey % 2 AS parent, CASE l_linenumber % 5 WHEN 0 THEN 'SPACE' WHEN 1 THEN 'LINE_BREAK' WHEN 2 THEN 'HYPHEN' WHEN 3 THEN 'EOL_SURE_SPACE' ELSE '' END AS br, l_discount * 10 AS conf, l_returnflag = 'R' AS red FROM lineitem),
b AS (SELECT *, sum(n) OVER (PARTITION BY page ORDER BY word ROWS UNBOUNDED PRECEDING) AS block FROM (SELECT *, CASE WHEN lag(parent) OVER (PARTITION BY page ORDER BY word) IS DISTINCT FROM parent THEN 1 ELSE 0 END AS n FROM w)),
s AS (SELECT *, sum(m) OVER (PARTITION BY page, block ORDER BY word ROWS UNBOUNDED PRECEDING) AS span FROM (SELECT *, CASE WHEN lag(red) OVER (PARTITION BY page, block ORDER BY word) IS DISTINCT FROM red THEN 1 ELSE 0 END AS m FROM b)),
p AS (SELECT page, block, span, CASE WHEN any_value(red) THEN 'red:' ELSE 'black:' END || replace(string_agg(text || CASE WHEN br <> '' THEN ' ' ELSE '' END, '' ORDER BY word), '  ', ' ') AS t FROM s GROUP BY 1, 2, 3),
g AS (SELECT page, string_agg(spans, ';' ORDER BY block) AS blocks FROM (SELECT page, block, string_agg(t, '/' ORDER BY span) AS spans FROM p GROUP BY 1, 2) GROUP BY 1)
SELECT page, blocks, round_even(coalesce(avg(conf) FILTER (conf > 0), 0), 3) AS mean_confidence, coalesce(array_to_string(list_slice(list(text ORDER BY word) FILTER (conf > 0 AND conf < 0.80), 1, 40), ','), '') AS uncertain FROM w JOIN g USING (page) GROUP BY page, blocks""")
def vision_drafts(spark, d):
    """Order lines stand for the words of a response."""
    br = F.expr("CASE l_linenumber % 5 WHEN 0 THEN 'SPACE' WHEN 1 THEN 'LINE_BREAK' WHEN 2 THEN 'HYPHEN' WHEN 3 THEN 'EOL_SURE_SPACE' ELSE '' END")
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_ORDER.split(", ")))
    w = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), n.alias("word"), F.concat(F.lit("w"), F.col("l_partkey").cast("string")).alias("text"), (F.col("l_suppkey") % 2).alias("parent"), br.alias("break_after"), (F.col("l_discount") * 10).alias("conf"), (F.col("l_returnflag") == "R").alias("is_red"))
    out = drafts.vision_drafts(w.select("page").distinct(), w)
    one = lambda b: F.array_join(F.transform(b["spans"], lambda s: F.concat(s["c"], F.lit(":"), s["t"])), "/")
    return out.select("page", F.array_join(F.transform("blocks", one), ";").alias("blocks"), F.round("mean_confidence", 3).alias("mean_confidence"), F.array_join(F.transform("uncertain", lambda u: u["text"]), ",").alias("uncertain"))


@query(_LINES + """g AS (SELECT page, line, string_agg(text || CASE WHEN red THEN '[RED]' ELSE '[BLACK]' END, ' ' ORDER BY word) AS t, count(*) AS n, count(*) FILTER (red) AS r FROM w GROUP BY 1, 2)
SELECT page, sha256('Tesseract found ' || count(*) || ' lines, ' || sum(n) || ' words, ' || sum(r) || ' of them red.' || chr(10) || 'Per line (Tesseract''s text is unreliable; the [RED]/[BLACK] flags are not):' || chr(10) || string_agg('  line ' || line || CASE WHEN title THEN ' (looks like a centred title)' ELSE '' END || ': ' || t, chr(10) ORDER BY line)) AS hint FROM g JOIN l USING (page, line) GROUP BY page""")
def layout_hint(spark, d):
    _, lines, w = _layout(spark, d)
    return transcripts.layout_hint(lines, w).select("page", F.sha2("hint", 256).alias("hint"))


# ---- texts and checks -----------------------------------------------------------


def _pages(spark, d):
    """Messages as blocks: their lines are spans, in turn black and red."""
    span = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("t"), F.when(i % 2 == 1, "red").otherwise("black").alias("c")))
    kind = F.when(F.col("role") == "user", "verse").otherwise("ornament")
    b = F.struct("turn", F.struct(kind.alias("type"), F.lit("").alias("verse_num_am"), F.when(F.col("turn") == 3, F.array(F.struct(F.lit(" ").alias("t"), F.lit("black").alias("c")))).otherwise(span).alias("spans")).alias("b"))
    return t(spark, d, "conversations").groupBy(F.col("conv_id").alias("page")).agg(F.transform(F.sort_array(F.collect_list(b)), lambda x: x["b"]).alias("blocks"))


_SPANS = """WITH b AS (SELECT conv_id AS page, turn, role, CASE WHEN turn = 3 THEN [' '] ELSE string_split(text, chr(10)) END AS spans FROM conversations),
s AS (SELECT page, turn, role, unnest(spans) AS t, generate_subscripts(spans, 1) AS i FROM b)
"""


@query(_SPANS + """, k AS (SELECT page, turn, string_agg(t, '' ORDER BY i) AS t FROM s GROUP BY 1, 2)
SELECT page, sha256(string_agg(t, chr(10) ORDER BY turn)) AS page_text, (SELECT sha256(coalesce(string_agg(t, '' ORDER BY turn, i), '')) FROM s WHERE s.page = k.page AND i % 2 = 0) AS red_text FROM k GROUP BY page""")
def transcript_text(spark, d):
    return _pages(spark, d).select("page", F.sha2(transcripts.page_text(F.col("blocks")), 256).alias("page_text"), F.sha2(transcripts.red_text(F.col("blocks")), 256).alias("red_text"))


@query(_SPANS + "SELECT page, CASE WHEN i % 2 = 0 THEN 'red' ELSE 'black' END AS c, count(*) AS spans, count(DISTINCT turn) AS blocks, CAST(sum(length(t)) AS BIGINT) AS chars, max(i) AS last FROM s GROUP BY 1, 2")
def block_spans(spark, d):
    """Blocks and spans of transcripts, row by row."""
    s = book.block_spans(book.transcript_blocks(_pages(spark, d).withColumn("book", F.lit(1)), ["book"]), ["book"])
    return s.groupBy("page", "c").agg(F.count("*").alias("spans"), F.countDistinct("block_ord").alias("blocks"), F.sum(F.length("t")).cast("long").alias("chars"), F.max("span_ord").cast("long").alias("last"))


@query(_SPANS + r""", x AS (SELECT page, string_agg(t, '' ORDER BY turn, i) AS joined, coalesce(string_agg(t, '' ORDER BY turn, i) FILTER (i % 2 = 0), '') AS red FROM s GROUP BY 1),
n AS (SELECT page, joined, length(regexp_replace(nfc_normalize(joined), '[^0-9A-Za-zÀ-ÿ]', '', 'g')) AS chars, length(regexp_replace(nfc_normalize(red), '[^0-9A-Za-zÀ-ÿ]', '', 'g')) AS red FROM x),
e AS (SELECT page, arg_min('verse', turn) AS kind FROM (SELECT page, turn, role, string_agg(t, '' ORDER BY i) AS t FROM s GROUP BY 1, 2, 3) WHERE role = 'user' AND trim(t) = '' GROUP BY 1)
SELECT page, CAST(len(regexp_extract_all(joined, '[A-Za-z]')) AS BIGINT) AS latin, substr(regexp_replace(joined, '[^A-Za-z]', '', 'g'), 1, 20) AS latin_shown, CAST(len(regexp_extract_all(joined, '[0-9]')) AS BIGINT) AS digits, chars AS script_chars, round(coalesce(red::DOUBLE / nullif(chars, 0), 0), 6) AS model_red,
  (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT greatest(1, len(spans)) AS n FROM b WHERE b.page = n.page)) AS model_lines, e.kind AS empty_type, page % 2 = 0 AS draft, false AS agrees FROM n LEFT JOIN e USING (page)""")
def page_checks(spark, d):
    """What a page's text gives its checks; without recognised words there is nothing to agree with."""
    p = _pages(spark, d).withColumn("source", F.when(F.col("page") % 2 == 0, "A DRAFT of it").otherwise("checked")).withColumn("ocr_text", F.lit(None).cast("string"))
    c = transcripts.page_checks(p, ranges=ASCII_WORD + ACCENTED)
    return c.select("page", "latin", "latin_shown", "digits", "script_chars", F.round("model_red", 6).alias("model_red"), L("model_lines").alias("model_lines"), "empty_type", "draft", F.col("agreement").isNotNull().alias("agrees"))


@query("""WITH f AS (SELECT doc_id AS page, lang, n_chars > 800 AS hit FROM documents)
SELECT lang, count(*) AS pages_checked, CAST(count(*) FILTER (hit) AS BIGINT) AS pages_flagged, sha256(coalesce(string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FILTER (hit), '')) AS flagged FROM f GROUP BY lang""")
def report_totals(spark, d):
    p = t(spark, d, "documents").select(F.col("doc_id").alias("page"), "lang", F.when(F.col("n_chars") > 800, F.array(F.lit("x"))).otherwise(F.expr("cast(array() as array<string>)")).alias("flags"))
    out = None
    for (lang,) in p.select("lang").distinct().collect():  # a few languages
        one = transcripts.report_totals(p.where(F.col("lang").eqNullSafe(lang))).select(F.lit(lang).cast("string").alias("lang"), "pages_checked", "pages_flagged", F.sha2(F.array_join(F.col("flagged_pages").cast("array<string>"), ","), 256).alias("flagged"))
        out = one if out is None else out.unionByName(one)
    return out


@query(_LINES + "j AS (SELECT page, string_agg(text, '' ORDER BY line, word) AS t, count(DISTINCT line) AS n FROM w GROUP BY 1) SELECT page, sha256(t) AS ocr_text, n AS ocr_lines FROM j")
def layout_text(spark, d):
    return transcripts.layout_text(_layout(spark, d)[2]).select("page", F.sha2("ocr_text", 256).alias("ocr_text"), "ocr_lines")


@query("""SELECT l_orderkey AS page, l_linenumber AS word, 'w' || l_partkey AS text, l_partkey % 500 AS x1, l_suppkey AS y1, l_partkey % 500 + 40 AS x2, l_suppkey + 12 AS y2, CASE WHEN l_linenumber % 2 = 0 THEN 'SPACE' END AS break_after FROM lineitem WHERE l_partkey % 7 <> 0""")
def response_words(spark, d):
    """Orders as responses of one block and paragraph; a word without symbols goes."""
    x, y = F.col("l_partkey") % 500, F.col("l_suppkey")
    v = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    chars = F.split(F.concat(F.lit("w"), F.col("l_partkey").cast("string")), "")
    last = F.when(F.col("l_linenumber") % 2 == 0, "SPACE")
    symbols = F.transform(chars, lambda c, i: F.struct(c.alias("text"), F.when(i == F.size(chars) - 1, last).alias("break")))
    w = F.struct(F.col("l_linenumber").alias("o"), F.struct(F.when(F.col("l_partkey") % 7 != 0, symbols).otherwise(F.filter(symbols, lambda s: F.lit(False))).alias("symbols"), F.array(v(x, y), v(x + 40, y), v(x + 40, y + 12), v(x, y + 12)).alias("vertices"), F.lit(0.9).alias("confidence")).alias("w"))
    g = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.sort_array(F.collect_list(F.col("l_linenumber"))).alias("n"), F.transform(F.array_sort(F.collect_list(w), lambda a, b: a["o"] - b["o"]), lambda z: z["w"]).alias("words"))
    r = g.withColumn("pages", F.array(F.struct(F.array(F.struct(F.array(F.struct("words")).alias("paragraphs"))).alias("blocks"))))
    f = sources.flatten_response(r.select("page", F.col("pages"), "n"))
    n = g.select(F.col("page").alias("p"), F.posexplode("n").alias("i", "no"))
    j = f.join(n, (F.col("page") == F.col("p")) & (F.col("word") == F.col("i")))
    return j.select("page", F.col("no").alias("word"), "text", "x1", "y1", "x2", "y2", "break_after")
