"""Chat formatting by quotation linking, native: DataFrame and SQL functions only.

Lines that begin with > are quotes, nested by the number of marks.  Runs of one
level are passages; passages and their lines are normalised and hashed, and each
hash is looked up among what earlier messages of the conversation wrote
themselves: one ordered pass per hash and stretch of turns carries the latest
earlier message along, so a common line costs its occurrences, not their square,
and a long conversation is no single task.  The quotes of the shallowest level
that matches name the message that a message replies to; roots and depths follow
by pointer doubling.  Messages come out without quotes, ordered by (root_turn,
turn), in which every reply follows what it replies to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, running, stored

#: Marks with blanks between them; one class, as a repeated group would take the regex engine a stack frame per mark.
MARK = r"^[ \t>]*>"
BLANK = " \t\n\x0b\f\r"
#: A line that ends like "On Monday A wrote:" right before a quote belongs to the quote, however long it is.
LEAD = r"(wrote|writes|schrieb|écrit|escribió)\x20?:\s*$"
#: What a matched whole passage weighs against one matched line.
PASSAGE_WEIGHT = 1000
#: Turns of a conversation that one ordered pass goes through.
STRETCH = 1024


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _norm(c):
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def _quotes() -> str:
    """Quoted lines that are not empty: struct<pos, level, run, body>; a run is a stretch of lines of one level."""
    level = f"length(regexp_replace(regexp_extract(x, {_lit(MARK)}, 0), '[^>]', ''))"
    new = "transform(v, (x, i) -> case when i > 0 and v[i - 1] = x then 0 else 1 end)"
    body = f"trim(regexp_replace(lower(regexp_replace(x, {_lit(MARK + '[ ' + chr(92) + 't]?')}, '')), {_lit(r'\s+')}, ' '))"
    rows = f"filter(transform(lines, (x, i) -> named_struct('pos', i, 'level', v[i], 'run', r[i], 'body', {body})), x -> x.level > 0 and x.body <> '')"
    return let(f"transform(lines, x -> {level})", "v", let(let(new, "n", running("n", "{x} + {y}")), "r", rows))


def linked(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, content, n_quotes, deepest_quote, parent_turn, root_turn, depth, formatted.

    content is the text without quotes, lead lines and surrounding blank lines;
    parent_turn is the earlier message that its quotes of the shallowest matched
    level come from (most matched lines, then the latest), or null; root_turn is
    reached by following parents.  Null texts are empty; rows with null conv_id
    or turn are kept, unlinked.  Repeated rows come back once each; rows of one
    (conv_id, turn) with different texts are messages of their own, of which the
    one with the largest checksum stands for both where they wrote the same.
    Long texts are parsed whole.  An empty table gives no rows.  Other columns
    are not read.
    """
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    m = m.withColumn("text_key", F.md5(F.col("text").cast("binary"))).withColumn("lines", F.split("text", r"\r?\n", -1))
    quote = f"x rlike {_lit(MARK)}"
    own = F.expr(f"filter(lines, (x, i) -> not ({quote}) and not (x rlike {_lit(LEAD)} and i + 1 < size(lines) and lines[i + 1] rlike {_lit(MARK)}))")
    content = F.btrim(F.array_join(own, "\n"), F.lit(BLANK))
    levels = F.expr(f"transform(filter(lines, x -> {quote}), x -> length(regexp_replace(regexp_extract(x, {_lit(MARK)}, 0), '[^>]', '')))")
    m = m.withColumn("own", own).withColumn("content", content).withColumn("levels", levels)
    node = ["conv_id", "turn", "text_key"]

    # Quoted passages and their lines, parsed inside the row; rows that repeat count once.
    q = m.where(F.size("levels") > 0).where("conv_id IS NOT NULL AND turn IS NOT NULL").select(*node, F.explode(F.expr(_quotes())).alias("q")).select(*node, "q.*").distinct()
    lines_ = q.select(*node, "level", F.sha2("body", 256).alias("h"), F.lit(1).alias("w"))
    whole = q.groupBy(*node, "level", "run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"]), " ").alias("body"))
    units = lines_.union(whole.select(*node, "level", F.sha2("body", 256), F.lit(PASSAGE_WEIGHT)))
    units = stored(units.groupBy(*node, "level", "h").agg(F.sum("w").alias("w")), "quotes")

    # What messages of quoting conversations wrote themselves: whole texts, paragraphs and lines.
    convs = units.select("conv_id").distinct()
    w = m.join(convs, "conv_id", "left_semi").where("turn IS NOT NULL")
    texts = F.array_distinct(F.concat(F.array("content"), F.split("content", r"\n\s*\n", -1), F.col("own")))
    o = w.select(*node, F.explode(texts).alias("t")).select(*node, F.sha2(_norm("t"), 256).alias("h"))
    o = o.join(units.select("conv_id", "h").distinct(), ["conv_id", "h"], "left_semi").distinct()

    # Latest earlier message that wrote the same: the latest of earlier stretches, then an ordered pass over a stretch.
    wrote = F.struct("turn", "text_key")
    both = o.select(*node, "h", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("w"), wrote.alias("wrote"))
    both = stored(both.union(units.select(*node, "h", "level", "w", F.lit(None))).withColumn("stretch", F.floor(F.col("turn") / STRETCH)), "lines")
    tops = both.groupBy("conv_id", "h", "stretch").agg(F.max("wrote").alias("top"))
    before = tops.select("conv_id", "h", "stretch", F.max("top").over(Window.partitionBy("conv_id", "h").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    here = F.max("wrote").over(Window.partitionBy("conv_id", "h", "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))
    hits = both.withColumn("here", here).where("w IS NOT NULL").join(before, ["conv_id", "h", "stretch"]).withColumn("from", F.coalesce("here", "earlier")).where("from IS NOT NULL")
    score = hits.groupBy(*node, "level", "from").agg(F.sum("w").alias("score"))
    parent = stored(score.groupBy(*node).agg(F.max(F.struct(-F.col("level"), "score", "from"))["from"].alias("parent")), "parents")

    # Roots by pointer doubling: each round doubles the path that is followed.
    path = parent.select(*node, F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"))
    for _ in range(64):
        over = path.select("conv_id", F.struct("turn", "text_key").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        stepped = stored(path.join(over, ["conv_id", "up"], "left").select(*node, F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")), "roots")
        path = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            break
    roots = path.join(parent, node).select(*node, F.col("parent.turn").alias("parent_turn"), F.col("up.turn").alias("root_turn"), "depth")

    out = m.join(roots, node, "left")
    name = F.coalesce("role", F.lit("user"))
    return out.select(
        "conv_id",
        "turn",
        "role",
        "content",
        F.size("levels").cast("long").alias("n_quotes"),
        F.coalesce(F.array_max("levels"), F.lit(0)).cast("long").alias("deepest_quote"),
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.concat(F.lit("<|im_start|>"), name, F.lit("\n"), F.col("content"), F.lit("<|im_end|>\n")).alias("formatted"),
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = rf"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, md5(coalesce(text, '')) AS k, string_split_regex(coalesce(text, ''), '\r?\n') AS lines FROM conversations),
c AS (
  SELECT *, list_filter(lines, lambda x, i: NOT regexp_matches(x, '{MARK}') AND NOT (regexp_matches(x, '{LEAD}') AND coalesce(regexp_matches(lines[i + 1], '{MARK}'), false))) AS own,
    list_transform(list_filter(lines, lambda x: regexp_matches(x, '{MARK}')), lambda x: length(regexp_replace(regexp_extract(x, '{MARK}'), '[^>]', '', 'g'))) AS levels FROM m),
e AS (SELECT *, trim(array_to_string(own, chr(10)), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content FROM c),
l AS (SELECT DISTINCT conv_id, turn, k, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
v AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '{MARK}'), '[^>]', '', 'g')) AS level,
    trim(regexp_replace(lower(regexp_replace(line, '{MARK}[ \t]?', '')), '\s+', ' ', 'g')) AS body FROM l),
n AS (SELECT *, CASE WHEN lag(level) OVER (PARTITION BY conv_id, turn, k ORDER BY pos) = level THEN 0 ELSE 1 END AS fresh FROM v),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, k ORDER BY pos) AS run FROM n),
q AS (SELECT * FROM r WHERE level > 0 AND body <> ''),
units AS (
  SELECT conv_id, turn, k, level, body AS t, 1 AS w FROM q
  UNION ALL SELECT conv_id, turn, k, level, string_agg(body, ' ' ORDER BY pos), {PASSAGE_WEIGHT} FROM q GROUP BY conv_id, turn, k, level, run),
wrote AS (
  SELECT DISTINCT conv_id, turn, k, trim(regexp_replace(lower(t), '\s+', ' ', 'g')) AS t
  FROM (SELECT conv_id, turn, k, unnest(list_concat([content], string_split_regex(content, '\n\s*\n'), own)) AS t FROM e WHERE turn IS NOT NULL)),
hits AS (
  SELECT u.conv_id, u.turn, u.k, u.level, u.t, any_value(u.w) AS w, max({{'t': o.turn, 'k': o.k}}) AS f
  FROM (SELECT conv_id, turn, k, level, t, sum(w) AS w FROM units GROUP BY ALL) u JOIN wrote o ON o.conv_id = u.conv_id AND o.t = u.t AND o.turn < u.turn GROUP BY u.conv_id, u.turn, u.k, u.level, u.t),
score AS (SELECT conv_id, turn, k, level, f, sum(w) AS s FROM hits GROUP BY ALL),
parent AS (SELECT conv_id, turn, k, arg_max(f, {{'l': -level, 's': s, 'f': f}}) AS f FROM score GROUP BY conv_id, turn, k),
walk(conv_id, turn, k, f, depth) AS (
  SELECT conv_id, turn, k, f, 1::BIGINT FROM parent
  UNION ALL SELECT w.conv_id, w.turn, w.k, p.f, w.depth + 1 FROM walk w JOIN parent p ON p.conv_id = w.conv_id AND p.turn = w.f.t AND p.k = w.f.k),
root AS (SELECT conv_id, turn, k, arg_max(f.t, depth) AS root_turn, arg_min(f.t, depth) AS parent_turn, max(depth) AS depth FROM walk GROUP BY conv_id, turn, k)
SELECT e.conv_id, e.turn, e.role, e.content, CAST(len(e.levels) AS BIGINT) AS n_quotes, CAST(coalesce(list_max(e.levels), 0) AS BIGINT) AS deepest_quote,
  root.parent_turn, coalesce(root.root_turn, e.turn) AS root_turn, coalesce(root.depth, 0) AS depth,
  '<|im_start|>' || coalesce(e.role, 'user') || chr(10) || e.content || '<|im_end|>' || chr(10) AS formatted
FROM e LEFT JOIN root ON root.conv_id = e.conv_id AND root.turn = e.turn AND root.k = e.k
"""
