"""Relational operators over pages, blocks, spans, words and reviews."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sqlparts import let

# ---- ordered computations --------------------------------------------------


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Numbers the stretches of rows that begin where `starts` holds."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.coalesce(starts.cast("int"), F.lit(0))).over(w))


def runs(df: DataFrame, keys: list[str], order: list[str], value: str, text: str, sep: str = " ") -> DataFrame:
    """Merges neighbours of equal value: keys, run, value, joined text, number of parts."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = df.withColumn("_new", ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1))
    numbered = islands(changed, keys, order, F.col("_new"), "run")
    parts = F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    return numbered.groupBy(*keys, "run", value).agg(F.array_join(F.transform(parts, lambda p: p["_t"]), sep).alias("text"), F.count("*").alias("parts"))


def paragraphs(pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Blank-line separated stretches of each page's lines: key, paragraph, text, lines."""
    line = pages.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    blank = F.col("line").rlike(r"^\s*$")
    w = Window.partitionBy(key).orderBy("pos")
    line = line.withColumn("_b", blank).withColumn("_s", ~F.col("_b") & F.coalesce(F.lag("_b").over(w), F.lit(True)))
    line = islands(line, [key], ["pos"], F.col("_s"), "paragraph").where(~F.col("_b"))
    parts = F.sort_array(F.collect_list(F.struct("pos", "line")))
    return line.groupBy(key, "paragraph").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text"), F.count("*").alias("lines"))


def forward_fill(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The last value that was set at or before each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def first_openings(blocks: DataFrame, keys: list[str], order: list[str], section: str, name: str = "section") -> DataFrame:
    """Section of each block: only a section's first opening counts and carries on; before any opening null."""
    w = Window.partitionBy(*keys, section).orderBy(*order)
    opened = blocks.withColumn("_open", F.when(F.col(section).isNotNull() & (F.row_number().over(w) == 1), F.col(section)))
    return forward_fill(opened, keys, order, "_open", name).drop("_open")


def numbered(df: DataFrame, keys: list[str], order: list[str], prefix: Column, name: str = "block_id") -> DataFrame:
    """prefix_001 and on, per key."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, F.format_string("%s_%03d", prefix, n))


def bounds(starts: DataFrame, keys: list[str], start: str, mid_page: str | None = None) -> DataFrame:
    """End of each section: the page before the next one starts, or that page where the next starts mid-page."""
    nxt = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    less = F.when(F.lead(mid_page).over(Window.partitionBy(*keys).orderBy(start)), 0).otherwise(1) if mid_page else F.lit(1)
    return starts.withColumn("end_page", nxt - less)


def newest(df: DataFrame, keys: list[str], order: list[Column], n: int = 50) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def sample_pages(pages: DataFrame, key: str, keys: list[str]) -> DataFrame:
    """First, middle and last page."""
    w = Window.partitionBy(*keys)
    t = pages.withColumn("_i", F.row_number().over(w.orderBy(key)) - 1).withColumn("_n", F.count("*").over(w))
    return t.where((F.col("_i") == 0) | (F.col("_i") == F.floor(F.col("_n") / 2)) | (F.col("_i") == F.col("_n") - 1)).drop("_i", "_n")


def preview(items: Column, n: int) -> Column:
    """The first n items, and how many more."""
    more = F.size(items) - n
    return F.concat(F.array_join(F.slice(items, 1, n), ", "), F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))).otherwise(""))


# ---- joins -----------------------------------------------------------------


def _fitting(rules: DataFrame | Iterable[tuple], page: str) -> Column:
    """The rules (section_id, ord, first_page, last_page) whose range holds the page, in their order.

    A section table is part of a book's config; as an array beside each page it needs no join.
    """
    rows = [tuple(r) for r in rules.select("section_id", "ord", "first_page", "last_page").collect()] if isinstance(rules, DataFrame) else list(rules)
    one = [F.struct(F.lit(s).cast("string").alias("section_id"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for s, _, a, b in sorted(rows, key=lambda r: r[1])]
    every = F.array(*one) if one else F.expr("cast(array() as array<struct<section_id:string,a:bigint,b:bigint>>)")
    return F.filter(every, lambda r: F.col(page).between(r["a"], r["b"]))


def section_ranges(pages: DataFrame, rules: DataFrame | Iterable[tuple], page: str) -> DataFrame:
    """Adds section_id of the first rule whose page range holds the page; rows stay as they are."""
    return pages.withColumn("section_id", F.try_element_at(_fitting(rules, page), F.lit(1))["section_id"])


def all_sections(pages: DataFrame, rules: DataFrame | Iterable[tuple], page: str) -> DataFrame:
    """Adds all rules whose range holds the page, joined by | in their order (archived form)."""
    return pages.withColumn("sections", F.array_join(F.transform(_fitting(rules, page), lambda r: r["section_id"]), "|"))


def fitting_rules(text: Column, rules: Iterable[tuple[str, int, list[list[str]]]]) -> Column:
    """Section ids, in table order, whose keyword groups the (normalised) text satisfies; a rule without groups, or a text without characters, fits nothing.

    The keywords are taken as they are: normalise them as the text was.
    """
    out = []
    for section, _, groups in sorted(rules, key=lambda r: r[1]):
        if groups:
            every = F.lit(True)
            for g in groups:
                one = F.lit(False)
                for a in g:
                    one = one | F.contains(text, F.lit(a))
                every = every & one
            out.append(F.when(every & (text != ""), F.lit(section)))
    return F.array_compact(F.array(*out)) if out else F.expr("cast(array() as array<string>)")


def first_unopened(fits: str) -> str:
    """SQL: for an array of arrays of section ids, in reading order, which section each opens: its first one that nothing opened before."""
    step = let("try_element_at(filter(f, s -> not array_contains(a.seen, s)), 1)", "o", "named_struct('seen', case when o is null then a.seen else array_append(a.seen, o) end, 'out', array_append(a.out, o))")
    start = "named_struct('seen', cast(array() as array<string>), 'out', cast(array() as array<string>))"
    return f"aggregate({fits}, {start}, (a, f) -> {step}, a -> a.out)"


def openings(titles: DataFrame, keys: list[str], order: list[str], fits: str) -> DataFrame:
    """(keys, order, opens): which section each title row opens. fits: an array column of the sections a title fits.

    A section that is open never opens again, so a title falls through to its
    next fitting rule.  Titles that fit nothing are not carried; a book's fitting
    titles come together in one row, as many as its headers.
    """
    some = titles.where(F.size(fits) > 0).select(*keys, F.struct(*order).alias("_o"), F.col(fits).alias("_f"))
    line = some.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_o", "_f"))).alias("_t"))
    line = line.select(*keys, F.posexplode(F.arrays_zip(F.expr("transform(_t, x -> x._o)").alias("o"), F.expr(first_unopened("transform(_t, x -> x._f)")).alias("opens"))).alias("_p", "_x"))
    return line.where("_x.opens IS NOT NULL").select(*keys, *[F.col("_x.o")[c].alias(c) for c in order], F.col("_x.opens").alias("opens"))


def inside(words: DataFrame, boxes: DataFrame, on: list[str], pad: float = 0.0, first: bool = True) -> DataFrame:
    """Adds region: the first box in order that holds a word's centre, edges included, padded (first=False: all of them).

    A page's boxes come together in one array, which meets its words by equal
    keys; words stay row for row, those without a box get null (none).
    """
    x, y = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    b = boxes.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("ord", "x1", "y1", "x2", "y2"))).alias("_boxes"))
    held = F.filter("_boxes", lambda r: x.between(r["x1"] - pad, r["x2"] + pad) & y.between(r["y1"] - pad, r["y2"] + pad))
    found = F.transform(held, lambda r: r["ord"])
    region = F.try_element_at(found, F.lit(1)) if first else F.coalesce(found, F.expr("array()").cast(f"array<{dict(boxes.dtypes)['ord']}>"))
    return words.join(b, on, "left").withColumn("region" if first else "regions", region).drop("_boxes")


def aligned(tokens: Column, words: Column) -> Column:
    """Token and word arrays agree position by position."""
    return (F.size(tokens) == F.size(words)) & F.forall(F.arrays_zip(tokens.alias("a"), words.alias("b")), lambda p: p["a"].eqNullSafe(p["b"]))


def missing(expected: DataFrame, have: DataFrame, on: list[str]) -> DataFrame:
    return expected.join(have, on, "left_anti")


def symmetric_difference(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Rows only one side has: key, side."""
    l, r = a.select(F.col(on).alias("_l")).distinct(), b.select(F.col(on).alias("_r")).distinct()
    j = l.join(r, F.col("_l") == F.col("_r"), "full")
    return j.where("_l IS NULL OR _r IS NULL").select(F.coalesce("_l", "_r").alias(on), F.when(F.col("_r").isNull(), "missing").otherwise("unexpected").alias("side"))


def upsert(old: DataFrame, new: DataFrame, key: str | list[str], columns: list[str]) -> DataFrame:
    """New rows replace old ones of their key (a column or several); old ones that nothing replaces stay."""
    keys = [key] if isinstance(key, str) else key
    o, n = (d.select(F.struct(*keys).alias(f"{p}k"), F.lit(True).alias(f"{p}has"), *[F.col(c).alias(f"{p}{c}") for c in columns]) for d, p in ((old, "o_"), (new, "n_")))
    j = o.join(n, reduce(and_, [F.col("o_k")[k] == F.col("n_k")[k] for k in keys]), "full").withColumn("_k", F.coalesce("n_k", "o_k"))
    return j.select(*[F.col("_k")[k].alias(k) for k in keys], *[F.when(F.col("n_has"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in columns])


def latest(df: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def restamped(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Review diff: rows of new, changed where a field differs from old (missing is not equal to a value)."""
    o = old.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in fields])
    j = new.join(o, F.col(key) == F.col("_k"), "full")
    same = None
    for c in fields:
        one = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = one if same is None else same & one
    return j.select(F.coalesce(key, "_k").alias(key), *[F.col(c) for c in fields], F.when(F.col(key).isNull(), "removed").when(F.col("_k").isNull(), "added").when(same, "kept").otherwise("changed").alias("change"))


# ---- geometry that depends on order ---------------------------------------


def group_lines(words: DataFrame, page: str, wobble: float = 0.4) -> DataFrame:
    """Adds line and place: greedy lines, numbered by (top, left), words in them by left edge.

    From the top down (equal tops as `word` goes), a word joins the first line
    whose vertical span, widened by wobble x the word's height, holds its centre;
    the span grows.  A page is folded inside one row, as its words are one page.
    """
    cols = [c for c in words.columns if c != page]
    item = F.struct(F.col("y1").cast("double").alias("_y1"), F.col("word").alias("_o"), F.col("x1").cast("double").alias("_x1"), F.col("y2").cast("double").alias("_y2"), *cols)
    rows = words.groupBy(page).agg(F.sort_array(F.collect_list(item)).alias("_w"))
    fits = f"array_position(transform(a.g, g -> g.top - {wobble} * (w._y2 - w._y1) <= (w._y1 + w._y2) / 2 and (w._y1 + w._y2) / 2 <= g.bottom + {wobble} * (w._y2 - w._y1)), true)"
    grown = "transform(a.g, (g, i) -> case when i + 1 = p then named_struct('top', least(g.top, w._y1), 'left', least(g.left, w._x1), 'bottom', greatest(g.bottom, w._y2)) else g end)"
    new = "array_append(a.g, named_struct('top', w._y1, 'left', w._x1, 'bottom', w._y2))"
    step = let(f"cast({fits} as int)", "p", f"named_struct('g', case when p > 0 then {grown} else {new} end, 'line', array_append(a.line, case when p > 0 then p else size(a.g) + 1 end))")
    start = "named_struct('g', cast(array() as array<struct<top:double,left:double,bottom:double>>), 'line', cast(array() as array<int>))"
    rows = rows.withColumn("_f", F.expr(f"aggregate(_w, {start}, (a, w) -> {step})"))
    rank = "transform(sort_array(transform(_f.g, (g, i) -> named_struct('top', g.top, 'left', g.left, 'i', i + 1))), x -> x.i)"
    rows = rows.withColumn("_r", F.expr(rank))
    each = F.expr("transform(_w, (w, i) -> named_struct('line', array_position(_r, _f.line[i]), 'x', w._x1, 'i', i, 'w', w))")
    # Within a line by left edge, equal ones as they joined.
    out = rows.select(page, F.posexplode(F.sort_array(each)).alias("_p", "_x"))
    place = F.row_number().over(Window.partitionBy(page, "line").orderBy("_p"))
    return out.select(page, *[F.col("_x.w")[c].alias(c) for c in cols], F.col("_x.line").alias("line"), "_p").withColumn("place", place.cast("long")).select(*words.columns, "line", "place")


def merge_phrases(boxes: DataFrame, page: str, row: int = 60, rise: int = 50, gap: int = 140) -> DataFrame:
    """Boxes by the row of their centre, then x; each joins the phrase before it if centres and x-gap are near, and the envelope grows. page, phrase, x1, y1, x2, y2."""
    whole = [F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")]
    key = F.floor((F.col("y1") + F.floor((F.col("y2") - F.col("y1")) / 2)) / row)
    rows = boxes.groupBy(page).agg(F.sort_array(F.collect_list(F.struct(key.alias("r"), *whole))).alias("_b"))
    near = f"size(a) > 0 and abs((a[size(a) - 1].y1 + a[size(a) - 1].y2) / 2 - (b.y1 + b.y2) / 2) < {rise} and b.x1 - a[size(a) - 1].x2 < {gap}"
    last = "named_struct('x1', least(l.x1, b.x1), 'y1', least(l.y1, b.y1), 'x2', greatest(l.x2, b.x2), 'y2', greatest(l.y2, b.y2))"
    grown = f"transform(a, (l, i) -> case when i = size(a) - 1 then {last} else l end)"
    fold = f"aggregate(_b, cast(array() as array<struct<x1:bigint,y1:bigint,x2:bigint,y2:bigint>>), (a, b) -> case when {near} then {grown} else array_append(a, named_struct('x1', b.x1, 'y1', b.y1, 'x2', b.x2, 'y2', b.y2)) end)"
    out = rows.select(page, F.posexplode(F.expr(fold)).alias("_p", "_x"))
    return out.select(page, (F.col("_p") + 1).cast("long").alias("phrase"), "_x.*")


# ---- review log ------------------------------------------------------------

_SAVES = pa.schema([("page", pa.int64()), ("seq", pa.int64()), ("outcome", pa.string()), ("archived", pa.string()), ("keeps_original", pa.bool_()), ("withdraws_approval", pa.bool_())])


def _walk(batches):
    """Rows come sorted by page and place in the log; what is kept is one page's present hash."""
    page, current, edited = object(), None, False
    for batch in batches:
        out = []
        for p, seq, base, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != page:
                page, current, edited = p, None, False
            saved = base == current
            changed = saved and current is not None and current != body
            out.append((p, seq, "saved" if saved else "conflict", current if changed else None, changed and not edited, saved and current != body))
            if saved:
                current, edited = body, edited or changed
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _SAVES, strict=True)] if out else [pa.array([], t.type) for t in _SAVES], schema=_SAVES)


def fold_saves(log: DataFrame, page: str = "page") -> DataFrame:
    """Compare-and-set over an edit log (page, seq, base, body_hash): page, seq, outcome, archived, keeps_original, withdraws_approval.

    An edit is saved where its base is the page's present hash (null: no text
    yet), else it conflicts.  A saved change archives the hash it replaced, keeps
    the very first text once as the original, and withdraws an approval.  The
    log is dealt by page and walked in order; memory does not grow with it.
    """
    rows = log.select(F.col(page).cast("long").alias("page"), F.col("seq").cast("long").alias("seq"), F.col("base").cast("string").alias("base"), F.col("body_hash").cast("string").alias("body_hash"))
    line = rows.repartition("page").sortWithinPartitions("page", "seq")
    out = line.mapInArrow(_walk, "page long, seq long, outcome string, archived string, keeps_original boolean, withdraws_approval boolean")
    return out.withColumnRenamed("page", page)
