"""Masks as tables of runs: one row (page, y, x1, x2) per stretch of set pixels in a row, ends exclusive.

Every step is a join or a grouping by page, row, tile or band, so a page is the
work of many tasks and no mask is held whole.  Where a mask is given, boxes (page,
x1, y1, x2, y2) may stand for it as well.  Parts are found within bands of rows
and then joined across the bands' borders; words meet masks in bands too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bands
from ..functions.sqlparts import rounded
from ..storage import stored
from . import core, graph, layout

#: Pixels of a tile's side.
TILE = 64
#: Parts under this area are specks; parts of widened ink over this are phrases, and how far ink is widened (fixed values).
LEAST_AREA, PHRASE_AREA, WIDE, TALL = 28, 1500, 45, 15


def united(runs: DataFrame, page: str = "page") -> DataFrame:
    """Runs that overlap or touch become one; empty ones go."""
    w = Window.partitionBy(page, "y").orderBy("x1", "x2")
    top = F.max("x2").over(w.rowsBetween(Window.unboundedPreceding, -1))
    some = runs.where("x1 < x2").select(page, "y", "x1", "x2")
    line = core.islands(some.withColumn("_new", F.col("x1") > top), [page, "y"], ["x1", "x2"], F.col("_new"), "_run")
    return line.groupBy(page, "y", "_run").agg(F.min("x1").alias("x1"), F.max("x2").alias("x2")).drop("_run")


def of_boxes(boxes: DataFrame, page: str = "page") -> DataFrame:
    """The runs of a page's boxes (x1, y1, x2, y2), ends exclusive; empty boxes have none."""
    rows = boxes.where("x1 < x2 AND y1 < y2").select(page, F.explode(F.expr("sequence(cast(y1 as bigint), cast(y2 as bigint) - 1)")).alias("y"), F.col("x1").cast("long").alias("x1"), F.col("x2").cast("long").alias("x2"))
    return united(rows, page)


def grown(runs: DataFrame, sizes: DataFrame, footprint: list[tuple[int, int, int]], page: str = "page") -> DataFrame:
    """Dilation: every run by the rows (dy, left, right) of a footprint, within the page (sizes: page, width, height)."""
    shape = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(left).alias("l"), F.lit(right).alias("r")) for dy, left, right in footprint])
    wide = runs.withColumn("_f", F.explode(shape)).join(sizes.select(page, "width", "height"), page)
    wide = wide.select(page, (F.col("y") + F.col("_f.dy")).alias("y"), F.greatest(F.lit(0), F.col("x1") - F.col("_f.l")).cast("long").alias("x1"), F.least("width", F.col("x2") + F.col("_f.r")).cast("long").alias("x2"), "height")
    return united(wide.where("y >= 0 AND y < height"), page)


def rectangle(width: int, height: int) -> list[tuple[int, int, int]]:
    """The footprint of a rectangle around its centre."""
    return [(dy, width // 2, width - 1 - width // 2) for dy in range(-(height // 2), height - height // 2)]


def without(a: DataFrame, b: DataFrame, page: str = "page") -> DataFrame:
    """What a covers and b does not."""
    ends = lambda df, k: df.select(page, "y", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.lit(1).alias("d")), F.struct(F.col("x2").alias("x"), F.lit(-1).alias("d")))).alias("e")).select(page, "y", "e.x", *[(F.col("e.d") if k == i else F.lit(0)).alias(n) for i, n in enumerate("ab")])
    steps = ends(a, 0).union(ends(b, 1)).groupBy(page, "y", "x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy(page, "y").orderBy("x")
    deep = [F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in "ab"]
    line = steps.select(page, "y", F.col("x").alias("x1"), F.lead("x").over(w).alias("x2"), *deep)
    return united(line.where("a > 0 AND b = 0 AND x2 IS NOT NULL"), page)


def _tiles(low: Column, high: Column) -> Column:
    """The numbers of the tiles that the places from low to high lie in."""
    return F.explode(F.sequence(F.floor(low / TILE), F.floor(high / TILE)))


def _node() -> Column:
    """A run's name within its page."""
    return (F.shiftleft(F.col("y").cast("long"), 32) + F.col("x1")).alias("node")


def touching(runs: DataFrame, page: str = "page") -> DataFrame:
    """(page, u, v): runs of neighbouring rows that touch, also by a corner only; a run has the name `node` if there is one."""
    name = F.col("node") if "node" in runs.columns else _node()
    r = runs.select(page, "y", "x1", "x2", name).withColumn("tile", _tiles(F.col("x1"), F.col("x2")))
    a = r.select(page, "tile", F.col("y").alias("ya"), F.col("x1").alias("a1"), F.col("x2").alias("a2"), F.col("node").alias("u"))
    b = r.select(page, "tile", (F.col("y") - 1).alias("ya"), F.col("x1").alias("b1"), F.col("x2").alias("b2"), F.col("node").alias("v"))
    # Two runs may share several tiles; they meet in that where both have begun.
    meet = (F.col("a1") <= F.col("b2")) & (F.col("b1") <= F.col("a2")) & (F.floor(F.greatest("a1", "b1") / TILE) == F.col("tile"))
    return a.join(b, [page, "tile", "ya"]).where(meet).select(page, "u", "v")


def boxed(mask: DataFrame, page: str = "page") -> DataFrame:
    """A mask of runs or boxes as boxes: page, x1, y1, x2, y2 of type long."""
    y1, y2 = ("y", F.col("y") + 1) if "y" in mask.columns else ("y1", F.col("y2"))
    return mask.select(page, *[F.col(c).cast("long").alias(n) for c, n in (("x1", "x1"), (y1, "y1"), ("x2", "x2"))], y2.cast("long").alias("y2"))


def _bands(first: Column, last: Column) -> Column:
    """The numbers of the bands that the rows from first to last lie in."""
    return F.sequence(F.floor(first / bands.BAND).cast("long"), F.floor(last / bands.BAND).cast("long"))


def _dealt(rows: DataFrame, page: str, *more: str) -> DataFrame:
    """Rows with band, dealt and sorted by page and band."""
    return rows.select(page, "band", "x1", "y1", "x2", "y2", *more).repartition(page, "band").sortWithinPartitions(page, "band")


def _pieces(whole: bool, schema: pa.Schema):
    def run(batches):
        for t, begins in bands.groups(batches):
            *box, group, back = bands.places(t, begins)
            start, end = bands.united(*box)
            if not len(start):
                continue
            first = bands.joined(start, end)
            order = np.argsort(first, kind="stable")
            at = np.flatnonzero(np.diff(first[order], prepend=-1))
            row, low = start >> bands.SHIFT, (1 << bands.SHIFT) - 1
            group = row // bands.BAND
            y, x1, x2 = (row + back[group])[order], ((start & low) - bands.SIDE)[order], (end - (row << bands.SHIFT) - bands.SIDE)[order]
            # The first run of a piece names it.
            node = (y[at] << 32) + x1[at]
            kept = np.ones(len(y), bool) if whole else np.isin(y % bands.BAND, (0, bands.BAND - 1))
            cut = np.concatenate([[0], np.cumsum(np.add.reduceat(kept.astype(np.int64), at))]).astype(np.int32)
            rows = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([pa.array(c[kept]) for c in (y, x1, x2)], ["y", "x1", "x2"]))
            ends = np.append(at[1:], len(y)) - 1
            page = t.column(0).combine_chunks().take(pa.array(begins[group[order][at]]))
            numbers = (node, np.minimum.reduceat(x1, at), y[at], np.maximum.reduceat(x2, at), y[ends] + 1, np.add.reduceat(x2 - x1, at))
            yield pa.RecordBatch.from_arrays([page, *map(pa.array, numbers), rows], schema=pa.schema([pa.field(schema[0].name, page.type), *list(schema)[1:]]))

    return run


_RUN = pa.struct([("y", pa.int64()), ("x1", pa.int64()), ("x2", pa.int64())])
_PIECE = [("node", pa.int64()), ("x1", pa.int64()), ("y1", pa.int64()), ("x2", pa.int64()), ("y2", pa.int64()), ("area", pa.int64()), ("runs", pa.list_(_RUN))]


def pieces(mask: DataFrame, page: str = "page", whole: bool = True) -> DataFrame:
    """Bands' shares of the mask's 8-connected parts: page, part, x1, y1, x2, y2, area, runs; part: the part's smallest node.

    runs: all of the share's runs, united, or without `whole` only those in the
    first and last rows of bands.
    """
    some = boxed(mask, page).where("x1 < x2 AND y1 < y2").withColumn("band", F.explode(_bands(F.col("y1"), F.col("y2") - 1)))
    kind = dict(mask.dtypes)[page]
    schema = pa.schema([(page, pa.null()), *_PIECE])
    found = _dealt(some, page).mapInArrow(_pieces(whole, schema), f"{page} {kind}, node long, x1 long, y1 long, x2 long, y2 long, area long, runs array<struct<y:bigint,x1:bigint,x2:bigint>>")
    own = stored(found, "pieces")
    edge = own.where(f"y1 % {bands.BAND} = 0 OR y2 % {bands.BAND} = 0").select(page, "node", F.explode(F.filter("runs", lambda r: (r["y"] + 1) % bands.BAND < 2)).alias("r"))
    ties = graph.components(touching(edge.select(page, "node", "r.*"), page).distinct(), "parts", (page,))
    return own.join(ties, [page, "node"], "left").select(page, F.coalesce("component", "node").alias("part"), "x1", "y1", "x2", "y2", "area", "runs")


def labelled(runs: DataFrame, page: str = "page") -> DataFrame:
    """The mask's runs with part: the smallest node of its 8-connected part."""
    return pieces(runs, page).select(page, "part", F.explode("runs").alias("r")).select(page, "r.*", "part")


def parts(marked: DataFrame, page: str = "page") -> DataFrame:
    """One row per part of labelled runs or of pieces: page, part, x1, y1, x2, y2, area."""
    y1, y2, area = ("y", F.col("y") + 1, F.col("x2") - F.col("x1")) if "y" in marked.columns else ("y1", F.col("y2"), F.col("area"))
    return marked.groupBy(page, "part").agg(F.min("x1").alias("x1"), F.min(y1).alias("y1"), F.max("x2").alias("x2"), F.max(y2).alias("y2"), F.sum(area).alias("area"))


def sorted_parts(marked: DataFrame, sizes: DataFrame, page: str = "page") -> DataFrame:
    """parts() with kind: small (a speck), ornament (a rule or border) or kept (glyph ink)."""
    p = parts(marked, page).join(sizes.select(page, F.col("width").alias("_w"), F.col("height").alias("_h")), page)
    rule = layout.ornament(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("area"), F.col("_w"), F.col("_h"))
    return p.withColumn("kind", F.when(F.col("area") < LEAST_AREA, "small").when(rule, "ornament").otherwise("kept")).drop("_w", "_h")


def _counts(kinds: DataFrame, sizes: DataFrame, page: str) -> DataFrame:
    found = ("kept", "small", "ornament")
    ink = F.sum(F.when(F.col("kind") == "kept", F.col("area")))
    n = kinds.groupBy(page).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in found], ink.alias("kept_area"))
    return sizes.select(page).join(n, page, "left").fillna(0, [*found, "kept_area"])


def filter_counts(mask: DataFrame, sizes: DataFrame, page: str = "page") -> DataFrame:
    """page, kept, small, ornament, kept_area: what the component filter of a red mask finds, 0 for pages without ink."""
    return _counts(sorted_parts(pieces(mask, page, whole=False), sizes, page), sizes, page)


def filtered(runs: DataFrame, sizes: DataFrame, page: str = "page") -> tuple[DataFrame, DataFrame]:
    """(runs with kind, counts): the component filter of a red mask; counts as filter_counts has them."""
    marked = pieces(runs, page)
    kinds = stored(sorted_parts(marked, sizes, page), "kinds")
    kept = marked.join(kinds.select(page, "part", "kind"), [page, "part"]).select(page, F.explode("runs").alias("r"), "kind")
    return kept.select(page, "r.*", "kind"), _counts(kinds, sizes, page)


def widened(mask: DataFrame, sizes: DataFrame, width: int, height: int, page: str = "page") -> DataFrame:
    """Dilation by a rectangle, box by box: boxes within the page."""
    left, up = width // 2, height // 2
    b = boxed(mask, page).where("x1 < x2 AND y1 < y2").join(sizes.select(page, F.col("width").alias("_w"), F.col("height").alias("_h")), page)
    x1, y1 = F.greatest(F.lit(0), F.col("x1") - left), F.greatest(F.lit(0), F.col("y1") - up)
    x2, y2 = F.least("_w", F.col("x2") + (width - 1 - left)), F.least("_h", F.col("y2") + (height - 1 - up))
    return b.select(page, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def red_phrases(red: DataFrame, sizes: DataFrame, least: int = PHRASE_AREA, page: str = "page") -> DataFrame:
    """page, phrase, x1, y1, x2, y2: parts of more than `least` pixels of red ink widened by WIDE x TALL, those of one line merged."""
    marked = pieces(widened(red, sizes, WIDE, TALL, page), page, whole=False)
    return core.merge_phrases(parts(marked, page).where(F.col("area") > least), page)


def _under(batches):
    for t, begins in bands.groups(batches):
        kind = t.column("kind").to_numpy()
        *box, group, back = bands.places(t, begins)
        red, ink, word = ([c[m] for c in box] for m in (kind == 0, kind == 1, kind == 2))
        which = pa.array(np.flatnonzero(kind == 2))
        yield pa.RecordBatch.from_arrays([t.column("word").combine_chunks().take(which), pa.array(bands.covered(red, word)), pa.array(bands.covered(ink, word))], names=["word", "_red", "_ink"])


def covered(words: DataFrame, red: DataFrame, ink: DataFrame, page: str = "page") -> DataFrame:
    """words with _red and _ink, the set pixels of both masks in each word's box; rows that repeat stay.

    Boxes and words are dealt by band; a word's counts are summed over its bands.
    """
    places = ("x1", "y1", "x2", "y2")
    last = F.greatest("y1", F.col("y2") - 1)
    whole = F.struct(*words.columns)
    # A word without a whole box lies in one band and covers nothing there.
    no = F.greatest(*[F.col(c).isNull().cast("int") for c in places]) == 1
    w = words.select(page, whole.alias("word"), F.when(no, F.array(F.lit(0).cast("long"))).otherwise(_bands(F.col("y1"), last)).alias("_b"), *[F.when(no, 0).otherwise(F.col(c)).cast("long").alias(c) for c in places])
    rows = w.select(page, *places, F.explode("_b").alias("band"), F.lit(2).alias("kind"), "word")
    for k, mask in enumerate((red, ink)):
        b = boxed(mask, page).where("x1 < x2 AND y1 < y2").withColumn("band", F.explode(_bands(F.col("y1"), last)))
        rows = rows.union(b.select(page, *places, "band", F.lit(k).alias("kind"), F.lit(None).cast(w.schema["word"].dataType).alias("word")))
    schema = T.StructType([T.StructField("word", w.schema["word"].dataType), T.StructField("_red", T.LongType()), T.StructField("_ink", T.LongType())])
    found = _dealt(rows, page, "kind", "word").mapInArrow(_under, schema).groupBy("word").agg(F.sum("_red").alias("_red"), F.sum("_ink").alias("_ink"), F.count("*").alias("_n"))
    found = found.select("word.*", "_red", "_ink", "_n")
    # Equal words are summed together: as many as their bands go into the rows.
    each = F.when(no, F.col("_n")).otherwise(F.floor(F.col("_n") / F.size(_bands(F.col("y1"), last)))).cast("int")
    found = found.withColumn("_n", each).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return found.select(*words.columns, *[F.floor(F.col(c) / F.col("_n")).alias(c) for c in ("_red", "_ink")])


def word_redness(words: DataFrame, red: DataFrame, ink: DataFrame, sizes: DataFrame, page: str = "page") -> DataFrame:
    """words with redness, to three places: red over ink pixels of each box; 0 without ink, null on pages that sizes lacks.

    words: page, x1, y1, x2, y2, ...; ink is all ink, red included.
    """
    j = covered(words, red, ink, page).join(sizes.select(page, F.lit(True).alias("_known")), page, "left")
    share = F.expr(rounded("cast(coalesce(_red, 0L) as double) / nullif(_ink, 0L)", 3))
    return j.withColumn("redness", F.when(F.col("_known"), F.coalesce(share, F.lit(0.0)))).select(*words.columns, "redness")
