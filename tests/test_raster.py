"""Rasters in bands and masks in runs against whole pages, plain loops and drawn pages."""

import duckdb
import numpy as np
import pandas as pd
import pytest
import raster_reference as ref
from folioflow.functions import raster
from folioflow.operators import layout, rasters, runs
from folioflow.plans import ORACLE_SQL, QUERIES
from folioflow.plans.masks import HIGH, WIDE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

RED, BLACK = (40, 40, 200), (20, 20, 20)


def flood(mask):
    seen, out = np.zeros(mask.shape, bool), []
    for y, x in np.argwhere(mask):
        if seen[y, x]:
            continue
        stack, part = [(y, x)], []
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            part.append((a, b))
            for c in range(max(a - 1, 0), min(a + 2, mask.shape[0])):
                for d in range(max(b - 1, 0), min(b + 2, mask.shape[1])):
                    if mask[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        stack.append((c, d))
        ys, xs = zip(*part, strict=True)
        out.append((int(min(xs)), int(min(ys)), int(max(xs)) + 1, int(max(ys)) + 1, len(part)))
    return sorted(out)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([3, 5]))
def test_median(seed, k):
    x = np.random.default_rng(seed).integers(0, 256, (9, 12), dtype=np.uint8)
    p = np.pad(x, k // 2, mode="edge")
    want = [[np.median(p[i : i + k, j : j + k]) for j in range(12)] for i in range(9)]
    assert (raster.median_blur(x, k) == np.array(want)).all()


def test_ellipse_and_hsv():
    assert raster.ellipse(3, 3).astype(int).tolist() == [[0, 1, 0], [1, 1, 1], [0, 1, 0]]
    assert raster.ellipse(5, 5).sum() == 17
    h, s, v = raster.hsv(np.array([[(0, 0, 255), (0, 255, 0), (255, 0, 0), (9, 9, 9)]], np.uint8))
    assert (h.tolist(), s.tolist(), v.tolist()) == ([[0, 60, 120, 0]], [[255, 255, 255, 0]], [[255, 255, 255, 9]])


def page():
    x = np.full((300, 400, 3), 250, np.uint8)
    x[40:52, 40:80] = RED
    x[40:52, 100:180] = BLACK
    x[100:104, 20:390] = RED  # a rule across the page
    x[200:203, 200:203] = RED  # a speck
    return x


def noisy(rng, h, w):
    x = rng.normal(225 - np.linspace(0, 60, w)[None, :, None], 6, (h, w, 3))
    for _ in range(40):
        y, z, a, b = rng.integers(0, h), rng.integers(0, w), rng.integers(2, 20), rng.integers(2, 40)
        x[y : y + a, z : z + b] = [RED, BLACK, (90, 90, 90), (60, 50, 150), (200, 30, 30)][rng.integers(0, 5)] + rng.normal(0, 8, 3)
    return np.clip(x, 0, 255).astype(np.uint8)


def images(spark, pages):
    rows = [(k, *(x.shape[:2] if x is not None else (0, 0)), 1 if x is not None and x.ndim == 2 else 3, None if x is None else x.tobytes()) for k, x in pages.items()]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["origin", "height", "width", "nChannels", "data"]), "origin string, height int, width int, nChannels int, data binary")


def painted(rows, shape):
    out = np.zeros(shape, bool)
    for r in rows:
        assert not out[r.y, r.x1 : r.x2].any()
        out[r.y, r.x1 : r.x2] = True
    return out


@pytest.mark.parametrize("band, k", [(252, 51), (24, 9)])
def test_bands_are_the_whole_page(spark, monkeypatch, band, k):
    monkeypatch.setattr(rasters, "BAND", band)
    rng = np.random.default_rng(band)
    pages = {"drawn": page(), "noisy": noisy(rng, 270, 180), "small": noisy(rng, 60, 90), "even": np.full((80, 60, 3), 240, np.uint8), "red": np.full((80, 60, 3), RED, np.uint8), "grey": noisy(rng, 70, 50)[..., 0].copy(), "line": noisy(rng, 4, 30), "thin": noisy(rng, 50, 3), "none": None}
    stats, red, black = rasters.split_pages(images(spark, pages), k=k)
    stats, red, black = ({r.origin: r for r in stats.collect()}, red.collect(), black.collect())
    assert stats["none"].width is None and set(stats) == set(pages)
    for name, x in pages.items():
        if x is None:
            continue
        whole = np.repeat(x[..., None], 3, 2) if x.ndim == 2 else x
        want, reds, blacks = ref.split_page(whole, k)
        got = stats[name].asDict()
        assert {c: got[c] for c in want} == want, name
        assert (painted([r for r in red if r.origin == name], reds.shape) == reds).all()
        assert (painted([r for r in black if r.origin == name], reds.shape) == blacks).all(), name
    assert stats["drawn"].red_components_kept == 1 and stats["even"].is_blank and stats["red"].is_illustration


def masks(rng, n):
    shapes = [(1, 1), (1, 90), (70, 3), (40, 150), (66, 140)]
    out = {i: rng.random(shapes[i % len(shapes)]) < rng.choice([0.05, 0.3, 0.5, 0.9]) for i in range(n)}
    spiral = np.zeros((41, 200), bool)
    for i in range(0, 41, 4):
        spiral[i] = True
        spiral[i : i + 3, 199 if i % 8 else 0] = True
    return out | {n: spiral, n + 1: np.zeros((5, 5), bool)}


def as_runs(spark, pages):
    rows = [(k, int(y), int(a), int(b)) for k, m in pages.items() for y, a, b in zip(*raster.runs(m), strict=True)]
    sizes = spark.createDataFrame([(k, m.shape[1], m.shape[0]) for k, m in pages.items()], "page int, width int, height int")
    return spark.createDataFrame(rows, "page int, y long, x1 long, x2 long"), sizes


def test_parts_and_filter(spark):
    pages = masks(np.random.default_rng(2), 15)
    table, sizes = as_runs(spark, pages)
    got = runs.parts(runs.labelled(table)).collect()
    kept, counts = runs.filtered(table, sizes)
    kept, counts = kept.collect(), {r.page: r for r in counts.collect()}
    for k, m in pages.items():
        assert sorted((r.x1, r.y1, r.x2, r.y2, r.area) for r in got if r.page == k) == flood(m)
        red, ornaments, n = ref.filter_components(m)
        assert {c: counts[k][c] for c in n} == n
        for kind, want in (("kept", red), ("ornament", ornaments)):
            assert (painted([r for r in kept if r.page == k and r.kind == kind], m.shape) == want).all()


def test_united_grown_and_without(spark):
    rng = np.random.default_rng(3)
    boxes = [(i % 4, int(x), int(y), int(x + w), int(y + h)) for i, (x, y, w, h) in enumerate(zip(*rng.integers(0, 60, (2, 60)), *rng.integers(0, 20, (2, 60)), strict=True))]
    want = {p: np.zeros((90, 90), bool) for p in range(4)}
    for p, x1, y1, x2, y2 in boxes:
        want[p][y1:y2, x1:x2] = True
    table = runs.of_boxes(spark.createDataFrame(boxes, "page int, x1 int, y1 int, x2 int, y2 int"))
    other, sizes = as_runs(spark, {p: rng.random((90, 90)) < 0.2 for p in range(4)})
    holes = {p: painted([r for r in other.collect() if r.page == p], (90, 90)) for p in range(4)}
    foot = rasters._footprint(5, 5)
    got, wide, less = table.collect(), runs.grown(table, sizes, foot).collect(), runs.without(table, other).collect()
    tall = runs.grown(table, sizes, runs.rectangle(45, 15)).collect()
    for p in range(4):
        own = lambda rows, p=p: painted([r for r in rows if r.page == p], (90, 90))
        assert (own(got) == want[p]).all() and (own(less) == (want[p] & ~holes[p])).all()
        assert (own(wide) == raster.dilate(want[p], raster.ellipse(5, 5))).all()
        assert (own(tall) == raster.dilate(want[p], np.ones((15, 45), bool))).all()


def test_red_phrases(spark):
    rng = np.random.default_rng(4)
    pages = {p: np.zeros((300, 400), bool) for p in range(4)}
    for m in pages.values():
        for _ in range(9):
            y, x = rng.integers(0, 290), rng.integers(0, 390)
            m[y : y + rng.integers(1, 30), x : x + rng.integers(1, 60)] = True
    images_ = images(spark, {str(p): (m * np.uint8(255)) for p, m in pages.items()})
    got = rasters.red_regions(images_, "origin").collect()
    for p, m in pages.items():
        boxes, phrases = ref.red_boxes(m).tolist(), []
        for x1, y1, x2, y2 in sorted(boxes, key=lambda b: ((b[1] + (b[3] - b[1]) // 2) // 60, *b)):
            last = phrases[-1] if phrases else None
            if last and abs((last[1] + last[3]) / 2 - (y1 + y2) / 2) < 50 and x1 - last[2] < 140:
                phrases[-1] = [min(last[0], x1), min(last[1], y1), max(last[2], x2), max(last[3], y2)]
            else:
                phrases.append([x1, y1, x2, y2])
        assert [[r.x1, r.y1, r.x2, r.y2] for r in sorted((r for r in got if r.origin == str(p)), key=lambda r: r.phrase)] == phrases


def test_word_redness(spark):
    rng = np.random.default_rng(5)
    ink = {p: rng.random((150, 170)) < 0.4 for p in range(3)}
    red = {p: m & (rng.random(m.shape) < 0.5) for p, m in ink.items()}
    ink[2][:] = red[2][:] = False
    words = [(p, i, *map(int, (x, y, x + w, y + h))) for p in range(4) for i, (x, y, w, h) in enumerate(zip(*rng.integers(-20, 170, (2, 40)), *rng.integers(0, 130, (2, 40)), strict=True))]
    df = spark.createDataFrame([(*w, "t") for w in words], "page int, word int, x1 int, y1 int, x2 int, y2 int, text string")
    (a, sizes), (b, _) = as_runs(spark, red), as_runs(spark, ink)
    got = {(r.page, r.word): r.redness for r in runs.word_redness(df, a, b, sizes).collect()}
    assert got == {(p, i): None if p == 3 else round(ref.redness(red[p], ink[p], box), 3) for p, i, *box in words}


def test_layers(spark):
    got = {r.origin: r.dark for r in rasters.dark_pixels(images(spark, {"a": page(), "b": None})).collect()}
    assert got["b"] is None and got["a"] > 80 * 12


def tall_boxes(rng, n=40):
    """Boxes of several bands' height over three pages, and the masks they make."""
    boxes = [(p, int(x), int(y), int(x + w), int(y + h)) for p in range(3) for x, y, w, h in zip(*rng.integers(0, 180, (1, n)), *rng.integers(0, 380, (1, n)), *rng.integers(1, 25, (1, n)), *rng.integers(1, 150, (1, n)), strict=True)]
    want = {p: np.zeros((400, 200), bool) for p in range(3)}
    boxes = [(p, x1, y1, min(x2, 200), min(y2, 400)) for p, x1, y1, x2, y2 in boxes]
    for p, x1, y1, x2, y2 in boxes:
        want[p][y1:y2, x1:x2] = True
    return boxes, want


PLACES = "page int, x1 int, y1 int, x2 int, y2 int"


def test_filter_of_boxes_across_bands(spark):
    boxes, want = tall_boxes(np.random.default_rng(6), 12)
    want[3] = np.random.default_rng(7).random((300, 40)) < 0.45
    boxes += [(3, int(a), int(y), int(b), int(y) + 1) for y, a, b in zip(*raster.runs(want[3]), strict=True)]
    df = spark.createDataFrame(boxes, PLACES)
    sizes = spark.createDataFrame([(p, m.shape[1], m.shape[0]) for p, m in want.items()] + [(9, 5, 5)], "page int, width int, height int")
    got = runs.parts(runs.pieces(df)).collect()
    counts = {r.page: r for r in runs.filter_counts(df, sizes).collect()}
    for p, m in want.items():
        assert sorted((r.x1, r.y1, r.x2, r.y2, r.area) for r in got if r.page == p) == flood(m)
        red, _, n = ref.filter_components(m)
        assert {c: counts[p][c] for c in n} | {"kept_area": counts[p].kept_area} == n | {"kept_area": int(red.sum())}
    assert (counts[9].kept, counts[9].kept_area) == (0, 0)


def test_red_phrases_of_boxes(spark):
    """A mask of boxes gives the phrases of its runs, and each box is widened once, not row by row."""
    boxes, want = tall_boxes(np.random.default_rng(8), 6)
    df = spark.createDataFrame(boxes, PLACES)
    table, sizes = as_runs(spark, want)
    assert runs.widened(df, sizes, runs.WIDE, runs.TALL).count() == len(boxes)
    assert sorted(map(tuple, runs.red_phrases(df, sizes).collect())) == sorted(map(tuple, runs.red_phrases(table, sizes).collect()))
    got = runs.parts(runs.pieces(runs.widened(df, sizes, 45, 15))).collect()
    for p, m in want.items():
        assert sorted((r.x1, r.y1, r.x2, r.y2, r.area) for r in got if r.page == p) == flood(raster.dilate(m, np.ones((15, 45), bool)))


def test_word_redness_of_boxes(spark):
    """Boxes as masks; words over several bands, repeated ones and ones without a whole box."""
    boxes, ink = tall_boxes(np.random.default_rng(9))
    reds = boxes[::3]
    red = {p: np.zeros_like(m) for p, m in ink.items()}
    for p, x1, y1, x2, y2 in reds:
        red[p][y1:y2, x1:x2] = True
    words = [(p, i, x1 - 3, y1 - 9, x2 + 3, y2 + 9) for i, (p, x1, y1, x2, y2) in enumerate(boxes)]
    words += words[:5] + [(0, 900, 50, 350, 20, 100), (0, 901, None, 1, 2, 3), (7, 902, 1, 1, 9, 9)]
    sizes = spark.createDataFrame([(p, 200, 400) for p in range(3)], "page int, width int, height int")
    df = spark.createDataFrame(words, "page int, word int, x1 int, y1 int, x2 int, y2 int")
    got = sorted((r.word, -1.0 if r.redness is None else r.redness) for r in runs.word_redness(df, spark.createDataFrame(reds, PLACES), spark.createDataFrame(boxes, PLACES), sizes).collect())
    assert got == sorted((i, -1.0 if p == 7 else 0.0 if i >= 900 else round(ref.redness(red[p], ink[p], tuple(box)), 3)) for p, i, *box in words)


def test_rules_that_fill_just_enough(spark):
    """0.55 of a box is 11 of 20 pixels, whatever the box; one pixel less is no rule."""
    sides = [(w, h) for w in range(12, 400) for h in range(1, w // 12 + 1) if 11 * w * h % 20 == 0]
    df = spark.createDataFrame([(w, h, 11 * w * h // 20 - less, less) for w, h in sides for less in (0, 1)], "w long, h long, area long, less int")
    got = df.withColumn("rule", layout.ornament(F.col("w"), F.col("h"), F.col("area"), F.lit(4000), F.lit(4000)))
    assert got.where("rule <> (less = 0)").count() == 0


def strokes(places):
    """lineitem rows (page, x, y, quantity, rule) of line 1 whose strokes lie at x and y."""
    across, down = WIDE - 60, HIGH - 20
    for page, x, y, quantity, rule in places:
        order = next(o for o in range(97 * down) if (o * 13 + 101 - y) % down == 0 and (o % 97 == 0) == rule)
        part = (x - order * 3) * pow(7, -1, across) % across
        yield order, part, page, 1, quantity, "R"


def test_component_filter_of_just_full_rules(spark, tmp_path):
    """Strokes whose boxes they fill to 0.55 exactly, and to one column less or more, as in the SQL."""
    # x and width of a stroke, whether it is a rule, and the other's way from it and width.
    pairs = [(30, 40, False, 35, 2, 15), (30, 40, False, 35, 2, 14), (30, 40, False, 35, 2, 16), (40, 60, True, 60, 3, 20), (40, 60, True, 57, 3, 31), (40, 60, True, 60, 3, 21)]
    places = [s for i, (x, w, rule, dx, dy, v) in enumerate(pairs) for s in ((i, x, 120, w - 1.0, rule), (i, x + dx, 120 + dy, v - 1.0, False))]
    rows = list(strokes(places))
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    names = "page, kept, small, ornament, red_pixels"
    want = con.execute(f"SELECT {names} FROM ({ORACLE_SQL['component_filter']}) ORDER BY page").fetchall()
    got = QUERIES["component_filter"](spark, str(tmp_path)).selectExpr(*names.split(", ")).orderBy("page").collect()
    assert [tuple(r) for r in got] == want
    assert [r.ornament for r in got] == [1, 1, 0, 1, 1, 0]
