"""Page images as bands of rows, masks as tables of runs.

An image comes as one row (the fields of Spark's image source).  It is cut into
bands that carry the rows around them which a filter needs, so a page is the work
of several tasks; what holds for a page (the threshold of its ink, its parts) is
a grouping of what its bands give.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import raster
from ..functions.sqlparts import rounded
from ..session import BATCH_BYTES
from ..storage import stored
from . import runs as rn

#: Rows of a band, a multiple of the cells of coloured_cells; rows beside it that closing and opening a mask need.
BAND, EDGE = 252, 4
#: Pixels that bands of one width are worked on together; pixels of a cell's side.
STACK, CELL = 1 << 17, 6
_RUNS = "array<struct<y:bigint,x1:bigint,x2:bigint>>"


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Blue, green and red bytes of the image source's row; grey pages get three equal channels."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(x, 3, 2) if channels == 1 else x[..., :3]


def _known(images: DataFrame, key: str) -> DataFrame:
    return images.where("data IS NOT NULL AND height > 0 AND width > 0").select(key, "height", "width", "nChannels", "data")


def _lists(values: list, names: list[str], count: np.ndarray) -> pa.ListArray:
    """Lists of structs; count: the length of each."""
    rows = pa.StructArray.from_arrays([pa.array(v) for v in values], names)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), rows)


def _binaries(values: np.ndarray, count: np.ndarray) -> pa.Array:
    """Binary values cut from one array; count: the bytes of each."""
    cut = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(cut), pa.py_buffer(values)])


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _stacks(batch: pa.RecordBatch, *same: str) -> Iterator[pa.RecordBatch]:
    """A batch of bands as batches of about STACK pixels, one band at the least, equal in the columns `same`, so that they are worked on as one tall band."""
    columns = np.stack(_columns(batch, *same), 1)
    size = np.prod(_columns(batch, "width", "count"), 0)
    for kind in np.unique(columns, axis=0):
        own = np.flatnonzero((columns == kind).all(1))
        for at in np.split(own, np.flatnonzero(np.diff(np.cumsum(size[own]) // STACK)) + 1):
            yield batch.take(pa.array(at))


def _rows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band, row within the band) of every row of a stack."""
    band = np.repeat(np.arange(len(count)), count)
    return band, np.arange(len(band)) - (np.cumsum(count) - count)[band]


def bands(images: DataFrame, key: str = "origin", halo: int = 25) -> DataFrame:
    """key, band, height, width, nChannels, y (the band's first row), above (rows before it that data holds as well), count, data."""
    kind = dict(images.dtypes)[key]
    names = ["band", "height", "width", "nChannels", "y", "above", "count"]

    def batch(keys: pa.Array, rows: list[tuple], data: list[bytes]) -> pa.RecordBatch:
        at, *columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([keys.take(pa.array(at)), *[pa.array(c, pa.int32()) for c in columns], pa.array(data, pa.binary())], names=[key, *names, "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, data, size = [], [], 0
            for i, (h, w, c) in enumerate(zip(*_columns(b, "height", "width", "nChannels"), strict=True)):
                page = memoryview(b.column("data")[i].as_buffer())
                if len(page) < h * w * c:
                    raise ValueError(f"{len(page)} bytes for {h} rows of {w} pixels in {c} channels")
                for n, y in enumerate(range(0, h, BAND)):
                    low, end = max(0, y - halo), min(h, y + BAND + halo)
                    rows.append((i, n, h, w, c, y, y - low, min(BAND, h - y)))
                    data.append(bytes(page[low * w * c : end * w * c]))
                    size += len(data[-1])
                    if size >= BATCH_BYTES:
                        yield batch(b.column(key), rows, data)
                        rows, data, size = [], [], 0
            if rows:
                yield batch(b.column(key), rows, data)

    cut = _known(images, key).mapInArrow(run, f"{key} {kind}, band int, height int, width int, nChannels int, y int, above int, count int, data binary")
    return cut.repartition(key, "band")


def _masked(b: pa.RecordBatch, key: str, k: int) -> pa.RecordBatch:
    """band_masks of bands of one width and number of channels, laid below each other."""
    width, channels = b.column("width")[0].as_py(), b.column("nChannels")[0].as_py()
    y, above, count = _columns(b, "y", "above", "count")
    data = b.column("data").to_pylist()
    have = np.array([len(d) for d in data]) // (width * channels)
    # Every band gets the rows beside it that filters need; those off the page repeat its first or last row.
    halo = max(EDGE, k // 2)
    band, row = _rows(count + 2 * halo)
    row += above[band] - halo
    outside = (row < 0) | (row >= have[band])
    at = (np.cumsum(have) - have)[band] + np.clip(row, 0, have[band] - 1)
    x = pixels(np.frombuffer(b"".join(data), np.uint8).reshape(-1, width, channels)[at].tobytes(), len(at), width, channels)
    row -= above[band]
    own = np.flatnonzero((row >= 0) & (row < count[band]))
    band, row = band[own], row[own]
    line, x1, x2 = raster.runs(raster.red_candidates(x, outside)[own])
    red = _lists([row[line] + y[band[line]], x1, x2], ["y", "x1", "x2"], np.bincount(band[line], minlength=len(b)))
    grey = raster.grey_of(x)
    back = raster.inner_median(np.pad(grey, ((0, 0), (k // 2, k // 2)), mode="edge"), k)
    flat = raster.evened(grey[own], back[own - k // 2])
    levels = np.bincount((band[:, None] * 256 + flat).ravel(), minlength=len(b) * 256).reshape(-1, 256)
    some, v = np.nonzero(levels)
    levels = _lists([v.astype(np.int32), levels[some, v]], ["v", "n"], np.bincount(some, minlength=len(b)))
    # Cells that end below the page's last whole cell are cut off with it.
    high, wide = count // CELL, width // CELL
    coloured, cells = np.zeros(len(b), np.int64), high * wide
    if wide and high.any():
        whole = x[own[row < high[band] * CELL]][:, : wide * CELL]
        coloured = np.bincount(np.repeat(np.arange(len(b)), high), raster.coloured(raster.cell_means(whole, CELL)).sum(1), len(b)).astype(np.int64)
    for i in np.flatnonzero((y == 0) & (high == 0) | (high > 0) & (wide == 0)):
        coloured[i], cells[i] = raster.coloured_cells(x[own[band == i]], CELL)
    columns = [b.column(c) for c in (key, "band", "height", "width", "y", "count")]
    return pa.RecordBatch.from_arrays([*columns, red, _binaries(flat, count * width), levels, pa.array(coloured), pa.array(cells)], names=[key, "band", "height", "width", "y", "count", "red", "flat", "levels", "coloured", "cells"])


def band_masks(cut: DataFrame, key: str = "origin", k: int = 51) -> DataFrame:
    """key, band, height, width, y, count, red (runs of red candidates), flat (grey levels without background), levels (their histogram, without zeros), coloured, cells."""
    kind = dict(cut.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _stacks(batch, "width", "nChannels"):
                yield _masked(b, key, k)

    return cut.mapInArrow(run, f"{key} {kind}, band int, height int, width int, y int, count int, red {_RUNS}, flat binary, levels array<struct<v:int,n:bigint>>, coloured long, cells long")


def _thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The threshold of each page; pages come sorted, and the last one's sums wait for the next batch."""

    def out(keys, levels):
        level, known = raster.otsu(levels)
        return pa.RecordBatch.from_arrays([keys, pa.array(level.astype(np.int32), mask=~known)], names=[name, "threshold"])

    keys, levels, name = None, np.zeros((0, 256)), ""
    for b in batches:
        if not len(b):
            continue
        lists, name = b.column("levels"), b.schema.names[0]
        band, some = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy()), lists.flatten()
        new = np.bincount(band * 256 + some.field("v").to_numpy(), some.field("n").to_numpy(), len(b) * 256).reshape(-1, 256)
        keys = b.column(0) if keys is None else pa.concat_arrays([keys, b.column(0)])
        code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        begins = np.flatnonzero(np.diff(code, prepend=-1))
        keys, levels = keys.take(pa.array(begins)), np.add.reduceat(np.concatenate([levels, new]), begins, axis=0)
        yield out(keys[:-1], levels[:-1])
        keys, levels = keys[-1:], levels[-1:]
    if keys is not None:
        yield out(keys, levels)


def ink_thresholds(masks: DataFrame, key: str = "origin") -> DataFrame:
    """key, threshold: the level that parts a page's histogram with the largest variance between both sides (the lowest of equals); null for an even page."""
    rows = masks.select(key, "levels").repartition(key).sortWithinPartitions(key)
    return rows.mapInArrow(_thresholds, f"{key} {dict(masks.dtypes)[key]}, threshold int")


def _unclaimed(b: pa.RecordBatch, key: str, shape: list[tuple[int, int, int]], whole: bool) -> pa.RecordBatch:
    """ink_left of bands of one width, laid below each other."""
    width = b.column("width")[0].as_py()
    y, count, level = _columns(b, "y", "count", "threshold")
    band, row = _rows(count)
    flat = np.frombuffer(b"".join(b.column("flat").to_pylist()), np.uint8).reshape(-1, width)
    ink = flat <= level[band, None]
    claims = b.column("claims")
    of, runs = np.repeat(np.arange(len(b)), claims.value_lengths().fill_null(0).to_numpy()), claims.flatten()
    if len(of):
        top, steps = np.cumsum(count) - count, np.zeros(len(flat) * (width + 1), np.int64)
        at, x1, x2 = (runs.field(c).to_numpy() for c in ("y", "x1", "x2"))
        for dy, left, right in shape:
            here = at + dy - y[of]
            on = (here >= 0) & (here < count[of])
            place = (top[of] + here)[on] * (width + 1)
            np.add.at(steps, place + np.maximum(x1[on] - left, 0), 1)
            np.add.at(steps, place + np.minimum(x2[on] + right, width), -1)
        ink &= steps.reshape(-1, width + 1).cumsum(1)[:, :-1] == 0
    names, columns = [key, "band", "pixels"], [b.column(key), b.column("band"), pa.array(np.bincount(band, ink.sum(1), len(b)).astype(np.int64))]
    if whole:
        line, x1, x2 = raster.runs(ink)
        names, columns = [*names, "runs"], [*columns, _lists([row[line] + y[band[line]], x1, x2], ["y", "x1", "x2"], np.bincount(band[line], minlength=len(b)))]
    return pa.RecordBatch.from_arrays(columns, names=names)


def ink_left(masks: DataFrame, thresholds: DataFrame, marked: DataFrame, key: str = "origin", whole: bool = True) -> DataFrame:
    """key, band, pixels and, if whole, runs of the ink (levels up to their page's threshold) that no marked run, widened by an ellipse of 5 x 5, claims."""
    kind, shape = dict(masks.dtypes)[key], _footprint(5, 5)
    far = max(abs(dy) for dy, _, _ in shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _stacks(batch, "width"):
                yield _unclaimed(b, key, shape, whole)

    near = F.explode(F.sequence(F.floor((F.col("y") - far) / BAND).cast("int"), F.floor((F.col("y") + far) / BAND).cast("int")))
    claims = marked.select(key, near.alias("band"), F.struct("y", "x1", "x2").alias("r")).groupBy(key, "band").agg(F.collect_list("r").alias("claims"))
    # Nothing is broadcast: it would pass through the driver.
    need = masks.select(key, "band").distinct().join(thresholds.where("threshold IS NOT NULL").hint("merge"), key).join(claims.hint("merge"), [key, "band"], "left")
    j = masks.select(key, "band", "y", "count", "width", "flat").join(need.hint("merge"), [key, "band"])
    return j.mapInArrow(run, f"{key} {kind}, band int, pixels long" + f", runs {_RUNS}" * whole)


def _footprint(width: int, height: int) -> list[tuple[int, int, int]]:
    """The rows of an ellipse as runs.grown takes them."""
    shape = raster.ellipse(width, height)
    return [(i - height // 2, int(width // 2 - np.flatnonzero(row)[0]), int(np.flatnonzero(row)[-1] - width // 2)) for i, row in enumerate(shape) if row.any()]


def split_pages(images: DataFrame, key: str = "origin", k: int = 51) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(statistics, red, black) of images (key, height, width, nChannels, data).

    statistics: one row per page; a row without data gives nulls.  red: the runs
    of red text.  black: the runs of ink that no red text or ornament, widened by
    an ellipse of 5 x 5, claims.
    """
    masks = stored(band_masks(bands(images, key, max(EDGE, k // 2)), key, k), "masks")
    sizes = masks.groupBy(key).agg(F.max("width").alias("width"), F.max("height").alias("height"), F.sum("coloured").alias("_c"), F.sum("cells").alias("_n"))
    marked, counts = rn.filtered(masks.select(key, F.explode("red").alias("r")).select(key, "r.*"), sizes, key)
    marked = stored(marked.where("kind <> 'small'"), "ink")
    red = marked.where("kind = 'kept'").drop("kind")
    thresholds = stored(ink_thresholds(masks, key), "thresholds")
    # A page that is given twice has each band twice; it counts once.
    left = ink_left(masks, thresholds, marked, key, whole=False).groupBy(key, "band").agg(F.max("pixels").alias("b"))
    black = rn.united(ink_left(masks, thresholds, marked, key).select(key, F.explode("runs").alias("r")).select(key, "r.*"), key)
    each = sizes.unionByName(counts.withColumnRenamed("kept_area", "r"), allowMissingColumns=True).unionByName(left.drop("band"), allowMissingColumns=True)
    s = each.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(c).alias(c) for c in each.columns if c != key]).fillna(0, ["r", "b"])
    s = s.withColumn("width", F.col("width").cast("int")).withColumn("height", F.col("height").cast("int"))
    s = s.withColumn("_cover", (F.col("r") + F.col("b")) / (F.col("width").cast("long") * F.col("height"))).withColumn("_colour", F.col("_c") / F.col("_n"))
    out = s.select(
        key,
        "width",
        "height",
        F.col("r").alias("red_ink_pixels"),
        F.col("b").alias("black_ink_pixels"),
        F.col("kept").alias("red_components_kept"),
        F.col("small").alias("red_components_dropped_small"),
        F.col("ornament").alias("red_components_dropped_ornament"),
        F.coalesce(F.expr(rounded("r / nullif(r + b, 0)", 4)), F.lit(0.0)).alias("red_ink_ratio"),
        F.expr(rounded("_cover", 5)).alias("ink_coverage"),
        F.expr(rounded("_colour", 4)).alias("colour_area"),
        (F.col("_cover") < raster.BLANK_INK).alias("is_blank"),
        (F.col("_colour") > raster.ILLUSTRATION).alias("is_illustration"),
    )
    return images.select(key).join(out.hint("merge"), key, "left"), red, black


def dark_pixels(images: DataFrame, key: str = "origin") -> DataFrame:
    """key, dark: pixels of a layer (an image) darker than half grey."""
    kind = dict(images.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            dark = [None if r.data is None else int((raster.grey_of(pixels(r.data, r.height, r.width, r.nChannels)) < 128).sum()) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame({key: pdf[key], "dark": pd.array(dark, "Int64")})

    return images.select(key, "height", "width", "nChannels", "data").mapInPandas(run, f"{key} {kind}, dark long")


def mask_runs(images: DataFrame, key: str = "page") -> DataFrame:
    """The runs of masks given as images: what is not black is set."""
    kind = dict(images.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                y, x1, x2 = raster.runs(raster.grey_of(pixels(r.data, r.height, r.width, r.nChannels)) > 0)
                yield pd.DataFrame({key: getattr(r, key), "y": y, "x1": x1, "x2": x2})

    return _known(images, key).mapInPandas(run, f"{key} {kind}, y long, x1 long, x2 long")


def red_regions(images: DataFrame, key: str = "page", least: int = rn.PHRASE_AREA) -> DataFrame:
    """key, phrase, x1, y1, x2, y2: the red phrases of every page's red mask (an image)."""
    return rn.red_phrases(mask_runs(images, key), _known(images, key).select(key, "width", "height"), least, key)
