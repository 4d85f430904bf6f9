"""Lines of words and their hints, and the geometry between scan and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is red from this share of red ink on; a title is centred, narrow, all red and short (fixed values).
RED_WORD, CENTRED, NARROW, SHORT = 0.5, 0.06, 0.75, 6
#: Model sides are multiples of STEP, its area between LEAST_AREA and the limit; longer shapes than ASPECT are refused (fixed values).
STEP, LEAST_AREA, MOST_AREA, ASPECT = 28, 3136, 11_289_600, 200


def red_word(layer: Column, redness: Column) -> Column:
    """Words of the red layer are red; others are from half their ink on."""
    return F.coalesce(layer == "red", F.lit(False)) | F.coalesce(redness >= RED_WORD, F.lit(False))


def looks_like_title(x1: Column, x2: Column, width: Column, red: Column, words: Column) -> Column:
    off = F.abs((x1 + x2) / 2.0 - width / 2.0) / width
    return (off <= CENTRED) & ((x2 - x1) / width.cast("double") <= NARROW) & (red == words) & (words <= SHORT)


def ornament(w: Column, h: Column, area: Column, page_w: Column, page_h: Column) -> Column:
    """A part of red ink that is a rule or border, not a glyph: over 55 % of the page's width, over 10 % of its height, or lying long (12 : 1) and full (0.55)."""
    # As a quotient, 11 of 20 pixels are 0.55; as a product, 0.55 * 200 is more than 110.
    long_ = (w >= 12 * F.greatest(F.lit(1), h)) & (area / F.greatest(F.lit(1), w * h) >= 0.55)
    return (w > 0.55 * page_w) | (h > 0.10 * page_h) | long_


def line_table(words: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """page, line, x1, y1, x2, y2, words, red_words, all_red, looks_like_title of words (page, line, box, is_red); pages: page, width."""
    g = words.groupBy(page, "line").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count("*").alias("words"), F.count_if("is_red").alias("red_words"))
    g = g.join(pages.select(page, F.col("width").alias("_w")), page).withColumn("all_red", F.col("red_words") == F.col("words"))
    return g.withColumn("looks_like_title", looks_like_title(F.col("x1"), F.col("x2"), F.col("_w"), F.col("red_words"), F.col("words"))).drop("_w")


def layout_totals(lines: DataFrame, page: str = "page") -> DataFrame:
    """page, line_count, word_count, red_word_count of a table of lines."""
    return lines.groupBy(page).agg(F.count("*").alias("line_count"), F.sum("words").alias("word_count"), F.sum("red_words").alias("red_word_count"))


def red_percent(totals: DataFrame) -> DataFrame:
    """One row: words, red, percent of all layouts (0 without words)."""
    t = totals.agg(F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"), F.coalesce(F.sum("red_word_count"), F.lit(0)).alias("red"))
    return t.withColumn("percent", F.col("red") * 100.0 / F.greatest(F.lit(1), F.col("words")))


def model_dimensions(width: Column, height: Column, most: int = MOST_AREA) -> Column:
    """struct(error, w, h): the size at which an image is sent, so that both sides agree on coordinates.

    Sides go to the nearest multiple of STEP (half to even); too large an area
    shrinks both by one factor and rounds down, too small a one grows and rounds up.
    """
    short, long_ = F.least(width, height), F.greatest(width, height)
    bad = F.when((short <= 0) | (long_ / F.nullif(short, F.lit(0)) > ASPECT), "unsupported image dimensions").when(F.lit(most < LEAST_AREA), f"max_pixels must be at least {LEAST_AREA}")
    area = width.cast("double") * height
    fit = lambda x: F.greatest(F.lit(STEP), F.bround(x / float(STEP)) * STEP)
    down = lambda x: F.greatest(F.lit(STEP), F.floor(x * F.sqrt(F.lit(float(most)) / area) / STEP) * STEP)
    up = lambda x: F.ceil(x * F.sqrt(F.lit(float(LEAST_AREA)) / area) / STEP) * STEP
    large = fit(width) * fit(height) > most
    w, h = (F.when(large, down(x)).otherwise(fit(x)) for x in (width, height))
    small = w * h < LEAST_AREA
    pick = lambda x, own: F.when(bad.isNull(), F.when(small, up(x)).otherwise(own)).cast("long")
    return F.struct(bad.alias("error"), pick(width, w).alias("w"), pick(height, h).alias("h"))


def rescaled(x: Column, original: Column, sent: Column) -> Column:
    """A coordinate of the image that was sent, on the scan."""
    return x * original / sent


def resize_bounds(width: Column, height: Column, edge: int) -> Column:
    """struct(w, h) with the long side at `edge` at most; images are never enlarged; half to even."""
    scale = F.lit(float(edge)) / F.greatest(width, height)
    side = lambda x: F.when(scale < 1.0, F.bround(x * scale)).otherwise(x).cast("long")
    return F.struct(side(width).alias("w"), side(height).alias("h"))


def context_fits(pixels: Column, completion: Column, length: Column, room: int = 512) -> Column:
    """Whether an image of so many pixels, the prompt's room and the completion fit a model's context."""
    return F.floor(pixels / (STEP * STEP)) + room + completion <= length
