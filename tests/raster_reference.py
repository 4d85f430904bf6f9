"""Whole pages by their definition, one process and one array per page."""

import numpy as np
from folioflow.functions.raster import BLANK_INK, ILLUSTRATION, dilate, ellipse, grey_of, red_candidates

LEAST_AREA = 28


def components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-connected parts: labels from 1 on, and one row (x1, y1, x2, y2, area) each, ends exclusive.

    Works on the runs of each row: runs of neighbouring rows that touch are tied
    by repeated minima, with pointer jumping.
    """
    height, width = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    n = len(row)
    labels = np.zeros(mask.shape, np.int32)
    if not n:
        return labels, np.zeros((0, 5), np.int64)
    # Runs of the row above that reach a run, itself widened by one on both sides, lie in one stretch.
    key, wide = row * (width + 2), width + 2
    first = np.searchsorted(key + end, (row - 1) * wide + start, "left")
    last = np.searchsorted(key + start, (row - 1) * wide + end, "right")
    many = np.maximum(last - first, 0) * (row > 0)
    a = np.repeat(np.arange(n), many)
    b = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    parent = np.arange(n)
    while True:
        low = np.minimum(parent[a], parent[b])
        new = parent.copy()
        np.minimum.at(new, parent[a], low)
        np.minimum.at(new, parent[b], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if (new == parent).all():
            break
        parent = new
    _, own = np.unique(parent, return_inverse=True)
    count = own.max() + 1
    box = np.empty((count, 5), np.int64)
    for k, (values, op, fill) in enumerate(((start, np.minimum, width), (row, np.minimum, height), (end, np.maximum, 0), (row + 1, np.maximum, 0))):
        column = np.full(count, fill)
        op.at(column, own, values)
        box[:, k] = column
    box[:, 4] = np.bincount(own, weights=end - start, minlength=count)
    size = end - start
    at = np.repeat(row * width + start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    labels.ravel()[at] = np.repeat(own + 1, size)
    return labels, box


def is_ornament(box: np.ndarray, height: int, width: int) -> np.ndarray:
    """Parts over 55 % of the width, over 10 % of the height, or lying long (12 : 1) and full (0.55); upright strokes are none."""
    w, h, area = box[:, 2] - box[:, 0], box[:, 3] - box[:, 1], box[:, 4]
    return (w > 0.55 * width) | (h > 0.10 * height) | ((w >= 12 * np.maximum(h, 1)) & (area >= 0.55 * np.maximum(w * h, 1)))


def filter_components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
    """(red text, ornaments, counts kept, small and ornament)."""
    labels, box = components(mask)
    small = box[:, 4] < LEAST_AREA
    ornament = ~small & is_ornament(box, *mask.shape)
    pick = lambda rows: np.concatenate([[False], rows])[labels]
    return pick(~small & ~ornament), pick(ornament), {"kept": int((~small & ~ornament).sum()), "small": int(small.sum()), "ornament": int(ornament.sum())}


def _box_sum(x: np.ndarray, k: int) -> np.ndarray:
    """Sum over k by k neighbours; edges are repeated."""
    p = np.pad(x, k // 2, mode="edge").astype(np.int32)
    s = np.zeros((p.shape[0] + 1, p.shape[1] + 1), np.int32)
    s[1:, 1:] = p.cumsum(0).cumsum(1)
    return s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k]


def median_blur(grey: np.ndarray, k: int = 51) -> np.ndarray:
    """Exact median of k by k neighbours: the first of the levels present whose count passes half."""
    out, half = np.full(grey.shape, 255, np.uint8), k * k // 2
    open_ = np.ones(grey.shape, bool)
    for v in np.unique(grey):
        now = open_ & (_box_sum(grey <= v, k) > half)
        out[now] = v
        open_ &= ~now
        if not open_.any():
            break
    return out


def otsu(grey: np.ndarray) -> int:
    """The threshold that parts the histogram with the largest variance between both sides."""
    p = np.bincount(grey.ravel(), minlength=256) / grey.size
    below, mean = np.cumsum(p), np.cumsum(p * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mean[-1] * below - mean) ** 2 / (below * (1 - below))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def ink_mask(bgr: np.ndarray, k: int = 51) -> np.ndarray:
    """Dark pixels once the background, a wide median, is divided out. An even page has no ink."""
    grey = grey_of(bgr)
    flat = np.minimum(np.rint(grey * 255.0 / np.maximum(median_blur(grey, k), 1)), 255).astype(np.uint8)
    return flat <= otsu(flat) if flat.min() < flat.max() else np.zeros(flat.shape, bool)


def colour_area(bgr: np.ndarray, step: int = 6) -> float:
    """Share of strongly coloured cells when the page is scaled down by averaging."""
    h, w = (max(n // step, 1) for n in bgr.shape[:2])
    small = bgr[: h * step, : w * step]
    if small.shape[:2] == (h * step, w * step):
        small = small.reshape(h, step, w, step, 3).mean((1, 3))
    small = small.astype(np.float64)
    v = small.max(-1)
    s = np.where(v > 0, (v - small.min(-1)) / np.where(v > 0, v, 1), 0)
    return float(((s > 0.35) & (v / 255 > 0.35)).mean())


def split_page(bgr: np.ndarray, k: int = 51) -> tuple[dict, np.ndarray, np.ndarray]:
    """(statistics, red text mask, black text mask): black is ink that no red, widened by a 5 x 5 ellipse, claims."""
    red, ornaments, counts = filter_components(red_candidates(bgr))
    black = ink_mask(bgr, k) & ~dilate(red | ornaments, ellipse(5, 5))
    area, reds, blacks, colour = red.size, int(red.sum()), int(black.sum()), colour_area(bgr)
    cover = (reds + blacks) / area
    stats = {
        "width": bgr.shape[1], "height": bgr.shape[0], "red_ink_pixels": reds, "black_ink_pixels": blacks,
        "red_components_kept": counts["kept"], "red_components_dropped_small": counts["small"], "red_components_dropped_ornament": counts["ornament"],
        "red_ink_ratio": round(reds / (reds + blacks), 4) if reds + blacks else 0.0, "ink_coverage": round(cover, 5), "colour_area": round(colour, 4),
        "is_blank": cover < BLANK_INK, "is_illustration": colour > ILLUSTRATION,
    }
    return stats, red, black


def redness(red: np.ndarray, ink: np.ndarray, box: tuple[int, int, int, int]) -> float:
    """Red pixels of a box over its ink pixels; 0 for an empty box or one without ink."""
    x1, y1, x2, y2 = box
    part = np.s_[max(y1, 0) : max(y2, 0), max(x1, 0) : max(x2, 0)]
    total = int(ink[part].sum())
    return float(red[part].sum() / total) if total else 0.0


def red_boxes(red: np.ndarray, least: int = 1500) -> np.ndarray:
    """Boxes of red phrases: parts of more than `least` pixels once widened by 45 x 15."""
    _, box = components(dilate(dilate(red, np.ones((15, 1), bool)), np.ones((1, 45), bool)))
    return box[box[:, 4] > least, :4]
