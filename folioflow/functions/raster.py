"""Kernels over stretches of page rasters: red ink, background, colour area, runs.

Rasters are (height, width, 3) arrays of blue, green and red bytes, as Spark's
image source gives them; masks are boolean arrays.
"""

from __future__ import annotations

import numpy as np

#: Thresholds of the colour masks (fixed values).
HUE_LOW, HUE_HIGH, LEAST_S, LEAST_V, LEAST_LEAD = 12, 168, 90, 70, 28
#: Blank and illustration limits of a page (fixed values).
BLANK_INK, ILLUSTRATION = 0.01, 0.15


def hsv(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hue 0-179, saturation and value 0-255, rounded as image libraries do for bytes."""
    b, g, r = (bgr[..., i].astype(np.float32) for i in range(3))
    v = np.maximum(np.maximum(b, g), r)
    span = v - np.minimum(np.minimum(b, g), r)
    safe = np.where(span > 0, span, 1)
    hue = np.where(v == r, (g - b) / safe, np.where(v == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) * 30
    hue = np.where(span > 0, np.where(hue < 0, hue + 180, hue), 0)
    s = np.where(v > 0, span * 255 / np.where(v > 0, v, 1), 0)
    return np.rint(hue).astype(np.int16) % 180, np.rint(s).astype(np.int16), v.astype(np.int16)


def ellipse(width: int, height: int) -> np.ndarray:
    """The elliptic footprint of that size."""
    ry, rx = height // 2, width // 2
    out = np.zeros((height, width), bool)
    for i in range(height):
        dy = i - ry
        if abs(dy) <= ry:
            dx = round(rx * np.sqrt((ry * ry - dy * dy) / (ry * ry))) if ry else rx
            out[i, max(rx - dx, 0) : min(rx + dx + 1, width)] = True
    return out


def dilate(mask: np.ndarray, foot: np.ndarray) -> np.ndarray:
    h, w = foot.shape
    padded = np.pad(mask, ((h // 2, h - 1 - h // 2), (w // 2, w - 1 - w // 2)))
    out = np.zeros_like(mask)
    for i, j in np.argwhere(foot):
        out |= padded[i : i + mask.shape[0], j : j + mask.shape[1]]
    return out


def erode(mask: np.ndarray, foot: np.ndarray) -> np.ndarray:
    return ~dilate(~mask, foot[::-1, ::-1])


def red_candidates(bgr: np.ndarray, outside: np.ndarray | None = None) -> np.ndarray:
    """Saturated red pixels that lead both other channels, closed and opened once; outside: rows that lie off the page."""
    h, s, v = hsv(bgr)
    lead = bgr[..., 2].astype(np.int16) - np.maximum(bgr[..., 0], bgr[..., 1])
    mask = ((h <= HUE_LOW) | (h >= HUE_HIGH)) & (s >= LEAST_S) & (v >= LEAST_V) & (lead >= LEAST_LEAD)
    foot = ellipse(3, 3)
    for step in (dilate, erode, erode, dilate):
        if outside is not None:
            mask[outside] = step is erode
        mask = step(mask, foot)
    return mask


def grey_of(bgr: np.ndarray) -> np.ndarray:
    return np.rint(bgr @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def _sums(x: np.ndarray, k: int, step: int) -> np.ndarray:
    """Sums of k values that lie `step` apart, by sums of 1, 2, 4, ... of them."""
    n, at, wide, out = len(x) - (k - 1) * step, 0, 1, None
    while True:
        if k & wide:
            part = x[at * step : at * step + n]
            out, at = part if out is None else out + part, at + wide
        if 2 * wide > k:
            return out
        x = x[: len(x) - wide * step] + x[wide * step :]
        wide *= 2


def inner_median(grey: np.ndarray, k: int) -> np.ndarray:
    """Exact median of the k by k neighbours of all pixels that have them.

    A pixel's median is the first of the levels at hand that more than half of its
    neighbours do not exceed.  Levels below or above all medians are left out by
    bisection.  Rows are laid end to end, so sums run over one long line.
    """
    high, wide = grey.shape
    levels, line, half = np.unique(grey), np.ascontiguousarray(grey).ravel(), k * k // 2
    kind = np.uint8 if k * k < 1 << 8 else np.uint16 if k * k < 1 << 16 else np.int64

    def few(i):
        """Where no more than half of the neighbours lie at or below level i."""
        return _sums(_sums((line <= levels[i]).view(np.uint8).astype(kind, copy=False), k, wide), k, 1) <= half

    def first(test):
        lo, hi = 0, len(levels) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if test(few(mid)) else (mid + 1, hi)
        return lo

    low, top = first(lambda x: not x.all()), first(lambda x: not x.any())
    rank = np.full((high - k + 1) * wide, low, np.uint8)
    for i in range(low, top):
        rank[: len(rank) - k + 1] += few(i)
    return levels[rank.reshape(-1, wide)[:, : wide - k + 1]]


def median_blur(grey: np.ndarray, k: int = 51) -> np.ndarray:
    """Exact median of k by k neighbours; edges are repeated."""
    return inner_median(np.pad(grey, k // 2, mode="edge"), k)


def evened(grey: np.ndarray, background: np.ndarray) -> np.ndarray:
    """Grey levels with the background, a wide median, divided out."""
    return np.minimum(np.rint(grey * 255.0 / np.maximum(background, 1)), 255).astype(np.uint8)


def otsu(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(threshold, whether there is one) of each histogram: what parts it with the largest variance between both sides, the lowest of equals; none for an even one."""
    p = levels / np.maximum(levels.sum(1, keepdims=True), 1)
    below, mean = p.cumsum(1), (p * np.arange(256)).cumsum(1)
    gap, part = mean[:, -1:] * below - mean, (below > 0) & (below < 1)
    spread = np.where(part, gap * gap / np.where(part, below * (1 - below), 1), -1.0)
    return spread.argmax(1), (levels > 0).sum(1) > 1


def coloured_cells(bgr: np.ndarray, step: int = 6) -> tuple[int, int]:
    """(strongly coloured cells, all cells) when the page is scaled down by averaging; a page narrower than a cell is taken pixel by pixel."""
    h, w = (max(n // step, 1) for n in bgr.shape[:2])
    small = bgr[: h * step, : w * step]
    found = coloured(cell_means(small, step) if small.shape[:2] == (h * step, w * step) else small)
    return int(found.sum()), found.size


def cell_means(bgr: np.ndarray, step: int = 6) -> np.ndarray:
    """The means of whole cells."""
    h, w = (n // step for n in bgr.shape[:2])
    rows = bgr.reshape(h, step, w * step * 3).sum(1, dtype=np.uint32)
    return rows.reshape(h, w, step, 3).sum(2) / (step * step)


def coloured(small: np.ndarray) -> np.ndarray:
    """Which cells are strongly coloured."""
    small = small.astype(np.float64)
    v = small.max(-1)
    s = np.where(v > 0, (v - small.min(-1)) / np.where(v > 0, v, 1), 0)
    return (s > 0.35) & (v / 255 > 0.35)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(y, x1, x2) of every stretch of set pixels, ends exclusive."""
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    y, start = np.nonzero(edge == 1)
    return y, start, np.nonzero(edge == -1)[1]
