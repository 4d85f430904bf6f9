"""Kernels over bands of masks: boxes of whole (page, band) groups to runs, their 8-connected pieces, and what they cover.

A band is BAND rows of a page.  Groups come sorted, many at a time; a run's place
is one integer, its row among all rows at hand above its column, so one sort and
one search serve all groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows of a band; boxes and rows of masks that are taken at a time.
BAND, BOXES, ROWS = 128, 1 << 15, 1 << 19
#: Columns lie within -SIDE and SIDE.
SHIFT, SIDE = 33, 1 << 32


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values, nulls too, as equal integers."""
    return column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _begins(t: pa.Table) -> np.ndarray:
    """Where groups begin in sorted rows whose first columns are page and band."""
    page, band = _codes(t.column(0)), t.column(1).to_numpy()
    return np.concatenate([[0], np.flatnonzero((page[1:] != page[:-1]) | (band[1:] != band[:-1])) + 1])


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of about ROWS rows of masks, and where groups begin; one group is one table at the least."""

    def cut(t, begins):
        high = np.maximum(t.column("y2").to_numpy() - t.column("y1").to_numpy(), 0)
        before = np.concatenate([[0], np.cumsum(high)])[begins]
        i = 0
        while i < len(begins):
            j = max(i + 1, int(np.searchsorted(before, before[i] + ROWS)))
            end = begins[j] if j < len(begins) else len(t)
            yield t.slice(begins[i], end - begins[i]), begins[i:j] - begins[i]
            i = j

    held, n, least = [], 0, BOXES
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            t = pa.Table.from_batches(held)
            begins = _begins(t)
            if begins[-1]:
                yield from cut(t.slice(0, begins[-1]), begins[:-1])
                t = t.slice(begins[-1]).combine_chunks()
            held, n = t.to_batches(), len(t)
            least = max(BOXES, 2 * n)
    if n:
        t = pa.Table.from_batches(held)
        yield from cut(t, _begins(t))


def spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, first[i] + 0 ... first[i] + count[i] - 1) for every i, one after the other."""
    i = np.repeat(np.arange(len(count)), count)
    return i, first[i] + np.arange(len(i)) - (np.cumsum(count) - count)[i]


def places(t: pa.Table, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """x1, x2, first row among all rows at hand, and height within the band, of each box; group of each; rows from page to hand."""
    group = np.zeros(len(t), np.int64)
    group[begins[1:]] = 1
    group = np.cumsum(group)
    x1, y1, x2, y2 = (t.column(c).to_numpy().astype(np.int64) for c in ("x1", "y1", "x2", "y2"))
    top = t.column("band").to_numpy().astype(np.int64) * BAND
    low = np.maximum(y1, top)
    high = np.maximum(np.minimum(y2, top + BAND) - low, 0)
    return x1, x2, group * BAND + low - top, np.where(x1 < x2, high, 0), group, top[begins] - np.arange(len(begins)) * BAND


def united(x1, x2, row, high) -> tuple[np.ndarray, np.ndarray]:
    """Both ends of the runs of boxes, as places, in order; those that overlap or touch are one."""
    i, r = spread(row, high)
    start, end = (r << SHIFT) + x1[i] + SIDE, (r << SHIFT) + x2[i] + SIDE
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at[1:], len(start)) - 1] if len(at) else reach


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component."""
    f = np.arange(n)
    while len(u):
        hi, lo = np.maximum(u, v), np.minimum(u, v)
        order = np.argsort(lo, kind="stable")[::-1]
        f[hi[order]] = lo[order]  # of several, the smallest is written last
        while (g := f[f]).tobytes() != f.tobytes():
            f = g
        u, v = f[u], f[v]
        u, v = u[u != v], v[u != v]
    return f


def joined(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first run of each run's piece: runs of neighbouring rows of a band that touch, also by a corner only."""
    on = np.flatnonzero((start >> SHIFT) % BAND < BAND - 1)
    lo = np.searchsorted(end, start[on] + (1 << SHIFT), "left")
    hi = np.searchsorted(start, end[on] + (1 << SHIFT), "right")
    i, v = spread(lo, np.maximum(hi - lo, 0))
    return roots(len(start), on[i], v)


def before(start: np.ndarray, end: np.ndarray, sums: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many set pixels lie before a place; sums: those of the runs before each."""
    if not len(start):
        return np.zeros(len(place), np.int64)
    i = np.searchsorted(start, place, "right")
    last = np.maximum(i - 1, 0)
    return sums[i] - np.where(i > 0, np.maximum(end[last] - place, 0), 0)


def covered(boxes: tuple, words: tuple) -> np.ndarray:
    """Set pixels of the mask of boxes under each word; both as (x1, x2, row, high)."""
    start, end = united(*boxes)
    sums = np.concatenate([[0], np.cumsum(end - start)])
    x1, x2, row, high = words
    i, r = spread(row, high)
    at = (r << SHIFT) + SIDE
    n = before(start, end, sums, at + x2[i]) - before(start, end, sums, at + x1[i])
    return np.bincount(i, n, len(x1)).astype(np.int64)
