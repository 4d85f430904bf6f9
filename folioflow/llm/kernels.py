"""Vectorised text kernels shared by the operators of this subpackage.

Everything here is NumPy over the UTF-8 buffers of Arrow string columns: no
per-word Python but for words of over LONG bytes.  Hashes are 64 bits wide: two
given words or shingles that differ have one hash with a probability near 2**-64,
whatever their bytes.  Where one collision alone would change a result, a second
hash of another seed is compared too.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled by one NumPy pass; a longer text is a pass of its own.
CHUNK_BYTES = 1 << 20


def release() -> None:
    """Gives memory that this process freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(run):
    """Wraps a function for mapInArrow: what it freed goes back to the system when its task ends.

    Python workers are kept for later tasks, and their allocators would keep a
    task's largest arrays, a few hundred MB in each, beside the executor's heap.
    """

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


#: Multipliers of the running combinations below; odd, so that no bit is lost.
STEP = U64(0xD6E8FEB86659FD93)
CHAIN = U64(0x9E3779B97F4A7C15)
#: Words of up to so many bytes are hashed eight bytes at a time, longer ones by BLAKE2b.
LONG = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(33)
        x = x * U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(33)
    return x


class Alphabet:
    """Which bytes make words, and what each byte is once A-Z is lower-cased."""

    def __init__(self, is_word: np.ndarray):
        self.is_word = is_word
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32


_ascii_space = np.zeros(256, bool)
_ascii_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Words of `[^\x20\x09-\x0D]+`.
SPACED = Alphabet(~_ascii_space)
_alnum = np.zeros(256, bool)
_alnum[0x30:0x3A] = True
_alnum[0x41:0x5B] = True
_alnum[0x61:0x7B] = True
_alnum[0x80:] = True
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM = Alphabet(_alnum)


def spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of every span of bytes raw[starts:ends]; hashes of two seeds are independent.

    Eight bytes at a time go through mix64, a bijection, so no pattern inside a
    span cancels out as it would in a polynomial modulo 2**64.
    """
    size = ends - starts
    with np.errstate(over="ignore"):
        start = mix64(np.array([seed + 1], U64) * CHAIN)[0]
        eight = np.zeros((len(raw) >> 3) + 3, U64)
        eight.view(np.uint8)[: len(raw)] = raw
        out = np.full(len(starts), start, U64)
        at, left, rows = starts, size, slice(None)
        for _ in range(LONG // 8):
            low, shift = at >> 3, ((at & 7) << 3).astype(U64)
            part = (eight[low] >> shift) | ((eight[low + 1] << U64(1)) << (U64(63) - shift))
            part &= ~U64(0) >> ((8 - np.minimum(left, 8)) << 3).astype(U64)
            out[rows] = mix64(out[rows] * CHAIN + part)
            more = left > 8
            if not more.any():
                break
            rows = np.flatnonzero(more) if isinstance(rows, slice) else rows[more]
            at, left = at[more] + 8, left[more] - 8
        out = mix64(out ^ (size.astype(U64) * STEP + start))
    view = memoryview(np.ascontiguousarray(raw))
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(view[starts[i] : ends[i]], digest_size=8, key=b"%d" % seed).digest(), "little")
    return out


def words(data: np.ndarray, doc_starts: np.ndarray, alphabet: Alphabet, seed: int = 0):
    """Start and end byte and hash of every word of a buffer; words never cross doc_starts."""
    n = len(data)
    if n == 0:
        e = np.empty(0, np.int64)
        return e, e, np.empty(0, U64)
    mark = alphabet.is_word[data]
    first = np.empty(n, bool)
    first[0] = mark[0]
    np.logical_and(mark[1:], ~mark[:-1], out=first[1:])
    last = np.empty(n, bool)
    last[-1] = mark[-1]
    np.logical_and(mark[:-1], ~mark[1:], out=last[:-1])
    cut = doc_starts[(doc_starts > 0) & (doc_starts < n)]
    first[cut] = mark[cut]
    last[cut - 1] = mark[cut - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, spans(alphabet.fold[data], starts, ends, seed)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """(first, last) row ranges of about `size` bytes; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def doc_of(starts: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Row number of every word start; doc_starts are the rows' first bytes, empty rows included."""
    return np.searchsorted(doc_starts, starts, "right") - 1


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive items."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for j in range(1, k):
            out *= STEP
            out += hashes[j : j + n]
        return mix64(out)


def sliding(op, x: np.ndarray, w: int) -> np.ndarray:
    """op (np.minimum, np.maximum) over every window of w items, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    have = 1
    while have * 2 <= w:
        x = op(x[: len(x) - have], x[have:])
        have *= 2
    if have < w:
        x = op(x[: len(x) - (w - have)], x[w - have :])
    return x
