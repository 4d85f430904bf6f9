"""Batch encoding with a tokenizers-library vocabulary of the lower-casing word-end BPE kind.

The library's model encodes each distinct pre-token once per worker and cache
period; cutting texts into pre-tokens and looking them up is NumPy.  Texts with
characters outside Latin blocks, control characters or special-token openers, and
vocabularies of another kind, go through the library's full encode instead, so
the ids are the library's ids either way.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from .kernels import U64, spans

#: The pre-token pattern the quick way implements (a fixed value of the vocabulary file).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LIMIT = 0x250
#: Among them characters below LIMIT whose lower case is longer or lies beyond it.
ODD = re.compile("[^\t-\r -~\x85\xa0-ɏ]|[" + "".join(c for c in map(chr, range(LIMIT)) if len(c.lower()) != 1 or ord(c.lower()) >= LIMIT) + "]|<\\|")
SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte: itself if printable Latin-1, else the next free character from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return out


def _classes() -> np.ndarray:
    out = np.full(LIMIT, OTHER, np.uint8)
    for c in range(LIMIT):
        kind = unicodedata.category(chr(c))[0]
        out[c] = LETTER if kind == "L" else DIGIT if kind == "N" else OTHER
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
    return out


class Encoder:
    SLOTS, POOL = 1 << 22, 1 << 24

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        norm = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.quick = (
            norm == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in pre] == ["Split", "ByteLevel"]
            and pre[0]["pattern"] == {"Regex": PATTERN}
            and not pre[1]["add_prefix_space"]
            and spec["post_processor"] is None
            and all(x["content"].startswith("<|") for x in spec["added_tokens"])
        )
        self.model = self.full.model
        self.chars = _byte_chars()
        self.kind = _classes()
        self.odd = np.array([bool(ODD.match(chr(c))) for c in range(LIMIT)])
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, U64)
        self.checks = np.zeros(self.SLOTS, U64)
        self.at = np.zeros(self.SLOTS, np.int32)
        self.size = np.zeros(self.SLOTS, np.int32)
        self.pool = np.empty(1 << 16, np.uint32)
        self.used = 0

    def _unit(self, unit: str) -> list[int]:
        if not unit.isascii():
            unit = "".join(map(self.chars.__getitem__, unit.encode()))
        return [t.id for t in self.model.tokenize(unit)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids per text, all ids): as encode_batch(texts, add_special_tokens=False)."""
        odd = list(range(len(texts)))
        if self.quick:
            every = "\n".join(texts)
            code = np.frombuffer(every.encode("utf-16-le", "surrogatepass"), np.uint16)
            plain = not len(code) or (code.max() < LIMIT and not self.odd[code].any() and "<|" not in every)
            odd = [] if plain else [i for i, t in enumerate(texts) if ODD.search(t)]
        if not odd:
            return self._encode(texts)
        slow = [np.array(self.full.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in odd]
        skip = set(odd)
        count, ids = self._encode(["" if i in skip else t for i, t in enumerate(texts)])
        pieces = np.split(ids, np.cumsum(count)[:-1])
        for i, s in zip(odd, slow, strict=True):
            pieces[i], count[i] = s, len(s)
        return count, np.concatenate(pieces).astype(np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\n".join(texts).lower()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        code = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
        n = len(code)
        if n == 0:
            return np.zeros(len(texts), np.int64), np.empty(0, np.uint32)
        kind = self.kind[code]
        first = np.empty(n, bool)
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        first |= kind == DIGIT
        first &= kind != SPACE
        if "'" in joined:
            at = np.flatnonzero((code == 39) & first)
            pad = np.concatenate([code, np.zeros(3, np.uint16)])
            a, b = pad[at + 1], pad[at + 2]
            one = np.isin(a, np.array([ord(x) for x in "stmd"], np.uint16))
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            for hit, length in ((at[one], 2), (at[two], 3)):
                first[hit + 1] = False
                nxt = hit[hit + length < n] + length
                first[nxt] = kind[nxt] != SPACE
        last = np.empty(n, bool)
        last[-1] = kind[-1] != SPACE
        last[:-1] = (kind[:-1] != SPACE) & (first[1:] | (kind[1:] == SPACE))
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        # A pre-token is known by 128 bits: two hashes of other seeds.
        raw = code.view(np.uint8)
        h, check = (spans(raw, 2 * starts, 2 * stops, seed) for seed in (0, 1))
        slot = (h & U64(self.SLOTS - 1)).astype(np.int64)
        where, size = self.at[slot], self.size[slot]
        miss = np.flatnonzero((self.keys[slot] != h) | (self.checks[slot] != check))
        if len(miss):
            pair = np.empty(len(miss), [("h", U64), ("check", U64)])
            pair["h"], pair["check"] = h[miss], check[miss]
            order = np.argsort(pair["h"], kind="stable")
            if (same := pair["h"][order[1:]] == pair["h"][order[:-1]]).any() and (same & (pair["check"][order[1:]] != pair["check"][order[:-1]])).any():
                order = np.argsort(pair, order=["h", "check"], kind="stable")
            fresh = np.ones(len(miss), bool)
            fresh[1:] = pair[order[1:]] != pair[order[:-1]]
            pick, back = order[fresh], np.empty(len(miss), np.int64)
            back[order] = np.cumsum(fresh) - 1
            new = pair[pick]
            at, sizes, pieces, used = np.empty(len(new), np.int32), np.empty(len(new), np.int32), [], self.used
            for j, m in enumerate(miss[pick].tolist()):
                ids = self._unit(joined[starts[m] : stops[m]])
                at[j], sizes[j] = used, len(ids)
                used += len(ids)
                pieces += ids
            if used > len(self.pool):
                grown = np.empty(max(used, 2 * len(self.pool)), np.uint32)
                grown[: self.used] = self.pool[: self.used]
                self.pool = grown
            self.pool[self.used : used] = pieces
            self.used = used
            where[miss], size[miss] = at[back], sizes[back]
            spot = (new["h"] & U64(self.SLOTS - 1)).astype(np.int64)
            # Of new pre-tokens that share a slot, the last one stays, in all four tables.
            spot, last = np.unique(spot[::-1], return_index=True)
            last = len(new) - 1 - last
            self.keys[spot], self.checks[spot], self.at[spot], self.size[spot] = new["h"][last], new["check"][last], at[last], sizes[last]
        total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        step = np.arange(total[-1]) - np.repeat(total[:-1], size)
        ids = self.pool[np.repeat(where, size) + step]
        cut = total[np.searchsorted(starts, ends)]
        if self.used > self.POOL:
            self.clear()
        return np.diff(np.concatenate([[0], cut])), ids


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
