"""Encoding of whole texts by a public byte-level BPE tokenizer, a distinct piece at a time.

The tokenizer first splits a text into pieces by a fixed pattern and merges bytes within pieces only, so
equal pieces have equal ids wherever they stand. Pieces are found with array operations on code points,
hashed, and looked up; only pieces that a worker hasn't met go through the tokenizers library's model. Texts that
the array form of the pattern doesn't cover (rare planes, unassigned characters, special tokens' strings)
go through the library whole.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from itertools import chain

import numpy as np

from .common import _BYTE_VALUES, slice_hashes

#: Pieces that a worker remembers; it starts anew beyond. Bits of their table's places, twice as many.
REMEMBERED, TABLE_BITS = 1 << 19, 20

#: White space of the pattern, and endings that follow an apostrophe.
_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SHORT_ENDS, _LONG_ENDS = "stmd", ("re", "ve", "ll")

LETTER, NUMBER, SPACE, OTHER, RARE = range(5)
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """Kind of each code point of the first plane, and one entry for all others."""
    if not _KINDS:
        table = np.full((1 << 16) + 1, RARE, np.uint8)
        for c in range(1 << 16):
            category = unicodedata.category(chr(c))
            table[c] = LETTER if category[0] == "L" else NUMBER if category[0] == "N" else RARE if category in ("Cn", "Cs") else OTHER
        table[_SPACE] = SPACE
        _KINDS.append(table)
    return _KINDS[0]


def pieces(codes: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first code point of each piece, kinds of all code points) of texts that begin at where (one more at the end)."""
    n = len(codes)
    kind = _kinds()[np.minimum(codes, 1 << 16)]
    edge = np.zeros(n + 1, bool)
    edge[where] = True
    new = edge[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # The last white space before something else stands alone, or with what follows if it is a plain space.
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:-1])
    new[last] = True
    joined = last[codes[last] == 32] + 1
    new[joined] = False
    # An apostrophe that begins a piece takes a short ending with it.
    quote = np.flatnonzero((codes == 39) & new)
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        closed = np.concatenate([edge, np.ones(3, bool)])  # a text ends before this place
        one, two = padded[quote + 1], padded[quote + 2]
        fits = ~closed[quote + 1]
        short = fits & np.isin(one, [ord(c) for c in _SHORT_ENDS])
        long = fits & ~closed[quote + 2] & np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in _LONG_ENDS])
        for some, width in ((quote[short], 2), (quote[long & ~short], 3)):
            for k in range(1, width):
                new[some + k] = False
            after = some + width
            after = after[after < n]
            # What comes next begins a piece, but for a letter's own run it would not be seen as one.
            letters = after[(kind[after] == LETTER) & ~edge[after]]
            new[letters] = True
    return np.flatnonzero(new), kind


class Table:
    """Numbers of 64-bit hashes, by open addressing: lookups of many hashes at once, in arrays of a fixed size."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where there is none; no hash is 0."""
        out, todo = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        at = (hashes >> self.shift).astype(np.int64)
        while len(todo):
            held = self.keys[at]
            hit = held == hashes
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (held != 0)
            todo, hashes, at = todo[on], hashes[on], (at[on] + 1) & self.mask
        return out

    def add(self, hashes: np.ndarray, first: int) -> None:
        """New different hashes, numbered from first on."""
        values, at = np.arange(first, first + len(hashes), dtype=np.int32), (hashes >> self.shift).astype(np.int64)
        while len(hashes):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]  # of several that meet in a place one is left
            won = self.keys[at] == hashes
            self.values[at[won]] = values[won]
            values, hashes, at = values[~won], hashes[~won], (at[~won] + 1) & self.mask


def splits_by_bytes(settings: dict) -> bool:
    """Whether a tokenizer file splits as pieces() does and then merges each piece alone: byte-level BPE with the usual pattern."""
    split, model = settings.get("pre_tokenizer") or {}, settings["model"]
    usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    other = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    return bool(usual and settings.get("normalizer") is None and model.get("type") == "BPE" and not any(model.get(o) for o in other))


class Encoder:
    """Ids of texts; one for each worker, as it remembers pieces.

    Files that split or merge in another way than the byte-level ones are read by the library alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.own_split = splits_by_bytes(json.loads(self.tokenizer.to_str()))
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.table, self.known = Table(TABLE_BITS), 0
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.width = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        merge = self.tokenizer.model.tokenize  # the pieces are split already, and mapped to the vocabulary's characters
        found = [[t.id for t in merge(x)] for x in texts]
        widths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(widths.sum()))
        n = self.known
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + len(found) > len(self.first):
            self.first, self.width = np.concatenate([self.first, np.zeros_like(self.first)]), np.concatenate([self.width, np.zeros_like(self.width)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.first[n : n + len(found)] = self.used + np.cumsum(widths) - widths
        self.width[n : n + len(found)] = widths
        self.used += len(flat)
        self.table.add(hashes, n)
        self.known += len(found)

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a chunk, bounds of each text's ids)."""
        n, data = len(offs) - 1, raw.tobytes()
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        if not self.own_split:
            return self._whole([data[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)])
        heads = np.flatnonzero((raw & 0xC0) != 0x80)
        codes = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        if len(codes) != len(heads):
            return self._whole([data[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)])
        where = np.searchsorted(heads, offs)
        begin, kind = pieces(codes, where)
        whole = np.zeros(n, bool)
        rare = np.flatnonzero(kind == RARE)
        if len(rare):
            whole[np.searchsorted(where, rare, "right") - 1] = True
        for mark in self.special:
            at = data.find(mark)
            while at >= 0:
                whole[np.searchsorted(offs, at, "right") - 1] = True
                at = data.find(mark, at + 1)
        a = heads[begin]
        b = np.append(a[1:], len(raw))
        hashes = slice_hashes(_BYTE_VALUES[raw], a, b) | np.uint64(1)
        index = self.table.find(hashes)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            new, sample, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            if self.known + len(new) > REMEMBERED and self.known:
                self.forget()
                missing = np.arange(len(hashes))
                new, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            at = missing[sample]
            mapped = _BYTE_CHARS[raw].tobytes().decode("utf-16-le")  # one character for each byte
            first = self.known
            self._learn(new, [mapped[x:y] for x, y in zip(a[at].tolist(), b[at].tolist(), strict=True)])
            index[missing] = first + inverse
        width = self.width[index]
        ends = np.cumsum(width)
        total = int(ends[-1])
        ids = self.pool[np.repeat(self.first[index] - (ends - width), width) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.searchsorted(begin, where)]
        if whole.any():
            return self._patched(ids, bounds, np.flatnonzero(whole), data, offs)
        return ids, bounds

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found), np.concatenate([[0], np.cumsum([len(f) for f in found])])

    def _patched(self, ids, bounds, rows, data, offs):
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for k in rows:
            parts[k] = np.array(self.tokenizer.encode(data[offs[k] : offs[k + 1]].decode("utf-8"), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _byte_chars() -> np.ndarray:
    """The character that byte-level vocabularies write for each byte: itself if it can be seen, else the next from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, rest = np.zeros(256, np.uint16), 256
    for b in range(256):
        out[b], rest = (b, rest) if b in seen else (rest, rest + 1)
    return out


_BYTE_CHARS = _byte_chars()
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


if sys.byteorder != "little":
    raise RuntimeError("token files are little-endian")
