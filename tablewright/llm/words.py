"""Words of an Arrow text column as arrays: places and hashes, without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def letters(seed: int, fold: bool = False) -> np.ndarray:
    """A random odd number for each byte; with ``fold`` A-Z count as a-z."""
    out = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold:
        out[65:91] = out[97:123]
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * BASE
    return x ^ (x >> np.uint64(32))


def power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            grown = np.full(1 << (n - 1).bit_length(), base, np.uint64)
            grown[0] = 1
            _powers[i] = np.multiply.accumulate(grown)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """Words (runs of bytes other than ``separators``, ASCII white space by default) of the texts; a null
    text has none.

    ``places``: word number at which each text begins, and the number of words at the end.
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray = BLANK):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        data = texts.buffers()[2] if size else b""
        self.raw = np.frombuffer(data, np.uint8)[first : first + size]
        offsets = offsets - first
        self.text_starts = offsets[:-1]
        blank = separators[self.raw]
        bound = np.zeros(size + 1, bool)
        bound[offsets] = True
        start, stop = ~blank, ~blank
        if size:
            start[1:] &= blank[:-1] | bound[1:-1]
            stop[:-1] &= blank[1:] | bound[1:-1]
        self.starts, self.stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self.places = np.searchsorted(self.starts, offsets)

    def hashes(self, table: np.ndarray) -> np.ndarray:
        """A 64-bit polynomial hash of each word over the numbers of ``table``."""
        powers, inverse = power(len(self.raw) + 1)
        total = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum(table[self.raw] * powers[:-1], out=total[1:])
        return mixed((total[self.stops] - total[self.starts]) * inverse[self.starts])

    def checks(self) -> np.ndarray:
        """A second mark of each word: its first eight bytes and its length."""
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.lib.stride_tricks.as_strided(padded, (len(self.raw) + 1, 8), (1, 1))[self.starts]
        head = np.ascontiguousarray(eight).view("<u8").reshape(-1)
        sizes = self.stops - self.starts
        shown = np.where(sizes >= 8, np.uint64(0), (np.uint64(8) - np.minimum(sizes, 8).astype(np.uint64)) * np.uint64(8))
        return ((head << shown) >> shown) ^ (sizes.astype(np.uint64) * MIX)

    def text(self, i: int) -> str:
        return self.raw[self.starts[i] : self.stops[i]].tobytes().decode()


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs values[start : start + size], one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class WordTable:
    """A bounded table from words to runs of numbers, by open addressing.

    A 64-bit hash, the length and the first eight bytes stand for a word. When ``entries`` is reached the table starts anew.
    """

    def __init__(self, entries: int):
        self.entries = entries
        self.first = letters(11)
        self.clear()

    def clear(self) -> None:
        self.n, self.used = 0, 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.keys, self.checks = np.zeros(1 << 14, np.uint64), np.zeros(1 << 14, np.uint64)
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.values = np.zeros(1 << 16, np.int32)

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.slots) - 1)
        slot = (keys & mask).astype(np.int64)
        found = self.slots[slot]
        other = np.flatnonzero((found >= 0) & ((self.keys[found] != keys) | (self.checks[found] != checks)))
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self.slots) - 1)
            e = self.slots[slot[other]]
            found[other] = e
            other = other[(e >= 0) & ((self.keys[e] != keys[other]) | (self.checks[e] != checks[other]))]
        return found

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        slot = (keys & np.uint64(len(self.slots) - 1)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.slots[slot[left]] < 0]
            self.slots[slot[free]] = entries[free]
            left = left[self.slots[slot[left]] != entries[left]]
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)

    def _add(self, keys: np.ndarray, checks: np.ndarray, runs: list[bytes]) -> None:
        a, b = self.n, self.n + len(keys)
        sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        end = self.used + int(sizes.sum())
        for name, need in (("keys", b), ("checks", b), ("starts", b), ("sizes", b), ("values", end)):
            have = getattr(self, name)
            if need > len(have):
                setattr(self, name, np.concatenate([have, np.zeros(max(need, 2 * len(have)) - len(have), have.dtype)]))
        self.keys[a:b], self.checks[a:b], self.sizes[a:b] = keys, checks, sizes
        self.starts[a:b] = self.used + np.cumsum(sizes) - sizes
        self.values[self.used : end] = np.frombuffer(b"".join(runs), "<i4")
        self.n, self.used = b, end
        if 2 * b > len(self.slots):
            self.slots = np.full(1 << (4 * b - 1).bit_length(), -1, np.int32)
            self._place(self.keys[:b], np.arange(b, dtype=np.int32))
        else:
            self._place(keys, np.arange(a, b, dtype=np.int32))

    def lookup(self, words: Words, make) -> tuple[np.ndarray, np.ndarray]:
        """Values of all words in order, and how many each word has. ``make`` gives the runs (little-endian
        32-bit numbers) of a list of words that the table does not hold."""
        if self.n > self.entries:
            self.clear()
        keys, checks = words.hashes(self.first), words.checks()
        found = self._find(keys, checks)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            _, at = np.unique(keys[missing] ^ (checks[missing] * MIX), return_index=True)
            new = missing[at]
            raw = words.raw.tobytes()
            places = zip(words.starts[new].tolist(), words.stops[new].tolist(), strict=True)
            self._add(keys[new], checks[new], make([raw[a:b].decode() for a, b in places]))
            found[missing] = self._find(keys[missing], checks[missing])
        sizes = self.sizes[found].astype(np.int64)
        return gathered(self.values, self.starts[found], sizes), sizes
