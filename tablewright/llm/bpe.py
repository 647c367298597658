"""Byte-pair encoding and decoding with a vocabulary file of the tokenizers library.

Method: the contiguous rank array. A short word is an array of parts with the merge rank of every pair
of neighbours. The array is scanned for the least rank (the leftmost of equals), the boundary there is
deleted, and the ranks of the two new neighbours are refreshed, until no pair can merge. Words of equal
length are held as the rows of one matrix, so that one scan serves them all. Words above ``SHORT`` bytes,
where repeated scans would cost the square of the length, take the same merges from a heap.

Defined cases: a null or empty text gives an empty id list, and that decodes to an empty text; null id
lists decode to null; ids outside the vocabulary are skipped, as the library does.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablewright.llm.common import Generations, map_columns, model, pieces, ship, with_columns, with_fields
from tablewright.llm.words import Words, WordTable

SHORT = 48
# Entries of a worker's table of encoded stretches; of one that decodes as well.
UNITS, FEW_UNITS = 1_500_000, 700_000
# Text encoded and decoded at a time, and id lists decoded together.
ROUND_BYTES, LISTS = 1 << 18, 256
NONE = np.int32(2**31 - 1)
# Unicode's White_Space, which is what \s means in the library's patterns.
SPACE = "\t-\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# Letters and numbers follow the pattern module's Unicode version; code points that only a newer or older
# version assigns may fall into another class than in the library.
WORDS = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{SPACE}\\p{{L}}\\p{{N}}]+")

PLAIN_MARKS = frozenset(".,;:!?")
ASCII_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for themselves, the others
    follow from code point 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(256 + extra))
        extra += b not in plain
    return out


class RankArrays:
    """The merges and vocabulary of one file, and the encoder over them."""

    def __init__(self, content: str, units: int = UNITS):
        spec = json.loads(content)
        bpe = spec["model"]
        if bpe.get("type", "BPE") != "BPE" or not bpe.get("end_of_word_suffix") or spec.get("decoder") is not None:
            raise ValueError("the file must hold a BPE model with word ends and no decoder")
        vocab: dict[str, int] = bpe["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        suffix = bpe["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(bpe["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault(vocab[left] << 32 | vocab[right], (rank, vocab[left + right]))
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        names: dict[int, str] = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())
        found = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.split_special = regex.compile(f"({found})") if found else None
        # Stretches between ASCII white space, and the words inside them.
        self.units, self.word_cache = WordTable(units), Generations()

    # ------------------------------------------------------------------ words

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rank and merged id of each pair; NONE where there is no merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), self.made[at]

    def _encode_rows(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of one length, one word a row."""
        n, length = raw.shape
        parts = self.inner[raw]
        parts[:, -1] = self.final[raw[:, -1]]
        if length == 1:
            return parts, np.ones(n, np.int64)
        done, size = np.zeros((n, length), np.int64), np.full(n, length)
        rows = np.arange(n)
        ranks, made = self._rank(parts[:, :-1], parts[:, 1:])
        columns = np.arange(length)
        while True:
            at = ranks.argmin(axis=1)
            each = np.arange(len(at))
            open_ = ranks[each, at] != NONE
            if not open_.all():
                done[rows[~open_], : parts.shape[1]] = parts[~open_]
                rows, parts, ranks, made, at = rows[open_], parts[open_], ranks[open_], made[open_], at[open_]
                each = np.arange(len(at))
            if not len(rows):
                return done, size
            new = made[each, at]
            width = parts.shape[1]
            # Delete the boundary: what stands right of it moves one place to the left.
            move = columns[: width - 1] + (columns[: width - 1] > at[:, None])
            parts = np.take_along_axis(parts, move, axis=1)
            parts[each, at] = new
            size[rows] -= 1
            if width == 2:
                done[rows, :1] = parts
                return done, size
            move = columns[: width - 2] + (columns[: width - 2] >= at[:, None])
            ranks, made = np.take_along_axis(ranks, move, axis=1), np.take_along_axis(made, move, axis=1)
            # Refresh the two pairs that the merged part stands in.
            for inside, spot in ((at > 0, at - 1), (at < width - 2, at)):
                r, s = each[inside], spot[inside]
                ranks[r, s], made[r, s] = self._rank(parts[r, s], parts[r, s + 1])

    def _encode_long(self, raw: bytes) -> bytes:
        parts = [int(self.inner[b]) for b in raw]
        parts[-1] = int(self.final[raw[-1]])
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = []

        def offer(i: int) -> None:
            found = self.pairs.get(parts[i] << 32 | parts[after[i]])
            if found is not None:
                heapq.heappush(heap, (found[0], i, parts[i], parts[after[i]], found[1]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([p for p in parts if p >= 0], "<i4").tobytes()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list[bytes] = [b""] * len(raw)
        for i in np.flatnonzero(sizes > SHORT).tolist():
            out[i] = self._encode_long(raw[i])
        for length in np.unique(sizes[sizes <= SHORT]).tolist():
            places = np.flatnonzero(sizes == length).tolist()
            rows = np.frombuffer(b"".join([raw[i] for i in places]), np.uint8).reshape(-1, length)
            ids, kept = self._encode_rows(rows)
            data, step = ids.astype("<i4").tobytes(), 4 * length
            for i, at, n in zip(places, range(0, step * len(places), step), kept.tolist(), strict=True):
                out[i] = data[at : at + 4 * n]
        return out

    # ------------------------------------------------------------------ texts

    def _units(self, unit: str) -> list[str | int]:
        """Words, and ids of special tokens, in a stretch without white space."""
        # Shortcuts for plain words, alone or before one ASCII mark; all else takes the patterns.
        stem, mark = (unit[:-1], unit[-1:]) if unit[-1:] in PLAIN_MARKS else (unit, "")
        if stem.isalpha() and (stem.isascii() or unicodedata.is_normalized("NFC", stem) and "Σ" not in stem):
            lower = stem.lower()
            if lower.isalpha():
                return [lower, mark] if mark else [lower]
        if unit.isascii() and "<" not in unit:
            return ASCII_WORDS.findall(unit.lower())
        out: list[str | int] = []
        for part in self.split_special.split(unit) if self.split_special and "<" in unit else [unit]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                # The library lowers letter by letter, so a capital sigma never takes its final form.
                out += WORDS.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def encode_units(self, units: list[str]) -> list[bytes]:
        words = [self._units(u) for u in units]
        wanted = {w for ws in words for w in ws}
        known = self.word_cache.fill({w for w in wanted if w.__class__ is str}, self.encode_words)
        for i in wanted.intersection(self.special.values()):
            known[i] = i.to_bytes(4, "little")
        get = known.__getitem__
        return [get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws)) for ws in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offset at which each text begins (and the end)."""
        words = Words(texts)
        ids, sizes = self.units.lookup(words, self.encode_units)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[words.places]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Token texts joined by one space, which is what the library does for a file without decoder."""
        flat = ids.flatten()
        flat = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens))), flat, pa.scalar(None, flat.type))
        offsets = pa.array(np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, self.tokens.take(flat))
        joined = pc.binary_join(_without_nulls(lists), " ")
        return pc.if_else(ids.is_null(), pa.scalar(None, joined.type), joined)


def _without_nulls(lists: pa.ListArray) -> pa.ListArray:
    values = lists.values
    if not values.null_count:
        return lists
    kept = np.concatenate([[0], np.cumsum(values.is_valid().to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(kept[lists.offsets.to_numpy()], pa.int32()), values.drop_null())


def id_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))


def vocabulary(df: DataFrame, path: str):
    """The file's content as a broadcast; a vocabulary has a size of its own, whatever the data."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is too large for a vocabulary")
    return df.sparkSession.sparkContext.broadcast(content)


def encoder(content: str, units: int = UNITS) -> RankArrays:
    key = hashlib.sha256(content.encode()).digest() + units.to_bytes(8, "little")
    return model("bpe", key, lambda: RankArrays(content, units))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` array<int>: the whole text under the vocabulary file at ``path`` (read on the driver)."""
    sent = vocabulary(df, path)
    return map_columns(
        df, text, [(ids, T.ArrayType(T.IntegerType()))], lambda texts: {ids: id_lists(*encoder(sent.value).encode(texts))}
    )


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the decoded id list, special tokens included."""
    sent = vocabulary(df, path)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, None):
            for start in range(0, batch.num_rows, LISTS):
                part = batch.slice(start, LISTS)
                lists = part.column(part.schema.get_field_index(ids)).cast(pa.list_(pa.int32()))
                yield with_columns(part, {text: encoder(sent.value).decode(lists)})

    return df.mapInArrow(run, with_fields(df.schema, [(text, T.StringType())]))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``decode`` after ``encode`` in one worker: adds ``ids`` and ``decoded`` and drops the text.

    Two operators in a row keep two workers a core, each with the vocabulary; this takes one, with a smaller
    table of stretches and less text at a time.
    """
    sent = vocabulary(df, path)

    def make(texts: pa.Array) -> dict[str, pa.Array]:
        ranks = encoder(sent.value, FEW_UNITS)
        lists = id_lists(*ranks.encode(texts)).cast(pa.list_(pa.int32()))
        return {ids: lists, decoded: ranks.decode(lists)}

    added = [(ids, T.ArrayType(T.IntegerType())), (decoded, T.StringType())]
    return map_columns(df, text, added, make, keep_text=False, limit=ROUND_BYTES)
