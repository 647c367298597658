"""Benchmark items inside documents, found with a number of edits allowed.

Method: pigeonhole edit matching. Texts are normalised to lower-case runs of letters and digits joined by
one space. An item of m characters may occur with k = m * percent // 100 edits; cut into k + 1 pieces, at
least one piece must then occur exactly. All pieces of all items form one automaton that reads every whole
document once; around each hit, Myers' bit-parallel algorithm finds the least edit distance of the item to
any substring, and the hit counts if that is at most k and the substring's words are whole words.

Between piece and item, the halves of the item that hold the piece are checked with their share of the
edits, from the smallest up. Items that share their text there share the stretch: it is stored once with its
parents, and tested once for each place of a document, however many items hold it.

An item of fewer than ``LEAST`` characters is no evidence of a leak (a document that says "no" does not hold
the answer "no"): it matches nothing and ``short_items`` reports it.

Items are sent to the workers in blocks of at most ``BLOCK_BYTES``; more items mean more passes.

Defined cases: a null or empty document has no matches; an item without letters or digits matches nothing;
equal items are reported each; an item with a null key counts like any other and is reported under a null key;
one row per document row and item: the least distance, then the earliest end. An input column that has the
name of a result stays out of it: results hold the two keys and their own columns.
Offsets are code points of the original text.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.common import model, pieces, ship, with_fields

WORD = re.compile(r"[^\W_]+")
PERCENT = 8
# Characters of the normal form from which an item is looked for.
LEAST = 12
BLOCK_BYTES = 8 << 20


def normalise(text: str | None) -> str:
    return " ".join(WORD.findall(text.lower())) if text else ""


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distances(pattern: dict[str, int], m: int, text: str, anchored: bool = False) -> Iterator[int]:
    """Myers: edit distance between the pattern and the best substring that ends at each place of
    ``text``; with ``anchored`` between the pattern and the whole of ``text`` up to there."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    get = pattern.get
    for c in text:
        eq = get(c, 0)
        vertical = eq | down
        across = (((eq & up) + up) ^ up) | eq
        plus = down | ~(across | up) & full
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1 | anchored) & full
        minus = minus << 1 & full
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        yield score


@dataclass(frozen=True)
class Match:
    item: int
    distance: int
    start: int
    end: int


class Stretch:
    """A stretch of text that may hold ``errors`` edits. ``parents``: (stretch, offset in it) of the stretches that it
    is a half of; ``items``: those whose whole text it is."""

    __slots__ = ("errors", "items", "length", "masks", "number", "parents")

    def __init__(self, text: str, errors: int, number: int):
        self.length, self.errors, self.number = len(text), errors, number
        self.masks = masks(text)
        self.parents: list[tuple[Stretch, int]] = []
        self.items: list[int] = []


def on_words(text: str, start: int, end: int) -> bool:
    """Whether a stretch of normalised text begins and ends with whole words."""
    return (start == 0 or text[start - 1] == " " or text[start : start + 1] == " ") and (
        end == len(text) or text[end] == " " or text[end - 1 : end] == " "
    )


class Matcher:
    """The automaton over the pieces of a block of items (key, normalised text).

    The pieces of an item are the leaves of a tree. If a stretch with e edits is cut into two that may hold
    a and b edits, with a + b + 1 = e, one of the two keeps within its own budget. So a piece hit only
    matters if every stretch above it matches within its budget too, and most chance hits end at the first.
    Stretches are known by their text and budget, so that items made from one template share them.
    """

    def __init__(self, items: list[tuple[int, str]], percent: int, least: int = LEAST):
        import ahocorasick

        self.items = items
        self.budget = [len(t) * percent // 100 for _, t in items]
        self.backward: dict[int, dict[str, int]] = {}
        known: dict[tuple[str, int], Stretch] = {}
        leaves: dict[str, list[Stretch]] = {}

        def stretch(text: str, cuts: list[int], a: int, b: int) -> Stretch:
            part = text[cuts[a] : cuts[b]]
            found = known.get((part, b - a - 1))
            if found is None:
                found = known[part, b - a - 1] = Stretch(part, b - a - 1, len(known))
                if b - a == 1:
                    leaves.setdefault(part, []).append(found)
            if b - a > 1:
                middle = (a + b) // 2
                for half, offset in ((stretch(text, cuts, a, middle), 0), (stretch(text, cuts, middle, b), cuts[middle] - cuts[a])):
                    if (found, offset) not in half.parents:
                        half.parents.append((found, offset))
            return found

        for i, (_, text) in enumerate(items):
            if len(text) < least:
                continue
            n, parts = len(text), self.budget[i] + 1
            stretch(text, [n * p // parts for p in range(parts + 1)], 0, parts).items.append(i)
        self.automaton = ahocorasick.Automaton()
        for piece, places in leaves.items():
            self.automaton.add_word(piece, places)
        if leaves:
            self.automaton.make_automaton()
        self.any = bool(leaves)

    def windows(self, text: str) -> dict[Stretch, list[list[int]]]:
        """For whole items, the merged stretches of ``text`` that a match could lie in."""
        out: dict[Stretch, list[list[int]]] = {}
        # Stretches and where they would begin: tested once, whatever piece or item led there.
        tested: set[tuple[int, int]] = set()
        for end, places in self.automaton.iter(text):
            todo = [(leaf, end + 1 - leaf.length) for leaf in places]
            while todo:
                node, origin = todo.pop()
                if node.items:
                    start, stop = max(0, origin - node.errors), min(len(text), origin + node.length + node.errors)
                    spans = out.setdefault(node, [])
                    if spans and spans[-1][0] <= start <= spans[-1][1]:
                        spans[-1][1] = max(stop, spans[-1][1])
                    else:
                        spans.append([start, stop])
                for parent, offset in node.parents:
                    place = (parent.number, origin - offset)
                    if place in tested:
                        continue
                    tested.add(place)
                    first = max(0, place[1] - parent.errors)
                    part = text[first : place[1] + parent.length + parent.errors]
                    if any(d <= parent.errors for d in distances(parent.masks, parent.length, part)):
                        todo.append((parent, place[1]))
        return out

    def search(self, text: str, first_only: bool = False) -> list[Match]:
        """The best match of every item in a normalised text."""
        if not self.any or not text:
            return []
        out = []
        for node, spans in self.windows(text).items():
            m, k, best = node.length, node.errors, None
            item = self.items[node.items[0]][1]
            for start, stop in spans:
                for at, score in enumerate(distances(node.masks, m, text[start:stop])):
                    end = start + at + 1
                    if score > k or (best is not None and score >= best[0]) or not (end == len(text) or " " in text[end - 1 : end + 1]):
                        continue
                    # Of the starts at a word's begin the one with the least distance, the nearest first.
                    before = text[max(0, end - m - k) : end][::-1]
                    if node.number not in self.backward:
                        self.backward[node.number] = masks(item[::-1])
                    limit = k if best is None else best[0] - 1
                    for n, d in enumerate(distances(self.backward[node.number], m, before, True)):
                        if d <= limit and on_words(text, end - n - 1, end):
                            best, limit = (d, end, n + 1), d - 1
            if best is None:
                continue
            score, end, length = best
            out += [Match(i, score, end - length, end) for i in node.items]
            if first_only:
                break
        return out


def _matcher(packed: bytes) -> Matcher:
    return model("items", hashlib.sha256(packed).digest(), lambda: Matcher(*pickle.loads(packed)))


def item_blocks(items: DataFrame, key: str, text: str, percent: int, limit: int = BLOCK_BYTES) -> list[bytes]:
    """Items packed for the workers, in blocks that hold at most ``limit`` bytes of text (or one item)."""
    blocks: list[bytes] = []
    block: list[tuple[int, str]] = []
    size = 0
    for r in items.select(key, text).orderBy(key, text).toLocalIterator():
        t = normalise(r[text])
        if not t:
            continue
        if block and size + len(t) > limit:
            blocks.append(pickle.dumps((block, percent)))
            block, size = [], 0
        block.append((r[key], t))
        size += len(t)
    if block:
        blocks.append(pickle.dumps((block, percent)))
    return blocks


def short_items(items: DataFrame, item_key: str = "item_id", item_text: str = "text", least: int = LEAST) -> DataFrame:
    """(key, n_chars) of the items that are too short to be looked for."""
    ship(items.sparkSession)
    kind = items.schema[item_key].dataType
    schema = T.StructType([T.StructField(item_key, kind), T.StructField("n_chars", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(normalise(t)) for t in batch.column(1).to_pylist()]
            short = [i for i, n in enumerate(sizes) if n < least]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(short, pa.int64())), pa.array([sizes[i] for i in short], pa.int64())], schema=arrow)

    return items.select(item_key, item_text).mapInArrow(run, schema)


def _original(text: str, start: int, end: int) -> tuple[int, int]:
    """Offsets in the text for offsets in its normal form; lower-casing may change lengths, so words carry them."""
    at, first, last = 0, 0, len(text)
    for w in re.finditer(r"[^\W_]+", text):
        n = len(w.group().lower())
        if at <= start < at + n + 1:
            first = w.start() + min(start - at, len(w.group()))
        if at < end <= at + n + 1:
            last = w.start() + min(end - at, len(w.group()))
            break
        at += n + 1
    return first, last


def matches(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """(key, item key, distance, budget, start, end): every item that a document holds."""
    spark = docs.sparkSession
    ship(spark)
    columns = [(key, docs.schema[key].dataType), (item_key, items.schema[item_key].dataType)]
    schema = T.StructType(
        [T.StructField(n, t) for n, t in columns]
        + [T.StructField(n, T.LongType()) for n in ("distance", "budget", "start", "end")]
    )
    arrow = to_arrow_schema(schema)  # named types, as a batch may hold null keys only
    out = spark.createDataFrame([], schema)
    for packed in item_blocks(items, item_key, item_text, percent):
        sent = spark.sparkContext.broadcast(packed)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent.value)
            for piece in pieces(batches, text):
                rows = []
                for k, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    for m in matcher.search(normalise(t)):
                        place = _original(t, m.start, m.end)
                        rows.append((k, matcher.items[m.item][0], m.distance, matcher.budget[m.item], *place))
                if rows:
                    columns = zip(zip(*rows, strict=True), arrow.types, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=arrow)

        out = out.unionByName(docs.select(key, text).mapInArrow(run, schema))
    return out


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    ship(docs.sparkSession)
    for packed in item_blocks(items, item_key, item_text, percent):
        sent = docs.sparkSession.sparkContext.broadcast(packed)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent.value)
            for piece in pieces(batches, text):
                texts = piece.column(piece.schema.get_field_index(text)).to_pylist()
                yield piece.filter(pa.array([not matcher.search(normalise(t), True) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, with_fields(docs.schema, []))
    return docs
