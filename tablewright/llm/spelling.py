"""Spelling variants: words one edit apart, found with k-d trees over letter-count vectors.

One inserted, deleted or replaced letter changes a word's letter counts by at most two in all: a replacement
takes one letter away and adds another, an insertion adds one. So the words that can be near lie in a small box
around a word's count vector, one box for each pair of lengths (the same length, or one more).

1. Count the words of all texts, combined before the shuffle.
2. Of every length, a k-d tree over the count vectors: its upper levels are planned on the driver from at most
   ``SAMPLE`` words (they only decide how even the cells are) and have at most ``CELLS`` cells. Every word goes
   to the cell that holds its vector, and as a query to every cell that its box touches.
3. In a cell the tree goes on down to leaves of ``LEAF`` words; a block of queries walks it together, each node
   keeping the queries whose spare additions and removals still reach it. What is left in a leaf is compared by
   counts, then by letter order.
4. A query leaves a cell as one row, its number of near words there and the best of them; rows of a word are
   summed up. Forms are followed to the last one by pointer doubling: n at least doubles with every step, so
   chains are short and have no circles.

Skew: a cell with more than ``CELL_ROWS`` words (a vector shared by many, or an uneven sample) is dealt out by
a hash of the word, and its queries go to each part. Words are at most CELL_ROWS a tree, queries come in blocks.

Defined cases: null and empty texts have no words; rows with a null id count with an empty id; repeated rows
count each; words of any length are taken whole; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import ship, stored

RUN = "[A-Za-z\u00c0-\u00ff]+"
# Planned noise: one run of so many loses a letter.
NOISE = 97
SHORTEST, FEWEST, RATIO = 5, 3, 2
SAMPLE, CELLS, CELL_ROWS, LEAF = 100_000, 16_384, 8_192, 24
# Queries that walk a tree together; words of many letters come in smaller blocks.
BLOCK, BLOCK_LETTERS = 4_096, 1 << 20
# Letters a-z and the 64 code points from U+00C0.
DIMENSIONS = 26 + 64
AXIS = np.zeros(256, np.int64)
AXIS[ord("a") : ord("z") + 1] = np.arange(26)
AXIS[0xC0:] = 26 + np.arange(64)


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, n) of all words that occur often enough; planned noise applied."""
    ident = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = docs.select(ident.alias("ident"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    size = F.length("run")
    # Only A-Z change case; the noise only takes letters away, so that shorter runs are never words.
    plain = F.octet_length("run") == size
    lowered = F.when(plain, F.lower("run")).otherwise(F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    marked = runs.filter(size >= SHORTEST).withColumn("run", lowered).withColumn("mark", F.crc32(F.concat("ident", F.lit(":"), "run").cast("binary")))
    at = (F.col("mark") % size).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    word = F.when(F.col("mark") % NOISE == 0, less).otherwise(F.col("run"))
    counted = marked.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # Stored before the words that the noise made too short go: a filter on the word would be pushed below the
    # aggregation, and every run be worked out twice.
    return stored(counted.filter(F.col("n") >= FEWEST)).filter(F.length("word") >= SHORTEST)


def vectors(words: list[bytes]) -> np.ndarray:
    """Letter counts, one row a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    rows = np.repeat(np.arange(len(words)), sizes)
    flat = AXIS[np.frombuffer(b"".join(words), np.uint8)]
    kind = np.int16 if not len(sizes) or sizes.max() < 1 << 15 else np.int32
    return np.bincount(rows * DIMENSIONS + flat, minlength=len(words) * DIMENSIONS).reshape(-1, DIMENSIONS).astype(kind)


def masks(counts: np.ndarray) -> np.ndarray:
    """The letters that a word has, as bits; letters 64 apart share one."""
    bits = np.uint64(1) << np.arange(DIMENSIONS, dtype=np.uint64) % np.uint64(64)
    return np.bitwise_or.reduce(np.where(counts > 0, bits, np.uint64(0)), axis=1)


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """(axis, limit) that halves the rows best: at most ``limit`` goes left. None for equal rows."""
    n = len(counts)
    axes = np.flatnonzero(counts.min(0) != counts.max(0))
    if not len(axes):
        return None
    used = counts[:, axes]
    # The best limit of an axis is its median or the number below.
    middle = np.minimum(np.partition(used, n // 2, axis=0)[n // 2], used.max(0) - 1)
    limits = np.stack([middle, np.maximum(middle - 1, used.min(0))])
    uneven = np.abs(2 * (used[None, :, :] <= limits[:, None, :]).sum(1) - n)
    row, axis = np.unravel_index(np.argmin(uneven), uneven.shape)
    return int(axes[axis]), int(limits[row, axis])


@dataclass(frozen=True)
class Node:
    """An inner node splits at ``axis``; a leaf has its number, or the rows that it holds."""

    axis: int = -1
    limit: int = 0
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1
    rows: np.ndarray | None = None


def planned(counts: np.ndarray, parts: int, smallest: int, numbers: Iterator[int] | None = None) -> Node:
    """A k-d tree with up to ``parts`` leaves of at least ``smallest`` rows, numbered if ``numbers`` are given."""

    def grow(rows: np.ndarray, parts: int) -> Node:
        split = best_split(counts[rows]) if parts > 1 and len(rows) >= 2 * smallest else None
        if split is None:
            return Node(leaf=next(numbers)) if numbers is not None else Node(rows=rows)
        low = counts[rows, split[0]] <= split[1]
        return Node(*split, grow(rows[low], (parts + 1) // 2), grow(rows[~low], parts // 2))

    return grow(np.arange(len(counts)), parts)


# A letter that may still be taken away or added; one that may not.
SPARE, NONE = -1, -2


def walk(node: Node, counts: np.ndarray, at: np.ndarray, took: np.ndarray, added: np.ndarray) -> Iterator[tuple[Node, np.ndarray]]:
    """Every leaf with the queries ``at`` whose box touches it. ``took`` and ``added`` are the axes on which a
    query has used its letter to get here, SPARE or NONE."""
    if not len(at):
        return
    if node.axis < 0:
        yield node, at
        return
    value = counts[at, node.axis] - (took == node.axis) + (added == node.axis)
    low = value <= node.limit
    down = ~low & (value == node.limit + 1) & (took == SPARE)
    up = low & (value == node.limit) & (added == SPARE)
    left, right = np.flatnonzero(low | down), np.flatnonzero(~low | up)
    yield from walk(node.left, counts, at[left], np.where(down[left], node.axis, took[left]), added[left])
    yield from walk(node.right, counts, at[right], took[right], np.where(up[right], node.axis, added[right]))


def leaves(node: Node, counts: np.ndarray, take: int, add: int) -> Iterator[tuple[Node, np.ndarray]]:
    n = len(counts)
    return walk(node, counts, np.arange(n), np.full(n, take), np.full(n, add))


def letters(words: list[bytes]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows in which ``long`` is ``short`` with one letter more."""
    n = short.shape[1]

    def agreeing(same: np.ndarray) -> np.ndarray:
        return np.where(same.all(1), n, same.argmin(1))

    return agreeing(short == long[:, :n]) + agreeing(short[:, ::-1] == long[:, :0:-1]) >= n


class Cell:
    """The words of one length in one cell, and the best near words found for them so far."""

    def __init__(self, words: list[bytes], ns: list[int]):
        self.words, self.ns = words, ns
        self.counts, self.letters = vectors(words), letters(words)
        self.present = masks(self.counts)
        self.tree = planned(self.counts, len(words), LEAF // 2)
        self.rank = ranks(words, ns)
        self.near = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, bytes]] = {}

    def pairs(self, words: list[bytes], same: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) index pairs that are one edit apart; queries have this length, or one letter less."""
        counts, own = vectors(words), letters(words)
        queries, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, BLOCK_LETTERS // own.shape[1])
        apart = 2 if same else 1
        present = masks(counts)
        for node, at in leaves(self.tree, counts, SPARE if same else NONE, SPARE):
            # Letters that only one of two words has, sixty-four at a time, spare most comparisons of counts.
            q, t = np.nonzero(np.bitwise_count(present[at][:, None] ^ self.present[node.rows][None, :]) <= apart)
            for i in range(0, len(q), BLOCK * 4):
                a, b = at[q[i : i + BLOCK * 4]], node.rows[t[i : i + BLOCK * 4]]
                close = np.abs(counts[a] - self.counts[b]).sum(1) == apart
                a, b = a[close], b[close]
                for j in range(0, len(a), step):
                    x, y = a[j : j + step], b[j : j + step]
                    right = (one_replaced if same else one_inserted)(own[x], self.letters[y])
                    queries.append(x[right])
                    found.append(y[right])
        return np.concatenate(queries), np.concatenate(found)

    def ask(self, words: list[bytes], ns: list[int], same: bool) -> Iterator[tuple[bytes, int, int, bytes]]:
        """(word, near words here, n of the best, the best) of the queries; longer words here remember theirs."""
        q, t = self.pairs(words, same)
        near = np.bincount(q, minlength=len(words))
        best = np.full(len(words), len(self.words))
        np.minimum.at(best, q, self.rank[t])
        by_rank = np.argsort(self.rank)
        for i in np.flatnonzero(near).tolist():
            j = int(by_rank[best[i]])
            yield words[i], int(near[i]), self.ns[j], self.words[j]
        if not same and len(t):
            self.near += np.bincount(t, minlength=len(self.words))
            rank = ranks(words, ns)
            back = np.full(len(self.words), len(words))
            np.minimum.at(back, t, rank[q])
            by_rank = np.argsort(rank)
            for i in np.flatnonzero(back < len(words)).tolist():
                j = int(by_rank[back[i]])
                one = (-ns[j], words[j])
                self.best[i] = min(one, self.best.get(i, one))

    def remembered(self) -> Iterator[tuple[bytes, int, int, bytes]]:
        for i, (n, word) in self.best.items():
            yield self.words[i], int(self.near[i]), -n, word


def ranks(words: list[bytes], ns: list[int]) -> np.ndarray:
    """Places in the order of falling n, then words."""
    out = np.empty(len(words), np.int64)
    out[sorted(range(len(words)), key=lambda i: (-ns[i], words[i]))] = np.arange(len(words))
    return out


def plan_cells(words: DataFrame) -> dict[int, Node]:
    """The upper tree of every length that needs more than one cell."""
    sizes = words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL_ROWS).orderBy("size").collect()
    if not sizes:
        return {}
    total = sum(r["n"] for r in sizes)
    many = words.filter(F.length("word").isin([r["size"] for r in sizes])).orderBy(F.xxhash64("word"), "word").limit(SAMPLE)
    sample: dict[int, list[bytes]] = {}
    for row in many.select("word").collect():
        sample.setdefault(len(row["word"]), []).append(row["word"].encode("latin-1"))
    trees = {}
    for size, n in ((r["size"], r["n"]) for r in sizes):
        cells = min(-(-2 * n // CELL_ROWS), max(2, CELLS * n // total))
        trees[size] = planned(vectors(sample.get(size, [])), cells, 1, iter(range(1 << 30)))
    return trees


def routed(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    """(size, cell, kind, word, n): every word in its own cell (kind 0), as a query to the other cells of its length
    that its box touches (1), and to those of the next length (2)."""
    sent = words.sparkSession.sparkContext.broadcast(trees)
    only = Node(leaf=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            texts = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            for i, w in enumerate(texts):
                by_size.setdefault(len(w), []).append(i)
            for size, every in by_size.items():
                step = max(1, BLOCK_LETTERS // size)
                for k in range(0, len(every), step):
                    rows = np.array(every[k : k + step])
                    counts = vectors([texts[i] for i in rows.tolist()])
                    own = np.zeros(len(rows), np.int64)
                    tree = trees.get(size, only)
                    for leaf, at in leaves(tree, counts, NONE, NONE):
                        own[at] = leaf.leaf
                    parts = [(size, own, 0, rows)]
                    for leaf, at in leaves(tree, counts, SPARE, SPARE):
                        other = at[own[at] != leaf.leaf]
                        parts.append((size, np.full(len(other), leaf.leaf), 1, rows[other]))
                    for leaf, at in leaves(trees.get(size + 1, only), counts, NONE, SPARE):
                        parts.append((size + 1, np.full(len(at), leaf.leaf), 2, rows[at]))
                    for to, cells, kind, which in parts:
                        if len(which):
                            there = batch.take(pa.array(which))
                            constant = [pa.array(np.full(len(which), v), pa.int32()) for v in (to, kind)]
                            yield pa.RecordBatch.from_arrays(
                                [constant[0], pa.array(cells, pa.int32()), constant[1], there.column("word"), there.column("n")],
                                ["size", "cell", "kind", "word", "n"],
                            )

    return words.select("word", "n").mapInArrow(run, "size int, cell int, kind int, word string, n long")


def dealt(rows: DataFrame) -> DataFrame:
    """Cells with too many words in parts: a word in one of them, a query in each."""
    large = rows.filter("kind = 0").groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("parts")).filter("parts > 2")
    large = stored(large)
    if large.isEmpty():
        return rows.withColumn("part", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    each = rows.join(large, ["size", "cell"], "left").withColumn("own", own).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    kind = F.when((F.col("kind") == 0) & (F.col("part") != F.col("own")), 1).otherwise(F.col("kind"))
    return each.withColumn("kind", kind).select(*rows.columns, "part")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of words one edit away and the commonest of them, for words that have any."""
    ship(words.sparkSession)
    rows = dealt(stored(routed(words, plan_cells(words))))
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // CELL_ROWS))
    place = ["size", "cell", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None
        held: tuple[list[bytes], list[int]] = ([], [])
        kind_now = 0

        def out(found) -> Iterator[pa.RecordBatch]:
            rows = list(found)
            if rows:
                a, n, b, w = zip(*rows, strict=True)
                arrays = [pa.array([x.decode("latin-1") for x in a]), pa.array(n, pa.int64()), pa.array(b, pa.int64()), pa.array([x.decode("latin-1") for x in w])]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "best_n", "best"])

        def finish() -> Iterator[pa.RecordBatch]:
            """What is held is the cell's words, or a block of queries."""
            nonlocal cell, held
            words, ns = held
            held = ([], [])
            if not words:
                return
            if kind_now == 0:
                cell = Cell(words, ns)
                step = block(len(words[0]))
                for i in range(0, len(words), step):
                    yield from out(cell.ask(words[i : i + step], ns[i : i + step], True))
            elif cell is not None:
                yield from out(cell.ask(words, ns, kind_now == 1))

        def block(size: int) -> int:
            return max(1, min(BLOCK, BLOCK_LETTERS // size))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (*place, "kind", "word", "n"))
            for size, c, part, kind, word, n in zip(*columns, strict=True):
                if (size, c, part) != now:
                    yield from finish()
                    if cell is not None:
                        yield from out(cell.remembered())
                    now, cell, kind_now = (size, c, part), None, kind
                elif kind != kind_now or (kind and len(held[0]) >= block(size)):
                    yield from finish()
                    kind_now = kind
                if kind == 0 or cell is not None:  # a cell without words has no answers
                    held[0].append(word.encode("latin-1"))
                    held[1].append(n)
        yield from finish()
        if cell is not None:
            yield from out(cell.remembered())

    ordered = rows.repartition(tasks, *place).sortWithinPartitions(*place, "kind").select(*place, "kind", "word", "n")
    found = ordered.mapInArrow(run, "word string, n_near long, best_n long, best string")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best"))
    return summed.select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words (word, form) that have a form: the last one of the chain."""
    state = stored(forms.select("word", F.col("form").alias("to")))
    while True:
        ahead = state.select(F.col("word").alias("to"), F.col("to").alias("_next"))
        joined = stored(state.join(ahead, "to", "left").select("word", F.coalesce("_next", "to").alias("to"), F.col("_next").isNotNull().alias("moved")))
        state = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return state.withColumnRenamed("to", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word: see the module's text."""
    words = word_counts(docs, key, text)
    near = near_words(words)
    joined = words.join(near, "word", "left").withColumn("ok", F.col("best_n") >= RATIO * F.col("n"))
    known = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(F.col("ok"), F.col("best")).alias("form"), F.when(F.col("ok"), F.col("best_n")).alias("form_n")))
    ends = roots(known.filter("form is not null"))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
