"""Exact n-gram Jaccard join: which documents share at least three quarters of their word shingles.

Method: a token-group matrix. Similar documents are put into groups, the tokens of a group's members are
stored as one union, a query document is bounded against the union, and only groups that pass are opened.

1. Every document becomes the set of its distinct 5-word shingles (64-bit hashes). Shingles have one order
   for the whole corpus: rare ones by hash, then the ``HOT`` commonest by rising count. By the prefix
   principle two linked sets must share one of their leading tokens, the first n - ceil(0.75 n) + 1, so
   that only a quarter of the tokens is ever moved.
2. Groups: documents that share leading tokens are compared with the smallest document that has them, then
   with a member of the largest group beside them; those that truly link, and equal sets, are one group
   (connected components).
3. Matrix: one row per leading token and group, with the largest overlap that the token still allows to any
   member. A query meets a group of higher rank (size, then id); the leading tokens that it shares with the
   group's union bound its overlap with every member. Groups that pass are opened.
4. Opened groups lie in blocks by size band and hash. A query goes to the blocks of the bands that its size
   allows, as one row with its leading tokens, and a block counts what it shares with every member. First only
   the best member of a group is compared exactly with a query: one link merges the two groups, and most
   queries are done. Those that did not link are then compared with every member that the count allows.

Exactness: the order only steers the work. A pair that links has a first common token; there, with n and m
tokens from that place on, min(n, m) must reach the overlap that the threshold asks of their sizes; beside
this, the sizes and the count of shared leading tokens (see ``enough``) prune. Sets are compared by 64-bit
hashes.

Skew: equal sets are reduced before the shuffle. Tokens outside the ``HOT`` list hold at most a few
millionths of all tokens each. The list's own tokens, whose documents can be a large part of the corpus,
are aggregated before the shuffle and reach the matrix once per group. Comparisons with one common document
are dealt out by salt. No pairs of a query and a group's members are made before they have passed the count.

Defined cases: a null or empty text has no shingles and links with nothing; fewer words than five make one
shingle of their own kind; rows with one key count as one document with several sets; a null key gives a
null component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import PIECE_BYTES, model, pieces, release, ship, small_batches, stored
from tablewright.llm.components import components
from tablewright.llm.words import Words, letters, mixed

WIDTH = 5
# The threshold as a fraction.
PART, WHOLE = 75, 100
HOT = 262_144
# Tokens looked at together for repeats, and the count in such a stretch from which a token is reported.
STRETCH, REPEATS = 1_000_000, 3
# Leading tokens of the members in one block of an opened group.
BLOCK_TOKENS = 262_144
# Documents compared with one common document in one salt, and ids that may be broadcast.
SALT_ROWS, BROADCAST_IDS = 512, 1_000_000
# Groups are formed from pairs that share one leading token for so many of the smaller set's tokens.
LIKELY = 20

LETTERS = letters(5, fold=True)


def runs(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    out = np.full(max(n, 0), np.uint64(width), np.uint64)
    for i in range(width if n > 0 else 0):
        out = mixed(out + words[i : i + n])
    return out


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; letters A-Z count as a-z."""
    found = Words(texts)
    words = found.hashes(LETTERS)
    all_runs = runs(words, WIDTH)
    places = found.places.tolist()
    out = []
    for a, b in zip(places, places[1:], strict=False):
        if b - a >= WIDTH:
            tokens = np.sort(all_runs[a : b - WIDTH + 1])
            out.append(tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])])
        else:
            out.append(runs(words[a:b], b - a) if b > a else words[:0])
    return out


def _sets(piece: pa.RecordBatch, text: str) -> list[np.ndarray]:
    return shingle_sets(piece.column(piece.schema.get_field_index(text)))


def hot_tokens(docs: DataFrame, text: str, most: int = HOT) -> np.ndarray:
    """The commonest shingles, commonest last: at most ``most``. Steers the order of tokens, nothing else."""
    ship(docs.sparkSession)

    def repeats(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
        often = counts >= REPEATS
        return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for piece in pieces(batches, text):
            for s in _sets(piece, text):
                mark = xxhash.xxh3_64_intdigest(s.tobytes())
                if mark not in seen:
                    seen.add(mark)
                    held.append(s)
                    size += len(s)
            if size >= STRETCH:
                yield repeats(held)
                held, size, seen = [], 0, set()
        yield repeats(held)

    found = docs.select(text).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "token").limit(most)
    with small_batches(docs.sparkSession):
        top = top.toPandas()
    return top["token"].to_numpy(np.int64)[::-1].view(np.uint64)


class Order:
    """The corpus-wide order of tokens."""

    def __init__(self, hot: np.ndarray):
        by_value = np.argsort(hot)
        self.values, self.ranks = hot[by_value], by_value

    def prefix(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """Leading tokens in order, and how many of them are not on the list of common ones."""
        n = len(tokens)
        length = n - -(-PART * n // WHOLE) + 1 if n else 0
        if not len(self.values):
            return tokens[:length], length
        at = np.minimum(np.searchsorted(self.values, tokens), len(self.values) - 1)
        hot = self.values[at] == tokens
        cold = tokens[~hot]
        if len(cold) >= length:
            return cold[:length], length
        ranked = tokens[hot][np.argsort(self.ranks[at[hot]])]
        return np.concatenate([cold, ranked])[:length], len(cold)


def _order(packed: bytes) -> Order:
    return model("hot", hashlib.sha256(packed).digest(), lambda: Order(np.frombuffer(packed, np.uint64)))


def leading_tokens(docs: DataFrame, key: str, text: str, hot: np.ndarray) -> DataFrame:
    """(doc, n, set_hi, set_lo, cold, hot): set size, 128-bit set hash, leading tokens in order.

    A task gives the tokens of equal sets once, for a row with a key: rows without one link with nothing.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(hot.tobytes())
    schema = "doc long, n long, set_hi long, set_lo long, cold array<long>, hot array<long>"
    lists = pa.list_(pa.int64())
    names = "doc n set_hi set_lo cold hot".split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = _order(sent.value), set()
        for piece in pieces(batches, text):
            sets = _sets(piece, text)
            marks = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            keys = piece.column(piece.schema.get_field_index(key)).cast(pa.int64())
            cold, hot_, ends = [], [], [0]
            for s, mark, keyed in zip(sets, marks, keys.is_valid().to_pylist(), strict=True):
                if keyed and len(s) and mark not in seen:
                    seen.add(mark)
                    tokens, n_cold = order.prefix(s)
                    cold.append(tokens[:n_cold])
                    hot_.append(tokens[n_cold:])
                else:
                    cold.append(s[:0])
                    hot_.append(s[:0])
            halves = np.frombuffer(b"".join(marks), ">i8").reshape(-1, 2).astype(np.int64)
            arrays = []
            for parts in (cold, hot_):
                ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                values = pa.array(np.concatenate(parts).view(np.int64))
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), values).cast(lists))
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    *arrays,
                ],
                names,
            )

    return docs.select(key, text).mapInArrow(run, schema)


def enough(common, n, m, most):
    """Can sets of n and m tokens link (other sets of up to ``most``) that share ``common`` leading tokens?

    Take the set whose leading tokens end first in the common order: all it shares up to there is counted, so
    it can share ceil(0.75 n) - 1 more at most, the tokens behind its leading ones.
    """
    behind = F.ceil(PART * F.greatest(n, most) / WHOLE) - 1
    return (WHOLE + PART) * (common + behind) >= PART * (n + m)


def shared_tokens(leading: DataFrame) -> DataFrame:
    """(token, doc, n, left, lead, lead_n, lead_left, hot): leading tokens that two documents have, beside the
    smallest of those documents. ``left``: the document's tokens from this one on, it included."""
    from_cold = leading.select("doc", "n", F.posexplode("cold").alias("at", "token"))
    from_hot = leading.select("doc", "n", F.size("cold").alias("cold"), F.posexplode("hot").alias("at", "token"))
    # Size and place travel in one number: most of the shuffle is these rows.
    packed = F.shiftleft("n", 32)
    first = F.struct("doc", "packed")
    cold = from_cold.select("token", "doc", packed.bitwiseOR(F.col("at")).alias("packed"))
    same = Window.partitionBy("token")
    cold = cold.select("*", F.min(first).over(same).alias("least"), F.max("doc").over(same).alias("last"))
    hot = from_hot.select("token", "doc", packed.bitwiseOR(F.col("cold") + F.col("at")).alias("packed"))
    # At most HOT rows, which is what the list holds.
    ends = hot.groupBy("token").agg(F.min(first).alias("least"), F.max("doc").alias("last"))
    hot = hot.join(F.broadcast(ends), "token").select(*cold.columns)
    both = cold.filter("least.doc < last").withColumn("hot", F.lit(False))
    both = both.unionAll(hot.filter("least.doc < last").withColumn("hot", F.lit(True)))
    n, lead_n = F.shiftright("packed", 32), F.shiftright("least.packed", 32)
    at, lead_at = (F.col(c).bitwiseAND(F.lit((1 << 32) - 1)) for c in ("packed", "least.packed"))
    return both.select(
        "token",
        "doc",
        n.alias("n"),
        (n - at).alias("left"),
        F.col("least.doc").alias("lead"),
        lead_n.alias("lead_n"),
        (lead_n - lead_at).alias("lead_left"),
        "hot",
    )


def join_ids(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Semi- or anti-join with a table of ids: broadcast if a count shows that they are few, else shuffled."""
    ids = stored(ids)
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def attached(rows: DataFrame, values: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join with a stored table that has one row per key: broadcast if a count shows that it is small, else shuffled."""
    return rows.join(F.broadcast(values) if values.count() <= BROADCAST_IDS else values, on, how)


def linked(docs: DataFrame, key: str, text: str, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v), u common to many, whose sets link. The sets are made again from the texts."""
    spark = docs.sparkSession
    pairs = stored(pairs.distinct())
    salts = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    others = pairs.join(salts, "u").select("u", F.col("v").alias("doc"), F.pmod(F.xxhash64("v"), F.col("salts")).cast("int").alias("salt"))
    own = salts.select("u", F.col("u").alias("doc"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    wanted = stored(others.unionAll(own).groupBy("doc").agg(F.collect_list(F.struct("u", "salt")).alias("places")))
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text")).join(side, "doc")
    ship(spark)

    def packed(rows: tuple[list, ...]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], ["u", "salt", "doc", "tokens"])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows, size = ([], [], [], []), 0
            places = piece.column(piece.schema.get_field_index("places")).to_pylist()
            for doc, s, at in zip(piece.column(0).to_pylist(), _sets(piece, "text"), places, strict=True):
                data = s.tobytes()
                for p in at:
                    for column, value in zip(rows, (p["u"], p["salt"], doc, data), strict=True):
                        column.append(value)
                    size += len(data)
                    if size > PIECE_BYTES:
                        yield packed(rows)
                        rows, size = ([], [], [], []), 0
            yield packed(rows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, common = None, []
        for batch in batches:
            u, v = [], []
            for a, salt, doc, data in zip(*(batch.column(c).to_pylist() for c in ("u", "salt", "doc", "tokens")), strict=True):
                tokens = np.frombuffer(data, np.uint64)
                if (a, salt) != place:
                    place, common = (a, salt), []
                if doc == a:  # rows of the common document come first
                    common.append(tokens)
                    continue
                for other in common:
                    both = np.concatenate([tokens, other])
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    if len(both) and WHOLE * same >= PART * (len(both) - same):
                        u.append(a)
                        v.append(doc)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    sets = texts.select("doc", "text", "places").mapInArrow(to_sets, "u long, salt int, doc long, tokens binary")
    dealt = sets.repartition("u", "salt").sortWithinPartitions("u", "salt", F.col("doc") != F.col("u"), "doc")
    return stored(dealt.mapInArrow(compare, "u long, v long").distinct())


def across_groups(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(token, doc, n, left, hot, group): the leading tokens that documents of different groups have."""
    named = attached(shared.select("token", "doc", "n", "left", "hot"), groups.withColumnRenamed("node", "doc"), ["doc"])
    named = named.withColumn("group", F.coalesce("component", "doc")).drop("component")
    # Tokens of one group only have done their work.
    same = Window.partitionBy("token")
    cold = named.filter("not hot").select("*", F.min("group").over(same).alias("a"), F.max("group").over(same).alias("b"))
    ends = named.filter("hot").groupBy("token").agg(F.min("group").alias("a"), F.max("group").alias("b"))
    common = named.filter("hot").join(F.broadcast(ends.filter("a < b")), "token").select(*cold.columns)
    rows = stored(cold.filter("a < b").unionAll(common).drop("a", "b"))
    release(shared.sparkSession)
    return rows


def group_sizes(groups: DataFrame) -> DataFrame:
    return groups.groupBy(F.col("component").alias("group")).agg(F.count(F.lit(1)).alias("size"))


def likely(rows: DataFrame) -> DataFrame:
    """Pairs (u, v) of rows (u, v, n), one a shared token, with so many in common that they may well link.

    Only for forming groups: a pair that is left out here is met again between groups.
    """
    counted = rows.groupBy("u", "v", "n").agg(F.count(F.lit(1)).alias("common"))
    return counted.filter(LIKELY * F.col("common") >= F.col("n")).select("u", "v")


def meetings(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc, target): groups of higher rank that may hold a link of a document, by the token-group matrix over the
    rows of ``across_groups``."""
    # The matrix: unions of the groups' leading tokens.
    matrix = rows.groupBy("token", "group").agg(F.max("left").alias("most_left"), F.min("n").alias("least_n"), F.max("n").alias("most_n"))
    sizes = stored(group_sizes(groups))

    def sized(df: DataFrame) -> DataFrame:
        return attached(df, sizes, ["group"]).withColumn("rank", F.struct(F.coalesce("size", F.lit(1)), "group")).drop("size")

    queries = sized(rows).alias("q")
    unions = sized(stored(matrix)).alias("g")
    # Only a group of higher rank is queried, so that a huge group meets few queries and asks none of small ones.
    meets = (
        (F.col("q.token") == F.col("g.token"))
        & (F.col("q.rank") < F.col("g.rank"))
        & (WHOLE * F.col("g.most_n") >= PART * F.col("q.n"))
        & (WHOLE * F.col("q.n") >= PART * F.col("g.least_n"))
    )
    # True for a token that can be the first one in common.
    first = (WHOLE + PART) * F.least(F.col("q.left"), F.col("g.most_left")) >= PART * (F.col("q.n") + F.col("g.least_n"))
    # The bound of the union: a member's common leading tokens are among those that the query shares with it.
    shares = (
        queries.join(unions, meets)
        .groupBy(F.col("q.doc").alias("doc"), F.col("q.n").alias("n"), F.col("g.group").alias("target"))
        .agg(
            F.count(F.lit(1)).alias("common"),
            F.min("g.least_n").alias("m"),
            F.max("g.most_n").alias("most"),
            F.max(first).alias("first"),
        )
    )
    return shares.filter(F.col("first") & enough(F.col("common"), F.col("n"), F.col("m"), F.col("most"))).select("doc", "target")


def opened(lists: DataFrame, meets: DataFrame, every: bool) -> DataFrame:
    """Pairs (u, v) of a member of a group and a document that meets it, by what they share of their leading tokens:
    all that may link, or the best of each group. ``lists`` has doc, n, group and tokens."""
    ratio = float(np.log(WHOLE / PART))
    place = F.log("n") / ratio
    members = lists.withColumnRenamed("group", "target")
    members = join_ids(members, meets.select("target").distinct(), "target", "left_semi").withColumn("band", F.floor(place).cast("int"))
    members = stored(members)
    parts = members.groupBy("target", "band").agg(F.ceil(F.sum(F.size("tokens")) / BLOCK_TOKENS).cast("int").alias("parts"))
    parts = stored(parts)
    block = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("block")
    held = attached(members, parts, ["target", "band"], "inner").select("target", "band", block, F.lit(0).alias("side"), "doc", "n", "tokens")
    asked = meets.join(lists.select("doc", "n", "tokens"), "doc")
    # Sizes that fit differ by one band at most.
    bands = F.sequence(F.floor(place - 1 - 1e-9).cast("int"), F.floor(place + 1 + 1e-9).cast("int"))
    asked = attached(asked.withColumn("band", F.explode(bands)), parts, ["target", "band"], "inner")
    blocks = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block")
    asked = asked.select("target", "band", blocks, F.lit(1).alias("side"), "doc", "n", "tokens")
    ship(lists.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, member, tokens, owners = None, None, None, None
        found: tuple[list, ...] = ([], [], [], [])
        docs, ns, lists = [], [], []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("target", "band", "block", "side", "doc", "n"))
            flat = batch.column("tokens")
            ends, values = flat.offsets.to_numpy(), flat.values.to_numpy(zero_copy_only=False)
            for i, (target, band, block, side, doc, n) in enumerate(zip(*columns, strict=True)):
                own = values[ends[i] : ends[i + 1]]
                if (target, band, block) != place:
                    place, member = (target, band, block), None
                    docs, ns, lists = [], [], []
                if side == 0:
                    docs.append(doc)
                    ns.append(n)
                    lists.append(own.copy())
                    continue
                if not docs:
                    continue
                if member is None:
                    member, sizes = np.array(docs), np.array(ns)
                    tokens = np.concatenate(lists)
                    order = np.argsort(tokens, kind="stable")
                    tokens, owners = tokens[order], np.repeat(np.arange(len(docs)), list(map(len, lists)))[order]
                first, last = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
                spans = last - first
                at = np.repeat(first - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
                common = np.bincount(owners[at], minlength=len(docs))
                behind = -(-PART * np.maximum(sizes, n) // WHOLE) - 1
                slack = (WHOLE + PART) * (common + behind) - PART * (sizes + n)
                fits = (common > 0) & (slack >= 0) & (WHOLE * np.minimum(sizes, n) >= PART * np.maximum(sizes, n))
                chosen = np.flatnonzero(fits)
                if len(chosen) and not every:
                    chosen = chosen[[np.argmax(slack[chosen] / (sizes[chosen] + n))]]
                for column, value in zip(found, (member[chosen], np.full(len(chosen), doc), np.full(len(chosen), target), slack[chosen] / (sizes[chosen] + n)), strict=True):
                    column.append(value)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["u", "v", "target", "score"])
                found = ([], [], [], [])

    dealt = held.unionAll(asked).repartition("target", "band", "block").sortWithinPartitions("target", "band", "block", "side")
    pairs = dealt.mapInArrow(count, "u long, v long, target long, score double")
    if every:
        return pairs.select("u", "v")
    best = pairs.groupBy("v", "target").agg(F.max(F.struct("score", "u")).alias("best"))
    return best.select(F.col("best.u").alias("u"), "v")


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every row: its set's size and the smallest key that it reaches
    over links."""
    spark = docs.sparkSession
    hot = hot_tokens(docs, text)
    leading = stored(leading_tokens(docs, key, text, hot))
    known = leading.filter(F.col("doc").isNotNull())
    least = known.filter("n > 0").groupBy("set_hi", "set_lo").agg(F.min("doc").alias("v"), F.max("doc").alias("last"))
    repeated = least.filter("v < last").drop("last")
    equal = stored(known.join(repeated, ["set_hi", "set_lo"]).select(F.col("doc").alias("u"), "v").filter("u <> v"))
    shared = stored(shared_tokens(known.select("doc", "n", "cold", "hot")))
    release(spark)
    stars = shared.filter("doc <> lead").filter(WHOLE * F.least("n", "lead_n") >= PART * F.greatest("n", "lead_n"))
    tried = stored(likely(stars.select(F.col("lead").alias("u"), F.col("doc").alias("v"), F.least("n", "lead_n").alias("n"))))
    links = equal.unionAll(linked(docs, key, text, tried))
    release(spark)
    groups = stored(components(links))
    rows = across_groups(shared, groups)
    meets = stored(meetings(rows, groups))
    release(spark)
    targets = stored(meets.select(F.col("target").alias("group"), F.lit(True).alias("_in")).distinct())
    askers = stored(meets.select("doc", F.lit(True).alias("_asks")).distinct())
    wanted = attached(attached(rows, targets, ["group"]), askers, ["doc"]).filter("_in or _asks")
    lists = stored(wanted.groupBy("doc", "n", "group").agg(F.collect_list("token").alias("tokens")))
    for every in (False, True):
        pairs = opened(lists, meets, every)
        for a, b in (("u", "v"), ("v", "u")):  # what was compared before
            pairs = pairs.join(tried.select(F.col(a).alias("u"), F.col(b).alias("v")), ["u", "v"], "left_anti")
        pairs = stored(pairs)
        found = linked(docs, key, text, pairs)
        release(spark)
        if not found.isEmpty():
            groups = stored(components(groups.select(F.col("node").alias("u"), F.col("component").alias("v")).unionAll(found)))
        if not every:
            tried = tried.unionAll(pairs)
            for column in ("doc", "target"):  # where the two are one group by now, nothing is left to find
                now = groups.select(F.col("node").alias(column), F.col("component").alias(f"_{column}"))
                meets = attached(meets, now, [column])
            meets = stored(meets.filter(F.coalesce("_doc", "doc") != F.coalesce("_target", "target")).select("doc", "target"))
    placed = leading.select("doc", F.col("n").alias("n_shingles")).join(groups.withColumnRenamed("node", "doc"), "doc", "left")
    return placed.select(F.col("doc").alias(key), "n_shingles", F.coalesce("component", "doc").alias("component_id"))
