"""The prefix trie of sequences, built by van Emde Boas recursion over depths.

A sequence is a key with numbered symbols (``pos`` from 1). Its prefixes are the nodes of a trie; a node is
named by its depth and the smallest key among its members, so that names need no dictionary.

1. Cut: the depths are halved, and halved again, down to single steps. At a cut every prefix of half the length
   gets its name: sequences with one name above and the same symbols up to the cut are one prefix. The upper
   trie goes on with one representative a prefix, the lower forests with the remainders below each name; all
   blocks of one size are cut together, in one job a round. A block with one sequence left below its root has
   nothing to share and is written out as a chain at once.
2. Graft: neighbouring blocks are joined again, from single steps upwards. The totals of the lower trees are
   summed at the cut node above them and added to that node and its ancestors in the upper block, whose list
   doubles from round to round. Only nodes with two members or more take part: below a node with one member
   there is one leaf and nothing to save.

So d steps take log2 d rounds each way, every row is one symbol or one node, and no sequence and no node's
members are gathered in one place. Symbols are compared by 128 bits. Equal sequences are one sequence from the
first step on; their keys are joined to text in ranges of 4,096 keys, and only nodes that end more than one
range of keys hash their texts in order, streamed, in one task a node.

Defined cases: a key without symbols is a member of the root alone and ends there; null keys are left out;
positions must run from 1 without gaps; an empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored

# Keys that are joined to one text: 2^12 neighbouring numbers.
RANGE_BITS = 12


def symbols(turns: DataFrame, key: str, pos: str, content: list[str], worth: Column) -> DataFrame:
    """(seq, pos, a, b, words): 128 bits that stand for the content at a position, and what sharing it saves."""
    parts = [F.col(c) for c in content]
    first, second = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    rows = turns.filter(F.col(key).isNotNull())
    return rows.select(
        F.col(key).alias("seq"), F.col(pos).cast("bigint").alias("pos"), F.xxhash64(pos, first, second).alias("a"),
        F.xxhash64(second, pos, first).alias("b"), worth.cast("bigint").alias("words"),
    )


def _digest() -> list[Column]:
    """Every symbol's bits hold its position, so their exclusive or stands for the run, whatever the order of rows."""
    return [F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")]


def cut_blocks(rows: DataFrame, distinct: DataFrame, deepest: int) -> tuple[DataFrame, DataFrame]:
    """Chains (seq, low, high, root, n_convs) of nodes at depths low + 1 to high, all named ``seq``, the first below
    the node named ``root``; and ends (seq, depth, name), the node at which each distinct sequence ends.

    ``distinct`` has seq, n (its length), weight (keys with this sequence) and root.
    """
    # ``open``: the row's own sequence ends at n, and its end has not been told yet.
    blocks = stored(distinct.select(F.lit(0).cast("bigint").alias("start"), "root", "seq", "weight", "n", F.lit(True).alias("open")))
    chains, ends = [], []
    size = 1 << max(deepest - 1, 0).bit_length()
    while not chains or not blocks.isEmpty():
        alone = blocks.groupBy("start", "root").agg(
            F.min("seq").alias("seq"), F.max("seq").alias("last"), F.first("weight").alias("weight"), F.first("n").alias("n"), F.first("open").alias("open")
        )
        alone = stored(alone.filter("seq = last"))
        chains.append(alone.select("seq", F.col("start").alias("low"), F.col("n").alias("high"), "root", F.col("weight").alias("n_convs")))
        ends.append(alone.filter("open").select("seq", F.col("n").alias("depth"), F.col("seq").alias("name")))
        shared = blocks.join(alone.select("seq", "start"), ["seq", "start"], "left_anti")
        half = max(size // 2, 1)
        # The runs of the upper halves, one row for each sequence and block.
        base = F.col("pos") - 1 - (F.col("pos") - 1) % size
        upper = rows.filter((F.col("pos") - 1) % size < half).groupBy("seq", base.alias("start")).agg(*_digest())
        known = stored(shared.join(upper, ["seq", "start"]).withColumn("top", F.least("n", F.col("start") + half)))
        prefix = ["start", "root", "a", "b", "top"]
        full = F.col("top") == F.col("start") + half
        names = known.groupBy(*prefix).agg(F.min("seq").alias("name"), F.sum("weight").alias("sum"), F.first("open").alias("single"))
        names = stored(names)
        met = stored(known.filter(full).join(names.select(*prefix, "name"), prefix).select("start", "seq", "weight", "n", "open", "name"))
        cut = F.col("start") + half
        ends.append(met.filter(F.col("open") & (F.col("n") == cut)).select("seq", cut.alias("depth"), "name"))
        if size == 1:
            chains.append(names.select(F.col("name").alias("seq"), F.col("start").alias("low"), F.col("top").alias("high"), "root", F.col("sum").alias("n_convs")))
            break
        # A prefix that reaches the cut stands for its members; one that ends before it is a sequence of its own.
        above = names.select("start", "root", F.col("name").alias("seq"), F.col("sum").alias("weight"), F.col("top").alias("n"), (~full & F.col("single")).alias("open"))
        below = met.filter(F.col("n") > cut).select(cut.alias("start"), F.col("name").alias("root"), "seq", "weight", "n", "open")
        blocks = stored(above.unionByName(below))
        size = half
    return _union(chains), _union(ends)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def graft(shared: DataFrame, deepest: int) -> DataFrame:
    """(depth, name, leaves, saved) summed over every node's subtree. ``shared`` has depth, name, up, leaves, saved:
    the own values of the nodes, all of whose children that are not in the table count among ``leaves``."""
    totals = stored(shared)
    # Ancestors of the nodes at multiples of ``half``, themselves first, and the node ``half`` steps above them.
    lists = shared.select("depth", "name", F.col("depth").alias("at"), F.col("name").alias("ancestor"))
    steps = shared.select("depth", "name", F.col("up").alias("above"))
    half = 1
    while half < deepest:
        cut = F.col("depth") - 1
        tops = totals.filter((cut % (2 * half) == half)).groupBy(cut.alias("depth"), F.col("up").alias("name"))
        sums = tops.agg(F.sum("leaves").alias("more"), F.sum("saved").alias("further"))
        met = sums.join(lists, ["depth", "name"]).groupBy(F.col("at").alias("depth"), F.col("ancestor").alias("name"))
        added = met.agg(F.sum("more").alias("more"), F.sum("further").alias("further"))
        more = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in (("leaves", "more"), ("saved", "further"))]
        totals = stored(totals.join(added, ["depth", "name"], "left").select("depth", "name", "up", *more))
        if 2 * half < deepest:
            even = stored(steps.filter(F.col("depth") % (2 * half) == 0))
            kept = lists.join(even.select("depth", "name"), ["depth", "name"], "left_semi")
            to = even.select("depth", "name", (F.col("depth") - half).alias("_depth"), F.col("above").alias("_name"))
            upper = lists.select(F.col("depth").alias("_depth"), F.col("name").alias("_name"), "at", "ancestor")
            farther = steps.select(F.col("depth").alias("_depth"), F.col("name").alias("_name"), F.col("above").alias("_above"))
            lists = stored(kept.unionByName(to.join(upper, ["_depth", "_name"]).select(*kept.columns)))
            steps = stored(to.join(farther, ["_depth", "_name"]).select("depth", "name", F.col("_above").alias("above")))
        half *= 2
    return totals.select("depth", "name", "leaves", "saved")


def key_digests(members: DataFrame) -> DataFrame:
    """(group, sha256) of the ascending keys of every group, in decimal and joined by commas."""
    bucket = F.shiftright("key", RANGE_BITS).alias("bucket")
    texts = members.groupBy("group", bucket).agg(F.array_join(F.array_sort(F.collect_list("key")).cast("array<string>"), ",").alias("keys"))
    texts = stored(texts)
    sums = texts.groupBy("group").agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"), F.min("keys").alias("keys"))
    sums = stored(sums)
    one = sums.filter("first = last").select("group", F.sha2("keys", 256).alias("sha256"))
    long = texts.join(sums.filter("first < last").select("group"), "group", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([state.hexdigest()])], ["group", "sha256"])

        for batch in batches:
            for group, keys in zip(batch.column("group").to_pylist(), batch.column("keys"), strict=True):
                if group != place:
                    if state is not None:
                        yield row()
                    place, state = group, hashlib.sha256(keys.as_py().encode())
                else:
                    state.update(b"," + keys.as_py().encode())
        if state is not None:
            yield row()

    ordered = long.repartition("group").sortWithinPartitions("group", "bucket").select("group", "keys")
    return one.unionByName(ordered.mapInArrow(run, "group long, sha256 string"))


def trie(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per node: depth, conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. ``rows`` as ``symbols`` makes them; ``keys`` (seq) names all sequences, also
    those without symbols."""
    rows = stored(rows)
    runs = rows.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), *_digest())
    whole = keys.filter("seq is not null").distinct().join(runs, "seq", "left")
    whole = stored(whole.select("seq", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n", "a", "b")]))
    first = whole.agg(F.min("seq"), F.max("n"), F.count(F.lit(1))).first()
    root, deepest, total = first
    sequence = ["n", "a", "b"]
    same = whole.groupBy(*sequence).agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("weight"))
    same = stored(same)
    # The group of equal sequences goes by its smallest key.
    repeated = same.filter("weight > 1").select(*sequence, F.col("seq").alias("group"))
    members = whole.join(repeated, sequence).select("group", F.col("seq").alias("key"))
    members = members.unionByName(same.filter("weight = 1").select(F.col("seq").alias("group"), F.col("seq").alias("key")))
    digests = key_digests(members)

    here = F.lit(root).cast("bigint")
    distinct = same.filter("n > 0").select("seq", "n", "weight", here.alias("root"))
    chains, ends = cut_blocks(rows, distinct, deepest or 0)
    depth = F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("depth")
    steps = chains.select("seq", "low", "root", "n_convs", depth)
    words = rows.select("seq", F.col("pos").alias("depth"), "words")
    up = F.when(F.col("depth") == F.col("low") + 1, F.col("root")).otherwise(F.col("seq"))
    nodes = stored(steps.join(words, ["seq", "depth"]).select("depth", F.col("seq").alias("name"), up.alias("up"), "n_convs", "words"))
    top = rows.sparkSession.range(1).filter(F.lit(bool(total))).select(
        F.lit(0).cast("bigint").alias("depth"), here.alias("name"), F.lit(None).cast("bigint").alias("up"),
        F.lit(total).cast("bigint").alias("n_convs"), F.lit(0).cast("bigint").alias("words"),
    )
    nodes = nodes.unionByName(top)

    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("name"))
    children = below.agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("solo"))
    known = stored(nodes.join(children, ["depth", "name"], "left").na.fill(0, ["n_children", "solo"]))
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("solo")).cast("bigint").alias("leaves")
    own = known.filter("n_convs > 1 or depth = 0").select("depth", "name", "up", leaves, ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    own = stored(own)
    depths = own.agg(F.max("depth")).first()[0] or 0
    totals = graft(own.filter("depth > 0"), depths)
    # The root lies above all blocks: its children's totals are the last to be grafted.
    first_level = own.filter("depth = 1").select("depth", "name").join(totals, ["depth", "name"])
    rest = first_level.select("leaves", "saved").unionByName(own.filter("depth = 0").select("leaves", "saved"))
    at_root = rest.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select(
        F.lit(0).cast("bigint").alias("depth"), here.alias("name"), "leaves", "saved"
    )
    told = ends.select("depth", "name", F.col("seq").alias("group")).unionByName(
        same.filter("n = 0").select(F.lit(0).cast("bigint").alias("depth"), here.alias("name"), F.col("seq").alias("group"))
    )
    ended = told.join(digests, "group").select("depth", "name", "sha256")
    out = known.join(totals.unionByName(at_root), ["depth", "name"], "left").join(ended, ["depth", "name"], "left")
    return out.select(
        "depth",
        F.col("name").alias("conv_id"),
        F.col("up").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
