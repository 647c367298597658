"""Mixing sources to target weights: packed blocks, drawn slots, permuted indices, one join.

Native: DataFrame functions and joins only.

1. Pack: the documents of a source form one stream of words, cut into blocks of ``BLOCK`` words (the last one
   may be shorter).
2. Draw: a source gets as many slots as its target asks for. All slots of all sources are dealt over output
   shards of ``SHARD`` slots by one pseudorandom permutation. The source counts of the shards are then
   multinomial draws given their totals: an unconditional draw for each shard would miss a source's target by
   the square root of its slots, and take some documents more often than allowed.
3. Map: slot i of a source is in epoch i div n of its n blocks, and the epoch's own permutation of 0..n-1
   names the block. The permutations are swap-or-not shuffles (Hoang, Morris, Rogaway 2012), which work on
   any n without tables, so slots are mapped where they are made.
4. Join: blocks and the pieces of documents in them meet by (source, block).

Targets: sources in code-point order, null last, weigh 1, 2, 3 and so on in turn, and share all words; none
gets more than ``MOST`` times its own words, what is left over goes to the others by weight.

Scale: a document's place in its source's stream comes from chunks of about ``CHUNK`` documents (by a hash of
its id and size), so a source of any size is spread over many tasks; one row per chunk is summed in order.
Slots are made from ranges of ``RANGE`` slots, dealt out over as many tasks before they are unrolled. All arithmetic is in whole
numbers, so that runs agree whatever the number of tasks.

Defined cases: a null or empty text has no words and nothing of it is taken; null sources are one source;
null ids are ids like others; rows that are equal in id, source and size lie side by side in the stream and
count each; a table without words has targets of zero. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.ordered import positions
from tablewright.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK, SHARD = 64, 256
CHUNK, RANGE = 4096, 8_192
SEED, ROUNDS = 20_011, 24
# A prime below 2^31: products of two remainders fit into 64 bits.
PRIME = 2_147_483_647


def quotient(a: Column, b: int) -> Column:
    """Whole-number division of 64-bit numbers."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def whole(n: int) -> Column:
    return F.lit(n).cast("bigint")


def scrambled(value: Column, key: Column) -> Column:
    """A pseudorandom number below PRIME from two numbers that are not negative; key is below PRIME."""
    a = (value % PRIME + quotient(value, PRIME) + key) % PRIME
    b = (a * 48_271 + 11) % PRIME
    return ((b * b + key) % PRIME * 69_621) % PRIME


def round_keys(n: Column, stream: Column) -> Column:
    """The swap points of all rounds, each in 0..n-1, for the permutation number ``stream`` of 0..n-1."""
    one = lambda r: scrambled(stream * 64 + r, whole(SEED))
    two = lambda r: scrambled(stream * 64 + r, whole(SEED + 1))
    return F.transform(F.sequence(whole(0), whole(ROUNDS - 1)), lambda r: (one(r) * PRIME + two(r)) % n)


def permuted(index: Column, n: Column, keys: Column) -> Column:
    """The place of ``index`` in a permutation of 0..n-1."""

    def step(x: Column, key: Column) -> Column:
        other = (key - x + n) % n
        coin = quotient(scrambled(F.greatest(x, other), key % PRIME), 65_536) % 2
        return F.when(coin == 1, other).otherwise(x)

    return F.aggregate(keys, index, step)


def measured(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(key, source, size) of every row: its number of words."""
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, idx, weight, n_rows, source_size, target): one row per source; idx from 0."""
    sums = stored(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size")))
    numbered = positions(sums, "source", name="idx").withColumn("idx", F.col("idx") - 1)
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    known = stored(numbered.withColumn("weight", weight))
    cap = F.col("source_size") * most
    level = 0.0
    while True:  # the level rises from round to round, until no further source reaches its limit
        full = cap <= F.col("weight") * level if level else F.lit(False)
        row = known.agg(
            (F.sum("source_size") - F.coalesce(F.sum(F.when(full, cap)), F.lit(0))).cast("double").alias("left"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if not row["weight"] or row["left"] / row["weight"] <= level:
            break
        level = row["left"] / row["weight"]
    share = F.col("weight") * F.lit(level)
    return known.withColumn("target", F.when(cap <= share, cap.cast("double")).otherwise(share))


def quotas(sources: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """The sources with n_blocks, full (whole epochs) and part (slots of the last, unfinished epoch)."""
    n = quotient(F.col("source_size") + block - 1, block)
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("bigint")
    rest = F.col("target") - F.col("source_size") * F.col("full")
    part = F.when(F.col("full") < most, F.least(F.col("n_blocks"), F.floor(rest / block + 0.5).cast("bigint"))).otherwise(0).cast("bigint")
    return sources.withColumn("n_blocks", n).withColumn("full", epochs).withColumn("part", part)


def slots(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, most: int = MOST) -> DataFrame:
    """(shard, place, idx, epoch, block) of every slot of the mix."""
    known = quotas(sources, block, most).filter("n_blocks > 0")
    counted = stored(known.withColumn("slots", F.col("full") * F.col("n_blocks") + F.col("part")))
    # One row per source is summed in source order.
    before = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(counted.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0))))
    total_slots = placed.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    total = whole(total_slots)
    epochs = placed.select("idx", "n_blocks", "first", "full", "part", F.explode(F.sequence(whole(0), whole(most))).alias("epoch"))
    length = F.when(F.col("epoch") < F.col("full"), F.col("n_blocks")).when(F.col("epoch") == F.col("full"), F.col("part")).otherwise(0)
    epochs = epochs.withColumn("length", length).filter("length > 0")
    ranges = epochs.select("*", F.explode(F.sequence(whole(0), quotient(F.col("length") - 1, RANGE))).alias("range"))
    stream = F.col("idx") * (most + 1) + F.col("epoch") + 1
    tasks = max(sources.sparkSession.sparkContext.defaultParallelism, total_slots // RANGE)
    dealt = ranges.repartition(tasks, "idx", "epoch", "range").withColumn("keys", round_keys(F.col("n_blocks"), stream))
    low = F.col("range") * RANGE
    each = dealt.select("*", F.explode(F.sequence(low, F.least(low + RANGE, F.col("length")) - 1)).alias("i"))
    stratum = F.col("first") + F.col("epoch") * F.col("n_blocks") + F.col("i")
    out = permuted(stratum, total, round_keys(total, whole(0)))
    mapped = each.select("idx", "epoch", permuted(F.col("i"), F.col("n_blocks"), F.col("keys")).alias("block"), out.alias("out"))
    return mapped.select(quotient(F.col("out"), shard).alias("shard"), (F.col("out") % shard).alias("place"), "idx", "epoch", "block")


def placed_rows(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(idx, start, key, size): every row with its first word's place in the stream of its source."""
    known = sources.select("source", "idx", "n_rows").withColumnRenamed("source", "_source")
    named = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    mark = F.pmod(F.coalesce(F.col("key"), F.lit(0)).cast("bigint"), F.lit(PRIME))
    chunks = quotient(F.col("n_rows") + CHUNK - 1, CHUNK)
    grouped = named.groupBy("idx", "n_rows", "key", "size").agg(F.count(F.lit(1)).alias("copies"))
    chunked = stored(grouped.withColumn("chunk", scrambled(mark, F.pmod("size", F.lit(PRIME))) % chunks).drop("n_rows"))
    words = F.col("size") * F.col("copies")
    sums = chunked.groupBy("idx", "chunk").agg(F.sum(words).alias("words"))
    by_chunk = Window.partitionBy("idx").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("idx", "chunk", F.coalesce(F.sum("words").over(by_chunk), F.lit(0)).alias("offset"))
    local = Window.partitionBy("idx", "chunk").orderBy(F.col("key").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = chunked.withColumn("local", F.coalesce(F.sum(words).over(local), F.lit(0))).join(offsets, ["idx", "chunk"])
    copy = F.explode(F.sequence(whole(0), F.col("copies") - 1)).alias("copy")
    each = inside.select("idx", "key", "size", (F.col("offset") + F.col("local")).alias("start"), copy)
    return each.select("idx", (F.col("start") + F.col("copy") * F.col("size")).alias("start"), "key", "size")


def mixed(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK, shard: int = SHARD
) -> DataFrame:
    """(key, size, source_size, target, taken) of every row: how many of its words the mix takes, repeats counted."""
    rows = stored(measured(docs, key, source, text))
    sources = stored(targets(rows))
    # Stored, so that the join knows its size: Catalyst's estimate does not see that ranges are unrolled.
    taken = stored(slots(sources, block, shard).groupBy("idx", "block").agg(F.count(F.lit(1)).alias("times")))
    placed = stored(placed_rows(rows, sources))
    end = F.col("start") + F.col("size")
    blocks = F.sequence(quotient(F.col("start"), block), quotient(end - 1, block))
    pieces = placed.filter("size > 0").select("*", F.explode(blocks).alias("block"))
    low = F.col("block") * block
    pieces = pieces.withColumn("words", F.least(low + block, end) - F.greatest(low, F.col("start")))
    met = pieces.join(taken, ["idx", "block"], "left")
    words = F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).alias("taken")
    summed = met.groupBy("idx", "start", "key", "size").agg(words).drop("start")
    empty = placed.filter("size = 0").select("idx", "key", "size", whole(0).alias("taken"))
    joined = summed.unionByName(empty).join(sources.select("idx", "source_size", "target"), "idx")
    return joined.select(F.col("key").alias(key), "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken"))
