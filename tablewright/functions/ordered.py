"""Exact order-dependent results without ever sorting a whole table, or a whole group, in one task.

Three building blocks live here.

``exact_quantiles``  quantiles per column, globally or per group. A mergeable sketch brackets the
                     wanted ranks, then only the rows inside the bracket are counted and ranked.
``positions``        row_number / rank over a group of any size. The total order is cut into chunks of
                     about equal row counts at real values; every chunk is ranked locally and shifted by
                     the row counts of the chunks before it.
``running_totals``   cumulative sums over a group of any size, by the same chunking.

Plans whose estimated input is small (``spark.tablewright.smallPlanBytes``) use one ordinary
aggregate or window, which is the chunked plan with one chunk. The result is the same either way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalar import attach_scalars, col, md5_bits
from tablewright.session import durable

SMALL_PLAN_CONF = "spark.tablewright.smallPlanBytes"
SMALL_PLAN_BYTES = 64 * 1024 * 1024
CHUNK_ROWS = 1_000_000
# Sampled rows behind each cut.
SAMPLED = 64
SKETCH_ACCURACY = 50_000
# Below this many values a group is ranked whole; above it the sketch margin is tens of ranks wide.
WHOLE_GROUP_VALUES = 1_000_000


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate; it errs on the large side once joins are involved."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get(SMALL_PLAN_CONF, str(SMALL_PLAN_BYTES)))
    return plan_bytes(df) <= limit


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a small table that sits in few files; a large table is left as it is.

    For inputs of iterative or per-row-heavy work only: elsewhere the extra shuffle costs more than
    it brings.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if is_small(df) else df


# --------------------------------------------------------------------------- quantiles


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    group: Sequence[str] = (),
    small: bool | None = None,
    whole_group_values: int = WHOLE_GROUP_VALUES,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Linear-interpolated quantiles: one ``array<double>`` per column, one row per group.

    Nulls are ignored; a column without values gives null. Rows with a null group are ignored.
    """
    for g in group:
        df = df.filter(col(g).isNotNull())
    if small is None:
        small = is_small(df)
    keys = [col(g) for g in group]
    if small:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        return df.groupBy(*keys).agg(*[F.percentile(col(c).cast("double"), wanted).alias(c) for c in columns])
    return _bracketed_quantiles(df, columns, probs, group, whole_group_values, accuracy)


def _bracketed_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    group: Sequence[str],
    whole_group_values: int,
    accuracy: int,
) -> DataFrame:
    keys = [col(g) for g in group]
    margin = 2.0 / accuracy
    edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    brackets = df.groupBy(*keys).agg(
        *[
            F.struct(
                F.count(col(c)).alias("n"),
                F.percentile_approx(col(c).cast("double"), edges, accuracy).alias("edges"),
            ).alias(f"_b_{c}")
            for c in columns
        ]
    )
    if group:
        # Left unhinted: adaptive execution broadcasts the brackets only when they turn out small,
        # and otherwise splits a skewed group on the row side.
        rows = df.join(brackets, list(group), "inner")
    else:
        rows = attach_scalars(df, brackets, "_b")
        rows = rows.select("*", *[F.col("_b")[f"_b_{c}"].alias(f"_b_{c}") for c in columns])

    cells = []
    for c in columns:
        value, found = col(c).cast("double"), F.col(f"`_b_{c}`")
        whole = found["n"] <= whole_group_values
        for i in range(len(probs)):
            low, high = found["edges"][2 * i], found["edges"][2 * i + 1]
            kept = F.when(whole | ((value >= low) & (value <= high)), value)
            # A null value in a cell stands for "below the bracket"; rows above it are dropped.
            cells.append(
                F.when(
                    value.isNotNull() & (whole | (value <= high)),
                    F.struct(F.lit(c).alias("column"), F.lit(i).alias("at"), kept.alias("value"), found["n"].alias("n")),
                )
            )
    long = rows.select(*keys, F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))
    counted = long.groupBy(*keys, "column", "at", "n", "value").agg(F.count(F.lit(1)).alias("rows"))
    ranked = counted.withColumn(
        "seen",
        F.sum("rows").over(Window.partitionBy(*keys, "column", "at").orderBy(F.col("value").asc_nulls_first())),
    )
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("at") + 1)
    rank = prob * (F.col("n") - 1)
    picked = ranked.groupBy(*keys, "column", "at").agg(
        F.first(rank - F.floor(rank)).alias("part"),
        F.min(F.when(F.col("seen") > F.floor(rank), F.struct("value")))["value"].alias("low"),
        F.min(F.when(F.col("seen") > F.ceil(rank), F.struct("value")))["value"].alias("high"),
    )
    missed = F.raise_error(F.lit("quantile bracket missed its rank; raise the sketch accuracy")).cast("double")
    value = F.when(F.col("low").isNull() | F.col("high").isNull(), missed).otherwise(
        F.col("low") + F.col("part") * (F.col("high") - F.col("low"))
    )
    picked = picked.withColumn("quantile", value)
    wide = picked.groupBy(*keys).agg(
        *[
            F.array(
                *[F.max(F.when((F.col("column") == c) & (F.col("at") == i), F.col("quantile"))) for i in range(len(probs))]
            ).alias(c)
            for c in columns
        ]
    )
    arrays = [F.when(col(c)[0].isNotNull(), col(c)).alias(c) for c in columns]
    if not group:
        return wide.select(*arrays)
    # Groups without any value vanish above; bring them back as nulls.
    return brackets.select(*keys).join(wide.select(*keys, *arrays), list(group), "left")


# --------------------------------------------------------------------------- chunks


@dataclass(frozen=True)
class Chunks:
    """Cut points: a stored one-row table with an array of real (order, tie) values, or None for one chunk."""

    cuts: DataFrame | None
    count: int
    descending: bool = False


def _point(order: str, tie: str | None) -> Column:
    return F.struct(col(order).alias("o"), (F.lit(0) if tie is None else col(tie)).alias("t"))


def _precedes(a: Column, b: Column, descending: bool) -> Column:
    """Whether a sorts strictly before b: null orders last, then by tie with nulls first."""
    no = F.lit(False)
    lead = F.coalesce(a["o"] > b["o"] if descending else a["o"] < b["o"], no) | (a["o"].isNotNull() & b["o"].isNull())
    later = F.coalesce(a["t"] < b["t"], no) | (a["t"].isNull() & b["t"].isNotNull())
    return lead | (a["o"].eqNullSafe(b["o"]) & later)


def _sorting(order: Column, tie: Column | None, descending: bool) -> list[Column]:
    lead = order.desc_nulls_last() if descending else order.asc_nulls_last()
    return [lead] if tie is None else [lead, tie.asc_nulls_first()]


def chunk_count(df: DataFrame) -> int:
    """One for a plan that is small by Catalyst's estimate; otherwise from the counted rows.

    Rows are counted wherever the estimate cannot be trusted: Catalyst does not multiply by a generator.
    The number of chunks changes the plan and never the result.
    """
    if is_small(df) and "Generate" not in df._jdf.queryExecution().optimizedPlan().toString():
        return 1
    rows = df.count()
    return max(1 if is_small(df) else 2, math.ceil(rows / CHUNK_ROWS))


def plan_chunks(df: DataFrame, order: str, tie: str | None, descending: bool = False, parts: int | None = None) -> Chunks:
    """Cut the total order (order, tie) into ``parts`` chunks at values met in a sample.

    The cuts are compared as what they are, of any type that sorts, so chunk order is row order: the sample
    decides how even the chunks are and nothing else. Only a repeated (order, tie) pair cannot be cut.
    """
    parts = chunk_count(df) if parts is None else parts
    if parts <= 1:
        return Chunks(None, 1, descending)
    points = df.select(_point(order, tie).alias("p"))
    rows = points.count()
    sample = points.sample(min(1.0, 1.2 * SAMPLED * parts / rows), 17) if rows > SAMPLED * parts else points
    place = F.row_number().over(Window.orderBy(*_sorting(F.col("p.o"), F.col("p.t"), descending)))
    counted = sample.select("p", place.alias("at"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    share = F.floor((F.col("at") - 1) * parts / F.col("n"))
    last = F.floor(F.col("at") * parts / F.col("n"))
    chosen = counted.filter((last > share) & (F.col("at") < F.col("n")))
    cuts = durable(chosen.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "p"))), lambda x: x["p"]).alias("cuts")))
    return Chunks(cuts, parts, descending)


def with_chunk(df: DataFrame, order: str, tie: str | None, chunks: Chunks, name: str = "_chunk") -> DataFrame:
    """Add the chunk number, the number of cuts before the row, by binary search."""
    if chunks.cuts is None:
        return df.withColumn(name, F.lit(0))
    keyed = df.withColumn("_cuts", chunks.cuts.scalar()).withColumn("_point", _point(order, tie))
    cuts, point = F.col("_cuts"), F.col("_point")
    steps = [1 << i for i in reversed(range(chunks.count.bit_length()))]

    def narrowed(low: Column, step: Column) -> Column:
        further = (low + step <= F.size(cuts)) & _precedes(F.get(cuts, low + step - 1), point, chunks.descending)
        return F.when(further, low + step).otherwise(low)

    found = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), narrowed)
    return keyed.withColumn(name, found).drop("_cuts", "_point")


def with_piece(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Add the group hash. It is never null, so rows without a group are kept; equal hashes are told
    apart by the group itself."""
    return rows.withColumn("_piece", F.xxhash64(*[col(g) for g in group]) if group else F.lit(0).cast("bigint"))


def by_piece(rows: DataFrame) -> DataFrame:
    """Shuffle chunked rows once, by (group hash, chunk).

    The local windows and the join that brings carried values back are satisfied by this
    partitioning, so the rows are not shuffled again.
    """
    return rows.repartition("_piece", "_chunk")


def piece_window(group: Sequence[str]):
    return Window.partitionBy("_piece", "_chunk", *[col(g) for g in group])


def join_pieces(rows: DataFrame, summary: DataFrame, group: Sequence[str]) -> DataFrame:
    """Attach a summary with one row per piece. The null-safe comparison of the group columns is kept
    out of the join keys, which would otherwise ask for another shuffle."""
    renamed = summary.withColumnsRenamed({"_piece": "_piece2", "_chunk": "_chunk2", **{g: f"_same_{i}" for i, g in enumerate(group)}})
    on = (F.col("_piece") == F.col("_piece2")) & (F.col("_chunk") == F.col("_chunk2"))
    for i, g in enumerate(group):
        other = F.col(f"_same_{i}")
        on = on & F.coalesce(col(g) == other, col(g).isNull() & other.isNull())
    return rows.join(renamed, on, "inner")


# --------------------------------------------------------------------------- positions


def positions(
    df: DataFrame,
    order: str,
    tie: str | None = None,
    group: Sequence[str] = (),
    descending: bool = False,
    name: str = "position",
    method: str = "row_number",
    chunks: int | None = None,
) -> DataFrame:
    """1-based position inside the group. ``method="rank"`` gives equal values the same position.

    Null order values come last, null ties first. ``chunks`` forces the number of chunks.
    """
    keys = [col(g) for g in group]
    by_rank = method == "rank"
    sort = _sorting(col(order), None if by_rank or tie is None else col(tie), descending)
    parts = chunk_count(df) if chunks is None else chunks
    if parts == 1:
        local = F.rank() if by_rank else F.row_number()
        return df.withColumn(name, local.over(Window.partitionBy(*keys).orderBy(*sort)).cast("bigint"))
    if by_rank:
        return _ranks(df, order, group, descending, name, parts)
    plan = plan_chunks(df, order, tie, descending, parts)
    chunked = with_piece(with_chunk(df, order, tie, plan), group)
    # Counted before the shuffle: one small row per task, group and chunk.
    sizes = chunked.groupBy("_piece", "_chunk", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_piece", *keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_piece", "_chunk", *keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    ranked = by_piece(chunked).withColumn("_local", F.row_number().over(piece_window(group).orderBy(*sort)))
    placed = (F.col("_local") + F.col("_offset")).cast("bigint").alias(name)
    return join_pieces(ranked, offsets, group).select(*[col(c) for c in df.columns], placed)


def _ranks(df: DataFrame, order: str, group: Sequence[str], descending: bool, name: str, parts: int) -> DataFrame:
    """Ranks from counts: equal values are combined before any shuffle, summed up once, and joined back."""
    named = [col(g).alias(f"_key_{i}") for i, g in enumerate(group)]
    keys = [f"_key_{i}" for i in range(len(group))]
    counted = df.groupBy(*named, col(order).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    summed = running_totals(counted, "_value", {"_seen": "_rows"}, keys, descending, parts)
    starts = summed.select(*keys, "_value", (F.col("_seen") - F.col("_rows") + 1).cast("bigint").alias("_rank"))
    on = col(order).eqNullSafe(F.col("_value"))
    for i, g in enumerate(group):
        on = on & col(g).eqNullSafe(F.col(f"_key_{i}"))
    return df.join(starts, on, "left").select(*[col(c) for c in df.columns], F.col("_rank").alias(name))


def previous_values(
    df: DataFrame,
    order: str,
    tie: str,
    columns: dict[str, str],
    group: Sequence[str] = (),
    steps: int = 1,
    chunks: int | None = None,
) -> DataFrame:
    """Values ``{output: input}`` of the row ``steps`` positions earlier in the group, null at its start.

    The large form numbers the rows and joins every position to the one before on (group, position),
    so the pairing is spread over all keys.
    """
    keys = [col(g) for g in group]
    chunks = chunk_count(df) if chunks is None else chunks
    if chunks == 1:
        sort = Window.partitionBy(*keys).orderBy(*_sorting(col(order), col(tie), False))
        return df.select("*", *[F.lag(col(src), steps).over(sort).alias(out) for out, src in columns.items()])
    placed = positions(df, order, tie, group, name="_pos", chunks=chunks)
    earlier = placed.select(
        *[col(g).alias(f"_same_{i}") for i, g in enumerate(group)],
        (F.col("_pos") + steps).alias("_pos2"),
        *[col(src).alias(out) for out, src in columns.items()],
    )
    on = F.col("_pos") == F.col("_pos2")
    for i, g in enumerate(group):
        on = on & col(g).eqNullSafe(F.col(f"_same_{i}"))
    return placed.join(earlier, on, "left").select(*[col(c) for c in df.columns], *columns)


# --------------------------------------------------------------------------- running totals


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    group: Sequence[str] = (),
    descending: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Inclusive cumulative sums ``{output: input}`` by ``order``, whose values are unique per group."""
    keys = [col(g) for g in group]
    sort = _sorting(col(order), None, descending)[0]
    parts = chunk_count(df) if chunks is None else chunks
    if parts == 1:
        frame = Window.partitionBy(*keys).orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(col(src)).over(frame).alias(out) for out, src in sums.items()])

    plan = plan_chunks(df, order, None, descending, parts)
    chunked = with_piece(with_chunk(df, order, None, plan), group)
    totals = chunked.groupBy("_piece", "_chunk", *keys).agg(*[F.sum(col(src)).alias(f"_t_{out}") for out, src in sums.items()])
    before = Window.partitionBy("_piece", *keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "_piece", "_chunk", *keys, *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_c_{out}") for out in sums]
    )
    local = piece_window(group).orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
    summed = by_piece(chunked).select("*", *[F.sum(col(src)).over(local).alias(f"_l_{out}") for out, src in sums.items()])
    return join_pieces(summed, carried, group).select(
        *[col(c) for c in df.columns], *[(F.col(f"_l_{out}") + F.col(f"_c_{out}")).alias(out) for out in sums]
    )


# --------------------------------------------------------------------------- thresholds


def nth_keys(df: DataFrame, order: str, tie: str, ranks: Sequence[int], chunks: int | None = None) -> list[tuple | None]:
    """The (order, tie) pairs at 1-based positions of the whole table, null orders last; None off the table.

    Rows are counted by chunk; only the chunks that hold a wanted position are ranked.
    """
    plan = plan_chunks(df, order, tie, parts=chunks)
    chunked = with_chunk(df.select(col(order).alias("_o"), col(tie).alias("_t")), "_o", "_t", plan)
    sizes = sorted((r["_chunk"], r["count"]) for r in chunked.groupBy("_chunk").count().collect())
    wanted: list[tuple[int, int, int]] = []
    for at, rank in enumerate(ranks):
        seen = 0
        for chunk, rows in sizes:
            if seen < rank <= seen + rows:
                wanted.append((at, chunk, rank - seen))
            seen += rows
    found: list[tuple | None] = [None] * len(ranks)
    if not wanted:
        return found
    local = Window.partitionBy("_chunk").orderBy(*_sorting(F.col("_o"), F.col("_t"), False))
    needed = chunked.filter(F.col("_chunk").isin(sorted({c for _, c, _ in wanted}))).withColumn("_n", F.row_number().over(local))
    hit = F.lit(False)
    for _, chunk, rank in wanted:
        hit = hit | ((F.col("_chunk") == chunk) & (F.col("_n") == rank))
    rows = {(r["_chunk"], r["_n"]): (r["_o"], r["_t"]) for r in needed.filter(hit).collect()}
    for at, chunk, rank in wanted:
        found[at] = rows[chunk, rank]
    return found


def nth_key(df: DataFrame, order: str, tie: str, n: int, chunks: int | None = None) -> tuple | None:
    """The (order, tie) pair at 1-based position ``n`` of the whole table, or None off the table."""
    return nth_keys(df, order, tie, [n], chunks)[0]


def at_or_before(order: Column, tie: Column, key: tuple | None) -> Column:
    """True for rows whose (order, tie) does not come after ``key``, else false: null orders come last, null
    ties first."""
    if key is None:
        return F.lit(False)
    tied = tie.isNull() if key[1] is None else (tie.isNull() | (tie <= F.lit(key[1])))
    if key[0] is None:
        return order.isNotNull() | tied
    return F.coalesce((order < F.lit(key[0])) | ((order == F.lit(key[0])) & tied), F.lit(False))


def hash_thresholds(
    df: DataFrame, key: str, ranks: Column, group: Sequence[str] = (), bits: int = 16
) -> DataFrame:
    """For every group, the (hash, key) pairs found at the wanted positions of the md5 order.

    ``ranks`` is an array of 1-based positions computed from the group's row count ``n``. Counting by
    the first ``bits`` of the hash finds the slot that holds each position; only the rows of that
    slot (about n / 2**bits) are ranked. Output: group columns and ``cuts``, an array of structs
    (hash, key) in the order of ``ranks``; a position below 1 gives a struct of nulls.
    """
    keys = [col(g) for g in group]
    # Null keys hash to 0 and sort first, so that they fall on one side and no row is lost.
    hashed = df.select(*keys, col(key).alias("_key"), F.coalesce(md5_bits(col(key)), F.lit(0)).alias("_hash"))
    hashed = hashed.withColumn("_slot", F.shiftright("_hash", 32 - bits))
    slots = hashed.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    frame = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    slots = slots.withColumn("_seen", F.sum("_rows").over(frame)).withColumn("n", F.sum("_rows").over(Window.partitionBy(*keys)))
    wanted = (
        slots.select("*", F.posexplode(ranks).alias("_at", "_rank"))
        .filter((F.col("_rank") <= F.col("_seen")) & (F.col("_rank") > F.col("_seen") - F.col("_rows")))
        .select(*keys, "_slot", "_at", (F.col("_rank") - (F.col("_seen") - F.col("_rows"))).alias("_inside"))
        .groupBy(*keys, "_slot")
        .agg(F.collect_list(F.struct("_at", "_inside")).alias("_wants"))
        .withColumnsRenamed({"_slot": "_slot2", **{g: f"_same_{i}" for i, g in enumerate(group)}})
    )
    # A label may be null, so it is compared null-safely.
    on = F.col("_slot") == F.col("_slot2")
    for i, g in enumerate(group):
        on = on & col(g).eqNullSafe(F.col(f"_same_{i}"))
    in_slot = Window.partitionBy(*keys, "_slot").orderBy("_hash", "_key")
    hits = (
        hashed.join(wanted, on, "inner")
        .withColumn("_pos", F.row_number().over(in_slot))
        .select("*", F.explode("_wants").alias("_want"))
        .filter(F.col("_want._inside") == F.col("_pos"))
    )
    return hits.groupBy(*keys).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("_want._at"), F.struct(F.col("_hash").alias("hash"), F.col("_key").alias("key"))))
        ).alias("cuts")
    )
