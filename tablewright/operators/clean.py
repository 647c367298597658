"""Null profiling, imputation, winsorising."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.ordered import (
    chunk_count,
    by_piece,
    exact_quantiles,
    join_pieces,
    piece_window,
    plan_chunks,
    with_chunk,
    with_piece,
)
from tablewright.functions.scalar import attach_scalars, col, numeric_columns, unpivot
from tablewright.operators.project import drop_null_rows, require_columns

UNKNOWN = "Unknown"


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, percent. One aggregation over one scan."""
    names = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(col(c).isNull()).alias(f"_n_{c}") for c in names])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), col(f"_n_{c}").alias("null_count")) for c in names])
    return wide.select(F.inline(cells), F.col("_n")).select(
        "column_name",
        "null_count",
        F.when(F.col("_n") > 0, 100.0 * F.col("null_count") / F.col("_n")).otherwise(0.0).alias("null_percent"),
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the most frequent value per column; ties give the smallest value, by number in numeric
    columns and by text in others.

    Counts are per distinct value and combined before the shuffle, so neither a frequent value nor a
    column of many values is gathered in one task.
    """
    counted = unpivot(df, [], columns, "column", "value", "string").filter("value is not null")
    counted = counted.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    numbers = [c for c in columns if c in numeric_columns(df)]
    number = F.when(F.col("column").isin(numbers), F.col("value").try_cast("double")) if numbers else F.lit(None).cast("double")
    best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("rows"), number, F.col("value"))).alias("value"))
    return best.agg(
        *[F.coalesce(F.max(F.when(F.col("column") == c, F.col("value"))), F.lit(UNKNOWN)).alias(c) for c in columns]
    )


def medians(df: DataFrame, columns: Sequence[str], small: bool | None = None) -> DataFrame:
    """One row with the exact median per column."""
    found = exact_quantiles(df, columns, [0.5], small=small)
    return found.select(*[col(c)[0].alias(c) for c in columns])


def means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(col(c)).alias(c) for c in columns])


def fill_from(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Fill nulls from a one-row frame whose columns carry the names to fill."""
    names = set(stats.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    wide = attach_scalars(df, stats, "_fill")
    return wide.select(
        *[
            F.coalesce(col(c), F.col("_fill")[c].cast(types[c])).alias(c) if c in names else col(c)
            for c in df.columns
        ]
    )


def impute_mode(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fill_from(df, modes(fit_on if fit_on is not None else df, columns))


def impute_median(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fill_from(df, medians(fit_on if fit_on is not None else df, columns))


def impute_mean(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fill_from(df, means(fit_on if fit_on is not None else df, columns))


def impute_constant(df: DataFrame, columns: Sequence[str], value: float | str = 0) -> DataFrame:
    return df.na.fill(value, subset=list(columns))


def impute_group_median(
    df: DataFrame, group: str, columns: Sequence[str], global_fallback: bool = True, small: bool | None = None
) -> DataFrame:
    """Group median; groups without any value take the median of the already filled column.

    The group table joins unhinted: it has one row per group, so adaptive execution broadcasts it
    when its measured size allows and splits a skewed group otherwise. Null-group rows are kept and
    can only be filled by the fallback.
    """
    per_group = exact_quantiles(df.filter(col(group).isNotNull()), columns, [0.5], group=[group], small=small)
    per_group = per_group.select(col(group), *[col(c)[0].alias(f"_m_{c}") for c in columns])
    joined = df.join(per_group, group, "left")
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = joined.select(
        *[
            F.coalesce(col(c), col(f"_m_{c}").cast(types[c])).alias(c) if c in columns else col(c)
            for c in df.columns
        ]
    )
    if not global_fallback:
        return filled
    return fill_from(filled, medians(filled, columns, small))


def interpolate(
    df: DataFrame, group: str, order: str, tie: str, columns: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """Linear interpolation by row position inside each group, ordered by (order, tie).

    Leading nulls stay null, trailing nulls repeat the last value; rows without a group are left as
    they are. A large input is cut along the
    order key into chunks of about equal size: every chunk is scanned by itself and takes the last
    known value before it and the first known value after it from a summary with one row per group
    and chunk. A group holding a third of all rows is thereby spread over all chunks.
    """
    parts = chunk_count(df) if chunks is None else chunks
    if parts == 1:
        return _interpolate_whole(df, group, order, tie, columns)
    plan = plan_chunks(df, order, tie, parts=parts)
    rows = by_piece(with_piece(with_chunk(df, order, tie, plan), [group]))
    sort = [col(order).asc_nulls_last(), col(tie).asc_nulls_first()]
    chunk = piece_window([group]).orderBy(*sort)
    rows = rows.withColumn("_pos", F.row_number().over(chunk).cast("bigint"))
    known = _known(columns)
    summary = rows.groupBy("_piece", "_chunk", col(group)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max(known[c]).alias(f"_l_{c}") for c in columns],
        *[F.min(known[c]).alias(f"_f_{c}") for c in columns],
    )
    by_chunk = Window.partitionBy("_piece", col(group)).orderBy("_chunk")
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    later = by_chunk.rowsBetween(1, Window.unboundedFollowing)
    summary = summary.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))

    def shifted(name: str):
        edge = col(name)
        return F.when(edge.isNotNull(), F.struct((edge["p"] + F.col("_offset")).alias("p"), edge["v"].alias("v")))

    summary = summary.select(
        "_piece",
        "_chunk",
        col(group),
        "_offset",
        *[shifted(f"_l_{c}").alias(f"_l_{c}") for c in columns],
        *[shifted(f"_f_{c}").alias(f"_f_{c}") for c in columns],
    ).select(
        "_piece",
        "_chunk",
        col(group),
        "_offset",
        *[F.last(col(f"_l_{c}"), ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in columns],
        *[F.first(col(f"_f_{c}"), ignorenulls=True).over(later).alias(f"_after_{c}") for c in columns],
    )
    joined = join_pieces(rows, summary, [group]).withColumn("_pos", F.col("_pos") + F.col("_offset"))
    past = chunk.rowsBetween(Window.unboundedPreceding, 0)
    future = chunk.rowsBetween(0, Window.unboundedFollowing)
    known = _known(columns)
    scanned = joined.select(
        *[col(c) for c in df.columns],
        "_pos",
        *[F.coalesce(F.last(known[c], ignorenulls=True).over(past), col(f"_before_{c}")).alias(f"_p_{c}") for c in columns],
        *[F.coalesce(F.first(known[c], ignorenulls=True).over(future), col(f"_after_{c}")).alias(f"_n_{c}") for c in columns],
    )
    return _between(scanned, group, df.columns, columns)


def _known(columns: Sequence[str]) -> dict:
    """(position, value) of the cells that hold a value."""
    return {c: F.when(col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), col(c).cast("double").alias("v"))) for c in columns}


def _interpolate_whole(df: DataFrame, group: str, order: str, tie: str, columns: Sequence[str]) -> DataFrame:
    ordered = Window.partitionBy(col(group)).orderBy(col(order).asc_nulls_last(), col(tie))
    past = ordered.rowsBetween(Window.unboundedPreceding, 0)
    future = ordered.rowsBetween(0, Window.unboundedFollowing)
    rows = df.withColumn("_pos", F.row_number().over(ordered).cast("bigint"))
    known = _known(columns)
    scanned = rows.select(
        *[col(c) for c in df.columns],
        "_pos",
        *[F.last(known[c], ignorenulls=True).over(past).alias(f"_p_{c}") for c in columns],
        *[F.first(known[c], ignorenulls=True).over(future).alias(f"_n_{c}") for c in columns],
    )
    return _between(scanned, group, df.columns, columns)


def _between(scanned: DataFrame, group: str, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def value(c: str):
        before, after = col(f"_p_{c}"), col(f"_n_{c}")
        slope = (after["v"] - before["v"]) / (after["p"] - before["p"])
        return (
            F.when(col(c).isNotNull(), col(c).cast("double"))
            .when(before.isNull() | col(group).isNull(), F.lit(None).cast("double"))
            .when(after.isNull(), before["v"])
            .otherwise(before["v"] + slope * (F.col("_pos") - before["p"]))
        )

    return scanned.select(*[value(c).alias(c) if c in columns else col(c) for c in names])


def impute_interpolate(
    df: DataFrame, group: str, order: str, tie: str, columns: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """Interpolation, then group median, then the global median."""
    filled = interpolate(df, group, order, tie, columns, chunks)
    return impute_group_median(filled, group, columns)


def winsorize(
    df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99, small: bool | None = None
) -> DataFrame:
    """Clip to exact quantiles; all columns share one statistics pass."""
    stats = exact_quantiles(df, columns, [low, high], small=small)
    wide = attach_scalars(df, stats, "_q")

    def clip(c: str):
        # Null stays null: greatest and least skip nulls.
        edges = F.col("_q")[c]
        return F.when(col(c).isNotNull(), F.greatest(F.least(col(c).cast("double"), edges[1]), edges[0]))

    return wide.select(*[clip(c).alias(c) if c in columns else col(c) for c in df.columns])


@dataclass(frozen=True)
class CleanSpec:
    """Which columns get which treatment. Targets are left alone unless they are listed."""

    mode: Sequence[str] = ()
    zero: Sequence[str] = ()
    median: Sequence[str] = ()
    group_median: Sequence[str] = ()
    interpolate: Sequence[str] = ()
    group: str | None = None
    order: str | None = None
    tie: str | None = None
    required: Sequence[str] = field(default_factory=tuple)
    drop_remaining_nulls: bool = True


# Treatment of the weather columns.
WEATHER_SPEC = CleanSpec(
    mode=("location", "wind_gust_dir", "wind_dir_9am", "wind_dir_3pm", "rain_today"),
    zero=("rainfall", "evaporation", "sunshine"),
    median=("wind_gust_speed", "wind_speed_9am", "wind_speed_3pm", "cloud_9am", "cloud_3pm", "risk_mm"),
    group_median=("humidity_9am", "humidity_3pm", "pressure_9am", "pressure_3pm"),
    interpolate=("temp_9am", "temp_3pm", "min_temp", "max_temp"),
    group="location",
    order="date",
    tie="date",
    required=("rain_tomorrow",),
)


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a ``CleanSpec``; each kind of statistic is gathered once for all of its columns."""
    have = set(df.columns)

    def present(names: Sequence[str]) -> list[str]:
        return [n for n in names if n in have]

    out = df
    if present(spec.mode):
        out = impute_mode(out, present(spec.mode))
    if present(spec.zero):
        out = impute_constant(out, present(spec.zero), 0.0)
    if present(spec.median):
        out = impute_median(out, present(spec.median))
    if present(spec.interpolate):
        require_columns(df, spec.group, spec.order, spec.tie)
        out = interpolate(out, spec.group, spec.order, spec.tie, present(spec.interpolate))
    grouped = [*present(spec.group_median), *present(spec.interpolate)]
    if grouped:
        out = impute_group_median(out, spec.group, grouped)
    if present(spec.required):
        out = drop_null_rows(out, present(spec.required))
    return drop_null_rows(out) if spec.drop_remaining_nulls else out


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows dropped and the percentage kept."""
    n_in = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = after.agg(F.count(F.lit(1)).alias("rows_out")).select(n_in.alias("rows_in"), "rows_out")
    return kept.select(
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("rows_dropped"),
        F.when(F.col("rows_in") > 0, 100.0 * F.col("rows_out") / F.col("rows_in")).otherwise(0.0).alias("kept_percent"),
    )


def drop_sparse_columns(df: DataFrame, max_null_ratio: float = 0.3) -> DataFrame:
    """Drop columns whose null share is above the limit (one aggregation, one row to the driver)."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(df.columns)]
    ).first()
    n = row["n"] or 1
    return df.drop(*[c for i, c in enumerate(df.columns) if row[f"_n_{i}"] / n > max_null_ratio])


def fill_missing(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    numeric_strategy: str = "median",
    categorical_strategy: str = "mode",
) -> DataFrame:
    """Configured fill: mean / median / mode / drop for numbers, mode / unknown / drop for text."""
    fills: Mapping[str, object] = {"mean": impute_mean, "median": impute_median, "mode": impute_mode}
    if numeric:
        df = drop_null_rows(df, numeric) if numeric_strategy == "drop" else fills[numeric_strategy](df, numeric)
    if categorical:
        if categorical_strategy == "drop":
            df = drop_null_rows(df, categorical)
        elif categorical_strategy == "unknown":
            df = impute_constant(df, categorical, UNKNOWN)
        else:
            df = impute_mode(df, categorical)
    return df
