"""Snapshots, quality checks, outliers, drift and monitoring."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ordered import exact_quantiles, positions, previous_values, running_totals
from tablewright.functions.scalar import attach_scalars, col, row_digest
from tablewright.operators.association import chi_square


def version_name(moment: datetime) -> str:
    return moment.strftime("v_%Y%m%d_%H%M%S")


def snapshot_metadata(df: DataFrame, version: str, date: str | None = None) -> DataFrame:
    """One row: shape, order-free content hash, columns, nulls per column, date range. One scan."""
    nulls = [F.count_if(col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    span = [] if date is None else [F.min(col(date)).alias("date_start"), F.max(col(date)).alias("date_end")]
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(row_digest(df)).alias("data_hash"),
        *nulls,
        *span,
    ).select(F.lit(version).alias("version"), F.lit(len(df.columns)).alias("column_count"), F.lit(",".join(df.columns)).alias("columns"), "*")


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def missing_features(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)


def quality_report(
    df: DataFrame,
    split: str,
    label: str,
    features: Sequence[str],
    test_features: Sequence[str] | None = None,
    max_missing: float = 0.1,
    min_class: float = 0.05,
) -> DataFrame:
    """One row per check: (check_name, value, level, passed). ``split`` is true for training rows.

    All counts come from two aggregations: one over the rows, one over the label counts.
    """
    train, test = col(split), ~col(split)
    cells = sum((F.when(train & col(c).isNull(), 1).otherwise(0) for c in features), F.lit(0))
    facts = df.agg(
        F.count_if(train).alias("train"), F.count_if(test).alias("test"), F.coalesce(F.sum(cells), F.lit(0)).alias("missing")
    )
    counts = df.filter(train & col(label).isNotNull()).groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
    smallest = counts.agg((F.try_divide(F.min("n"), F.sum("n"))).alias("share"))
    wide = attach_scalars(facts, smallest, "_c")
    ratio = F.try_divide(F.col("test"), F.col("train") + F.col("test"))
    missing = F.try_divide(F.col("missing"), F.col("train") * len(features))
    matching = test_features is None or set(features) == set(test_features)

    def check(name: str, value: Column, level: str, ok: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"), value.cast("double").alias("value"), F.lit(level).alias("level"), F.coalesce(ok, F.lit(True)).alias("passed")
        )

    nonempty = (F.col("train") > 0) & (F.col("test") > 0)
    return wide.select(
        F.inline(
            F.array(
                check("non_empty", F.least("train", "test"), "error", nonempty),
                check("test_ratio", ratio, "warning", (ratio >= 0.1) & (ratio <= 0.5)),
                check("same_features", F.lit(1 if matching else 0), "error", F.lit(matching)),
                check("missing_ratio", missing, "warning", missing <= max_missing),
                check("class_share", F.col("_c.share"), "warning", F.col("_c.share") >= min_class),
            )
        )
    )


def report_verdict(report: DataFrame) -> DataFrame:
    """Overall result: failed errors fail the report, failed warnings are only listed."""
    bad = ~F.col("passed")

    def names(level: str) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(bad & (F.col("level") == level), F.col("check_name")))), ",")

    return report.agg(
        (F.count_if(bad & (F.col("level") == "error")) == 0).alias("passed"), names("error").alias("errors"), names("warning").alias("warnings")
    )


def class_balance(df: DataFrame, label: str, min_samples: int = 1000, max_ratio: float = 10.0) -> DataFrame:
    counts = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("samples"),
        (F.sum("n") >= min_samples).alias("enough_samples"),
        F.try_divide(F.max("n"), F.min("n")).alias("imbalance"),
        (F.try_divide(F.max("n"), F.min("n")) <= max_ratio).alias("balanced"),
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5, small: bool | None = None) -> DataFrame:
    """Rows outside the Tukey fences, per column."""
    q = exact_quantiles(df, columns, [0.25, 0.75], small=small)
    wide = attach_scalars(df.select(*[col(c) for c in columns]), q, "_q")
    flags = []
    for c in columns:
        a, b = F.col("_q")[c][0], F.col("_q")[c][1]
        flags.append(F.count_if((col(c) < a - k * (b - a)) | (col(c) > b + k * (b - a))).alias(c))
    return _long_counts(wide.agg(*flags), columns)


def zscore_outliers(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Rows more than ``limit`` population deviations from the mean, per column."""
    stats = df.agg(*[F.struct(F.avg(col(c)).alias("m"), F.stddev_pop(col(c)).alias("s")).alias(c) for c in columns])
    wide = attach_scalars(df.select(*[col(c) for c in columns]), stats, "_s")
    return _long_counts(
        wide.agg(*[F.count_if(F.abs(col(c) - F.col("_s")[c]["m"]) > F.col("_s")[c]["s"] * limit).alias(c) for c in columns]), columns
    )


def _long_counts(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), col(c).alias("outliers")) for c in columns]))
    )


# ------------------------------------------------------------------ drift


def ks_statistic(df: DataFrame, value: str, is_reference: Column, chunks: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and the asymptotic critical value at 5 %.

    Values are reduced to counts per distinct value before the cumulative pass.
    """
    counts = df.filter(col(value).isNotNull()).groupBy(col(value).alias("v")).agg(
        F.count_if(is_reference).alias("a"), F.count_if(~is_reference).alias("b")
    )
    cumulated = running_totals(counts, "v", {"ca": "a", "cb": "b"}, chunks=chunks)
    totals = counts.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    wide = attach_scalars(cumulated, totals, "_n")
    gap = F.abs(F.try_divide(F.col("ca"), F.col("_n.na")) - F.try_divide(F.col("cb"), F.col("_n.nb")))
    # Fixed value: 1.3581 is the 5 % point of the Kolmogorov distribution.
    critical = F.lit(1.3581) * F.sqrt(F.try_divide(F.col("na") + F.col("nb"), F.col("na").cast("double") * F.col("nb")))
    return wide.agg(F.max(gap).alias("statistic"), F.first("_n").alias("_n")).select(
        "statistic", "_n.na", "_n.nb"
    ).select("statistic", critical.alias("critical"), (F.col("statistic") > critical).alias("drifted"))


def population_stability(df: DataFrame, value: str, is_reference: Column, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """PSI over equal-width bins of the reference range; values outside go to the end bins."""
    ref = F.when(is_reference, col(value))
    edges = df.agg(F.min(ref).cast("double").alias("lo"), F.max(ref).cast("double").alias("hi"))
    wide = attach_scalars(df.filter(col(value).isNotNull()).select(col(value).alias("v"), is_reference.alias("r")), edges, "_e")
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    spot = F.when(hi == lo, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))))
    counts = wide.groupBy(spot.cast("int").alias("bin")).agg(F.count_if(F.col("r")).alias("a"), F.count_if(~F.col("r")).alias("b"))
    totals = counts.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    every = edges.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).join(counts, "bin", "left")
    parts = attach_scalars(every, totals, "_n")
    p = F.greatest(F.lit(floor), F.coalesce(F.try_divide(F.col("a"), F.col("_n.na")), F.lit(0.0)))
    q = F.greatest(F.lit(floor), F.coalesce(F.try_divide(F.col("b"), F.col("_n.nb")), F.lit(0.0)))
    return parts.agg(F.sum((p - q) * F.log(p / q)).alias("psi"))


def category_drift(df: DataFrame, columns: Sequence[str], is_reference: Column) -> DataFrame:
    """Chi-square test of every category against the period."""
    return chi_square(df.withColumn("_period", is_reference), columns, "_period")


def target_drift(df: DataFrame, target: str, is_reference: Column) -> DataFrame:
    return df.agg(F.avg(F.when(is_reference, col(target))).alias("reference"), F.avg(F.when(~is_reference, col(target))).alias("current")).select(
        "reference", "current", (F.col("current") - F.col("reference")).alias("change")
    )


# ------------------------------------------------------------------ monitoring

# Metric -> (relative change that triggers retraining, better direction).
RETRAIN_LIMITS = {"f1_score": (0.05, "higher"), "rmse": (0.10, "lower"), "accuracy": (0.03, "higher")}


def metric_trend(df: DataFrame, model: str, order: str, tie: str, metric: str, chunks: int | None = None) -> DataFrame:
    """Change of a metric against the model's run before."""
    out = previous_values(df, order, tie, {"previous": metric}, [model], chunks=chunks)
    return out.withColumn("change", col(metric) - F.col("previous"))


def retrain_triggers(df: DataFrame, model: str, order: str, tie: str, metric: str, limits=RETRAIN_LIMITS) -> DataFrame:
    """Runs whose metric got worse by more than its relative limit."""
    limit, better = limits[metric]
    trend = metric_trend(df, model, order, tie, metric)
    worse = -F.col("change") if better == "higher" else F.col("change")
    return trend.withColumn("retrain", F.coalesce(worse > F.abs(F.col("previous")) * limit, F.lit(False)))


def freshness(df: DataFrame, moment: str, as_of: Column) -> DataFrame:
    return df.agg(F.max(col(moment)).alias("newest")).select("newest", F.datediff(as_of, F.col("newest")).alias("age_days"))


def quality_score(report: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Share of passed checks; errors weigh twice a warning."""
    weight = F.when(F.col("level") == "error", 2.0).otherwise(1.0)
    score = F.try_divide(F.sum(F.when(F.col("passed"), weight).otherwise(0.0)), F.sum(weight))
    return report.agg(score.alias("score"), (score >= threshold).alias("acceptable"))


def keep_snapshots(df: DataFrame, dataset: str, created: str, tie: str, keep: int = 30) -> DataFrame:
    """Mark the newest ``keep`` snapshots of every dataset."""
    ranked = positions(df, created, tie, [dataset], descending=True, name="_age")
    return ranked.withColumn("kept", F.col("_age") <= keep).drop("_age")


def weighted_winner(
    df: DataFrame, group: str, primary: str, secondary: str, complexity: str, created: str, name: str,
    weights: tuple[float, float, float] = (0.7, 0.2, 0.1),
) -> DataFrame:
    """Best weighted score per group; equal scores go to the latest model."""
    score = col(primary) * weights[0] + col(secondary) * weights[1] + (1 - col(complexity)) * weights[2]
    best = df.withColumn("_score", F.round(score, 9)).filter(F.col("_score").isNotNull()).groupBy(col(group)).agg(
        F.max(F.struct(F.col("_score"), col(created).alias("_created"), col(name).alias("_name"))).alias("b")
    )
    return best.select(col(group), F.col("b._name").alias("winner"), F.col("b._score").alias("score"))
