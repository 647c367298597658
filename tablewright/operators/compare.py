"""Ranking and comparing models from their metric tables (one row per model)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.ordered import positions
from tablewright.functions.scalar import attach_scalars, col

# Metrics used for ranking regressors and the direction that is better.
REGRESSION_METRICS = {"r2": "higher", "rmse": "lower", "mae": "lower", "cv_rmse": "lower"}
CLASSIFICATION_METRICS = {m: "higher" for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc")}
COLLECTED_METRICS = "mse double, rmse double, mae double, r2 double, cv_rmse double"


def collect_metrics(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Read one JSON document per model; absent metrics are null, unreadable documents are skipped.

    All files are read by one scan; the model name comes from the file it was read from.
    """
    schema = f"{COLLECTED_METRICS}, _corrupt_record string"
    read = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(list(paths.values()))
        .withColumn("_file", F.regexp_replace(F.url_decode(F.input_file_name()), "^file:/+", "file:/"))
    )
    name = F.lit(None).cast("string")
    for model, path in paths.items():
        # Whole paths are compared. A document may be a file or a folder of part files.
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        whole = re.sub("^file:/+", "file:/", files.makeQualified(place).toString())
        name = F.when((F.col("_file") == whole) | F.col("_file").startswith(whole + "/"), model).otherwise(name)
    good = read.filter(F.col("_corrupt_record").isNull())
    return good.select(name.alias("model"), "mse", "rmse", "mae", "r2", "cv_rmse").orderBy(F.desc_nulls_last("r2"), "model")


def stack_metric_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Union one-row metric tables, keeping every metric any of them has."""
    stacked: DataFrame | None = None
    for model, df in tables.items():
        named = df.select(F.lit(model).alias("model"), "*")
        stacked = named if stacked is None else stacked.unionByName(named, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no metric tables given")
    return stacked


def to_long(df: DataFrame, directions: Mapping[str, str], model: str = "model") -> DataFrame:
    """(model, metric, value, badness): smaller badness is better; absent metrics and nulls are left out."""
    cells = [
        F.struct(
            F.lit(m).alias("metric"),
            col(m).cast("double").alias("value"),
            (-col(m).cast("double") if d == "higher" else col(m).cast("double")).alias("badness"),
        )
        for m, d in directions.items()
        if m in df.columns
    ]
    return df.select(col(model).alias("model"), F.inline(F.array(*cells))).filter("value is not null")


def best_per_metric(long: DataFrame) -> DataFrame:
    """(metric, model, score): an arg-min aggregate, no sort."""
    best = long.groupBy("metric").agg(F.min(F.struct("badness", "model", "value")).alias("b"))
    return best.select("metric", F.col("b.model").alias("model"), F.col("b.value").alias("score"))


def rank_per_metric(long: DataFrame) -> DataFrame:
    """(metric, model, value, position), position 1 is best; ties by name."""
    return positions(long, "badness", "model", ["metric"]).select("metric", "model", "value", "position")


def average_rank(long: DataFrame) -> DataFrame:
    """Mean 0-based position over all metrics for models that have every metric, and the overall place."""
    ranked = rank_per_metric(long)
    total = long.select("metric").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    means = ranked.groupBy("model").agg(F.avg(F.col("position") - 1).alias("avg_rank"), F.count(F.lit(1)).alias("_n"))
    return positions(means.filter(F.col("_n") == total).drop("_n"), "avg_rank", "model")


def metric_statistics(long: DataFrame) -> DataFrame:
    """Mean, sample deviation, min and max of every metric."""
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def best_by(df: DataFrame, metric: str, model: str = "model") -> DataFrame:
    """The model with the largest metric (ties: smallest name)."""
    best = df.filter(col(metric).isNotNull()).agg(F.min(F.struct((-col(metric)).alias("k"), col(model).alias("m"), col(metric).alias("v"))).alias("b"))
    return best.select(F.col("b.m").alias("model"), F.col("b.v").alias(metric))


def linearity_hint(df: DataFrame, nonlinear: str = "random_forest", linear: str = "linear_regression", metric: str = "r2") -> DataFrame:
    """Ratio of two models' scores and what it suggests; no hint unless both are positive."""
    pair = df.agg(
        F.max(F.when(F.col("model") == nonlinear, col(metric))).alias("nonlinear"),
        F.max(F.when(F.col("model") == linear, col(metric))).alias("linear"),
    )
    ratio = F.when((F.col("nonlinear") > 0) & (F.col("linear") > 0), F.try_divide("nonlinear", "linear"))
    hint = F.when(F.col("ratio") > 1.2, "nonlinear_better").when(F.col("ratio") < 0.9, "linear_enough").otherwise("none")
    return pair.select("nonlinear", "linear", ratio.alias("ratio")).withColumn("hint", hint)


def insights(df: DataFrame) -> DataFrame:
    """Overall quality band, imbalance flag and deployment suggestions from a classifier table."""
    stats = df.agg(F.avg("f1_score").alias("f1"), F.avg("accuracy").alias("acc"))
    both = attach_scalars(attach_scalars(stats, best_by(df, "f1_score"), "_f"), best_by(df, "roc_auc"), "_a")
    band = F.when(F.col("f1") > 0.8, "excellent").when(F.col("f1") > 0.7, "good").otherwise("needs improvement")
    other = F.col("_a.model").isNotNull() & (F.col("_a.model") != F.col("_f.model"))
    return both.select(
        band.alias("performance"),
        (F.abs(F.col("acc") - F.col("f1")) > 0.1).alias("possible_imbalance"),
        F.col("_f.model").alias("deploy"),
        F.when(other, F.col("_a.model")).alias("consider_for_probabilities"),
    )


def normalised(df: DataFrame, lower_is_better: Sequence[str], keep: Sequence[str] = ("model", "r2")) -> DataFrame:
    """1 - value / max for error metrics, as ``<metric>_normalized``."""
    tops = df.agg(*[F.max(col(m)).alias(m) for m in lower_is_better])
    wide = attach_scalars(df, tops, "_top")
    return wide.select(
        *[col(c) for c in keep], *[(1 - F.try_divide(col(m), F.col("_top")[m])).alias(f"{m}_normalized") for m in lower_is_better]
    )


def rank_matrix(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Model by metric positions; a missing metric counts as models + 1."""
    ranked = rank_per_metric(to_long(df, {m: "higher" for m in metrics}))
    wide = ranked.groupBy("model").agg(*[F.max(F.when(F.col("metric") == m, F.col("position"))).alias(f"_{m}") for m in metrics])
    worst = df.agg((F.count(F.lit(1)) + 1).alias("n")).scalar()
    return df.select("model").join(wide, "model", "left").select("model", *[F.coalesce(F.col(f"_{m}"), worst).alias(m) for m in metrics])


def compare_classifiers(df: DataFrame) -> DataFrame:
    """One row: counts, best model by F1 and metric averages, failures included in the totals."""
    ok = F.col("error").isNull()
    stats = df.agg(
        F.count(F.lit(1)).alias("total_models"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        *[F.avg(F.when(ok, col(m))).alias(f"avg_{m}") for m in CLASSIFICATION_METRICS],
    )
    best = best_by(df.filter(ok), "f1_score").select(F.col("model")).scalar()
    return stats.withColumn("best_model", best)


def rank_by_primary(df: DataFrame, metric: str, group: Sequence[str], tie: str = "model") -> DataFrame:
    """Rank inside each group, best first, missing values last, with the group's lead over the second."""
    ranked = positions(df, metric, tie, group, descending=True, name="rank")
    lead = ranked.filter(F.col("rank") <= 2).groupBy(*[col(g) for g in group]).agg(
        F.max(F.when(F.col("rank") == 1, F.coalesce(col(metric), F.lit(0.0)))).alias("_first"),
        F.max(F.when(F.col("rank") == 2, F.coalesce(col(metric), F.lit(0.0)))).alias("_second"),
    )
    gap = (F.col("_first") - F.col("_second")).alias("performance_gap")
    if not group:
        return attach_scalars(ranked, lead.select(gap), "_g").withColumn("performance_gap", F.col("_g.performance_gap")).drop("_g")
    return ranked.join(lead.select(*[col(g) for g in group], gap), list(group), "left")


def compare_by_type(df: DataFrame, metric: str, type_column: str, tie: str = "model") -> DataFrame:
    """``rank_by_primary`` inside every type that has at least two models."""
    many = df.groupBy(col(type_column)).agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 2").select(col(type_column))
    return rank_by_primary(df.join(many, type_column, "left_semi"), metric, [type_column], tie)


def ranking_report(df: DataFrame, directions: Mapping[str, str]) -> DataFrame:
    """One row with the ranking as a nested document: best per metric, general ranking, best overall.

    Arrays hold one entry per metric or per model of a metric table.
    """
    long = to_long(df, directions)

    def listed(source: DataFrame, *fields: str) -> Column:
        return source.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("x")).scalar()

    overall = average_rank(long)
    return overall.filter("position = 1").select(
        F.col("model").alias("best_overall_model"),
        listed(best_per_metric(long), "metric", "model", "score").alias("best_models"),
        listed(overall, "position", "model", "avg_rank").alias("general_ranking"),
    )


def as_document(report: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return report.select(F.to_json(F.struct(*[col(c) for c in report.columns])).alias("document"))
