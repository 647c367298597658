"""Gaussian naive Bayes as two aggregations and a parameter table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import attach_scalars, col

LOG_TWO_PI = 1.8378770664093453


def fit_gaussian(df: DataFrame, features: Sequence[str], label: str, smoothing: float = 1e-9) -> DataFrame:
    """One row per class: label, log_prior, means, variances (arrays in feature order).

    Every variance gets ``smoothing`` times the largest feature variance of the whole table. A null
    feature counts as 0, here and in the scored rows.
    """
    rows = df.filter(col(label).isNotNull()).na.fill(0, subset=list(features))
    overall = rows.agg(
        F.count(F.lit(1)).alias("n"), F.array_max(F.array(*[F.var_pop(col(c)) for c in features])).alias("v")
    )
    per_class = rows.groupBy(col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array(*[F.avg(col(c)) for c in features]).alias("means"),
        F.array(*[F.var_pop(col(c)) for c in features]).alias("_vars"),
    )
    wide = attach_scalars(per_class, overall, "_o")
    return wide.select(
        "label",
        F.log(F.col("_n") / F.col("_o.n")).alias("log_prior"),
        "means",
        F.transform("_vars", lambda v: v + F.col("_o.v") * smoothing).alias("variances"),
    )


def posteriors(df: DataFrame, params: DataFrame, features: Sequence[str], output: str = "posterior") -> DataFrame:
    """Add an array of (label, p), labels ascending. The parameter table (one row per class) rides
    along as one array in a scalar subquery."""
    packed = params.agg(F.array_sort(F.collect_list(F.struct("label", "log_prior", "means", "variances"))).alias("classes"))
    wide = attach_scalars(df, packed, "_nb")

    def likelihood(c):
        total = c["log_prior"]
        for i, name in enumerate(features):
            gap = F.coalesce(col(name).cast("double"), F.lit(0.0)) - c["means"][i]
            total = total - 0.5 * (LOG_TWO_PI + F.log(c["variances"][i]) + gap * gap / c["variances"][i])
        return F.struct(c["label"].alias("label"), total.alias("ll"))

    scored = wide.withColumn("_ll", F.transform("_nb.classes", likelihood))
    scored = scored.withColumn("_top", F.array_max(F.transform("_ll", lambda x: x["ll"])))
    scored = scored.withColumn(
        "_w", F.transform("_ll", lambda x: F.struct(x["label"].alias("label"), F.exp(x["ll"] - F.col("_top")).alias("w")))
    )
    scored = scored.withColumn("_sum", F.aggregate("_w", F.lit(0.0), lambda acc, x: acc + x["w"]))
    return scored.select(
        *[col(c) for c in df.columns],
        F.transform("_w", lambda x: F.struct(x["label"].alias("label"), (x["w"] / F.col("_sum")).alias("p"))).alias(output),
    )


def predict_gaussian(df: DataFrame, params: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add y_pred (most likely class; ties take the smallest) and score (probability of the last class)."""
    scored = posteriors(df, params, features)
    best = F.array_max(F.transform("posterior", lambda x: x["p"]))
    first = F.filter("posterior", lambda x: x["p"] == best)[0]["label"]
    return scored.select(*[col(c) for c in df.columns], first.alias("y_pred"), F.element_at("posterior", -1)["p"].alias("score"))


def variance_importance(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """1 / (1 + mean of the class variances) per feature: small spread inside classes ranks high."""
    per_class = df.groupBy(col(label)).agg(*[F.var_pop(col(c)).alias(c) for c in features])
    wide = per_class.agg(*[F.avg(c).alias(c) for c in features])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), (1 / (1 + F.col(c))).alias("importance")) for c in features])
    return wide.select(F.inline(cells))


def fit_binned(df: DataFrame, features: Sequence[str], target: str, bins: int = 10, smoothing: float = 1e-9) -> DataFrame:
    """Naive Bayes over equal-width bins of the target; adds the centre of every bin that has rows."""
    edges = df.agg(F.min(col(target)).cast("double").alias("lo"), F.max(col(target)).cast("double").alias("hi"))
    wide = attach_scalars(df, edges, "_e")
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    spot = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((col(target) - lo) / (hi - lo) * bins), F.lit(bins - 1)))
    binned = wide.withColumn("_bin", spot.cast("int"))
    params = fit_gaussian(binned, features, "_bin", smoothing)
    located = attach_scalars(params, edges, "_e")
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    return located.withColumn("center", F.col("_e.lo") + (F.col("label") + 0.5) * width).drop("_e")


def predict_binned(df: DataFrame, params: DataFrame, features: Sequence[str], output: str = "prediction") -> DataFrame:
    """Expected bin centre. Centres are looked up by bin id, so empty bins do no harm."""
    centers = params.agg(F.map_from_entries(F.collect_list(F.struct("label", "center"))).alias("at"))
    scored = attach_scalars(posteriors(df, params.drop("center"), features), centers, "_c")
    expected = F.aggregate("posterior", F.lit(0.0), lambda acc, x: acc + x["p"] * F.col("_c.at")[x["label"]])
    return scored.select(*[col(c) for c in df.columns], expected.alias(output))
