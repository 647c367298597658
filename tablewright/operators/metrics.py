"""Metrics over prediction tables. All of them are aggregations; no prediction reaches the driver."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ordered import exact_quantiles, running_totals
from tablewright.functions.scalar import attach_scalars, col



def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """mse, rmse, mae, r2, mape in one aggregation. r2 is null when the target is constant."""
    pairs = df.filter(col(actual).isNotNull() & col(predicted).isNotNull())
    error = col(actual) - col(predicted)
    sums = pairs.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(col(actual)).alias("_var"),
        F.avg(F.when(col(actual) != 0, F.abs(error / col(actual)))).alias("mape"),
    )
    return sums.select(
        *[col(b) for b in by],
        "rows",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        F.when(F.col("_var") > 0, 1 - F.col("mse") / F.col("_var")).alias("r2"),
        "mape",
    )


def accuracy(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[col(b) for b in by]).agg(F.avg((col(truth) == col(predicted)).cast("double")).alias("accuracy"))


def _ratio(top: Column, bottom: Column) -> Column:
    """Division with 0 for an empty denominator."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def binary_metrics(df: DataFrame, truth: str, predicted: str, positive: object = 1, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class."""
    t, p = col(truth) == F.lit(positive), col(predicted) == F.lit(positive)
    counts = df.groupBy(*[col(b) for b in by]).agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.avg((col(truth) == col(predicted)).cast("double")).alias("accuracy"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *[col(b) for b in by],
        "accuracy",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _rows(count: str | None) -> Column:
    """Row count, or the sum of a count column when the input is pre-aggregated."""
    return F.count(F.lit(1)) if count is None else F.sum(col(count))


def confusion_counts(df: DataFrame, truth: str, predicted: str, count: str | None = None) -> DataFrame:
    """Observed cells only: (y_true, y_pred, n)."""
    return df.groupBy(col(truth).alias("y_true"), col(predicted).alias("y_pred")).agg(_rows(count).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """All label pairs, zero cells included. The label list is one array of the classes."""
    cells = confusion_counts(df, truth, predicted)
    labels = cells.select(F.explode(F.array("y_true", "y_pred")).alias("label")).distinct()
    every = labels.agg(F.collect_list("label").alias("all")).scalar()
    grid = labels.select(F.col("label").alias("y_true"), F.explode(every).alias("y_pred"))
    return grid.join(cells, ["y_true", "y_pred"], "left").select("y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def class_metrics(df: DataFrame, truth: str, predicted: str, count: str | None = None) -> DataFrame:
    """Per class: precision, recall, f1, support. Works on the confusion counts."""
    cells = confusion_counts(df, truth, predicted, count)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y_true").alias("label"), F.col("n").alias("actual"), F.lit(0).alias("said"), F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("y_pred").alias("label"), F.lit(0).alias("actual"), F.col("n").alias("said"), F.lit(0).alias("hit")),
            )
        )
    )
    sums = sides.groupBy("label").agg(F.sum("actual").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    return sums.select(
        "label",
        _ratio(F.col("hit"), F.col("said")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1"),
        "support",
    )


def weighted_metrics(df: DataFrame, truth: str, predicted: str, count: str | None = None) -> DataFrame:
    """Precision, recall and F1 averaged by class support; empty denominators count as 0."""
    classes = class_metrics(df, truth, predicted, count)
    n = F.sum("support")
    return classes.agg(*[F.try_divide(F.sum(F.col(m) * F.col("support")), n).alias(m) for m in ("precision", "recall", "f1")])


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Class rows plus accuracy, macro avg and weighted avg. One pass over the predictions.

    ``rollup`` over the class rows (one per class) gives the class rows and their totals together.
    """
    classes = class_metrics(df, truth, predicted).withColumn("name", F.col("label").cast("string"))
    n = F.sum("support")
    totals = classes.rollup("name").agg(
        *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), n).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")],
        F.try_divide(F.sum(F.col("recall") * F.col("support")), n).alias("accuracy"),
        n.alias("support"),
        F.grouping("name").alias("is_total"),
    )

    def row(name, p, r, f):
        return F.struct(name.alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("support"))

    macro = row(F.lit("macro avg"), *[F.col(f"{m}_macro") for m in ("precision", "recall", "f1")])
    weighted = row(F.lit("weighted avg"), *[F.col(f"{m}_weighted") for m in ("precision", "recall", "f1")])
    acc = row(F.lit("accuracy"), *[F.col("accuracy")] * 3)
    plain = row(F.col("name"), *[F.col(f"{m}_macro") for m in ("precision", "recall", "f1")])
    return totals.select(F.inline(F.when(F.col("is_total") == 1, F.array(acc, macro, weighted)).otherwise(F.array(plain))))


def score_counts(df: DataFrame, truth: str, score: str, positive: object = 1, count: str | None = None) -> DataFrame:
    """(score, pos, neg): one row per distinct score, combined before the shuffle."""
    is_pos, weight = (col(truth) == F.lit(positive)).cast("bigint"), F.lit(1) if count is None else col(count)
    return (
        df.filter(col(score).isNotNull() & col(truth).isNotNull())
        .groupBy(col(score).alias("score"))
        .agg(F.sum(is_pos * weight).alias("pos"), F.sum((1 - is_pos) * weight).alias("neg"))
    )


def roc_auc(df: DataFrame, truth: str, score: str, positive: object = 1, chunks: int | None = None, count: str | None = None) -> DataFrame:
    """Mann-Whitney AUC with half credit for ties; null when a class is absent."""
    table = running_totals(score_counts(df, truth, score, positive, count), "score", {"neg_seen": "neg"}, chunks=chunks)
    wins = F.sum(F.col("pos") * (F.col("neg_seen") - F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return table.agg(F.when(pairs > 0, wins / pairs).alias("roc_auc"))


def average_precision(df: DataFrame, truth: str, score: str, positive: object = 1, chunks: int | None = None, count: str | None = None) -> DataFrame:
    """Step-wise sum of (recall gain * precision) over descending distinct scores."""
    table = running_totals(
        score_counts(df, truth, score, positive, count), "score", {"tp": "pos", "fp": "neg"}, descending=True, chunks=chunks
    )
    gain = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    return table.agg(F.when(F.sum("pos") > 0, gain / F.sum("pos")).alias("average_precision"))


def log_loss(df: DataFrame, truth: str, score: str, eps: float = 1e-15) -> DataFrame:
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), col(score)))
    return df.agg((-F.avg(F.when(col(truth) == 1, F.log(p)).otherwise(F.log(1 - p)))).alias("log_loss"))


def class_distribution(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, n_true, n_pred) from one pass."""
    cells = confusion_counts(df, truth, predicted)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("y_true").alias("label"), F.col("n").alias("t"), F.lit(0).alias("p")),
                F.struct(F.col("y_pred").alias("label"), F.lit(0).alias("t"), F.col("n").alias("p")),
            )
        )
    )
    return sides.groupBy("label").agg(F.sum("t").alias("n_true"), F.sum("p").alias("n_pred"))


def residuals(df: DataFrame, actual: str, predicted: str, output: str = "residual") -> DataFrame:
    return df.withColumn(output, col(actual) - col(predicted))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the observed range: bin, low, high, n. Empty bins are kept."""
    value = col(column).cast("double")
    edges = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    wide = attach_scalars(df.filter(value.isNotNull()).select(value.alias("v")), edges, "_e")
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    spot = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1)))
    counts = wide.groupBy(spot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = edges.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def describe(df: DataFrame, columns: Sequence[str], small: bool | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column; one row per column."""
    basics = df.agg(
        *[
            F.struct(
                F.count(col(c)).alias("count"),
                F.avg(col(c)).alias("mean"),
                F.stddev_samp(col(c)).alias("std"),
                F.min(col(c)).cast("double").alias("min"),
                F.max(col(c)).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], small=small)
    both = attach_scalars(basics, quartiles, "_q")
    return both.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        *[col(c)[s].alias(s) for s in ("count", "mean", "std", "min")],
                        *[F.col("_q")[c][i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
                        col(c)["max"].alias("max"),
                    )
                    for c in columns
                ]
            )
        )
    )


def unique_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column: values are deduplicated before they are counted."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), col(c).cast("string").alias("v")) for c in columns])
    distinct = df.select(F.inline(cells)).filter("v is not null").distinct()
    return distinct.groupBy("column_name").agg(F.count(F.lit(1)).alias("unique_values"))


def rows_with_null(df: DataFrame) -> DataFrame:
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | col(c).isNull()
    return df.agg(F.count_if(any_null).alias("rows_with_null"))


def evaluate_classifier(df: DataFrame, name: str, truth: str, predicted: str, score: str | None = None) -> DataFrame:
    """One row: accuracy, weighted precision / recall / F1, AUC, average precision and row count.

    The predictions are reduced once, to counts per (truth, predicted, score); all metrics start from
    that same exchange, so an expensive prediction plan is not run again for each of them.
    """
    keys = [truth, predicted] + ([score] if score else [])
    cells = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    hits = F.sum(F.when(col(truth) == col(predicted), F.col("_rows")).otherwise(0))
    base = cells.agg(F.sum("_rows").alias("test_size"), F.try_divide(hits, F.sum("_rows")).alias("accuracy"))
    out = attach_scalars(base, weighted_metrics(cells, truth, predicted, "_rows"), "_w")
    auc = roc_auc(cells, truth, score, count="_rows").scalar() if score else F.lit(None).cast("double")
    ap = average_precision(cells, truth, score, count="_rows").scalar() if score else F.lit(None).cast("double")
    return out.select(
        F.lit(name).alias("model"),
        "test_size",
        "accuracy",
        F.col("_w.precision").alias("precision"),
        F.col("_w.recall").alias("recall"),
        F.col("_w.f1").alias("f1_score"),
        auc.alias("roc_auc"),
        ap.alias("average_precision"),
        F.lit(None).cast("string").alias("error"),
    )


def evaluate_many(spark, jobs: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Evaluate models one by one; a model that fails becomes an error row and the rest go on.

    Each evaluation is one row, fetched as it is finished.
    """
    schema = (
        "model string, test_size bigint, accuracy double, precision double, recall double, f1_score double,"
        " roc_auc double, average_precision double, error string"
    )
    rows = []
    for name, job in jobs.items():
        try:
            rows.append(tuple(job().first()))
        except Exception as problem:  # the failure itself is the result
            rows.append((name, *[None] * 7, type(problem).__name__))
    return spark.createDataFrame(rows, schema)


def evaluate_split(df: DataFrame, split: str, truth: str, predicted: str, actual: str, fitted: str) -> DataFrame:
    """Classification and regression metrics for every value of the split column, in one pass."""
    error = col(actual) - col(fitted)
    sums = df.groupBy(col(split)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((col(truth) == col(predicted)).cast("double")).alias("accuracy"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(col(actual)).alias("_var"),
    )
    return sums.select(
        col(split), "rows", "accuracy", "mse", "mae", F.when(F.col("_var") > 0, 1 - F.col("mse") / F.col("_var")).alias("r2")
    )


def cumulative_curve(df: DataFrame, truth: str, score: str, positive: object = 1) -> DataFrame:
    """Points of the ROC curve: score, tpr, fpr, one per distinct score."""
    table = running_totals(score_counts(df, truth, score, positive), "score", {"tp": "pos", "fp": "neg"}, descending=True)
    sums = table.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    wide = attach_scalars(table, sums, "_s")
    return wide.select("score", _ratio(F.col("tp"), F.col("_s.p")).alias("tpr"), _ratio(F.col("fp"), F.col("_s.n")).alias("fpr"))
