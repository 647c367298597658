"""Linear and logistic learners on MLlib, with penalties stated the way users state them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import attach_scalars, col
from tablewright.operators.association import assemble, fit_on, importance_frame, training_rows


def _prepared(df: DataFrame, features: Sequence[str], target: str, weight: str | None = None) -> DataFrame:
    return training_rows(df, features, target, [] if weight is None else [weight])


def fit_ols(df: DataFrame, features: Sequence[str], target: str):
    """Least squares with intercept: one pass of normal equations."""
    learner = LinearRegression(solver="normal", regParam=0.0, labelCol=target, featuresCol="features")
    return fit_on(learner, _prepared(df, features, target))


def fit_ridge(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0):
    """Minimises |y - Xw|^2 + alpha |w|^2.

    MLlib averages the loss and rescales the penalty by the label's deviation, hence the conversion.
    """
    n, spread = df.na.drop(subset=[target]).agg(F.count(F.lit(1)), F.stddev_pop(col(target))).first()
    penalty = alpha / max(n, 1) * (spread or 0.0)
    learner = LinearRegression(
        solver="normal", elasticNetParam=0.0, regParam=penalty, standardization=False, labelCol=target, featuresCol="features"
    )
    return fit_on(learner, _prepared(df, features, target))


def fit_lasso(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.1):
    """Minimises |y - Xw|^2 / 2n + alpha |w|_1."""
    learner = LinearRegression(
        elasticNetParam=1.0, regParam=alpha, standardization=False, labelCol=target, featuresCol="features", maxIter=500, tol=1e-10
    )
    return fit_on(learner, _prepared(df, features, target))


def predict(model, df: DataFrame, features: Sequence[str], output: str = "prediction") -> DataFrame:
    """The input with the model's prediction; the assembled vector does not stay behind."""
    from pyspark.ml.feature import VectorAssembler

    filled = df.withColumns({f"_f_{i}": F.coalesce(col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(features)})
    temporary = [f"_f_{i}" for i in range(len(features))]
    vectors = VectorAssembler(inputCols=temporary, outputCol="features").transform(filled)
    scored = model.transform(vectors)
    return scored.select(*[col(c) for c in df.columns], F.col("prediction").alias(output))


def coefficients(df: DataFrame, features: Sequence[str], model, top: int | None = None, nonzero: bool = False) -> DataFrame:
    """(feature, value, abs_value), largest magnitude first."""
    out = importance_frame(df, features, np.asarray(model.coefficients.toArray()))
    if nonzero:
        out = out.filter("abs_value > 0")
    return out if top is None else out.limit(top)


def prediction_summary(df: DataFrame, column: str = "prediction") -> DataFrame:
    value = col(column)
    return df.agg(
        F.count(value).alias("rows"), F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )


def cross_validate_linear(df: DataFrame, features: Sequence[str], target: str, fold: str, alpha: float = 0.0) -> DataFrame:
    """Out-of-fold mean squared error of least squares (or ridge) for all folds from one scan.

    Each fold is reduced to its cross-product sums; training on the other folds is "total minus
    fold", and the held-out error follows from the same sums. Per fold there are about p^2 / 2
    numbers, so k small rows are all that reaches the driver. Columns are centred on the overall
    means first, which keeps the sums well scaled.
    """
    names = [*features, target]
    # As in the fit: a null feature counts as 0, a row without target is left out.
    df = df.na.drop(subset=[target]).na.fill(0, subset=list(features))
    means = df.agg(*[F.avg(col(c)).alias(c) for c in names])
    centred = attach_scalars(df, means, "_m")
    values = {c: col(c).cast("double") - F.col("_m")[c] for c in names}
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = centred.groupBy(col(fold).alias("fold")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(values[c]).alias(f"s{i}") for i, c in enumerate(names)],
        *[F.sum(values[names[i]] * values[names[j]]).alias(f"p{i}_{j}") for i, j in pairs],
    )
    parts = []
    for row in sums.orderBy("fold").collect():
        size = len(names)
        gram = np.zeros((size + 1, size + 1))
        gram[0, 0] = row["n"]
        for i in range(size):
            gram[0, i + 1] = gram[i + 1, 0] = row[f"s{i}"]
        for i, j in pairs:
            gram[i + 1, j + 1] = gram[j + 1, i + 1] = row[f"p{i}_{j}"]
        parts.append((row["fold"], gram))
    total = sum(g for _, g in parts)
    rows = []
    for name, held in parts:
        train = total - held
        penalty = np.diag([0.0] + [alpha] * len(features))
        # The smallest solution where a constant feature leaves several.
        weights = np.linalg.lstsq(train[:-1, :-1] + penalty, train[:-1, -1], rcond=None)[0]
        error = held[-1, -1] - 2 * weights @ held[:-1, -1] + weights @ held[:-1, :-1] @ weights
        rows.append((int(name), int(held[0, 0]), float(error / held[0, 0])))
    return df.sparkSession.createDataFrame(rows, "fold int, rows bigint, mse double")


def balanced_weights(df: DataFrame, label: str, output: str = "class_weight", many: str | None = None) -> DataFrame:
    """n / (classes * n_class) on every labelled row; ``many`` names a column with the number of rows that one stands for.

    The class counts (MLlib's classifiers take at most a hundred classes) travel as one map in a
    scalar subquery, so the rows are neither joined nor shuffled.
    """
    rows = df.filter(col(label).isNotNull())
    counts = rows.groupBy(col(label).alias("_l")).agg((F.count(F.lit(1)) if many is None else F.sum(col(many))).alias("_n"))
    packed = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("_l", "_n"))).alias("counts"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k")
    )
    wide = attach_scalars(rows, packed, "_w")
    return wide.withColumn(output, F.col("_w.n") / (F.col("_w.k") * F.element_at("_w.counts", col(label)))).drop("_w")


def fit_logistic(
    df: DataFrame, features: Sequence[str], label: str, c: float = 1.0, penalty: str = "l2", l1_ratio: float = 0.5, balanced: bool = True
):
    """Logistic regression with inverse penalty strength ``c``; penalty l2, l1, elasticnet or none."""
    weighted = balanced_weights(df, label) if balanced else df.withColumn("class_weight", F.lit(1.0))
    n = df.filter(col(label).isNotNull()).count()
    learner = LogisticRegression(
        labelCol=label,
        featuresCol="features",
        weightCol="class_weight",
        standardization=False,
        regParam=0.0 if penalty == "none" else 1.0 / (c * max(n, 1)),
        elasticNetParam={"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio, "none": 0.0}[penalty],
        maxIter=200,
        tol=1e-8,
    )
    return fit_on(learner, _prepared(weighted, features, label, "class_weight"))


def predict_classes(model, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns, predicted class and probability of class 1."""
    vectors = assemble(df, features, keep=keep)
    scored = model.transform(vectors)
    return scored.select(
        *[col(c) for c in keep], F.col("prediction").cast("int").alias("y_pred"), vector_to_array("probability")[1].alias("score")
    )


def signed_coefficients(df: DataFrame, features: Sequence[str], model) -> DataFrame:
    """Coefficients by magnitude, with what the sign means for class 1."""
    out = importance_frame(df, features, np.asarray(model.coefficients.toArray()))
    return out.withColumn("effect", F.when(F.col("value") > 0, "raises").when(F.col("value") < 0, "lowers").otherwise("none"))
