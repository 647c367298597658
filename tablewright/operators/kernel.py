"""Radial-kernel machines by random Fourier features (Rahimi and Recht, 2007).

These are approximations of the exact kernel solvers by construction: the features' inner products
approach the kernel as their number grows. Everything runs as column expressions and MLlib learners.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.scalar import col
from tablewright.operators.association import combined, fit_on, fixed_layout
from tablewright.operators.linear import balanced_weights
from tablewright.session import reused


@dataclass(frozen=True)
class FourierMap:
    features: tuple[str, ...]
    weights: np.ndarray
    shifts: np.ndarray

    def apply(self, df: DataFrame, keep: Sequence[str], output: str = "features") -> DataFrame:
        scale = float(np.sqrt(2.0 / len(self.shifts)))
        inputs = [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in self.features]
        waves = []
        for i, (row, shift) in enumerate(zip(self.weights, self.shifts, strict=True)):
            angle = F.lit(float(shift))
            for x, w in zip(inputs, row, strict=True):
                angle = angle + x * float(w)
            waves.append((F.cos(angle) * scale).alias(f"_w{i}"))
        wide = df.select(*[col(c) for c in keep], *waves)
        names = [f"_w{i}" for i in range(len(self.shifts))]
        return VectorAssembler(inputCols=names, outputCol=output).transform(wide).drop(*names)


def scale_gamma(df: DataFrame, features: Sequence[str]) -> float:
    """1 / (features * variance of all feature cells)."""
    row = df.agg(
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(features)], *[F.var_pop(col(c)).alias(f"v{i}") for i, c in enumerate(features)]
    ).first()
    means = np.array([row[f"m{i}"] for i in range(len(features))])
    variances = np.array([row[f"v{i}"] for i in range(len(features))])
    total = variances.mean() + means.var()
    return 1.0 / (len(features) * total) if total > 0 else 1.0


def fourier_map(features: Sequence[str], gamma: float, waves: int = 64, seed: int = 42) -> FourierMap:
    random = np.random.default_rng(seed)
    return FourierMap(
        tuple(features), random.normal(0.0, np.sqrt(2.0 * gamma), (waves, len(features))), random.uniform(0.0, 2.0 * np.pi, waves)
    )


@dataclass(frozen=True)
class KernelClassifier:
    lift: FourierMap
    machine: object
    calibration: object
    label: str

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Kept columns, margin, y_pred and a calibrated score."""
        return _calibrated(_margins(self.machine, self.lift.apply(df, keep), keep), self.calibration, keep)

    def support_rows(self, df: DataFrame) -> DataFrame:
        """Rows on or inside the margin, per class: the analogue of support-vector counts."""
        equal = df.groupBy(*[col(c) for c in dict.fromkeys([self.label, *self.lift.features])]).agg(F.count(F.lit(1)).alias("_n"))
        scored = _margins(self.machine, self.lift.apply(equal, [self.label, "_n"]), [self.label, "_n"])
        signed = F.col("margin") * (col(self.label) * 2 - 1)
        return scored.groupBy(col(self.label)).agg(
            F.sum(F.when(signed <= 1, F.col("_n")).otherwise(0)).alias("support_rows"), F.sum("_n").alias("rows")
        )


def _laid_out(rows: DataFrame, lift: FourierMap, keep: Sequence[str]) -> DataFrame:
    """The kept columns and features in the layout of the lifted rows. Only the narrow rows are shuffled, sorted and
    stored; the waves are worked out again where the machine stores its blocks."""
    wide = lift.apply(rows, list(dict.fromkeys([*keep, *lift.features])), "_lifted")
    marked = wide.withColumn("_digest", F.xxhash64(*[col(c) for c in keep], "_lifted")).drop("_lifted")
    return fixed_layout(marked, "_digest").drop("_digest")


def _margins(machine, lifted: DataFrame, keep: Sequence[str]) -> DataFrame:
    return machine.transform(lifted).select(*[col(c) for c in keep], vector_to_array("rawPrediction")[1].alias("margin"))


def _calibrated(scored: DataFrame, calibration, keep: Sequence[str]) -> DataFrame:
    a, b = float(calibration.coefficients[0]), float(calibration.intercept)
    return scored.select(
        *[col(c) for c in keep], "margin", (F.col("margin") > 0).cast("int").alias("y_pred"), (1 / (1 + F.exp(-(F.col("margin") * a + b)))).alias("score")
    )


def fit_svm(df: DataFrame, features: Sequence[str], label: str, c: float = 1.0, gamma: float | str = "scale", waves: int = 64, balanced: bool = True, max_iter: int = 50, seed: int = 42) -> KernelClassifier:
    """Support-vector classifier: lifted features, linear machine, one-feature logistic calibration.

    Equal rows of a large table are one row of their summed weight (``association.combined``)."""
    rows = df.select(*[col(c) for c in dict.fromkeys([label, *features])]).na.drop(subset=[label])
    width = scale_gamma(rows, features) if gamma == "scale" else float(gamma)
    lift = fourier_map(features, width, waves, seed)
    few = combined(rows)
    with nullcontext(rows) if few is None else reused(few) as given:
        many = None if few is None else "_n"
        weighted = balanced_weights(given, label, many=many) if balanced else given.withColumn("class_weight", F.lit(1.0))
        keep, calibrator = [label, "class_weight"], LogisticRegression(labelCol=label, featuresCol="features")
        if few is None:
            n = rows.count()
        else:
            n = given.agg(F.sum("_n")).first()[0]
            weighted = weighted.withColumn("class_weight", F.col("class_weight") * F.col("_n"))
            keep, calibrator = [*keep, "_n"], calibrator.setWeightCol("_n")
        machine = LinearSVC(
            labelCol=label, weightCol="class_weight", regParam=1.0 / (c * max(n, 1)), standardization=False, maxIter=max_iter, tol=1e-4
        )
        with reused(_laid_out(weighted, lift, keep)) as kept:
            lifted = lift.apply(kept, keep)
            machine = machine.fit(lifted)
            with reused(_margins(machine, lifted, [c for c in keep if c != "class_weight"])) as margins:
                vector = VectorAssembler(inputCols=["margin"], outputCol="features").transform(margins)
                calibration = fit_on(calibrator, vector)
    return KernelClassifier(lift, machine, calibration, label)


@dataclass(frozen=True)
class KernelRegressor:
    lift: FourierMap
    machine: object
    target: str
    epsilon: float

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return self.machine.transform(self.lift.apply(df, keep)).select(*[col(c) for c in keep], "prediction")

    def support_rows(self, df: DataFrame) -> DataFrame:
        """Rows at least epsilon away from the fit: the analogue of the support-vector count."""
        scored = self.predict(df, [self.target])
        return scored.agg(
            F.count_if(F.abs(col(self.target) - F.col("prediction")) >= self.epsilon).alias("support_rows"), F.count(F.lit(1)).alias("rows")
        )


def fit_svr(df: DataFrame, features: Sequence[str], target: str, c: float = 1.0, epsilon: float = 0.1, gamma: float | str = "scale", waves: int = 64, seed: int = 42) -> KernelRegressor:
    """Kernel regression with a robust loss on lifted features."""
    rows = df.select(*[col(c) for c in dict.fromkeys([target, *features])]).na.drop(subset=[target])
    width = scale_gamma(rows, features) if gamma == "scale" else float(gamma)
    lift = fourier_map(features, width, waves, seed)
    n = rows.count()
    machine = LinearRegression(
        labelCol=target, loss="huber", epsilon=1.35, regParam=1.0 / (c * max(n, 1)), standardization=False, maxIter=100
    )
    with reused(_laid_out(rows, lift, [target])) as kept:
        machine = machine.fit(lift.apply(kept, [target]))
    return KernelRegressor(lift, machine, target, epsilon)
