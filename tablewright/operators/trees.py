"""Tree learners with the parameters of the usual tabular forests: trees and forests from ``growing``, boosting by MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.functions.scalar import col, md5_bits
from tablewright.operators import association, boosting, growing
from tablewright.operators.association import assemble, combined, fit_on, fixed_layout, importance_frame, training_rows
from tablewright.operators.linear import balanced_weights
from tablewright.session import reused

DEEPEST = growing.DEEPEST


def _rows(df: DataFrame, features: Sequence[str], target: str, balanced: bool, keep: Sequence[str] = ()) -> DataFrame:
    rows = balanced_weights(df, target) if balanced else df.withColumn("class_weight", F.lit(1.0))
    return training_rows(rows, features, target, ["class_weight", *keep])


def fit_forest_regressor(df, features, target, trees=100, depth=DEEPEST, min_split=2, min_leaf=1, seed=42, bins=growing.BINS):
    return growing.fit(
        df, features, target, trees=trees, depth=depth, min_split=min_split, min_leaf=min_leaf, bootstrap=True, seed=seed, bins=bins
    )


def fit_boosting_regressor(df, features, target, rounds=100, rate=0.1, depth=3, subsample=1.0, seed=42):
    """Rounds over cells of equal bins, as in ``boosting``; rounds on a share of the rows (``subsample``) need the rows,
    and MLlib's learner draws them."""
    if subsample >= 1:
        return boosting.fit(df, features, target, False, rounds, rate, depth, seed=seed)
    learner = GBTRegressor(labelCol=target, maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=subsample, seed=seed)
    return fit_on(learner, _rows(df, features, target, False))


def _classes(df: DataFrame, target: str) -> list:
    """The target's values, in order; a target of more than a hundred is no class."""
    rows = df.select(col(target).alias("y")).filter("y is not null").distinct().orderBy("y").limit(101).collect()
    if len(rows) > 100:
        raise ValueError(f"{target} has more than a hundred classes")
    return [int(r["y"]) for r in rows]


def fit_forest_classifier(
    df, features, target, trees=200, depth=20, min_split=5, min_leaf=2, balanced=True, subset="sqrt", seed=42, bins=growing.BINS
):
    """Rows are drawn with their class weights; a class's weight is of all rows, not of each draw."""
    rows = balanced_weights(df, target) if balanced else df
    return growing.fit(
        rows, features, target, _classes(df, target), trees, depth, min_split, min_leaf, 0.0, subset, "gini", True,
        "class_weight" if balanced else None, bins, seed,
    )


def fit_tree_classifier(
    df, features, target, criterion="gini", depth=10, min_split=20, min_leaf=10, min_gain=0.0, balanced=True, seed=42, bins=growing.BINS
):
    """``min_gain``: the least fall of impurity, as a share of a node's weight, that a split must bring."""
    rows = balanced_weights(df, target) if balanced else df
    return growing.fit(
        rows, features, target, _classes(df, target), 1, depth, min_split, min_leaf, min_gain, "all", criterion, False,
        "class_weight" if balanced else None, bins, seed,
    )


def fit_boosting_classifier(
    df, features, target, key, rounds=100, rate=0.1, depth=3, min_split=2, min_leaf=1, validation=0.1, patience=5, tolerance=1e-4, seed=42
):
    """Boosting that ends after ``patience`` rounds without progress on a validation share chosen by key hash.

    The hash is salted, so that the choice is independent of a train/test split on the plain key hash.
    """
    judges = md5_bits(col(key), F.lit("validation")) < int(validation * 4294967296)
    return boosting.fit(df, features, target, True, rounds, rate, depth, min_split, min_leaf, judges, patience, tolerance, seed=seed)


def score_classes(model, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    if isinstance(model, (growing.Forest, boosting.Boosted)):
        return model.score(df, keep)
    scored = model.transform(assemble(df, features, keep=keep))
    return scored.select(
        *[col(c) for c in keep], F.col("prediction").cast("int").alias("y_pred"), vector_to_array("probability")[1].alias("score")
    )


def score_values(model, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    if isinstance(model, (growing.Forest, boosting.Boosted)):
        return model.score(df, keep)
    scored = model.transform(assemble(df, features, keep=keep))
    return scored.select(*[col(c) for c in keep], F.col("prediction"))


def importances(df: DataFrame, features: Sequence[str], model, top: int | None = None) -> DataFrame:
    values = model.importances if isinstance(model, (growing.Forest, boosting.Boosted)) else model.featureImportances.toArray()
    out = importance_frame(df, features, values)
    return out if top is None else out.limit(top)


def tree_shape(spark: SparkSession, model: growing.Forest) -> DataFrame:
    """Depth, node and leaf count and the printed rules of one tree."""
    nodes = model.nodes()
    leaves = sum(feature is None for _, feature, *_ in nodes)
    return spark.createDataFrame([(model.depth(), len(nodes), leaves, tree_rules(model))], "depth int, nodes int, leaves int, rules string")


def tree_rules(model: growing.Forest, levels: int | None = None) -> str:
    """The tests of one tree, a line each, indented by depth; ``levels`` ends it early."""
    nodes = {n: (feature, limit, rows, value) for n, feature, limit, rows, value in model.nodes()}
    lines, stack = [], [(1, "")]
    while stack:
        n, test = stack.pop()
        feature, limit, rows, value = nodes[n]
        depth = n.bit_length() - 1
        ended = feature is None or (levels is not None and depth >= levels)
        said = f" -> {[round(v, 4) for v in value]} of {rows:g}" if ended else ""
        lines.append("  " * depth + (test or "all") + said)
        if not ended:
            stack += [(2 * n + 1, f"{feature} > {limit:g}"), (2 * n, f"{feature} <= {limit:g}")]
    return "\n".join(lines)


def overfit_gap(model: growing.Forest, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """(train_accuracy, test_accuracy, gap) of a fitted tree or forest."""
    right = F.avg((F.col("y_pred") == col(label)).cast("double"))
    both = train.select("*", F.lit(True).alias("_train")).unionByName(test.select("*", F.lit(False).alias("_train")))
    scored = model.score(both, [label, "_train"]).groupBy().pivot("_train", [True, False]).agg(right)
    return scored.select(
        F.col("true").alias("train_accuracy"), F.col("false").alias("test_accuracy"), (F.col("true") - F.col("false")).alias("gap")
    )


def staged_accuracy(model, df: DataFrame, features: Sequence[str], label: str, split: str) -> DataFrame:
    """(iteration, split, accuracy) after every boosting round.

    The trees add to a running margin column, and all rounds are scored in one aggregation.
    """
    if isinstance(model, boosting.Boosted):
        return model.staged(df, label, split)
    rows = assemble(df, features, keep=[label, split])
    margins, total = [], F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
        rows = tree.setPredictionCol(f"_t{i}").transform(rows)
        total = total + F.col(f"_t{i}") * weight
        margins.append(total)
    right = [F.avg(((m > 0).cast("int") == col(label)).cast("double")).alias(f"a{i}") for i, m in enumerate(margins)]
    wide = rows.groupBy(col(split).alias("split")).agg(*right)
    cells = F.array(*[F.struct(F.lit(i + 1).alias("iteration"), F.col(f"a{i}").alias("accuracy")) for i in range(len(margins))])
    return wide.select("split", F.inline(cells))


def best_iteration(staged: DataFrame, lookback: int = 10) -> DataFrame:
    """Best iteration, and the first one that scores below the score ``lookback`` rounds before.

    The table has one row per boosting round.
    """
    order = Window.orderBy("iteration")
    with_lag = staged.withColumn("_then", F.lag("accuracy", lookback).over(order))
    worse = F.col("accuracy") < F.col("_then")
    return with_lag.agg(
        F.min(F.struct((-F.col("accuracy")).alias("a"), "iteration"))["iteration"].alias("best_iteration"),
        F.min(F.when(worse, F.col("iteration"))).alias("overfit_at"),
    )


def parameter_table(spark: SparkSession, model_or_learner) -> DataFrame:
    """(name, value, type) of every set parameter; values that are no plain scalars become text."""
    kinds = {bool: "bool", int: "int", float: "float", str: "str"}
    rows = []
    for param, value in model_or_learner.extractParamMap().items():
        if value is not None:
            rows.append((param.name, str(value), kinds.get(type(value), "str")))
    return spark.createDataFrame(sorted(rows), "parameter_name string, parameter_value string, parameter_type string")


def algorithm(task: str, name: str, **params):
    """The fitting function for a configured algorithm name."""
    from functools import partial

    from tablewright.operators import linear

    known: Mapping[tuple[str, str], object] = {
        ("classification", "random_forest"): fit_forest_classifier,
        ("classification", "decision_tree"): fit_tree_classifier,
        ("classification", "logistic"): linear.fit_logistic,
        ("regression", "random_forest"): fit_forest_regressor,
        ("regression", "gradient_boosting"): fit_boosting_regressor,
        ("regression", "linear"): linear.fit_ols,
        ("regression", "ridge"): linear.fit_ridge,
        ("regression", "lasso"): linear.fit_lasso,
    }
    if (task, name) not in known:
        raise ValueError(f"unknown {task} algorithm {name}")
    return partial(known[(task, name)], **params)


def grid_search(df: DataFrame, learner, grid: Mapping[str, Sequence], features: Sequence[str], label: str, fold: str, folds: int, metric="areaUnderROC", parallelism=4):
    """Cross-validated grid over given folds: (parameters, mean metric) rows and the best model.

    The learner is given projections of the kept rows: MLlib's cross-validator marks every fold's rows as kept, for which
    a learner does not store its blocks but builds them again in each iteration. Equal rows of a large table are one row of
    their summed weight (``association.combined``), for the learner and for the metric.
    """
    from contextlib import nullcontext
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder

    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(learner.getParam(name), list(values))
    maps = builder.build()
    judge = (
        BinaryClassificationEvaluator(labelCol=label, metricName=metric)
        if metric.startswith("areaUnder")
        else MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    )
    weights = [learner.getWeightCol()] if learner.hasParam("weightCol") and learner.isSet("weightCol") else []
    given, few = df, None
    if learner.hasParam("weightCol"):
        slim = df.select(*[col(c) for c in dict.fromkeys([label, fold, *weights, *features])]).na.drop(subset=[label]).na.fill(0, subset=list(features))
        few = combined(slim, parts=association.COMBINED_PARTS)
    if few is not None:
        given = few.withColumn("_weight", F.col("_n") * col(weights[0]) if weights else F.col("_n"))
        learner, judge, weights = learner.copy({learner.weightCol: "_weight"}), judge.setWeightCol("_n"), ["_weight", "_n"]
    with nullcontext(given) if few is None else reused(given) as given, reused(fixed_layout(training_rows(given, features, label, [fold, *weights]))) as rows:
        sizes = {r[fold]: r["n"] for r in rows.groupBy(fold).agg(F.count(F.lit(1)).alias("n")).collect()}
        if set(sizes) != set(range(folds)) or folds < 2:
            raise ValueError(f"every fold from 0 to {folds - 1}, and no other, must have rows; got {sorted(sizes, key=str)}")

        def tried(case) -> float:
            held, params = case
            model = learner.fit(rows.filter(col(fold) != held), params)
            return judge.evaluate(model.transform(rows.filter(col(fold) == held)))

        cases = [(i, m) for i in range(folds) for m in maps]
        with ThreadPool(min(parallelism, len(cases))) as pool:
            found = np.reshape(pool.map(inheritable_thread_target(df.sparkSession)(tried), cases, chunksize=1), (folds, len(maps)))
        means = found.mean(0)
        best = int(means.argmax() if judge.isLargerBetter() else means.argmin())
        model = learner.fit(rows.drop(fold), maps[best])
    scores = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(score))
        for m, score in zip(maps, means, strict=True)
    ]
    table = df.sparkSession.createDataFrame(scores, "parameters string, score double")
    return table, model
