"""Queries for model comparison. Each order line number plays one model."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import compare as K
from tablewright.operators import metrics as M
from tablewright.plans.registry import query
from tablewright.plans.tables import table

MODELS = ["linear_regression", "random_forest", "lasso", "ridge", "svr", "knn", "naive_bayes"]


def _model():
    return F.element_at(F.array(*[F.lit(m) for m in MODELS]), F.col("l_linenumber"))


def predictions(spark, folder):
    return table(spark, folder, "lineitem").select(
        _model().alias("model"),
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 1500.0).alias("predicted"),
        F.when(F.col("l_tax") < 0.04, F.col("l_extendedprice") - F.col("l_quantity") * 1500.0).alias("held_out"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") >= 0.05).cast("int").alias("p"),
    )


def regression_table(spark, folder):
    """model, mse, rmse, mae, r2, cv_rmse: one aggregation over the predictions."""
    df = predictions(spark, folder)
    base = M.regression_metrics(df, "actual", "predicted", ["model"]).select("model", "mse", "rmse", "mae", "r2")
    cv = df.groupBy("model").agg(F.sqrt(F.avg(F.col("held_out") ** 2)).alias("cv_rmse"))
    return base.join(cv, "model").withColumn("mae", F.when(F.col("model") != "svr", F.col("mae")))


def classification_table(spark, folder):
    """model, accuracy, precision, recall, f1_score, roc_auc (missing for one model), error."""
    base = M.binary_metrics(predictions(spark, folder), "y", "p", by=["model"])
    return base.select(
        "model",
        "accuracy",
        "precision",
        "recall",
        F.col("f1").alias("f1_score"),
        F.when(F.col("model") != "knn", (F.col("accuracy") + F.col("recall")) / 2).alias("roc_auc"),
        F.when(F.col("model") == "svr", "fit failed").alias("error"),
    )


_MODEL_SQL = "[" + ", ".join(f"'{m}'" for m in MODELS) + "][l_linenumber]"
REG = f"""reg AS (SELECT {_MODEL_SQL} AS model, avg((l_extendedprice - l_quantity * 1500) ** 2) AS mse,
  sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)) AS rmse,
  CASE WHEN {_MODEL_SQL} <> 'svr' THEN avg(abs(l_extendedprice - l_quantity * 1500)) END AS mae,
  1 - avg((l_extendedprice - l_quantity * 1500) ** 2) / var_pop(l_extendedprice) AS r2,
  sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2) FILTER (l_tax < 0.04)) AS cv_rmse FROM lineitem GROUP BY {_MODEL_SQL}),
reglong AS (SELECT model, 'r2' AS metric, r2 AS value, -r2 AS badness FROM reg
  UNION ALL SELECT model, 'rmse', rmse, rmse FROM reg UNION ALL SELECT model, 'mae', mae, mae FROM reg WHERE mae IS NOT NULL
  UNION ALL SELECT model, 'cv_rmse', cv_rmse, cv_rmse FROM reg),
regrank AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY badness, model) AS position FROM reglong)"""
_HITS = "count(*) FILTER (l_returnflag = 'R' AND l_discount >= 0.05)"
CLS = f"""cls0 AS (SELECT {_MODEL_SQL} AS model, avg(CAST((l_returnflag = 'R') = (l_discount >= 0.05) AS INT)) AS accuracy,
  {_HITS} / count(*) FILTER (l_discount >= 0.05) AS precision, {_HITS} / count(*) FILTER (l_returnflag = 'R') AS recall,
  2 * {_HITS} / (count(*) FILTER (l_returnflag = 'R') + count(*) FILTER (l_discount >= 0.05)) AS f1_score FROM lineitem GROUP BY 1),
cls AS (SELECT *, CASE WHEN model <> 'knn' THEN (accuracy + recall) / 2 END AS roc_auc,
  CASE WHEN model = 'svr' THEN 'fit failed' END AS error FROM cls0),
clslong AS ({' UNION ALL '.join(f"SELECT model, '{m}' AS metric, {m} AS value FROM cls WHERE {m} IS NOT NULL" for m in K.CLASSIFICATION_METRICS)}),
clsrank AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS position FROM clslong)"""


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "metric_table",
    "K2 K1",
    f"""WITH {REG} SELECT model, round(mse, 1) AS mse, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2,
        round(cv_rmse, 4) AS cv_rmse FROM reg""",
)
def metric_table(spark, folder):
    full = regression_table(spark, folder)
    one_row = {m: full.filter(F.col("model") == m).drop("model", *(["mae"] if m == "svr" else [])) for m in MODELS}
    out = K.stack_metric_tables(one_row)
    return out.select("model", F.round("mse", 1).alias("mse"), *[F.round(c, d).alias(c) for c, d in (("rmse", 4), ("mae", 4), ("r2", 6), ("cv_rmse", 4))])


@query(
    "best_per_metric",
    "K3",
    f"WITH {REG} SELECT metric, model, round(value, 6) AS score FROM regrank WHERE position = 1",
)
def best_per_metric(spark, folder):
    return _rounded(K.best_per_metric(K.to_long(regression_table(spark, folder), K.REGRESSION_METRICS)))


@query("rank_per_metric", "K4", f"WITH {REG} SELECT metric, model, round(value, 6) AS value, position FROM regrank")
def rank_per_metric(spark, folder):
    return _rounded(K.rank_per_metric(K.to_long(regression_table(spark, folder), K.REGRESSION_METRICS)))


@query(
    "average_rank",
    "K5",
    f"""WITH {REG}, a AS (SELECT model, avg(position - 1) AS avg_rank FROM regrank GROUP BY model HAVING count(*) = 4)
    SELECT model, round(avg_rank, 6) AS avg_rank, row_number() OVER (ORDER BY avg_rank, model) AS position FROM a""",
)
def average_rank(spark, folder):
    return _rounded(K.average_rank(K.to_long(regression_table(spark, folder), K.REGRESSION_METRICS)))


@query(
    "metric_statistics",
    "K6",
    f"""WITH {REG} SELECT metric, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
        round(max(value), 4) AS max FROM reglong GROUP BY metric""",
)
def metric_statistics(spark, folder):
    return _rounded(K.metric_statistics(K.to_long(regression_table(spark, folder), K.REGRESSION_METRICS)), 4)


@query(
    "compare_classifiers",
    "K7 K4",
    f"""WITH {CLS} SELECT count(*) AS total_models, count(*) FILTER (error IS NULL) AS successful, count(error) AS failed,
       {', '.join(f"round(avg({m}) FILTER (error IS NULL), 6) AS avg_{m}" for m in K.CLASSIFICATION_METRICS)},
       (SELECT model FROM cls WHERE error IS NULL ORDER BY f1_score DESC, model LIMIT 1) AS best_model FROM cls""",
)
def compare_classifiers(spark, folder):
    return _rounded(K.compare_classifiers(classification_table(spark, folder)))


@query(
    "best_by_accuracy",
    "K8",
    f"WITH {CLS} SELECT model, round(accuracy, 6) AS accuracy FROM cls ORDER BY cls.accuracy DESC, model LIMIT 1",
)
def best_by_accuracy(spark, folder):
    return _rounded(K.best_by(classification_table(spark, folder), "accuracy"))


@query(
    "linearity_hint",
    "K9",
    f"""WITH {REG}, p AS (SELECT max(r2) FILTER (model = 'random_forest') AS n, max(r2) FILTER (model = 'linear_regression') AS l FROM reg),
    r AS (SELECT n, l, CASE WHEN n > 0 AND l > 0 THEN n / l END AS ratio FROM p)
    SELECT round(n, 6) AS nonlinear, round(l, 6) AS linear, round(ratio, 6) AS ratio,
           CASE WHEN ratio > 1.2 THEN 'nonlinear_better' WHEN ratio < 0.9 THEN 'linear_enough' ELSE 'none' END AS hint FROM r""",
)
def linearity_hint(spark, folder):
    return _rounded(K.linearity_hint(regression_table(spark, folder)))


@query(
    "insight_rules",
    "K10",
    f"""WITH {CLS}, a AS (SELECT avg(f1_score) AS f1, avg(accuracy) AS acc,
        (SELECT model FROM cls ORDER BY f1_score DESC, model LIMIT 1) AS bf,
        (SELECT model FROM cls WHERE roc_auc IS NOT NULL ORDER BY roc_auc DESC, model LIMIT 1) AS ba FROM cls)
    SELECT CASE WHEN f1 > 0.8 THEN 'excellent' WHEN f1 > 0.7 THEN 'good' ELSE 'needs improvement' END AS performance,
       abs(acc - f1) > 0.1 AS possible_imbalance, bf AS deploy, CASE WHEN ba <> bf THEN ba END AS consider_for_probabilities FROM a""",
)
def insight_rules(spark, folder):
    return K.insights(classification_table(spark, folder))


@query(
    "normalised_metrics",
    "K11",
    f"""WITH {REG} SELECT model, round(r2, 6) AS r2, round(1 - rmse / (SELECT max(rmse) FROM reg), 6) AS rmse_normalized,
        round(1 - mae / (SELECT max(mae) FROM reg), 6) AS mae_normalized FROM reg""",
)
def normalised_metrics(spark, folder):
    return _rounded(K.normalised(regression_table(spark, folder), ["rmse", "mae"]))


@query(
    "rank_matrix",
    "K12",
    f"""WITH {CLS} SELECT model, {', '.join(f"coalesce(max(position) FILTER (metric = '{m}'), 8) AS {m}" for m in K.CLASSIFICATION_METRICS)}
        FROM clsrank GROUP BY model""",
)
def rank_matrix(spark, folder):
    return K.rank_matrix(classification_table(spark, folder), list(K.CLASSIFICATION_METRICS))


TYPED = f"""{CLS}, typed AS (SELECT model, roc_auc, CASE WHEN model = 'lasso' THEN 'single' WHEN model IN ('knn', 'svr', 'ridge') THEN 'a' ELSE 'b' END AS kind FROM cls),
placed AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY roc_auc DESC NULLS LAST, model) AS rank, count(*) OVER (PARTITION BY kind) AS n FROM typed)"""


def _typed(spark, folder):
    kind = F.when(F.col("model") == "lasso", "single").when(F.col("model").isin("knn", "svr", "ridge"), "a").otherwise("b")
    return classification_table(spark, folder).select("model", "roc_auc", kind.alias("kind"))


@query(
    "rank_by_primary",
    "K13",
    f"""WITH {CLS}, r AS (SELECT model, roc_auc, row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, model) AS rank FROM cls)
    SELECT model, round(roc_auc, 6) AS roc_auc, rank,
      round((SELECT roc_auc FROM r WHERE rank = 1) - (SELECT roc_auc FROM r WHERE rank = 2), 6) AS performance_gap FROM r""",
)
def rank_by_primary(spark, folder):
    df = classification_table(spark, folder).select("model", "roc_auc")
    return _rounded(K.rank_by_primary(df, "roc_auc", []))


@query(
    "compare_by_type",
    "K14",
    f"""WITH {TYPED} SELECT model, kind, round(roc_auc, 6) AS roc_auc, rank,
      round(max(CASE WHEN rank = 1 THEN coalesce(roc_auc, 0) END) OVER (PARTITION BY kind)
          - max(CASE WHEN rank = 2 THEN coalesce(roc_auc, 0) END) OVER (PARTITION BY kind), 6) AS performance_gap FROM placed WHERE n >= 2""",
)
def compare_by_type(spark, folder):
    return _rounded(K.compare_by_type(_typed(spark, folder), "roc_auc", "kind"))


@query(
    "ranking_report",
    "K15 S7",
    f"""WITH {REG}, a AS (SELECT model, avg(position - 1) AS avg_rank FROM regrank GROUP BY model HAVING count(*) = 4),
    g AS (SELECT model, row_number() OVER (ORDER BY avg_rank, model) AS position FROM a)
    SELECT (SELECT model FROM g WHERE position = 1) AS best_overall_model,
      (SELECT string_agg(metric || '=' || model, ',' ORDER BY metric) FROM regrank WHERE position = 1) AS best_models,
      (SELECT string_agg(model, ',' ORDER BY position) FROM g) AS general_ranking""",
)
def ranking_report(spark, folder):
    report = K.ranking_report(regression_table(spark, folder), K.REGRESSION_METRICS)
    document = K.as_document(report)
    parsed = document.select(F.from_json("document", report.schema).alias("d"))
    return parsed.select(
        F.col("d.best_overall_model").alias("best_overall_model"),
        F.array_join(F.transform("d.best_models", lambda x: F.concat(x["metric"], F.lit("="), x["model"])), ",").alias("best_models"),
        F.array_join(F.transform("d.general_ranking", lambda x: x["model"]), ",").alias("general_ranking"),
    )
