"""Queries for association statistics, feature voting and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.scalar import md5_bits
from tablewright.operators import association as A
from tablewright.operators import metrics as M
from tablewright.plans.registry import query
from tablewright.plans.tables import SCORED, TRADES, md5_sql, scored, table, trades
from tablewright.session import durable

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FLAGS = ["l_returnflag", "l_linestatus"]


def _rounded(df, digits=6):
    kinds = {"double", "float"}
    return df.select(*[F.round(c, digits).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


CORR = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, finished) AS correlation FROM trades" for c in NUMBERS)


@query(
    "correlation_top",
    "A1 A9 D3",
    f"""WITH {TRADES}, c AS ({CORR})
    SELECT feature, round(correlation, 6) AS correlation, round(abs(correlation), 6) AS abs_correlation
    FROM c ORDER BY abs(correlation) DESC, feature LIMIT 3""",
)
def correlation_top(spark, folder):
    li = trades(spark, folder).withColumn("constant", F.lit(1.0))
    return _rounded(A.top_correlated(li, [*NUMBERS, "constant"], "finished", 3))


@query(
    "correlation_matrix",
    "A2",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in NUMBERS for b in NUMBERS
    ),
)
def correlation_matrix(spark, folder):
    return _rounded(A.correlation_matrix(table(spark, folder, "lineitem"), NUMBERS))


_MI = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, least(floor(({c} - (SELECT min({c}) FROM trades)) /
        ((SELECT max({c}) FROM trades) - (SELECT min({c}) FROM trades)) * 10), 9) AS bin, finished AS y FROM trades"""
    for c in NUMBERS
)
MI = f"""b AS ({_MI}), j AS (SELECT feature, bin, y, count(*) AS n FROM b GROUP BY ALL),
p AS (SELECT feature, n / sum(n) OVER (PARTITION BY feature) AS p,
        sum(n) OVER (PARTITION BY feature, bin) / sum(n) OVER (PARTITION BY feature) AS px,
        sum(n) OVER (PARTITION BY feature, y) / sum(n) OVER (PARTITION BY feature) AS py FROM j),
mi AS (SELECT feature, sum(p * ln(p / (px * py))) AS mi FROM p GROUP BY feature)"""


@query("mutual_information", "A3", f"WITH {TRADES}, {MI} SELECT feature, round(mi, 6) AS mi FROM mi")
def mutual_information(spark, folder):
    return _rounded(A.mutual_information(trades(spark, folder), NUMBERS, "finished"))


CHI_FEATURES = ["l_returnflag", "rate", "year"]
_CHI = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, CAST({e} AS VARCHAR) AS level, finished AS y FROM trades"
    for n, e in (("l_returnflag", "l_returnflag"), ("rate", "CASE WHEN l_discount >= 0.05 THEN 'high' ELSE 'low' END"), ("year", "year(l_shipdate)"))
)
CHI = f"""x AS ({_CHI}), o AS (SELECT feature, level, y, count(*) AS o FROM x GROUP BY ALL),
lv AS (SELECT feature, level, count(*) AS r FROM x GROUP BY ALL), cl AS (SELECT feature, y, count(*) AS c FROM x GROUP BY ALL),
tot AS (SELECT feature, count(*) AS n FROM x GROUP BY ALL),
g AS (SELECT lv.feature, r, c, n, coalesce(o.o, 0) AS o, r * c / n AS e FROM lv JOIN cl USING (feature) JOIN tot USING (feature)
      LEFT JOIN o ON o.feature = lv.feature AND o.level = lv.level AND o.y = cl.y),
d AS (SELECT feature, CAST((count(DISTINCT level) - 1) * (count(DISTINCT y) - 1) AS INT) AS dof FROM x GROUP BY feature),
s AS (SELECT feature, any_value(dof) AS dof,
        sum(CASE WHEN dof = 1 THEN (abs(o - e) - least(0.5, abs(o - e))) ** 2 / e ELSE (o - e) ** 2 / e END) AS statistic
      FROM g JOIN d USING (feature) GROUP BY feature),
t AS (SELECT feature, statistic, dof, dof / 2.0 AS a, statistic / 2 AS h FROM s),
chi AS (SELECT feature, statistic, dof, greatest(0.0, 1 - list_sum(list_transform(range(0, 400),
        lambda i: exp(CAST((a + i) * ln(h) - h - lgamma(a + i + 1) AS DOUBLE))))) AS p_value FROM t)"""


def chi_input(spark, folder):
    return trades(spark, folder).select(
        "l_returnflag",
        F.when(F.col("l_discount") >= 0.05, "high").otherwise("low").alias("rate"),
        F.year("l_shipdate").alias("year"),
        "finished",
    )


@query(
    "chi_square",
    "A4",
    f"WITH {TRADES}, {CHI} SELECT feature, round(statistic, 6) AS statistic, dof, round(p_value, 6) AS p_value, p_value < 0.05 AS significant FROM chi",
)
def chi_square(spark, folder):
    return _rounded(A.chi_square(chi_input(spark, folder), CHI_FEATURES, "finished"))


@query("forest_importance", "A5")
def forest_importance(spark, folder):
    out, accuracy = A.forest_importance(trades(spark, folder), NUMBERS, "finished")
    return out.withColumn("train_accuracy", F.lit(accuracy))


@query("eliminate_features", "A6")
def eliminate_features(spark, folder):
    return A.eliminate_features(trades(spark, folder), NUMBERS, "finished", keep=2)


# A planted table: ten features of four values that decide the label by falling weights, and ten that do not.
WEIGHTS = [20, 16, 13, 10.5, 8.5, 5.5, 5.5, 5.5, 5.5, 5.5]
SIGNALS, NOISE = [f"s{i:02d}" for i in range(1, 11)], [f"z{i:02d}" for i in range(1, 11)]
_PLANT = {f: j for j, f in enumerate(SIGNALS + NOISE)}
_SUM = " + ".join(f"{w} * {f}" for w, f in zip(WEIGHTS, SIGNALS, strict=True))
PLANTED = f"""drawn AS (SELECT o_orderkey, {", ".join(f"{md5_sql(f"o_orderkey || '|{j}'")} % 4 AS {f}" for f, j in _PLANT.items())} FROM orders),
planted AS (SELECT *, CAST({_SUM} > {1.5 * sum(WEIGHTS)} AS INT) AS y FROM drawn)"""


def planted(spark, folder):
    # Twenty hashes a row: the keys are dealt out first, as a scan may be one task.
    keys = table(spark, folder, "orders").select("o_orderkey").repartition(3 * spark.sparkContext.defaultParallelism)
    drawn = keys.select(
        "o_orderkey", *[(md5_bits(F.col("o_orderkey"), F.lit(j)) % 4).cast("double").alias(f) for f, j in _PLANT.items()]
    )
    return drawn.withColumn("y", F.expr(f"CAST({_SUM} > {1.5 * sum(WEIGHTS)} AS INT)"))


def ranked_methods(spark, folder):
    """Ranked lists of the five methods on the planted table; the elimination names the ten features that it keeps."""
    from pyspark.sql import Window

    df, names = durable(planted(spark, folder)), [*SIGNALS, *NOISE]
    place = F.row_number().over(Window.partitionBy("method").orderBy(F.desc("score"), "feature"))
    lists = [
        A.target_correlation(df, names, "y").select(F.lit("correlation").alias("method"), "feature", F.col("abs_correlation").alias("score")),
        A.mutual_information(df, names, "y").select(F.lit("mutual_info").alias("method"), "feature", F.col("mi").alias("score")),
        A.chi_square(df, names, "y").select(F.lit("chi_square").alias("method"), "feature", F.col("statistic").alias("score")),
        A.forest_importance(df, names, "y")[0].select(F.lit("feature_importance").alias("method"), "feature", F.col("value").alias("score")),
        A.eliminate_features(df, names, "y").filter("rank = 1").select(F.lit("rfe").alias("method"), "feature", F.lit(0.0).alias("score")),
    ]
    every = lists[0]
    for one in lists[1:]:
        every = every.unionByName(one)
    return durable(every.select("method", "feature", place.alias("place")))


# Correlations are computed; the other lists are known from the weights that were planted.
_KNOWN = " UNION ALL ".join(
    f"SELECT '{method}' AS method, '{f}' AS feature, {i + 1} AS place"
    for method, features in (("mutual_info", _PLANT), ("chi_square", _PLANT), ("feature_importance", SIGNALS), ("rfe", SIGNALS))
    for i, f in enumerate(features)
)
_LISTS = f"""{PLANTED}, c AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, abs(corr({f}, y)) AS score FROM planted" for f in _PLANT)}),
ranked AS (SELECT 'correlation' AS method, feature, row_number() OVER (ORDER BY score DESC, feature) AS place FROM c UNION ALL {_KNOWN})"""


@query(
    "vote_features",
    "A7 A5 A6",
    f"""WITH {_LISTS},
    v AS (SELECT feature,
            sum(CASE method WHEN 'correlation' THEN 1 WHEN 'mutual_info' THEN 2 WHEN 'chi_square' THEN 1
                            WHEN 'feature_importance' THEN 2 ELSE 3 END) AS votes,
            min(1000 * CASE method WHEN 'correlation' THEN 0 WHEN 'mutual_info' THEN 1 WHEN 'chi_square' THEN 2
                            WHEN 'feature_importance' THEN 3 ELSE 4 END + place) AS seen
          FROM ranked WHERE place <= 10 GROUP BY feature),
    placed AS (SELECT feature, CAST(votes AS INT) AS votes, CAST(row_number() OVER (ORDER BY votes DESC, seen) AS INT) AS place FROM v)
    SELECT feature, votes, place, CAST(coalesce((SELECT votes FROM placed WHERE place = 15), 0) AS INT) AS threshold FROM placed WHERE place <= 15""",
)
def vote_features(spark, folder):
    return A.vote(ranked_methods(spark, folder))


@query(
    "selection_report",
    "A8 A5 A6",
    f"""WITH {_LISTS} SELECT method, count(*) AS features_named,
         string_agg(feature, ',' ORDER BY place) FILTER (place <= 5) AS top_features FROM ranked GROUP BY method""",
)
def selection_report(spark, folder):
    return A.selection_report(ranked_methods(spark, folder))


@query(
    "select_by_chi_square",
    "A4 A9 D3",
    f"""WITH {TRADES}, {CHI} SELECT CAST(row_number() OVER (ORDER BY statistic DESC, feature) - 1 AS INT) AS place, feature
    FROM chi WHERE p_value < 0.05""",
)
def select_by_chi_square(spark, folder):
    chosen = A.select_features(chi_input(spark, folder), CHI_FEATURES, "finished", "chi2")
    return spark.createDataFrame(list(enumerate(chosen)), "place int, feature string")


REG = """count(*) AS rows, round(avg((actual - predicted) ** 2), 2) AS mse, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
round(avg(abs(actual - predicted)), 4) AS mae, round(1 - avg((actual - predicted) ** 2) / var_pop(actual), 6) AS r2,
round(avg(abs((actual - predicted) / actual)), 6) AS mape"""


@query("regression_metrics", "E1 D14", f"WITH {SCORED} SELECT {REG} FROM scored")
def regression_metrics(spark, folder):
    out = M.regression_metrics(scored(spark, folder), "actual", "predicted")
    return out.select(
        "rows", F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"),
        F.round("r2", 6).alias("r2"), F.round("mape", 6).alias("mape"),
    )


@query("accuracy", "E2", f"WITH {SCORED} SELECT round(avg(CAST(y_true = y_pred AS INT)), 6) AS accuracy FROM scored")
def accuracy(spark, folder):
    return _rounded(M.accuracy(scored(spark, folder), "y_true", "y_pred"))


@query(
    "binary_metrics",
    "E3",
    f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
        count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, avg(CAST(y_true = y_pred AS INT)) AS a FROM scored)
    SELECT round(a, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def binary_metrics(spark, folder):
    return _rounded(M.binary_metrics(scored(spark, folder), "y_true", "y_pred"))


CLASSES = f"""{SCORED}, labels_seen AS (SELECT class_true AS label FROM scored UNION SELECT class_pred FROM scored),
per AS (SELECT label, coalesce((SELECT count(*) FROM scored WHERE class_true = label), 0) AS support,
          (SELECT count(*) FROM scored WHERE class_pred = label) AS said,
          (SELECT count(*) FROM scored WHERE class_pred = label AND class_true = label) AS hit FROM labels_seen),
cls AS (SELECT label, support, CASE WHEN said = 0 THEN 0 ELSE hit / said END AS precision,
          CASE WHEN support = 0 THEN 0 ELSE hit / support END AS recall,
          CASE WHEN said + support = 0 THEN 0 ELSE 2 * hit / (said + support) END AS f1 FROM per)"""


@query(
    "weighted_metrics",
    "E4",
    f"""WITH {CLASSES} SELECT round(sum(precision * support) / sum(support), 6) AS precision,
        round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM cls""",
)
def weighted_metrics(spark, folder):
    return _rounded(M.weighted_metrics(scored(spark, folder), "class_true", "class_pred"))


@query(
    "confusion_matrix",
    "E5",
    f"""WITH {CLASSES} SELECT a.label AS y_true, b.label AS y_pred,
        (SELECT count(*) FROM scored WHERE class_true = a.label AND class_pred = b.label) AS n FROM labels_seen a, labels_seen b""",
)
def confusion_matrix(spark, folder):
    return M.confusion_matrix(scored(spark, folder), "class_true", "class_pred")


@query(
    "classification_report",
    "E6",
    f"""WITH {CLASSES}, r AS (SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM cls
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM cls
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM cls
      UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT avg(CAST(class_true = class_pred AS INT)) AS a, count(*) AS n FROM scored))
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r""",
)
def classification_report(spark, folder):
    return _rounded(M.classification_report(scored(spark, folder), "class_true", "class_pred"))


STEPS = f"""{SCORED}, g AS (SELECT score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM scored GROUP BY score),
up AS (SELECT *, sum(neg) OVER (ORDER BY score) AS nn, sum(pos) OVER (ORDER BY score DESC) AS tp,
         sum(neg) OVER (ORDER BY score DESC) AS fp FROM g)"""


@query(
    "roc_auc",
    "E7",
    f"WITH {STEPS} SELECT round(sum(pos * (nn - neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM up",
)
def roc_auc(spark, folder):
    return _rounded(M.roc_auc(scored(spark, folder), "y_true", "score"))


@query(
    "average_precision",
    "E8",
    f"WITH {STEPS} SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS average_precision FROM up",
)
def average_precision(spark, folder):
    return _rounded(M.average_precision(scored(spark, folder), "y_true", "score"))


@query(
    "roc_curve",
    "E7",
    f"WITH {STEPS} SELECT score, round(tp / (SELECT sum(pos) FROM g), 6) AS tpr, round(fp / (SELECT sum(neg) FROM g), 6) AS fpr FROM up",
)
def roc_curve(spark, folder):
    return _rounded(M.cumulative_curve(scored(spark, folder), "y_true", "score"))


@query(
    "class_distribution",
    "E9",
    f"WITH {CLASSES} SELECT label, support AS n_true, said AS n_pred FROM per",
)
def class_distribution(spark, folder):
    return M.class_distribution(scored(spark, folder), "class_true", "class_pred")


@query(
    "residual_histogram",
    "E10",
    f"""WITH {SCORED}, r AS (SELECT actual - predicted AS v FROM scored), e AS (SELECT min(v) AS lo, max(v) AS hi FROM r),
    c AS (SELECT CAST(least(floor((v - lo) / (hi - lo) * 12), 11) AS INT) AS bin, count(*) AS n FROM r, e GROUP BY 1)
    SELECT CAST(i AS INT) AS bin, round(lo + i * ((hi - lo) / 12), 4) AS low, round(lo + (i + 1) * ((hi - lo) / 12), 4) AS high,
           coalesce(n, 0) AS n
    FROM e, range(0, 12) t(i) LEFT JOIN c ON c.bin = i""",
)
def residual_histogram(spark, folder):
    return _rounded(M.histogram(M.residuals(scored(spark, folder), "actual", "predicted"), "residual", 12), 4)


@query(
    "describe",
    "E11",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max FROM lineitem"""
        for c in NUMBERS
    ),
)
def describe(spark, folder):
    return _rounded(M.describe(table(spark, folder, "lineitem"), NUMBERS), 4)


@query(
    "unique_counts",
    "E11",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS unique_values FROM lineitem" for c in ["l_orderkey", *NUMBERS, *FLAGS]
    ),
)
def unique_counts(spark, folder):
    return M.unique_counts(table(spark, folder, "lineitem"), ["l_orderkey", *NUMBERS, *FLAGS])


@query(
    "evaluate_classifiers",
    "E12 E2 E4 E7 E8",
    f"""WITH {CLASSES}, bin AS (SELECT label, (SELECT count(*) FROM scored WHERE y_true = label) AS support,
          (SELECT count(*) FROM scored WHERE y_pred = label) AS said,
          (SELECT count(*) FROM scored WHERE y_pred = label AND y_true = label) AS hit FROM (VALUES (0), (1)) v(label)),
    g AS (SELECT score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM scored GROUP BY score),
    up AS (SELECT *, sum(neg) OVER (ORDER BY score) AS nn, sum(pos) OVER (ORDER BY score DESC) AS tp,
         sum(neg) OVER (ORDER BY score DESC) AS fp FROM g)
    SELECT 'discount_rule' AS model, CAST((SELECT count(*) FROM scored) AS BIGINT) AS test_size,
      round((SELECT avg(CAST(y_true = y_pred AS INT)) FROM scored), 6) AS accuracy,
      round(sum(hit / said * support) / sum(support), 6) AS precision, round(sum(hit / support * support) / sum(support), 6) AS recall,
      round(sum(2 * hit / (said + support) * support) / sum(support), 6) AS f1_score,
      round((SELECT sum(pos * (nn - neg / 2)) / (sum(pos) * sum(neg)) FROM up), 6) AS roc_auc,
      round((SELECT sum(pos * tp / (tp + fp)) / sum(pos) FROM up), 6) AS average_precision, CAST(NULL AS VARCHAR) AS error
    FROM bin
    UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'AnalysisException'""",
)
def evaluate_classifiers(spark, folder):
    df = scored(spark, folder)
    jobs = {
        "discount_rule": lambda: M.evaluate_classifier(df, "discount_rule", "y_true", "y_pred", "score"),
        "broken": lambda: M.evaluate_classifier(df, "broken", "y_true", "no_such_column"),
    }
    return _rounded(M.evaluate_many(spark, jobs))


@query(
    "evaluate_train_test",
    "E13",
    f"""WITH {SCORED} SELECT part, count(*) AS rows, round(avg(CAST(y_true = y_pred AS INT)), 6) AS accuracy,
      round(avg((actual - predicted) ** 2), 1) AS mse, round(avg(abs(actual - predicted)), 4) AS mae,
      round(1 - avg((actual - predicted) ** 2) / var_pop(actual), 6) AS r2 FROM scored GROUP BY part""",
)
def evaluate_train_test(spark, folder):
    out = M.evaluate_split(scored(spark, folder), "part", "y_true", "y_pred", "actual", "predicted")
    return out.select(
        "part", "rows", F.round("accuracy", 6).alias("accuracy"), F.round("mse", 1).alias("mse"),
        F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
    )


@query(
    "log_loss",
    "D14",
    f"""WITH {SCORED}, p AS (SELECT y_true, greatest(1e-15, least(1 - 1e-15, score)) AS p FROM scored)
    SELECT round(-avg(CASE WHEN y_true = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss FROM p""",
)
def log_loss(spark, folder):
    return _rounded(M.log_loss(scored(spark, folder), "y_true", "score"))


# Features with a known relation to the target: one strong, one weaker, one below the threshold, one constant.
_PLANTED = f"""planted AS (
  SELECT o_orderkey, CAST({md5_sql('o_orderkey')} % 2 AS INT) AS y, CAST({md5_sql('o_orderkey')} // 2 % 10 AS INT) AS noise FROM orders),
f AS (SELECT o_orderkey, y, y * 3 + noise % 2 AS strong, y * 2 + noise AS weaker, noise AS none, 1 AS flat FROM planted)"""
PLANTED = ["strong", "weaker", "none", "flat"]


def _planted(spark, folder):
    bits = md5_bits(F.col("o_orderkey"))
    y, noise = (bits % 2).cast("int"), (F.floor(bits / 2) % 10).cast("int")
    return table(spark, folder, "orders").select(
        "o_orderkey", y.alias("y"), (y * 3 + noise % 2).alias("strong"), (y * 2 + noise).alias("weaker"), noise.alias("none"), F.lit(1).alias("flat")
    )


def _chosen(spark, names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "place int, feature string")


@query(
    "select_by_correlation",
    "A9 D3",
    f"""WITH {_PLANTED}, c AS (
      SELECT 'strong' AS feature, abs(corr(strong, y)) AS r FROM f UNION ALL SELECT 'weaker', abs(corr(weaker, y)) FROM f
      UNION ALL SELECT 'none', abs(corr(none, y)) FROM f)
    SELECT CAST(row_number() OVER (ORDER BY r DESC) - 1 AS INT) AS place, feature FROM c WHERE r >= 0.1""",
)
def select_by_correlation(spark, folder):
    """The threshold of the configured selector drops what is not related."""
    return _chosen(spark, A.select_features(_planted(spark, folder), PLANTED, "y", "correlation", 20, 0.1))


@query("select_by_mutual_information", "A9 D3", "SELECT * FROM (VALUES (0, 'strong'), (1, 'weaker')) t(place, feature)")
def select_by_mutual_information(spark, folder):
    return _chosen(spark, A.select_features(_planted(spark, folder), PLANTED, "y", "mutual_info", 2))


@query("select_by_elimination", "A6 A9 D3", "SELECT 0 AS place, 'strong' AS feature")
def select_by_elimination(spark, folder):
    """Only the planted feature decides the target, so elimination keeps it."""
    return _chosen(spark, A.select_features(_planted(spark, folder), PLANTED, "y", "rfe", 1))
