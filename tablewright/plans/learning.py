"""Queries that fit and score models."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tablewright.operators import bayes as B
from tablewright.operators import boosting as T
from tablewright.operators import kernel as V
from tablewright.operators import linear as L
from tablewright.operators import metrics as M
from tablewright.operators import neighbors as N
from tablewright.operators import trees as R
from tablewright.operators.features import apply_scaler, fit_scaler
from tablewright.operators.split import hash_split, hashed_folds
from tablewright.plans.registry import query
from tablewright.plans.tables import TRADES, md5_sql, table, trades
from tablewright.session import durable

XS = ["l_quantity", "l_discount", "l_tax"]


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


SPLIT = f"{md5_sql('l_orderkey')} >= 858993459"
# Two-regressor least squares from covariances; a ridge penalty is added to both variances.
PLANE = """cov AS (SELECT var_pop(x1) + {alpha} / count(*) AS v1, var_pop(x2) + {alpha} / count(*) AS v2, covar_pop(x1, x2) AS c12,
  covar_pop(y, x1) AS c1, covar_pop(y, x2) AS c2, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM fit),
w AS (SELECT (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, my, m1, m2 FROM cov)"""
LINE = f"""fit AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x1, l_tax * 100 AS x2 FROM lineitem WHERE {SPLIT}),
test AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x1, l_tax * 100 AS x2 FROM lineitem WHERE NOT ({SPLIT}))"""


def _line(spark, folder):
    li = hash_split(table(spark, folder, "lineitem"), "l_orderkey")
    return li.select(
        "is_train", "l_orderkey", (F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("x1"), (F.col("l_tax") * 100).alias("x2")
    )


def _scored_line(fit, spark, folder, **params):
    df = _line(spark, folder)
    model = fit(df.filter("is_train"), ["x1", "x2"], "y", **params)
    out = M.regression_metrics(L.predict(model, df.filter("not is_train"), ["x1", "x2"]), "y", "prediction")
    w = [float(v) for v in model.coefficients]
    return _rounded(out.select(F.lit(w[0]).alias("b1"), F.lit(w[1]).alias("b2"), "rows", "rmse", "mae", "r2"), 5)


def _line_sql(alpha):
    return f"""WITH {LINE}, {PLANE.format(alpha=alpha)},
    p AS (SELECT y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p, b1, b2 FROM test, w)
    SELECT round(any_value(b1), 5) AS b1, round(any_value(b2), 5) AS b2, count(*) AS rows, round(sqrt(avg((y - p) ** 2)), 5) AS rmse,
      round(avg(abs(y - p)), 5) AS mae, round(1 - avg((y - p) ** 2) / var_pop(y), 5) AS r2 FROM p"""


@query("linear_regression", "M1 T2 E1", _line_sql(0))
def linear_regression(spark, folder):
    return _scored_line(L.fit_ols, spark, folder)


@query("ridge_regression", "M2 T2 E1", _line_sql(5000))
def ridge_regression(spark, folder):
    return _scored_line(L.fit_ridge, spark, folder, alpha=5000.0)


@query(
    "lasso_regression",
    "M3",
    f"""WITH {LINE}, c AS (SELECT covar_pop(y, x1) AS c, var_pop(x1) AS v, avg(y) AS my, avg(x1) AS mx FROM fit),
    w AS (SELECT sign(c) * greatest(abs(c) - 2, 0) / v AS b, my, mx FROM c)
    SELECT round(b, 4) AS b, count(*) AS rows, round(sqrt(avg((y - (my + b * (x1 - mx))) ** 2)), 4) AS rmse FROM test, w GROUP BY b""",
)
def lasso_regression(spark, folder):
    df = _line(spark, folder)
    model = L.fit_lasso(df.filter("is_train"), ["x1"], "y", 2.0)
    out = M.regression_metrics(L.predict(model, df.filter("not is_train"), ["x1"]), "y", "prediction")
    return _rounded(out.select(F.lit(float(model.coefficients[0])).alias("b"), "rows", "rmse"), 4)


@query(
    "lasso_coefficients",
    "M3 M19",
)
def lasso_coefficients(spark, folder):
    df = trades(spark, folder).withColumn("y", F.col("l_extendedprice") / 1000)
    return L.coefficients(df, XS, L.fit_lasso(df, XS, "y", 0.1), top=10, nonzero=True)


@query(
    "coefficient_table",
    "M19 M1",
    f"""WITH fit AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x1, l_tax * 100 AS x2 FROM lineitem), {PLANE.format(alpha=0)}
    SELECT 'x1' AS feature, round(b1, 5) AS value, round(abs(b1), 5) AS abs_value FROM w
    UNION ALL SELECT 'x2', round(b2, 5), round(abs(b2), 5) FROM w""",
)
def coefficient_table(spark, folder):
    df = _line(spark, folder)
    return _rounded(L.coefficients(df, ["x1", "x2"], L.fit_ols(df, ["x1", "x2"], "y"), 20), 5)


@query(
    "linear_cross_validation",
    "M1 T6 T7 T9",
    f"""WITH d AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS x1, l_tax * 100 AS x2, {md5_sql('l_orderkey')} % 4 AS fold FROM lineitem),
    pairs AS (SELECT held.fold AS f, d.* FROM d, (SELECT DISTINCT fold FROM d) held WHERE d.fold <> held.fold),
    cov AS (SELECT f, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12, covar_pop(y, x1) AS c1, covar_pop(y, x2) AS c2,
              avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM pairs GROUP BY f),
    w AS (SELECT f, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, my, m1, m2 FROM cov)
    SELECT CAST(fold AS INT) AS fold, count(*) AS rows, round(avg((y - (my + b1 * (x1 - m1) + b2 * (x2 - m2))) ** 2), 5) AS mse
    FROM d JOIN w ON d.fold = w.f GROUP BY fold""",
)
def linear_cross_validation(spark, folder):
    df = hashed_folds(_line(spark, folder), "l_orderkey", 4)
    return _rounded(L.cross_validate_linear(df, ["x1", "x2"], "y", "fold"), 5)


@query(
    "prediction_table",
    "M20 M1 S4",
    f"""WITH {LINE}, {PLANE.format(alpha=0)}, p AS (SELECT my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM test, w)
    SELECT count(*) AS rows, round(min(p), 5) AS min, round(max(p), 5) AS max, round(avg(p), 5) AS mean, round(stddev_pop(p), 5) AS std FROM p""",
)
def prediction_table(spark, folder):
    df = _line(spark, folder)
    model = L.fit_ols(df.filter("is_train"), ["x1", "x2"], "y")
    return _rounded(L.prediction_summary(L.predict(model, df.filter("not is_train"), ["x1", "x2"])), 5)


def _class_rows(spark, folder):
    li = hash_split(trades(spark, folder), "l_orderkey")
    return li.select("l_orderkey", "is_train", "finished", "returned", *XS)


def _classified(scored, label="finished"):
    return M.evaluate_classifier(scored, "model", label, "y_pred", "score")


@query("logistic_regression", "M12 M19 T8")
def logistic_regression(spark, folder):
    df = _class_rows(spark, folder)
    model = L.fit_logistic(df.filter("is_train"), XS, "returned")
    return _classified(L.predict_classes(model, df.filter("not is_train"), XS, ["returned"]), "returned")


@query("logistic_coefficients", "M12 M19")
def logistic_coefficients(spark, folder):
    df = _class_rows(spark, folder)
    return L.signed_coefficients(df, XS, L.fit_logistic(df.filter("is_train"), XS, "returned", penalty="elasticnet"))


NB_FIT = f"""nb AS (SELECT *, {SPLIT} AS is_train FROM trades), tr AS (SELECT * FROM nb WHERE is_train),
eps AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in XS)}) AS e FROM tr),
par AS (SELECT {{label}} AS label, ln(count(*) / (SELECT count(*) FROM tr)) AS prior,
  {', '.join(f'avg({c}) AS m{i}, var_pop({c}) + (SELECT e FROM eps) AS v{i}' for i, c in enumerate(XS))} FROM tr GROUP BY 1)"""
_LL = " ".join(f"- 0.5 * (1.8378770664093453 + ln(v{i}) + ({c} - m{i}) ** 2 / v{i})" for i, c in enumerate(XS))


@query(
    "naive_bayes",
    "M10 E3",
    f"""WITH {TRADES}, {NB_FIT.format(label='returned')},
    te AS (SELECT *, row_number() OVER () AS rid FROM nb WHERE NOT is_train),
    ll AS (SELECT rid, returned, label, prior {_LL} AS ll FROM te, par),
    pr AS (SELECT rid, returned, max(ll) FILTER (label = 0) AS l0, max(ll) FILTER (label = 1) AS l1 FROM ll GROUP BY ALL)
    SELECT returned, count(*) AS n, CAST(sum(CAST(l1 > l0 AS INT)) AS BIGINT) AS said_yes, round(avg(1 / (1 + exp(l0 - l1))), 6) AS mean_score
    FROM pr GROUP BY returned""",
)
def naive_bayes(spark, folder):
    df = _class_rows(spark, folder)
    params = B.fit_gaussian(df.filter("is_train"), XS, "returned")
    out = B.predict_gaussian(df.filter("not is_train").select("returned", *XS), params, XS)
    return out.groupBy("returned").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_pred").cast("bigint").alias("said_yes"), F.round(F.avg("score"), 6).alias("mean_score")
    )


@query(
    "naive_bayes_importance",
    "M10",
    f"WITH {TRADES}, v AS (SELECT {', '.join(f'var_pop({c}) AS {c}' for c in XS)} FROM trades GROUP BY finished) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(1 / (1 + avg({c})), 6) AS importance FROM v" for c in XS),
)
def naive_bayes_importance(spark, folder):
    return _rounded(B.variance_importance(trades(spark, folder), XS, "finished"))


@query(
    "naive_bayes_regression",
    "M11",
    f"""WITH {TRADES}, nb AS (SELECT *, {SPLIT} AS is_train FROM trades), tr AS (SELECT * FROM nb WHERE is_train),
    ed AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM tr),
    bn AS (SELECT tr.*, least(floor((l_extendedprice - lo) / (hi - lo) * 10), 9) AS label FROM tr, ed),
    eps AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in XS)}) AS e FROM tr),
    par AS (SELECT label, any_value((SELECT lo FROM ed)) + (label + 0.5) * any_value((SELECT (hi - lo) / 10 FROM ed)) AS center,
      ln(count(*) / (SELECT count(*) FROM tr)) AS prior,
      {', '.join(f'avg({c}) AS m{i}, var_pop({c}) + (SELECT e FROM eps) AS v{i}' for i, c in enumerate(XS))} FROM bn GROUP BY label),
    te AS (SELECT *, row_number() OVER () AS rid FROM nb WHERE NOT is_train),
    ll AS (SELECT rid, l_extendedprice AS y, center, prior {_LL} AS ll FROM te, par),
    mx AS (SELECT *, max(ll) OVER (PARTITION BY rid) AS top FROM ll),
    pr AS (SELECT rid, y, sum(center * exp(ll - top)) / sum(exp(ll - top)) AS p FROM mx GROUP BY rid, y)
    SELECT count(*) AS rows, round(avg(p), 3) AS mean_prediction, round(sqrt(avg((y - p) ** 2)), 3) AS rmse FROM pr""",
)
def naive_bayes_regression(spark, folder):
    df = hash_split(trades(spark, folder), "l_orderkey")
    params = B.fit_binned(df.filter("is_train"), XS, "l_extendedprice")
    out = B.predict_binned(df.filter("not is_train").select("l_extendedprice", *XS), params, XS)
    return out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("prediction"), 3).alias("mean_prediction"),
        F.round(F.sqrt(F.avg((F.col("l_extendedprice") - F.col("prediction")) ** 2)), 3).alias("rmse"),
    )


# ------------------------------------------------------------------ neighbours

K = 5
KNN = f"""e AS (SELECT vec_id, label, embedding, {md5_sql('vec_id')} >= 858993459 AS is_train FROM embeddings),
d AS (SELECT q.vec_id, q.label AS truth, t.vec_id AS neighbor_id, t.label AS value,
        sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) ** 2))) AS distance
      FROM e q, e t WHERE NOT q.is_train AND t.is_train),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank FROM d)"""


def _vectors(spark, folder):
    e = table(spark, folder, "embeddings").withColumnRenamed("embedding", "vector")
    return hash_split(e, "vec_id")


def _neighbors(spark, folder, k):
    e = _vectors(spark, folder)
    test = e.filter("not is_train")
    return N.nearest(test, e.filter("is_train"), "vec_id", "vec_id", k, "label"), test


@query(
    "nearest_neighbors",
    "M6 M9",
    f"WITH {KNN} SELECT vec_id, CAST(rank AS INT) AS rank, neighbor_id, round(distance, 6) AS distance, CAST(value AS DOUBLE) AS value FROM r WHERE rank <= {K}",
)
def nearest_neighbors(spark, folder):
    return _rounded(_neighbors(spark, folder, K)[0])


@query(
    "knn_regression",
    "M6",
    f"WITH {KNN} SELECT vec_id, round(sum(value / distance) / sum(1 / distance), 6) AS prediction FROM r WHERE rank <= {K} GROUP BY vec_id",
)
def knn_regression(spark, folder):
    return _rounded(N.knn_regression(_neighbors(spark, folder, K)[0], "vec_id", "distance"))


@query(
    "knn_regression_scaled",
    "M6 F9",
)
def knn_regression_scaled(spark, folder):
    """Uniform 5-neighbour regression of order totals on scaled date parts, over all orders."""
    o = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.col("o_custkey").cast("double").alias("c"),
        F.unix_date(F.to_date("o_orderdate")).cast("double").alias("t"),
    )
    df = hash_split(o, "o_orderkey")
    scaler = fit_scaler(df.filter("is_train"), ["c", "t"])
    df = N.as_vector(apply_scaler(df, scaler, ["c", "t"]), ["c", "t"])
    test = df.filter("not is_train")
    near = N.nearest(test, df.filter("is_train"), "o_orderkey", "o_orderkey", K, "o_totalprice")
    pairs = N.knn_regression(near, "o_orderkey").join(test.select("o_orderkey", "o_totalprice"), "o_orderkey")
    return M.regression_metrics(pairs, "o_totalprice", "prediction")


@query(
    "knn_r2_by_k",
    "M7",
    f"""WITH {KNN}, p AS (SELECT vec_id, truth, rank AS k, avg(value) OVER (PARTITION BY vec_id ORDER BY rank) AS p FROM r WHERE rank <= 20)
    SELECT CAST(k AS INT) AS k, round(1 - avg((truth - p) ** 2) / var_pop(truth), 6) AS r2 FROM p GROUP BY k""",
)
def knn_r2_by_k(spark, folder):
    near, test = _neighbors(spark, folder, 20)
    return _rounded(N.r2_by_k(near, test, "vec_id", "label"))


@query(
    "knn_classification",
    "M9 E2",
    f"""WITH {KNN}, v AS (SELECT vec_id, value, count(*) AS n FROM r WHERE rank <= {K} GROUP BY ALL),
    b AS (SELECT vec_id, value, n, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, value) AS o FROM v),
    s AS (SELECT vec_id, avg(distance) AS m, stddev_pop(distance) AS s FROM r WHERE rank <= {K} GROUP BY vec_id)
    SELECT vec_id, CAST(value AS INT) AS y_pred, round(n / {K}, 6) AS vote_share, round(m, 6) AS mean_distance, round(s, 6) AS std_distance
    FROM b JOIN s USING (vec_id) WHERE o = 1""",
)
def knn_classification(spark, folder):
    return _rounded(N.knn_classification(_neighbors(spark, folder, K)[0], "vec_id"))


@query(
    "knn_distance_summary",
    "M9",
    f"WITH {KNN} SELECT round(avg(distance), 6) AS mean_distance, round(stddev_pop(distance), 6) AS std_distance FROM r WHERE rank <= {K}",
)
def knn_distance_summary(spark, folder):
    return _rounded(N.distance_summary(_neighbors(spark, folder, K)[0]))


@query(
    "knn_best_k",
    "T10 M9 T7",
    f"""WITH e AS (SELECT vec_id, label, embedding, {md5_sql('vec_id')} % 3 AS fold FROM embeddings),
    d AS (SELECT q.fold, q.vec_id, q.label AS truth, t.vec_id AS nid, t.label AS value,
        sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) ** 2))) AS distance
      FROM e q, e t WHERE q.fold <> t.fold),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, nid) AS rank FROM d),
    v AS (SELECT fold, vec_id, truth, k, value, count(*) AS n FROM r, (VALUES (3), (5), (7), (9), (11), (15), (21)) ks(k) WHERE rank <= k GROUP BY ALL),
    b AS (SELECT *, row_number() OVER (PARTITION BY vec_id, k ORDER BY n DESC, value) AS o FROM v),
    a AS (SELECT fold, k, avg(CAST(value = truth AS INT)) AS accuracy FROM b WHERE o = 1 GROUP BY fold, k)
    SELECT k, round(avg(accuracy), 6) AS accuracy FROM a GROUP BY k""",
)
def knn_best_k(spark, folder):
    e = hashed_folds(table(spark, folder, "embeddings").withColumnRenamed("embedding", "vector"), "vec_id", 3)
    return _rounded(N.cross_validated_k(e, "vec_id", "label", "fold", 3, [3, 5, 7, 9, 11, 15, 21]))


# ------------------------------------------------------------------ trees and kernels


def _value_rows(spark, folder):
    li = hash_split(trades(spark, folder), "l_orderkey")
    return li.select("l_orderkey", "is_train", (F.col("l_extendedprice") / 1000).alias("y"), *XS)


@query("forest_regression", "M4 M17")
def forest_regression(spark, folder):
    df = _value_rows(spark, folder)
    model = R.algorithm("regression", "random_forest")(df.filter("is_train"), XS, "y")
    return M.regression_metrics(R.score_values(model, df.filter("not is_train"), XS, ["y"]), "y", "prediction")


@query("boosting_regression", "M5 M19")
def boosting_regression(spark, folder):
    df = _value_rows(spark, folder)
    model = R.fit_boosting_regressor(df.filter("is_train"), XS, "y")
    return M.regression_metrics(R.score_values(model, df.filter("not is_train"), XS, ["y"]), "y", "prediction")


@query("tree_classification", "M13 E12")
def tree_classification(spark, folder):
    df = _class_rows(spark, folder)
    model = R.fit_tree_classifier(df.filter("is_train"), XS, "returned")
    return _classified(R.score_classes(model, df.filter("not is_train"), XS, ["returned"]), "returned")


def _split_sql(node: int, where: str) -> str:
    """Best split of the rows ``where``: the greatest fall of Gini impurity, then the first feature, then the lowest limit."""
    each = " UNION ALL ".join(f"SELECT {i} AS f, {c}::DOUBLE AS v, returned AS y FROM rows_ WHERE {where}" for i, c in enumerate(XS))
    return f"""c{node} AS (SELECT f, v, count(*) AS n, sum(y) AS p FROM ({each}) GROUP BY f, v),
    w{node} AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS next, sum(n) OVER (PARTITION BY f ORDER BY v) AS n, sum(p) OVER (PARTITION BY f ORDER BY v) AS p,
      sum(n) OVER (PARTITION BY f) AS tn, sum(p) OVER (PARTITION BY f) AS tp FROM c{node}),
    g{node} AS (SELECT f, tn, tp, (SELECT list_sort(list(DISTINCT x.v)) FROM (SELECT v FROM (SELECT f, v FROM all_ GROUP BY ALL) a WHERE a.f = w{node}.f) x) AS vs, v,
      round((tn - (tp ** 2 + (tn - tp) ** 2) / tn) - (n - (p ** 2 + (n - p) ** 2) / n) - ((tn - n) - ((tp - p) ** 2 + (tn - n - tp + p) ** 2) / (tn - n)), 6) AS gain
      FROM w{node} WHERE next IS NOT NULL AND n >= 10 AND tn - n >= 10 AND tn >= 20),
    s{node} AS (SELECT {node} AS node, f, tn AS rows, tp, gain, (v + vs[list_position(vs, v) + 1]) / 2 AS cut FROM g{node} WHERE gain > 0 ORDER BY gain DESC, f, v LIMIT 1)"""


_CASE = " ".join(f"WHEN {i} THEN {c}::DOUBLE" for i, c in enumerate(XS))


@query(
    "tree_splits",
    "M13",
    f"""WITH {TRADES}, rows_ AS (SELECT *, row_number() OVER () AS rid FROM trades),
    all_ AS ({" UNION ALL ".join(f"SELECT {i} AS f, {c}::DOUBLE AS v FROM rows_" for i, c in enumerate(XS))}),
    {_split_sql(1, "true")},
    {_split_sql(2, f"(SELECT CASE f {_CASE} END <= cut FROM s1)")},
    {_split_sql(3, f"(SELECT CASE f {_CASE} END > cut FROM s1)")},
    found AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)
    SELECT node, {"CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(XS)) + " END"} AS feature, round(cut, 6) AS cut,
      CAST(rows AS BIGINT) AS rows, round(tp / rows, 6) AS share FROM found""",
)
def tree_splits(spark, folder):
    """The splits of a tree of two levels, with the reference's least rows of a split and of a leaf."""
    model = R.fit_tree_classifier(trades(spark, folder), XS, "returned", depth=2, balanced=False)
    nodes = [(n, f, round(cut, 6), int(rows), round(value[1], 6)) for n, f, cut, rows, value in model.nodes() if f is not None]
    return spark.createDataFrame(nodes, "node int, feature string, cut double, rows bigint, share double")


@query("tree_overfit", "M13")
def tree_overfit(spark, folder):
    """Accuracy of the tree on its own rows and on others."""
    df = _class_rows(spark, folder)
    train, test = df.filter("is_train"), df.filter("not is_train")
    return R.overfit_gap(R.fit_tree_classifier(train, XS, "returned", min_gain=0.01), train, test, "returned")


@query("tree_shape", "M13")
def tree_shape(spark, folder):
    df = _class_rows(spark, folder)
    return R.tree_shape(spark, R.fit_tree_classifier(df.filter("is_train"), XS, "returned"))


@query("forest_classification", "M14 M17")
def forest_classification(spark, folder):
    df = _class_rows(spark, folder)
    model = R.algorithm("classification", "random_forest")(df.filter("is_train"), XS, "returned")
    return _classified(R.score_classes(model, df.filter("not is_train"), XS, ["returned"]), "returned")


@query("boosting_classification", "M15")
def boosting_classification(spark, folder):
    df = _class_rows(spark, folder)
    model = R.fit_boosting_classifier(df.filter("is_train"), XS, "returned", "l_orderkey")
    return _classified(R.score_classes(model, df.filter("not is_train"), XS, ["returned"]), "returned")


@query(
    "boosting_first_round",
    "M15 M5",
    f"""WITH {TRADES}, e AS ({" UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, {c}::DOUBLE AS v, returned AS y FROM trades" for i, c in enumerate(XS))}),
    c AS (SELECT f, feature, v, count(*) AS n, sum(y) AS p FROM e GROUP BY ALL),
    w AS (SELECT f, feature, v, lead(v) OVER g AS next, sum(n) OVER g AS n, sum(p) OVER g AS p, sum(n) OVER (PARTITION BY f) AS tn, sum(p) OVER (PARTITION BY f) AS tp
          FROM c WINDOW g AS (PARTITION BY f ORDER BY v)),
    s AS (SELECT *, tp / tn AS s FROM w WHERE next IS NOT NULL),
    b AS (SELECT *, round((p - n * s) ** 2 / n + (tp - p - (tn - n) * s) ** 2 / (tn - n), 6) AS gain FROM s ORDER BY gain DESC, f, v LIMIT 1)
    SELECT feature, round((v + next) / 2, 6) AS cut, round(ln(s / (1 - s)), 6) AS base, round((p - n * s) / (n * s * (1 - s)), 6) AS below,
      round((tp - p - (tn - n) * s) / ((tn - n) * s * (1 - s)), 6) AS above FROM b""",
)
def boosting_first_round(spark, folder):
    """The split of the first tree of one level, and the Newton steps of its two leaves."""
    model = T.fit(trades(spark, folder), XS, "returned", True, rounds=1, depth=1)
    tree = model.trees[0]
    row = (XS[tree["feature"][0]], round(float(tree["limit"][0]), 6), round(model.base, 6), *(round(float(v), 6) for v in tree["value"][1:, 0]))
    return spark.createDataFrame([row], "feature string, cut double, base double, below double, above double")


@query("boosting_stages", "M18 M15")
def boosting_stages(spark, folder):
    df = _class_rows(spark, folder)
    model = R.fit_boosting_classifier(df.filter("is_train"), XS, "returned", "l_orderkey")
    return R.staged_accuracy(model, df, XS, "returned", "is_train")


@query(
    "boosting_best_iteration",
    "M18",
    """WITH s AS (SELECT l_quantity AS iteration, avg(CAST((l_returnflag = 'R') = (l_discount >= 0.05) AS INT)) AS a FROM lineitem GROUP BY 1),
    g AS (SELECT CAST(iteration AS INT) AS iteration, a AS accuracy, lag(a, 10) OVER (ORDER BY iteration) AS back FROM s)
    SELECT (SELECT iteration FROM g ORDER BY accuracy DESC, iteration LIMIT 1) AS best_iteration,
      min(iteration) FILTER (accuracy < back) AS overfit_at FROM g""",
)
def boosting_best_iteration(spark, folder):
    right = (F.col("l_returnflag") == "R") == (F.col("l_discount") >= 0.05)
    staged = table(spark, folder, "lineitem").groupBy(F.col("l_quantity").cast("int").alias("iteration")).agg(
        F.avg(right.cast("double")).alias("accuracy")
    )
    return R.best_iteration(staged)


def _standard(df, fit):
    """The features scaled by what the rows of ``fit`` say, which is worked out once and not for every pass."""
    return apply_scaler(df, durable(fit_scaler(fit, XS)), XS)


@query("svm_classification", "M16")
def svm_classification(spark, folder):
    df = _class_rows(spark, folder)
    df = _standard(df, df.filter("is_train"))
    model = V.fit_svm(df.filter("is_train"), XS, "returned", waves=32)
    return _classified(model.predict(df.filter("not is_train"), ["returned"]), "returned")


@query("svm_support_rows", "M16")
def svm_support_rows(spark, folder):
    df = _class_rows(spark, folder)
    df = _standard(df, df.filter("is_train"))
    train = df.filter("is_train")
    return V.fit_svm(train, XS, "returned").support_rows(train)


@query("svr_regression", "M8 F9 F10")
def svr_regression(spark, folder):
    df = _value_rows(spark, folder)
    df = apply_scaler(df, fit_scaler(df.filter("is_train"), XS), XS)
    model = V.fit_svr(df.filter("is_train"), XS, "y", waves=32)
    return M.regression_metrics(model.predict(df.filter("not is_train"), ["y"]), "y", "prediction")


@query(
    "hyper_parameters",
    "M21 G14",
    """SELECT * FROM (VALUES ('aggregationDepth', '2', 'int'), ('elasticNetParam', '0.0', 'float'), ('epsilon', '1.35', 'float'),
      ('featuresCol', 'features', 'str'), ('fitIntercept', 'True', 'bool'), ('labelCol', 'y', 'str'), ('loss', 'squaredError', 'str'),
      ('maxBlockSizeInMB', '0.0', 'float'), ('maxIter', '100', 'int'), ('predictionCol', 'prediction', 'str'), ('regParam', '0.0', 'float'),
      ('solver', 'normal', 'str'), ('standardization', 'True', 'bool'), ('tol', '1e-06', 'float'))
      AS t(parameter_name, parameter_value, parameter_type)""",
)
def hyper_parameters(spark, folder):
    df = _value_rows(spark, folder)
    model = L.fit_ols(df.filter("is_train"), XS, "y")
    return R.parameter_table(spark, model)


@query("grid_search", "T10 T8")
def grid_search(spark, folder):
    df = _class_rows(spark, folder).filter("is_train")
    df = L.balanced_weights(_standard(df, df), "returned")
    df = hashed_folds(df, "l_orderkey", 5)
    learner = LogisticRegression(labelCol="returned", featuresCol="features", weightCol="class_weight", maxIter=1000)
    fitted_on = df.count() * 4 / 5
    grid = {"regParam": [1 / (c * fitted_on) for c in (0.01, 0.1, 1.0, 10.0, 100.0)], "elasticNetParam": [1.0, 0.0]}
    return R.grid_search(df, learner, grid, XS, "returned", "fold", 5)[0]
