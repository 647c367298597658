"""Hand-made edge tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.scalar import chi_square_tail
from tablewright.operators import association as A
from tablewright.operators import bayes as B
from tablewright.operators import clean as C
from tablewright.operators import compare as K
from tablewright.operators import features as X
from tablewright.operators import linear as L
from tablewright.operators import metrics as M
from tablewright.operators import neighbors as N
from tablewright.operators.split import hash_split
from tablewright.operators import project as P
from tablewright.operators import registry as R
from tablewright.operators import boosting
from tablewright.operators import growing as G
from tablewright.operators import trees
from tablewright.sources import tables as S


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_mode_ties_and_unknown(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (3, "b", None), (4, "a", None), (5, None, None)], "i int, x string, y string")
    out = {r["i"]: (r["x"], r["y"]) for r in C.impute_mode(df, ["x", "y"]).collect()}
    assert out[5] == ("a", "Unknown") and out[1] == ("b", "Unknown")


def test_interpolation_edges(spark):
    values = [None, 1.0, None, None, 4.0, None, 7.0, None]
    df = spark.createDataFrame([(i, "g", v) for i, v in enumerate(values)], "i int, g string, v double")
    out = [r["v"] for r in C.interpolate(df, "g", "i", "i", ["v"]).orderBy("i").collect()]
    assert out == [None, 1.0, 2.0, 3.0, 4.0, 5.5, 7.0, 7.0]
    filled = [r["v"] for r in C.impute_interpolate(df, "g", "i", "i", ["v"]).orderBy("i").collect()]
    assert filled[0] == 4.0


def test_group_median_fallback_uses_the_filled_column(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", None), ("b", 3.0), ("c", 10.0)], "g string, v double")
    out = sorted(r["v"] for r in C.impute_group_median(df, "g", ["v"]).collect())
    assert out == [1.0, 2.0, 2.5, 2.5, 3.0, 10.0]
    kept = C.impute_group_median(df, "g", ["v"], global_fallback=False)
    assert kept.filter("v is null").count() == 2


def test_winsorize_bounds_and_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,)], "v double")
    for small in (True, False):
        out = C.winsorize(df, ["v"], small=small).agg(F.min("v"), F.max("v"), F.count("v")).first()
        assert (round(out[0], 6), round(out[1], 6), out[2]) == (1.99, 99.01, 100)


def test_weather_spec_leaves_no_nulls(spark):
    names = ["location", "rain_tomorrow", "rain_today", "rainfall", "wind_gust_speed", "humidity_9am", "temp_9am", "date"]
    data = [
        ("x", "Yes", None, None, 10.0, None, 1.0, "2024-01-01"),
        ("x", "No", "Yes", 1.0, None, 5.0, None, "2024-01-02"),
        ("x", None, "Yes", 1.0, 2.0, 7.0, 3.0, "2024-01-03"),
        ("y", "No", "No", None, 4.0, None, None, "2024-01-01"),
    ]
    schema = "location string, rain_tomorrow string, rain_today string, rainfall double, wind_gust_speed double, humidity_9am double, temp_9am double, date string"
    df = spark.createDataFrame(data, schema).withColumn("date", F.to_date("date"))
    out = {(r["location"], str(r["date"])): r for r in C.clean(df, C.WEATHER_SPEC).select(*names).collect()}
    assert len(out) == 3  # the row without target is dropped
    assert out["x", "2024-01-01"]["rain_today"] == "Yes" and out["x", "2024-01-01"]["rainfall"] == 0.0
    assert out["x", "2024-01-01"]["humidity_9am"] == 6.0
    assert out["x", "2024-01-02"]["temp_9am"] == 2.0
    assert out["x", "2024-01-02"]["wind_gust_speed"] == 4.0
    assert out["y", "2024-01-01"]["temp_9am"] == 2.0


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "i int, x string")
    out = X.one_hot(df, ["x"])
    assert out.columns == ["i", "x_b", "x_c"]
    assert {r["i"]: (r["x_b"], r["x_c"]) for r in out.collect()} == {1: (True, False), 2: (False, False), 3: (False, False), 4: (False, True)}
    with pytest.raises(ValueError):
        X.levels(df, ["x"], limit=2)


def test_labels(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "x string")
    test = spark.createDataFrame([("b",), ("z",), (None,)], "x string")
    labels = X.fit_labels(train, "x")
    assert {r["x"]: r["y"] for r in X.apply_labels(test, "x", labels, "y").collect()} == {"b": 1, "z": 2, None: 2}
    with pytest.raises(Exception, match="unseen label"):
        X.apply_labels(test, "x", labels, "y", on_unseen="error").collect()


def test_constant_feature(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], "c double, y double")
    for method in ("standard", "minmax", "robust"):
        scaler = X.fit_scaler(df, ["c"], method)
        assert rows(scaler.select("scale")) == [(1.0,)]
        assert {r["c"] for r in X.apply_scaler(df, scaler, ["c"]).collect()} == {0.0}
    assert A.target_correlation(df, ["c"], "y").count() == 0


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(P.MissingColumnError):
        P.select_existing(df, ["a"], "target")
    with pytest.raises(P.MissingColumnError):
        X.features_by_name(df, ["a", "b"])
    out, absent = P.select_existing(df.withColumn("t", F.lit(1)), ["b", "a"], "t")
    assert out.columns == ["a", "t"] and absent == ["b"]


def test_yates(spark):
    data = [("p", 0)] * 10 + [("p", 1)] * 20 + [("q", 0)] * 20 + [("q", 1)] * 10
    out = A.chi_square(spark.createDataFrame(data, "x string, y int"), ["x"], "y").first()
    assert out["statistic"] == pytest.approx(5.4) and out["dof"] == 1 and out["significant"]
    assert out["p_value"] == pytest.approx(math.erfc(math.sqrt(5.4 / 2)), abs=1e-9)
    flat = A.chi_square(spark.createDataFrame([("p", 0), ("p", 1)], "x string, y int"), ["x"], "y").first()
    assert (flat["statistic"], flat["dof"], flat["p_value"], flat["significant"]) == (0.0, 0, 1.0, False)
    nothing = A.chi_square(spark.createDataFrame([(None, 0)], "x string, y int"), ["x"], "y").first()
    assert (nothing["statistic"], nothing["dof"], nothing["p_value"], nothing["significant"]) == (0.0, 0, 1.0, False)


def test_chi_square_tail(spark):
    # Even degrees of freedom have a closed form: exp(-x/2) * sum (x/2)^j / j!.
    cases = [(x, d) for x in (0.5, 3.0, 20.0, 90.0) for d in (2, 6, 40)]
    df = spark.createDataFrame(cases, "x double, d int").select("x", "d", chi_square_tail(F.col("x"), F.col("d")).alias("p"))
    for x, d, p in rows(df):
        want = math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(d // 2))
        assert p == pytest.approx(want, abs=1e-10)
    one = spark.createDataFrame([(3.84,)], "x double").select(chi_square_tail(F.col("x"), F.lit(1))).first()[0]
    assert one == pytest.approx(math.erfc(math.sqrt(1.92)), abs=1e-10)


def test_auc_with_ties_and_single_class(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.1), (1, 0.9)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(0.875)
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert M.roc_auc(one, "y", "s").first()[0] is None
    assert M.average_precision(one, "y", "s").first()[0] == 1.0
    single = spark.createDataFrame([(1, 1), (1, 0)], "y int, p int")
    assert M.weighted_metrics(single, "y", "p").first()["precision"] == 1.0
    assert {r["label"]: r["precision"] for r in M.class_metrics(single, "y", "p").collect()}[0] == 0.0
    report = {r["label"]: r for r in M.classification_report(single, "y", "p").collect()}
    assert report["accuracy"]["f1"] == 0.5 and report["macro avg"]["support"] == 2


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "a double, p double")
    out = M.regression_metrics(df, "a", "p").first()
    assert out["r2"] is None and out["mse"] == 0.5


def test_binned_bayes_with_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.1), (10.0, 5.0), (10.0, 5.1)], "y double, x double")
    params = B.fit_binned(df, ["x"], "y", bins=5)
    assert sorted(r["center"] for r in params.collect()) == [1.0, 9.0]
    out = sorted(r["prediction"] for r in B.predict_binned(df, params, ["x"]).collect())
    assert out == pytest.approx([1.0, 1.0, 9.0, 9.0])


def test_average_rank(spark):
    df = spark.createDataFrame([("a", 0.9, 3.0), ("b", 0.8, 1.0), ("c", 0.7, 2.0), ("d", 0.95, None)], "model string, r2 double, rmse double")
    out = {r["model"]: (r["avg_rank"], r["position"]) for r in K.average_rank(K.to_long(df, {"r2": "higher", "rmse": "lower"})).collect()}
    assert out == {"b": (1.0, 1), "a": (1.5, 2), "c": (2.0, 3)}


def test_vote_order(spark):
    data = [("mutual_info", "m", 1), ("correlation", "c1", 1), ("correlation", "c2", 2), ("rfe", "r", 1), ("feature_importance", "m", 2)]
    out = A.vote(spark.createDataFrame(data, "method string, feature string, place int"), take=3).collect()
    assert [(r["feature"], r["votes"]) for r in out] == [("m", 4), ("r", 3), ("c1", 1)] and out[0]["threshold"] == 1


def test_versions(spark):
    data = [(i, "m", f"1.0.{i}", i) for i in range(12)] + [(50, "n", "2.3.9", 5)]
    df = spark.createDataFrame(data, "id bigint, model_name string, version string, created_at int").withColumn("status", F.lit("active"))
    names = spark.createDataFrame([("m",), ("n",), ("new",)], "model_name string")
    assert dict(rows(R.next_versions(names, df))) == {"m": "1.0.12", "n": "2.3.10", "new": "1.0.0"}
    assert dict(rows(R.next_versions(names, df, "minor")))["n"] == "2.4.0"
    assert dict(rows(R.next_versions(names, df, "major")))["n"] == "3.0.0"
    gone = R.archive_old(df, 10).filter("status = 'archived'")
    assert sorted(r["version"] for r in gone.collect()) == ["1.0.0", "1.0.1"]
    assert R.exact_version(df, "m").first()["version"] == "1.0.11"
    assert R.exact_version(df, "m", "1.0.3").first()["id"] == 3
    assert R.archive_version(df, "n", "2.3.9").filter("status = 'archived'").count() == 1


def test_csv_tokens_and_malformed_lines(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('a,b,c\n1,NA,x\n2,NaN,""\nnull,3.5,y\n4,oops,z\n5,1.0,w,extra\n')
    schema = T.StructType.fromDDL("a int, b double, c string")
    got = sorted(rows(S.read_csv(spark, str(tmp_path / "raw.csv"), schema)), key=str)
    assert got == sorted([(1, None, "x"), (2, None, None), (None, 3.5, "y"), (4, None, "z")], key=str)


def test_unreadable_metric_documents_are_skipped(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"r2": 0.5, "mse": 2.0, "model": "x"}')
    (tmp_path / "bad.json").write_text("{not json")
    out = K.collect_metrics(spark, {"good": str(tmp_path / "good.json"), "bad": str(tmp_path / "bad.json")}).collect()
    assert [(r["model"], r["r2"], r["mae"]) for r in out] == [("good", 0.5, None)]


def test_json_text():
    from datetime import datetime
    from decimal import Decimal

    assert S.json_text({"a": Decimal("1.5"), "b": np.float64(2), "c": datetime(2024, 1, 2), "d": np.array([1, 2])}) == (
        '{"a": 1.5, "b": 2.0, "c": "2024-01-02T00:00:00", "d": [1, 2]}'
    )


@pytest.mark.parametrize(("pivots", "block"), [(1, 10_000), (8, 7), (40, 3)])
def test_neighbors_against_brute_force(spark, pivots, block):
    """Two thirds of the points are copies or near copies of one point; blocks are tiny."""
    random = np.random.default_rng(1)
    points = [random.normal(size=3).round(3).tolist() for _ in range(60)]
    points += [[1.0, 1.0, 1.0]] * 60 + [[1.0, 1.0, 1.0 + i * 1e-4] for i in range(60)]
    data = [(i, p, float(i % 7)) for i, p in enumerate(points)]
    df = spark.createDataFrame(data, "id bigint, vector array<double>, y double")
    asked = df.filter("id % 4 = 0")
    got = {}
    for r in N.nearest(asked, df, "id", "id", 6, "y", pivots=pivots, block_rows=block).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbor_id"], r["value"])
    matrix = np.array(points)
    for i in range(0, len(points), 4):
        distance = np.sqrt(((matrix - matrix[i]) ** 2).sum(1))
        want = np.lexsort((np.arange(len(points)), distance))[:6]
        assert [got[i][k + 1][0] for k in range(6)] == want.tolist()
        assert [got[i][k + 1][1] for k in range(6)] == [float(j % 7) for j in want]


def _brute(points, asked, train, k):
    matrix, train = np.array(points), np.asarray(train)
    out = {}
    for i in asked:
        distance = np.sqrt(((matrix[train] - matrix[i]) ** 2).sum(1))
        out[i] = train[np.lexsort((train, distance))[:k]].tolist()
    return out


@pytest.mark.parametrize("dims", [2, 10])
def test_neighbors_in_cells_of_a_hash_split(spark, monkeypatch, dims):
    """Cells come from the rows of a hash split and grow with them; some points are near copies far from the origin."""
    random = np.random.default_rng(dims)
    points = np.r_[random.normal(size=(1500, dims)), 1000 + random.integers(0, 9, size=(300, dims)) * 1e-5].tolist()
    df = hash_split(spark.createDataFrame([(i, p, float(i % 7)) for i, p in enumerate(points)], "id bigint, vector array<double>, y double"), "id")
    cells = []
    for kind in (N._Boxes, N._Regions):
        own = kind.__init__
        monkeypatch.setattr(kind, "__init__", lambda self, *a, own=own: (own(self, *a), cells.append(self.cells))[0])
    train = df.filter("is_train")
    for r, block in ((train.filter("id < 400"), 100), (train, 100)):
        got = {}
        for row in N.nearest(df.filter("not is_train"), r, "id", "id", 6, "y", block_rows=block).collect():
            got.setdefault(row["id"], {})[row["rank"]] = row["neighbor_id"]
        assert {i: [g[j] for j in range(1, 7)] for i, g in got.items()} == _brute(points, list(got), [x["id"] for x in r.collect()], 6)
        assert len(got) == df.filter("not is_train").count()
    assert cells[0] > 1 and cells[1] > 2 * cells[0]


def test_a_bounded_query_measures_no_more_rows_in_a_larger_table():
    """Rows of the visited cells, for a query with a bound: the same for 64 times the rows."""
    random, visited = np.random.default_rng(3), []
    for n in (2_000, 128_000):
        points = random.random((n, 2))
        boxes = N._Boxes(points, 64)
        rows, cells = boxes.near(points[:500], np.full(500, 1.5 / n**0.5))
        sizes = np.array([len(m) for m in boxes.members])
        assert sizes.sum() == n and sizes.max() <= 64
        visited.append(sizes[cells].sum() / 500)
    assert visited[1] < 1.2 * visited[0] < 400


@pytest.mark.parametrize("dims", [1, 3, 7, 64])
def test_search_against_brute_force(dims):
    """Bounds, ties, copies, rows near each other far from the origin, and very small and very large numbers."""
    random = np.random.default_rng(dims)
    plain = random.normal(size=(5000, dims))
    for ts in (plain, plain.round(1), 1e4 + plain * 1e-6, np.tile(plain[:500], (9, 1)), plain * 1e-30, plain * 1e20, plain[:3]):
        qs, tid = np.r_[ts[:200], ts[-200:] * 1.01], random.permutation(len(ts))
        distance = np.sqrt(((qs[:, None, :] - ts[None]) ** 2).sum(2))
        for bound in (np.full(len(qs), np.inf), np.sort(distance, axis=1)[:, min(3, len(ts) - 1)]):
            rows, cols, exact = N._search(qs, ts, tid, 5, bound)
            for i in range(len(qs)):
                within = np.flatnonzero(distance[i] <= bound[i])
                want = within[np.lexsort((tid[within], distance[i][within]))[:5]]
                assert cols[rows == i][: len(want)].tolist() == want.tolist()
                assert exact[rows == i][: len(want)].tolist() == distance[i][want].tolist()


def test_distance_weights_let_exact_hits_win(spark):
    near = spark.createDataFrame([(1, 1, 0.0, 9, 4.0), (1, 2, 1.0, 8, 100.0), (2, 1, 1.0, 7, 1.0), (2, 2, 2.0, 6, 4.0)], N._out_schema("q"))
    out = dict(rows(N.knn_regression(near, "q", "distance")))
    assert out[1] == 4.0 and out[2] == pytest.approx((1 + 2) / 1.5)


@pytest.fixture(scope="module")
def separable(spark):
    return spark.range(400).select(
        "id",
        (F.col("id") % 2).cast("int").alias("y"),
        ((F.col("id") % 2) * 4 + (F.col("id") * 7 % 10) / 10).alias("x1"),
        ((F.col("id") * 13 % 10) / 10).alias("x2"),
    )


def test_tree_learners(spark, separable):
    names = ["x1", "x2"]
    for name, params in (("random_forest", {"trees": 5}), ("decision_tree", {}), ("logistic", {})):
        model = trees.algorithm("classification", name, **params)(separable, names, "y")
        scored = trees.score_classes(model, separable, names, ["y"])
        assert M.accuracy(scored, "y", "y_pred").first()[0] == 1.0
        assert scored.filter("score < 0 or score > 1").count() == 0
    forest = trees.fit_forest_classifier(separable, names, "y", trees=5)
    again = trees.fit_forest_classifier(separable, names, "y", trees=5)
    assert forest.importances.tolist() == again.importances.tolist()
    weights = {r["feature"]: r["value"] for r in trees.importances(separable, names, forest).collect()}
    assert sum(weights.values()) == pytest.approx(1.0) and weights["x1"] > weights["x2"]
    ranks = dict(rows(A.eliminate_features(separable, names, "y", keep=1, trees=3)))
    assert ranks == {"x1": 1, "x2": 2}
    with pytest.raises(ValueError):
        trees.algorithm("classification", "none")


def test_linear_learners(spark, separable):
    df = separable.withColumn("t", 3 * F.col("x1") - 2 * F.col("x2") + 1)
    model = L.fit_ols(df, ["x1", "x2"], "t")
    assert list(model.coefficients) == pytest.approx([3.0, -2.0]) and model.intercept == pytest.approx(1.0)
    pdf = df.toPandas()
    x = pdf[["x1", "x2"]].to_numpy() - pdf[["x1", "x2"]].to_numpy().mean(0)
    y = pdf["t"].to_numpy() - pdf["t"].mean()
    want = np.linalg.solve(x.T @ x + 50 * np.eye(2), x.T @ y)
    assert list(L.fit_ridge(df, ["x1", "x2"], "t", 50.0).coefficients) == pytest.approx(list(want), rel=1e-6)
    weights = {r["y"]: r["class_weight"] for r in L.balanced_weights(df.filter("id < 3"), "y").collect()}
    assert weights == {0: 0.75, 1: 1.5}


def test_best_iteration(spark):
    scores = [0.5, 0.9] + [0.8] * 9 + [0.85, 0.7]
    df = spark.createDataFrame([(i + 1, s) for i, s in enumerate(scores)], "iteration int, accuracy double")
    out = trees.best_iteration(df).first()
    assert (out["best_iteration"], out["overfit_at"]) == (2, 12)


def test_numeric_modes_break_ties_by_number(spark):
    df = spark.createDataFrame([(9, "9"), (10, "10"), (None, None)], "n int, t string")
    assert rows(C.impute_mode(df, ["n", "t"]))[2] == (9, "10")


def test_csv_rows_do_not_depend_on_the_selection(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\nNA,x,0\n")
    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in "abc"])
    read = S.read_csv(spark, str(tmp_path / "f.csv"), schema)
    assert sorted(rows(read), key=str) == [(1, 2, 3), (4, 5, None), (None, None, 0)]
    assert read.count() == 3 and read.select("a").collect() == [r[:1] for r in read.collect()]


def test_a_saved_version_replaces_itself_only(spark, tmp_path):
    for version, n in (("1", 3), ("2", 4), ("1", 5)):
        S.save_version(spark.range(n), str(tmp_path / "v"), version)
    assert [S.load_version(spark, str(tmp_path / "v"), v).count() for v in ("1", "2")] == [5, 4]


def test_documents_of_one_name_keep_their_models(spark, tmp_path):
    paths = {}
    for i, model in enumerate(("ridge", "lasso")):
        (tmp_path / model).mkdir()
        (tmp_path / model / "metrics.json").write_text(f'{{"r2": {i / 10}}}')
        paths[model] = str(tmp_path / model / "metrics.json")
    assert {(r["model"], r["r2"]) for r in K.collect_metrics(spark, paths).collect()} == {("ridge", 0.0), ("lasso", 0.1)}


def test_null_features_count_as_zero(spark):
    df = spark.createDataFrame([(i, float(i % 5) if i % 4 else None, 5.0, float(i)) for i in range(40)], "i int, x double, c double, y double")
    marked = df.withColumn("label", F.col("i") % 2)
    scored = B.predict_gaussian(marked, B.fit_gaussian(marked, ["x", "c"], "label"), ["x", "c"])
    assert scored.filter("y_pred is null").count() == 0 and scored.count() == 40
    cv = L.cross_validate_linear(df.withColumn("fold", F.col("i") % 3), ["x", "c"], "y", "fold")
    assert sum(r["rows"] for r in cv.collect()) == 40


def test_models_do_not_depend_on_the_layout(spark):
    df = spark.range(3000).select(*[(F.xxhash64("id", F.lit(j)) % 100).cast("double").alias(f"x{j}") for j in range(3)], "id")
    df = df.withColumn("y", (F.col("x0") + F.col("x1") * 0.5 > 20).cast("int"))
    found = [rows(A.forest_importance(d, ["x0", "x1", "x2"], "y", trees=5, depth=4)[0]) for d in (df.repartition(2), df.repartition(7, "x2"), df.coalesce(1))]
    assert found[0] == found[1] == found[2]
    with pytest.raises(ValueError):
        trees.fit_forest_regressor(df, ["x0"], "y", depth=61)


def test_local_and_distributed_growth_agree(spark):
    df = spark.range(4000).select(*[(F.xxhash64("id", F.lit(j)) % 40).cast("double").alias(f"x{j}") for j in range(11)], "id")
    df = df.withColumn("y", (F.col("x0") + F.col("x1") * 0.5 + F.col("x10") > 20).cast("int")).withColumn("z", F.col("x0") * F.col("x1") + F.col("id") % 3)
    names = [f"x{j}" for j in range(11)]
    key = lambda m: [(n, f, None if f is None else cut, rows) for n, f, cut, rows, _ in m.nodes()]
    for target, classes, criterion in (("y", [0, 1], "gini"), ("y", [0, 1], "entropy"), ("z", None, "gini")):
        whole, split = (G.fit(df, names, target, classes, depth=4, min_split=20, min_leaf=5, criterion=criterion, local_cells=c) for c in (10**6, 300))
        assert key(whole) == key(split)
        assert [r for *_, r, _ in whole.nodes()][0] == 4000


def test_trees_by_brute_force(spark):
    rows_ = [(i, (i * 37 % 11) / 2, float(i * 13 % 7), (i * i) % 5 > 1, (i % 9) * 1.5) for i in range(300)]
    df = spark.createDataFrame(rows_, "id int, a double, b double, c boolean, y double").withColumn("k", F.col("c").cast("int"))
    model = G.fit(df, ["a", "b"], "k", [0, 1], depth=1, min_leaf=10)

    def gini(part):
        p = sum(r[3] for r in part)
        return 2 * p * (len(part) - p) / len(part) if part else 0.0

    best = None
    for f, j in (("a", 1), ("b", 2)):
        values = sorted({r[j] for r in rows_})
        for low, high in zip(values, values[1:], strict=False):
            left, right = [r for r in rows_ if r[j] <= low], [r for r in rows_ if r[j] > low]
            gain = round(gini(rows_) - gini(left) - gini(right), 6)
            if min(len(left), len(right)) >= 10 and (best is None or gain > best[0]):
                best = (gain, f, (low + high) / 2)
    root = model.nodes()[0]
    assert (root[1], root[2]) == best[1:]
    full = G.fit(df, ["a", "b"], "y")
    cells = {}
    for r in rows_:
        cells.setdefault(r[1:3], []).append(r[4])
    got = full.score(df, ["id", "a", "b"]).collect()
    assert all(r["prediction"] == pytest.approx(np.mean(cells[r["a"], r["b"]])) for r in got)


def test_trees_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 5.0, 1), (3, 5.0, None), (4, float(2**40), 1)], "id int, x double, y int")
    model = trees.fit_tree_classifier(df, ["x"], "y", min_split=2, min_leaf=1)
    assert {r["id"]: r["y_pred"] for r in model.score(df, ["id"]).collect()} == {1: 0, 2: 1, 3: 1, 4: 1}
    constant = trees.fit_forest_regressor(df.withColumn("x", F.lit(1.0)), ["x"], "y", trees=3)
    assert [len(t["id"]) for t in constant.trees] == [1] * len(constant.trees) and constant.importances.tolist() == [0.0]
    gap = trees.overfit_gap(model, df.filter("id < 3"), df.filter("id = 4"), "y").first()
    assert tuple(gap) == (1.0, 1.0, 0.0)
    assert trees.tree_rules(model).splitlines()[0] == "all"


def test_boosting_stops_after_its_best_round(spark):
    falling = [1 / (i + 1) for i in range(10)]
    assert boosting.rounds_kept(falling, 5, 1e-4) == (10, False)
    assert boosting.rounds_kept([*falling, *[0.2] * 4], 5, 1e-4) == (10, False)
    assert boosting.rounds_kept([*falling, *[0.2] * 5], 5, 1e-4) == (10, True)
    assert boosting.rounds_kept([1.0, 0.99995, 0.9999, 0.99985], 3, 1e-3) == (1, True)
    df = spark.range(600).select("id", (F.col("id") % 10).cast("double").alias("a"), F.pmod(F.xxhash64("id"), F.lit(10)).cast("double").alias("b"))
    df = df.withColumn("y", (F.col("a") + F.pmod(F.xxhash64("id", F.lit(3)), F.lit(7)) > 7).cast("int"))
    model = trees.fit_boosting_classifier(df, ["a", "b"], "y", "id", rounds=40, rate=0.5)
    held = [loss for _, loss in model.losses]
    assert len(model.trees) == len(held) == model.best + 5 and min(held) >= held[model.best - 1] - 1e-4
    got = {(r["split"], r["iteration"]): r["accuracy"] for r in trees.staged_accuracy(model, df.withColumn("part", F.col("id") < 500), ["a", "b"], "y", "part").collect()}
    assert len(got) == 2 * len(held) and got[True, model.best] > 0.75
    scored = model.score(df, ["id", "y"]).collect()
    right = sum(r["y_pred"] == r["y"] for r in scored if r["id"] < 500) / 500
    assert right == pytest.approx(got[True, model.best]) and all(0 < r["score"] < 1 for r in scored)
    assert model.importances[0] > model.importances[1]


def test_boosting_of_squares_by_brute_force(spark):
    rows_ = [(i, float(i % 6), (i * 7 % 11) / 2.0) for i in range(60)]
    df = spark.createDataFrame(rows_, "id int, x double, y double")
    model = boosting.fit(df, ["x"], "y", False, rounds=3, rate=0.5, depth=1)
    y, x = np.array([r[2] for r in rows_]), np.array([r[1] for r in rows_])
    margin = np.full(60, y.mean())
    for _ in range(3):
        rest = y - margin
        best = max(np.arange(5), key=lambda c: (round(rest[x <= c].sum() ** 2 / (x <= c).sum() + rest[x > c].sum() ** 2 / (x > c).sum(), 6), -c))
        margin = margin + 0.5 * np.where(x <= best, rest[x <= best].mean(), rest[x > best].mean())
    got = {r["id"]: r["prediction"] for r in model.score(df, ["id"]).collect()}
    assert [got[i] for i in range(60)] == pytest.approx(margin.tolist())
    assert model.best == 3 and model.losses[-1][0] == pytest.approx(((y - margin) ** 2).mean())


def test_vectors_with_nulls_raise(spark):
    good = spark.createDataFrame([(1, [0.0, 1.0], 2.0), (2, [1.0, 1.0], 3.0)], "id int, vector array<double>, y double")
    bad = spark.createDataFrame([(3, [0.0, None], 2.0)], "id int, vector array<double>, y double")
    assert N.nearest(good, good, "id", "id", 1, "y").count() == 2
    for queries, train in ((bad, good), (good, bad.unionAll(good))):
        with pytest.raises(Exception, match="holds a null"):
            N.nearest(queries, train, "id", "id", 1, "y").collect()


def test_registration_refuses_repeats(spark):
    from tablewright.operators import registry as R

    schema = "id long, model_name string, model_hash string, _note string"
    known = spark.createDataFrame([(1, "a", "x", None), (2, "b", None, None)], schema)
    rows = [(3, "a", "n", None), (4, "c", "x", None), (5, "d", "y", "p"), (6, "e", "y", None), (7, "f", None, None), (8, "g", None, None)]
    batch = spark.createDataFrame(rows, schema)
    taken = R.accepted_models(batch, known)
    assert taken.columns == batch.columns and sorted(tuple(r) for r in taken.collect()) == [rows[2], rows[4], rows[5]]
    assert R.accepted_models(batch, known.unionByName(taken)).count() == 0
    assert R.accepted_models(batch.limit(0), known).count() == 0
    parameters = spark.createDataFrame([(5, "k"), (6, "k"), (5, "j")], "model_id long, parameter_name string")
    assert sorted(r[1] for r in R.registered_parameters(taken, parameters).collect()) == ["j", "k"]


def test_gains_and_accuracy_need_no_collected_trees(spark):
    """What stays on the executors says the same as the collected forest, whole or split into subtrees."""
    df = spark.range(3000).select(*[(F.xxhash64("id", F.lit(j)) % 20).cast("double").alias(f"x{j}") for j in range(10)], "id")
    df = df.withColumn("y", (F.col("x0") + F.col("x9") * 0.5 > 3).cast("int"))
    names = [f"x{j}" for j in range(10)]
    for cells in (10**6, 900):
        common = {"classes": [0, 1], "trees": 2, "depth": 4, "subset": "sqrt", "bootstrap": True, "local_cells": cells}
        forest = G.fit(df, names, "y", **common)
        right = forest.score(df, ["y"]).agg(F.avg((F.col("y_pred") == F.col("y")).cast("double"))).first()[0]
        for keep in ("gains", "leaves"):
            weighed = G.fit(df, names, "y", **common, keep=keep)
            assert weighed.importances.tolist() == pytest.approx(forest.importances.tolist())
            assert weighed.accuracy is None if keep == "gains" else weighed.accuracy == pytest.approx(right)


def test_draws_are_those_of_the_column_hash(spark):
    rows_ = spark.range(300).select(F.xxhash64("id").alias("r"), F.xxhash64(F.xxhash64("id")).alias("s"))
    wanted = rows_.select("s", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("t"), F.pmod(F.xxhash64("r", "t", F.lit(42)), F.lit(1 << 32)).alias("u")).toPandas()
    state = wanted[wanted["t"] == 0]["s"].to_numpy().view(np.uint64)
    drawn = G._draws(state, np.arange(7), 42)
    below = [sum(np.exp(-1) / math.factorial(i) for i in range(k)) for k in range(1, 9)]
    for t in range(7):
        u = wanted[wanted["t"] == t]["u"].to_numpy() / 2.0**32
        assert drawn[t].tolist() == np.searchsorted(below, u, side="right").tolist()


def test_rows_between_the_same_limits_are_predicted_once(spark):
    df = spark.range(500).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("y"))
    forest = G.fit(df, ["a", "b"], "y", trees=3, bootstrap=True)
    x = np.array([[i % 50, i % 7] for i in range(500)] + [[np.nan, 3.0], [-1.0, np.inf]], float)
    for _ in range(2):
        assert forest.predict_each(x).tolist() == forest.predict(x).tolist()


def test_layouts_have_a_bounded_number_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(A, "LAYOUT_ROWS", 2)
    assert A.fixed_layout(spark.range(2000)).rdd.getNumPartitions() == 256


def test_boosting_of_numbers_works_on_cells(spark, separable):
    model = trees.fit_boosting_regressor(separable, ["x1", "x2"], "y", rounds=5)
    assert len(model.trees) == 5 and model.base == pytest.approx(0.5)
    errors = [e for e, _ in model.losses]
    assert errors == sorted(errors, reverse=True) and errors[-1] == pytest.approx(0.25 * 0.9**10)


def test_grid_search_stores_the_blocks_of_each_fold(spark, separable, monkeypatch):
    from pyspark import StorageLevel
    from pyspark.ml.classification import LogisticRegression

    seen, own = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, rows: seen.append(rows.storageLevel) or own(self, rows))
    df = separable.withColumn("fold", (F.xxhash64("id") % 2 != 0).cast("int"))
    table, model = trees.grid_search(df, LogisticRegression(labelCol="y"), {"regParam": [0.1, 1.0]}, ["x1", "x2"], "y", "fold", 2)
    assert table.count() == 2 and model.numFeatures == 2
    assert len(seen) == 5 and all(s == StorageLevel.NONE for s in seen)
    with pytest.raises(ValueError):
        trees.grid_search(df, LogisticRegression(labelCol="y"), {"regParam": [0.1]}, ["x1"], "y", "fold", 3)


def test_fitted_rows_are_not_marked_as_kept(spark):
    from pyspark import StorageLevel

    class Learner:
        def fit(self, rows):
            return rows.storageLevel, rows.count()

    assert A.fit_on(Learner(), spark.range(50)) == (StorageLevel.NONE, 50)


def test_forests_of_small_tables_shuffle_nothing_for_a_tree(spark, monkeypatch):
    """Importance and elimination send the bins to the workers; the cells of a tree are no table."""
    cell = F.xxhash64("id")
    df = spark.range(400).select(*[F.when(F.pmod(cell, F.lit(9 + j)) > 0, F.pmod(F.shiftright(cell, 8 * j), F.lit(4))).alias(f"x{j}") for j in range(5)], "id")
    df = df.withColumn("y", F.when(F.col("id") % 17 > 0, (F.coalesce("x0", F.lit(0)) + F.coalesce("x4", F.lit(1)) > 3).cast("int")))
    df, names = df.unionAll(df.filter("id % 3 = 0")), [f"x{j}" for j in range(5)]
    common = {"classes": [0, 1], "trees": 6, "subset": "sqrt", "bootstrap": True, "keep": "leaves"}
    with monkeypatch.context() as large:
        large.setattr(G, "GATHERED", 0)
        wanted = G.fit(df, names, "y", **common)
        ranks = rows(A.eliminate_features(df, names, "y", keep=2, trees=6))

    def cells(*args, **kwargs):
        raise AssertionError("cells of all trees")

    monkeypatch.setattr(G, "cells", cells)
    found = G.fit(df, names, "y", **common)
    assert found.importances.tolist() == pytest.approx(wanted.importances.tolist()) and found.accuracy == pytest.approx(wanted.accuracy)
    assert rows(A.eliminate_features(df, names, "y", keep=2, trees=6)) == ranks


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("bins", [3, 100])
def test_each_split_is_the_best_of_its_node(whole, bins):
    random = np.random.default_rng(bins)
    cells = np.unique(random.integers(0, [bins, 2, 1, bins], (300, 4)).astype(np.int8), axis=0)
    n = random.integers(1, 4, len(cells)).astype(float)
    first = random.integers(0, 2, len(cells)).astype(bool)
    sums = np.column_stack([n * first, n * ~first]) * (1.0 if whole else 0.37)
    got = G.grow_local(1, cells, n, sums, G.Rules("gini", 60, 2, 1, 0.0, 4, 127, 1), 0)
    inside = {1: np.ones(len(cells), bool)}

    def lost(some):
        s = sums[some].sum(0)
        return s.sum() - (s**2).sum() / s.sum()

    for i, node in enumerate(got["id"].tolist()):
        here = inside[node]
        assert got["totals"][i].tolist() == pytest.approx([n[here].sum(), *sums[here].sum(0)])
        gains = {}
        for f in range(4):
            for b in np.unique(cells[here, f])[:-1].tolist():
                low = here & (cells[:, f] <= b)
                gains[f, b] = round(lost(here) - lost(low) - lost(here & ~low), 6)
        best = max(gains.values(), default=0.0)
        assert got["gain"][i] == pytest.approx(max(best, 0.0), abs=2e-6)
        if got["feature"][i] >= 0:
            f, b = got["feature"][i], got["bin"][i]
            inside[2 * node], inside[2 * node + 1] = here & (cells[:, f] <= b), here & (cells[:, f] > b)
        else:
            assert (got["leaf"][here] == i).all()


def _repeated(spark):
    """2,000 rows of 40 kinds, with null features and rows without a label."""
    df = spark.range(2000).select((F.col("id") % 5).cast("double").alias("a"), F.when(F.col("id") % 8 > 0, (F.col("id") % 8) / 4).alias("b"), (F.col("id") % 2).cast("int").alias("fold"))
    return df.withColumn("y", F.when(F.rand(3) > 0.05, (F.col("a") + F.coalesce("b", F.lit(0.0)) > 2.6).cast("int"))).cache()


def test_support_vectors_of_equal_rows(spark, monkeypatch):
    """Equal rows of a large table are fitted as one of their weight, and are counted as the rows that they are."""
    from tablewright.operators import kernel

    df, seen = _repeated(spark), []
    wanted = kernel.fit_svm(df, ["a", "b"], "y", waves=16)
    laid_out = kernel._laid_out
    monkeypatch.setattr(kernel, "_laid_out", lambda given, *args: seen.append(given.count()) or laid_out(given, *args))
    monkeypatch.setattr(A, "COMBINED_ROWS", 1000)
    found = kernel.fit_svm(df, ["a", "b"], "y", waves=16)
    assert seen == [df.filter("y is not null").select("a", "b", "y").distinct().count()] and seen[0] <= 40
    said = [{(r["a"], r["b"], r["y_pred"]) for r in m.predict(df, ["a", "b"]).collect()} for m in (wanted, found)]
    assert said[0] == said[1]
    assert sorted(rows(found.support_rows(df.na.drop(subset=["y"])).select("y", "rows"))) == sorted(rows(df.na.drop(subset=["y"]).groupBy("y").count()))
    different = spark.range(2000).select(F.col("id").cast("double").alias("a"))
    assert A.combined(different) is None and A.combined(different.limit(500)) is None


def test_grid_search_of_equal_rows(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression

    df = _repeated(spark).withColumn("w", F.col("a") + 1)
    monkeypatch.setattr(A, "COMBINED_PARTS", 200)
    for learner in (LogisticRegression(labelCol="y"), LogisticRegression(labelCol="y", weightCol="w")):
        found = []
        for least in (10**6, 1000):
            monkeypatch.setattr(A, "COMBINED_ROWS", least)
            table, model = trees.grid_search(df, learner, {"regParam": [0.01, 1.0]}, ["a", "b"], "y", "fold", 2)
            found.append((rows(table), model.coefficients.toArray().tolist(), model.summary.totalIterations >= 0))
        assert [r[0] for r in found[0][0]] == [r[0] for r in found[1][0]]
        assert [r[1] for r in found[1][0]] == pytest.approx([r[1] for r in found[0][0]])
        assert found[1][1] == pytest.approx(found[0][1], rel=1e-2)
    few = A.combined(df, parts=200)
    assert 200 <= few.count() < 300 and few.agg(F.sum("_n")).first()[0] == pytest.approx(2000)
