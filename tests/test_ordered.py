"""The chunked plans must give what one plain window or aggregate gives, also with hot keys and ties."""

import math
import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.functions import ordered as O
from tablewright.operators import clean as C
from tablewright.operators import metrics as M
from tablewright.operators import quality as Q
from tablewright.operators import split as S


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one group, a third share one order value, some order values are null."""
    random.seed(7)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 else (None if i % 27 == 0 else f"g{i % 40}")
        order = 5.0 if i % 3 == 1 else (None if i % 101 == 0 else float(random.randint(0, 60)))
        value = None if random.random() < 0.35 else round(random.random() * 100, 2)
        rows.append((i, group, order, value))
    return spark.createDataFrame(rows, "id bigint, g string, o double, v double").cache()


@pytest.mark.parametrize("method", ["row_number", "rank"])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("group", [[], ["g"]])
def test_positions(skewed, method, descending, group):
    plain = O.positions(skewed, "o", "id", group, descending, method=method).collect()
    cut = O.positions(skewed, "o", "id", group, descending, method=method, chunks=7).collect()
    assert {r["id"]: r["position"] for r in plain} == {r["id"]: r["position"] for r in cut}
    assert len(cut) == 3000


def test_no_chunk_is_much_larger_than_its_share(skewed):
    plan = O.plan_chunks(skewed, "o", "id", parts=10)
    sizes = [r["count"] for r in O.with_chunk(skewed, "o", "id", plan).groupBy("_chunk").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 10
    assert max(sizes) <= 2.5 * 3000 / 10


KINDS = {
    "text": lambda i: None if i % 41 == 0 else f"order-{i * 37 % 200:04d}",
    "dates": lambda i: f"2024-{1 + i * 5 % 12:02d}-{1 + i * 7 % 28:02d}",
    "wide": lambda i: 2**60 + i * 7 % 300,
    "decimals": lambda i: None if i % 50 == 1 else Decimal(i * 13 % 400) / 8 + Decimal(2) ** 70,
    "heavy": lambda i: "same" if i % 3 else f"s{i % 9}",
    "moments": lambda i: datetime(2024, 1, 1) + timedelta(microseconds=i * 31 % 977),
}


@pytest.fixture(scope="module", params=sorted(KINDS))
def typed(request, spark):
    kind = {"wide": "bigint", "decimals": "decimal(38,4)", "moments": "timestamp"}.get(request.param, "string")
    make = KINDS[request.param]
    rows = [(f"k{i * 7919 % 600:05d}", f"g{i % 4}" if i % 11 else None, make(i), None if i % 3 == 0 else i * 1.5) for i in range(600)]
    return spark.createDataFrame(rows, f"id string, g string, o {kind}, v double").repartition(3)


@pytest.mark.parametrize("method", ["row_number", "rank"])
def test_positions_of_any_type(typed, method):
    for down in (False, True):
        for group in ([], ["g"]):
            plain = O.positions(typed, "o", "id", group, down, method=method, chunks=1).collect()
            cut = O.positions(typed, "o", "id", group, down, method=method, chunks=4).collect()
            assert {r["id"]: r["position"] for r in plain} == {r["id"]: r["position"] for r in cut} and len(cut) == 600


def test_other_primitives_of_any_type(typed):
    ranks = [0, 1, 50, 299, 300, 587, 600, 601]
    assert O.nth_keys(typed, "o", "id", ranks, 1) == O.nth_keys(typed, "o", "id", ranks, 5)
    for make in (
        lambda n: O.previous_values(typed, "o", "id", {"p": "v"}, ["g"], chunks=n),
        lambda n: C.interpolate(typed, "g", "o", "id", ["v"], chunks=n),
    ):
        assert sorted(map(str, make(1).collect())) == sorted(map(str, make(4).collect()))


def test_splits_keep_every_row(typed):
    rows = S.chronological_split(typed, "o", "id", 0.25).groupBy("is_train").count().collect()
    assert {r["is_train"]: r["count"] for r in rows} == {True: 450, False: 150}
    folds = S.contiguous_folds(typed, "o", "id", 5).groupBy("fold").count().collect()
    assert {r["fold"]: r["count"] for r in folds} == dict.fromkeys(range(5), 120)
    gaps = typed.withColumn("id", F.when(F.col("v").isNotNull(), F.col("id")))
    for part in (S.stratified_split(gaps, "id", "g"), S.stratified_split(gaps, "id", None)):
        counted = {r["is_train"]: r["count"] for r in part.groupBy("is_train").count().collect()}
        assert sum(counted.values()) == 600 and counted[False] >= 120 and None not in counted
    assert S.stratified_folds(gaps, "id", "g", 3).filter("fold is null").count() == 0


def test_running_totals(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).cast("double").alias("o"), (F.col("id") % 5).alias("n"))
    for down in (False, True):
        plain = {r["o"]: r["t"] for r in O.running_totals(df, "o", {"t": "n"}, descending=down).collect()}
        cut = {r["o"]: r["t"] for r in O.running_totals(df, "o", {"t": "n"}, descending=down, chunks=9).collect()}
        assert plain == cut


def test_previous_values(skewed):
    plain = O.previous_values(skewed, "o", "id", {"p": "v"}, ["g"], steps=3).collect()
    cut = O.previous_values(skewed, "o", "id", {"p": "v"}, ["g"], steps=3, chunks=6).collect()
    assert {r["id"]: r["p"] for r in plain} == {r["id"]: r["p"] for r in cut}


PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("group", [[], ["g"]])
def test_bracketed_quantiles_match(skewed, group):
    def rows(df):
        return {tuple(r[g] for g in group): (r["v"], r["o"]) for r in df.collect()}

    plain = rows(O.exact_quantiles(skewed, ["v", "o"], PROBS, group, small=True))
    # Groups above 500 values go through the sketch brackets.
    cut = rows(O.exact_quantiles(skewed, ["v", "o"], PROBS, group, small=False, whole_group_values=500, accuracy=100))
    whole = rows(O.exact_quantiles(skewed, ["v", "o"], PROBS, group, small=False))
    assert plain.keys() == cut.keys() == whole.keys()
    for k in plain:
        for a, b, c in zip(plain[k], cut[k], whole[k], strict=True):
            assert (a is None) == (b is None) == (c is None)
            if a is not None:
                assert np.allclose(a, b, atol=1e-9) and np.allclose(a, c, atol=1e-9)


def test_quantiles_of_an_all_null_group(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", 4.0)], "g string, v double")
    for small in (True, False):
        out = {r["g"]: r["v"] for r in O.exact_quantiles(df, ["v"], [0.5], ["g"], small=small).collect()}
        assert out == {"a": None, "b": [2.5]}
    nothing = df.filter("g = 'a'")
    assert O.exact_quantiles(nothing, ["v"], [0.5], small=False).collect()[0]["v"] is None


@pytest.mark.parametrize("chunks", [None, 5, 40])
def test_interpolation_matches_pandas(spark, skewed, chunks):
    got = {r["id"]: r["v"] for r in C.interpolate(skewed, "g", "o", "id", ["v"], chunks).collect()}
    pdf = skewed.toPandas().sort_values(["g", "o", "id"], na_position="last")
    want = pdf.groupby("g")["v"].transform(lambda x: x.interpolate(method="linear"))
    want = want.where(pdf["g"].notna(), pdf["v"])  # rows without a group keep what they have
    for i, w in zip(pdf["id"], want, strict=True):
        assert (got[i] is None and math.isnan(w)) or got[i] == pytest.approx(w, abs=1e-9)


def test_nth_key_large_form(spark, skewed, monkeypatch):
    rows = skewed.filter("o is not null")
    ordered = [(r["o"], r["id"]) for r in rows.orderBy("o", "id").collect()]
    monkeypatch.setattr(O, "is_small", lambda df: False)
    for n in (1, 2, 700, 1000, 1500, len(ordered)):
        assert O.nth_key(rows, "o", "id", n) == ordered[n - 1]
    assert O.nth_key(rows, "o", "id", 0) is None
    monkeypatch.setattr(O, "WHOLE_GROUP_VALUES", 10)
    monkeypatch.setattr(O, "SKETCH_ACCURACY", 100)
    assert O.nth_key(rows, "o", "id", 1234) == ordered[1233]


def test_hash_thresholds_with_few_slots(spark, skewed):
    from tablewright.functions.scalar import md5_bits

    wanted = F.array(F.ceil(F.col("n") * 0.2).cast("bigint"), F.col("n"), F.lit(1).cast("bigint"))
    order = Window.partitionBy("g").orderBy(md5_bits(F.col("id")), "id")
    ranked = skewed.withColumn("r", F.row_number().over(order)).collect()
    sizes = {}
    for r in ranked:
        sizes[r["g"]] = max(sizes.get(r["g"], 0), r["r"])
    by_rank = {(r["g"], r["r"]): r["id"] for r in ranked}
    for bits in (1, 8, 16):
        for row in O.hash_thresholds(skewed, "id", wanted, ["g"], bits).collect():
            n = sizes[row["g"]]
            got = [row["cuts"][i]["key"] for i in range(3)]
            assert got == [by_rank[row["g"], math.ceil(n * 0.2)], by_rank[row["g"], n], by_rank[row["g"], 1]]


def test_auc_and_ap_chunked(spark):
    random.seed(3)
    rows = [(random.randint(0, 1), round(random.random(), 2)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for chunks in (None, 8):
        assert M.roc_auc(df, "y", "s", chunks=chunks).first()[0] == pytest.approx(want)
    assert M.average_precision(df, "y", "s").first()[0] == pytest.approx(M.average_precision(df, "y", "s", chunks=8).first()[0])


def test_ks_chunked(spark):
    df = spark.range(400).select((F.col("id") % 37).cast("double").alias("v"), (F.col("id") % 3 == 0).alias("r"))
    a = Q.ks_statistic(df, "v", F.col("r")).first()
    b = Q.ks_statistic(df, "v", F.col("r"), chunks=5).first()
    assert a["statistic"] == pytest.approx(b["statistic"])


def test_splits_are_exact(spark, skewed):
    n = skewed.count()
    got = S.stratified_split(skewed, "id", "g", 0.25).groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_train")).alias("t")
    )
    assert all(r["t"] == math.ceil(r["n"] * 0.25) for r in got.collect())
    assert S.stratified_split(skewed, "id", None, 0.2).filter("not is_train").count() == math.ceil(n * 0.2)
    folds = S.stratified_folds(skewed, "id", "g", 5).groupBy("g", "fold").count().toPandas()
    spread = folds.groupby("g", dropna=False)["count"].agg(["min", "max"])
    assert (spread["max"] - spread["min"]).max() <= 1
    contiguous = S.contiguous_folds(skewed.filter("o is not null"), "o", "id", 4).toPandas().sort_values(["o", "id"])
    want = [4 * i // len(contiguous) for i in range(len(contiguous))]
    assert list(contiguous["fold"]) == want


def test_medians_match_pandas(spark, skewed):
    pdf = skewed.toPandas()
    got = {r["id"]: r["v"] for r in C.impute_group_median(skewed, "g", ["v"]).collect()}
    filled = pdf.groupby("g")["v"].transform(lambda x: x.fillna(x.median())).where(pdf["g"].notna(), pdf["v"])
    filled = filled.fillna(filled.median())
    assert all(got[i] == pytest.approx(w) for i, w in zip(pdf["id"], filled, strict=True))
    assert isinstance(pdf, pd.DataFrame)
