"""Queries for feature engineering, encoders and scalers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import features as X
from tablewright.operators.split import hash_split
from tablewright.plans.registry import query
from tablewright.plans.tables import GAPPY, gappy_events, md5_sql, table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df, columns, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


@query(
    "date_parts",
    "F1",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       CAST(day(o_orderdate) AS INT) AS day, CAST(isodow(o_orderdate) - 1 AS INT) AS day_of_week FROM orders""",
)
def date_parts(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return X.date_parts(o, "o_orderdate").drop("o_orderdate")


@query(
    "one_hot",
    "F2 D5",
    f"""WITH {GAPPY}
    SELECT event_id, coalesce(event_type = 'error', false) AS event_type_error,
           coalesce(event_type = 'purchase', false) AS event_type_purchase,
           coalesce(event_type = 'signup', false) AS event_type_signup, coalesce(event_type = 'view', false) AS event_type_view
    FROM gappy""",
)
def one_hot(spark, folder):
    return X.one_hot(gappy_events(spark, folder).select("event_id", "event_type"), ["event_type"])


@query(
    "one_hot_sparse",
    "F2",
    """WITH l AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS i FROM (SELECT DISTINCT p_type FROM part))
    SELECT p_partkey, i AS hot FROM part JOIN l USING (p_type)""",
)
def one_hot_sparse(spark, folder):
    from pyspark.ml.functions import vector_to_array

    encoded, _ = X.one_hot_sparse(table(spark, folder, "part").select("p_partkey", "p_type"), "p_type", "v")
    return encoded.select("p_partkey", (F.array_position(vector_to_array("v"), F.lit(1.0)) - 1).alias("hot"))


@query("yes_no_flags", "F3", f"WITH {GAPPY} SELECT event_id, CAST(coalesce(event_type = 'view', false) AS INT) AS flag FROM gappy")
def yes_no_flags(spark, folder):
    return gappy_events(spark, folder).select("event_id", X.yes_flag(F.col("event_type"), "view").alias("flag"))


@query(
    "differences",
    "F4",
    """SELECT l_returnflag, round(sum(l_quantity - l_tax), 2) AS a, round(sum(l_tax - l_discount), 2) AS b
       FROM lineitem GROUP BY 1""",
)
def differences(spark, folder):
    li = table(spark, folder, "lineitem")
    out = X.differences(li, {"a": ("l_quantity", "l_tax"), "b": ("l_tax", "l_discount"), "c": ("l_tax", "none")})
    return out.groupBy("l_returnflag").agg(F.round(F.sum("a"), 2).alias("a"), F.round(F.sum("b"), 2).alias("b"))


@query(
    "interactions",
    "F5",
    """SELECT l_returnflag, round(sum(l_quantity * l_discount), 2) AS product, round(sum((l_tax + l_discount) / 2), 2) AS average,
       round(sum(l_extendedprice - l_quantity), 2) AS span FROM lineitem GROUP BY 1""",
)
def interactions(spark, folder):
    out = X.interactions(
        table(spark, folder, "lineitem"),
        products={"product": ("l_quantity", "l_discount")},
        averages={"average": ("l_tax", "l_discount")},
        ranges={"span": ("l_extendedprice", "l_quantity")},
    )
    return out.groupBy("l_returnflag").agg(*[F.round(F.sum(c), 2).alias(c) for c in ("product", "average", "span")])


@query(
    "transform_table",
    "F6 F1 F2 F3 F4 C4",
    f"""WITH {GAPPY}, m AS (SELECT median(value) AS v, median(level) AS l FROM gappy),
    f AS (SELECT gappy.*, coalesce(value, (SELECT v FROM m)) AS v, coalesce(level, (SELECT l FROM m)) AS l FROM gappy)
    SELECT event_id, user_id, round(v, 6) AS value, round(l, 6) AS level,
           CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
           CAST(isodow(ts) - 1 AS INT) AS day_of_week,
           event_id % 3 = 1 AS kind_b, event_id % 3 = 2 AS kind_c,
           CAST(coalesce(event_type = 'view', false) AS INT) AS event_type_binary, round(l - v, 6) AS spread,
           user_id % 2 = 1 AS place_south
    FROM f""",
)
def transform_table(spark, folder):
    ev = gappy_events(spark, folder).withColumns(
        {
            "kind": F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("event_id") % 3 + 1).cast("int")),
            "place": F.when(F.col("user_id") % 2 == 1, "south").otherwise("north"),
            "event_type": F.when(F.col("event_type") == "view", "Yes").otherwise("No"),
        }
    )
    out = X.transform_table(ev, "ts", ["kind"], ["event_type"], "place", {"spread": ("level", "value")})
    return _rounded(out, ["value", "level", "spread"])


LABELS = f"""split AS (SELECT o_orderkey, o_orderpriority, {md5_sql('o_orderkey')} >= 858993459 AS is_train FROM orders),
known AS (SELECT DISTINCT o_orderpriority FROM split WHERE is_train AND o_orderpriority <> '3-MEDIUM'),
ids AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS id FROM known)"""


@query(
    "label_encode_unseen",
    "F7 F8 T2",
    f"WITH {LABELS} SELECT o_orderkey, CAST(coalesce(id, (SELECT count(*) FROM ids)) AS INT) AS code FROM split LEFT JOIN ids USING (o_orderpriority)",
)
def label_encode_unseen(spark, folder):
    o = hash_split(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey")
    labels = X.fit_labels(o.filter(F.col("is_train") & (F.col("o_orderpriority") != "3-MEDIUM")), "o_orderpriority")
    return X.apply_labels(o, "o_orderpriority", labels, "code").select("o_orderkey", "code")


@query(
    "label_encode_target",
    "F8",
    """WITH ids AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS id FROM (SELECT DISTINCT l_returnflag FROM lineitem))
    SELECT CAST(id AS INT) AS code, count(*) AS n FROM lineitem JOIN ids USING (l_returnflag) GROUP BY 1""",
)
def label_encode_target(spark, folder):
    li = table(spark, folder, "lineitem").select("l_returnflag")
    out = X.apply_labels(li, "l_returnflag", X.fit_labels(li, "l_returnflag"), "code", on_unseen="error")
    return out.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "scaler_parameters",
    "F9 F10",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 4) AS center, round(stddev_pop({c}), 4) AS scale FROM lineitem" for c in NUMBERS
    ),
)
def scaler_parameters(spark, folder):
    return _rounded(X.fit_scaler(table(spark, folder, "lineitem"), NUMBERS), ["center", "scale"], 4)


def _scaled_check(columns):
    return [f for c in columns for f in (F.round(F.sum(c), 2).alias(f"sum_{c}"), F.round(F.max(c), 6).alias(f"max_{c}"))]


def _scale_sql(kind):
    params = {
        "standard": "avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}",
        "minmax": "min({c}) AS m_{c}, max({c}) - min({c}) AS s_{c}",
        "robust": "median({c}) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}",
    }[kind]
    outs = ", ".join(
        f"round(sum(({c} - m_{c}) / s_{c}), 2) AS sum_{c}, round(max(({c} - m_{c}) / s_{c}), 6) AS max_{c}" for c in NUMBERS
    )
    fit = f"WHERE {md5_sql('l_orderkey')} >= 858993459"
    return f"WITH p AS (SELECT {', '.join(params.format(c=c) for c in NUMBERS)} FROM lineitem {fit}) SELECT l_returnflag, {outs} FROM lineitem, p GROUP BY 1"


def _scaled(spark, folder, kind):
    li = hash_split(table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", *NUMBERS), "l_orderkey")
    scaler = X.fit_scaler(li.filter("is_train"), NUMBERS, kind)
    return X.apply_scaler(li, scaler, NUMBERS).groupBy("l_returnflag").agg(*_scaled_check(NUMBERS))


@query("scale_standard", "F9 T2", _scale_sql("standard"))
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query("scale_minmax", "D2", _scale_sql("minmax"))
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query("scale_robust", "D2", _scale_sql("robust"))
def scale_robust(spark, folder):
    return _scaled(spark, folder, "robust")


@query("features_by_name", "F11 F12", "SELECT l_tax, l_quantity FROM lineitem")
def features_by_name(spark, folder):
    return X.features_by_name(table(spark, folder, "lineitem"), ["l_tax", "l_quantity"])


@query(
    "feature_metadata",
    "F13",
    f"""SELECT 4 AS feature_count, 'l_quantity,l_extendedprice,l_discount,l_tax' AS feature_names,
       count(*) FILTER ({md5_sql('l_orderkey')} >= 858993459) AS train_rows,
       count(*) FILTER ({md5_sql('l_orderkey')} < 858993459) AS test_rows, 5 AS train_columns, 5 AS test_columns, true AS scaled
    FROM lineitem""",
)
def feature_metadata(spark, folder):
    li = hash_split(table(spark, folder, "lineitem").select("l_orderkey", *NUMBERS), "l_orderkey")
    train, test = li.filter("is_train").drop("is_train"), li.filter("not is_train").drop("is_train")
    return X.feature_metadata(train, test, NUMBERS, True)


@query(
    "polynomial_features",
    "D4",
    """SELECT l_returnflag, round(sum(l_quantity * l_quantity), 2) AS qq, round(sum(l_quantity * l_tax), 2) AS qt,
       round(sum(l_tax * l_tax), 4) AS tt FROM lineitem GROUP BY 1""",
)
def polynomial_features(spark, folder):
    out = X.polynomial(table(spark, folder, "lineitem"), ["l_quantity", "l_tax"])
    return out.groupBy("l_returnflag").agg(
        F.round(F.sum("`l_quantity*l_quantity`"), 2).alias("qq"),
        F.round(F.sum("`l_quantity*l_tax`"), 2).alias("qt"),
        F.round(F.sum("`l_tax*l_tax`"), 4).alias("tt"),
    )


@query(
    "target_encode",
    "D5",
    f"""WITH s AS (SELECT *, {md5_sql('o_orderkey')} >= 858993459 AS is_train FROM orders),
    e AS (SELECT o_custkey, avg(o_totalprice) AS m FROM s WHERE is_train GROUP BY 1)
    SELECT o_orderkey, round(coalesce(m, (SELECT avg(o_totalprice) FROM s WHERE is_train)), 7) AS code
    FROM s LEFT JOIN e USING (o_custkey)""",
)
def target_encode(spark, folder):
    o = hash_split(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
    out = X.target_encode(o.filter("is_train"), o, "o_custkey", "o_totalprice", "code")
    return out.select("o_orderkey", F.round("code", 7).alias("code"))
