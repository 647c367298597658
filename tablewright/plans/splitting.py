"""Queries for splits, folds and cross-validation summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.ordered import positions, previous_values
from tablewright.operators import split as S
from tablewright.operators.clean import interpolate
from tablewright.plans.registry import query
from tablewright.plans.tables import gappy_events, md5_sql, table


@query(
    "split_chronological",
    "T1 T4",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n FROM events)
    SELECT event_id, r <= floor(n * 0.8) AS is_train FROM n""",
)
def split_chronological(spark, folder):
    ev = table(spark, folder, "events").select("event_id", "ts")
    return S.chronological_split(ev, "ts", "event_id").select("event_id", "is_train")


@query("split_random", "T2", f"SELECT o_orderkey, {md5_sql('o_orderkey')} >= 858993459 AS is_train FROM orders")
def split_random(spark, folder):
    return S.hash_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "split_random_exact",
    "T2",
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {md5_sql('o_orderkey')}, o_orderkey)
               > ceil(round(0.2 * (SELECT count(*) FROM orders), 9)) AS is_train FROM orders""",
)
def split_random_exact(spark, folder):
    return S.stratified_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", None)


@query(
    "split_stratified",
    "T3 T4",
    f"""SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {md5_sql('event_id')}, event_id)
               > ceil(round(0.2 * count(*) OVER (PARTITION BY event_type), 9)) AS is_train FROM events""",
)
def split_stratified(spark, folder):
    ev = table(spark, folder, "events").select("event_id", "event_type")
    return S.stratified_split(ev, "event_id", "event_type")


@query(
    "split_tail",
    "T5",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey FROM n WHERE r > floor(n * 0.8)""",
)
def split_tail(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return S.tail_split(o, "o_orderdate", "o_orderkey").select("o_orderkey")


@query(
    "folds_contiguous",
    "T6",
    """WITH n AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n FROM events)
    SELECT event_id, CAST(floor(5 * (r - 1) / n) AS INT) AS fold FROM n""",
)
def folds_contiguous(spark, folder):
    ev = table(spark, folder, "events").select("event_id", "ts")
    return S.contiguous_folds(ev, "ts", "event_id", 5).select("event_id", "fold")


@query("folds_shuffled", "T7", f"SELECT o_orderkey, CAST({md5_sql('o_orderkey')} % 5 AS INT) AS fold FROM orders")
def folds_shuffled(spark, folder):
    return S.hashed_folds(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 5)


@query(
    "folds_stratified",
    "T8",
    f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {md5_sql('event_id')}, event_id) AS r,
                        count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_id, event_type, CAST(floor(5 * (r - 1) / n) AS INT) AS fold FROM n""",
)
def folds_stratified(spark, folder):
    ev = table(spark, folder, "events").select("event_id", "event_type")
    return S.stratified_folds(ev, "event_id", "event_type", 5)


@query(
    "cv_regression",
    "T9 T7",
    f"""WITH f AS (SELECT {md5_sql('l_orderkey')} % 5 AS fold, avg((l_extendedprice - l_quantity * 1500) ** 2) AS mse
               FROM lineitem GROUP BY 1)
    SELECT count(*) AS folds, round(sqrt(avg(mse)), 4) AS cv_rmse FROM f""",
)
def cv_regression(spark, folder):
    li = S.hashed_folds(table(spark, folder, "lineitem"), "l_orderkey", 5)
    out = S.regression_cv(li.withColumn("p", F.col("l_quantity") * 1500), "fold", "l_extendedprice", "p")
    return out.withColumn("cv_rmse", F.round("cv_rmse", 4))


@query(
    "cv_classification",
    "T9 T7",
    f"""WITH f AS (SELECT {md5_sql('l_orderkey')} % 5 AS fold,
               avg(CAST((l_returnflag = 'R') = (l_discount >= 0.05) AS INT)) AS acc FROM lineitem GROUP BY 1)
    SELECT count(*) AS folds, round(avg(acc), 6) AS cv_mean, round(stddev_pop(acc), 6) AS cv_std FROM f""",
)
def cv_classification(spark, folder):
    li = S.hashed_folds(table(spark, folder, "lineitem"), "l_orderkey", 5)
    pairs = li.select("fold", (F.col("l_returnflag") == "R").alias("y"), (F.col("l_discount") >= 0.05).alias("p"))
    out = S.classification_cv(pairs, "fold", "y", "p")
    return out.select("folds", F.round("cv_mean", 6).alias("cv_mean"), F.round("cv_std", 6).alias("cv_std"))


@query(
    "numbered_by_name",
    "T5 T6",
    """SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name, c_custkey) AS position FROM customer""",
)
def numbered_by_name(spark, folder):
    """Text keys with one long common prefix, cut into several chunks."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    return positions(customers, "c_name", "c_custkey", ["c_nationkey"], chunks=6).select("c_custkey", "position")


@query("ranked_by_name", "K13", "SELECT p_partkey, rank() OVER (ORDER BY p_name DESC) AS position FROM part")
def ranked_by_name(spark, folder):
    return positions(table(spark, folder, "part").select("p_partkey", "p_name"), "p_name", None, [], True, method="rank", chunks=5).select(
        "p_partkey", "position"
    )


@query(
    "previous_by_text_date",
    "D15 G15",
    """SELECT event_id, lag(value, 2) OVER (PARTITION BY event_type ORDER BY strftime(ts, '%Y-%m-%d'), event_id) AS earlier FROM events""",
)
def previous_by_text_date(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return previous_values(events, "day", "event_id", {"earlier": "value"}, ["event_type"], steps=2, chunks=4).select("event_id", "earlier")


@query(
    "interpolated_by_text_date",
    "C6",
    """WITH e AS (
      SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day,
             CASE WHEN (event_id * 7919) % 11 < 3 OR user_id % 50 = 0 THEN NULL ELSE value END AS v FROM events),
    p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day, event_id) AS pos FROM e),
    w AS (
      SELECT *, max(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS lo,
             min(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi
      FROM p)
    SELECT w.event_id, round(CASE WHEN w.v IS NOT NULL THEN w.v WHEN a.v IS NULL THEN NULL WHEN b.v IS NULL THEN a.v
             ELSE a.v + (b.v - a.v) / (w.hi - w.lo) * (w.pos - w.lo) END, 6) AS value
    FROM w LEFT JOIN p a ON a.user_id = w.user_id AND a.pos = w.lo LEFT JOIN p b ON b.user_id = w.user_id AND b.pos = w.hi""",
)
def interpolated_by_text_date(spark, folder):
    events = gappy_events(spark, folder).select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return interpolate(events, "user_id", "day", "event_id", ["value"], chunks=4).select("event_id", F.round("value", 6).alias("value"))
