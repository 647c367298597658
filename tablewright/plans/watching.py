"""Queries for snapshots, quality checks, drift and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import quality as Q
from tablewright.operators.split import hash_split
from tablewright.plans.registering import BOARD, MODELS, SUMMARY, models, summary
from tablewright.plans.registry import query
from tablewright.plans.tables import GAPPY, TRADES, gappy_events, md5_sql, table, trades

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def reference_period():
    """The earlier part of the events, against which the later part is compared."""
    return F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(
    "snapshot_metadata",
    "Q1",
    f"""SELECT 'v_20250101_000000' AS version, 4 AS column_count, 'o_orderkey,o_custkey,o_orderstatus,o_orderpriority' AS columns,
      count(*) AS row_count,
      CAST(sum({md5_sql("concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)")}) AS BIGINT) AS data_hash,
      count(*) - count(o_orderkey) AS nulls_o_orderkey, count(*) - count(o_custkey) AS nulls_o_custkey,
      count(*) - count(o_orderstatus) AS nulls_o_orderstatus, count(*) - count(o_orderpriority) AS nulls_o_orderpriority FROM orders""",
)
def snapshot_metadata(spark, folder):
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return Q.snapshot_metadata(o, "v_20250101_000000")


@query(
    "snapshot_range",
    "Q1",
    f"""WITH {GAPPY} SELECT count(*) AS row_count, count(*) - count(value) AS nulls_value, count(*) - count(event_type) AS nulls_event_type,
      min(ts) AS date_start, max(ts) AS date_end FROM gappy""",
)
def snapshot_range(spark, folder):
    out = Q.snapshot_metadata(gappy_events(spark, folder), "v", "ts")
    return out.select("row_count", "nulls_value", "nulls_event_type", "date_start", "date_end")


QUALITY = f"""{GAPPY}, q AS (SELECT *, {md5_sql('event_id')} >= 858993459 AS tr FROM gappy),
f AS (SELECT count(*) FILTER (tr) AS train, count(*) FILTER (NOT tr) AS test,
  sum((value IS NULL)::INT + (level IS NULL)::INT) FILTER (tr) AS missing FROM q),
s AS (SELECT min(n) / sum(n) AS share FROM (SELECT count(*) AS n FROM q WHERE tr AND event_type IS NOT NULL GROUP BY event_type)),
checks AS (SELECT 'non_empty' AS check_name, CAST(least(train, test) AS DOUBLE) AS value, 'error' AS level, train > 0 AND test > 0 AS passed FROM f
  UNION ALL SELECT 'test_ratio', test / (train + test), 'warning', test / (train + test) BETWEEN 0.1 AND 0.5 FROM f
  UNION ALL SELECT 'same_features', 1, 'error', true
  UNION ALL SELECT 'missing_ratio', missing / (train * 2), 'warning', missing / (train * 2) <= 0.1 FROM f
  UNION ALL SELECT 'class_share', share, 'warning', share >= 0.05 FROM s)"""


def _report(spark, folder):
    ev = hash_split(gappy_events(spark, folder), "event_id")
    return Q.quality_report(ev, "is_train", "event_type", ["value", "level"])


@query("quality_report", "Q2 Q3 Q4 Q5 Q6 Q7", f"WITH {QUALITY} SELECT check_name, round(value, 6) AS value, level, passed FROM checks")
def quality_report(spark, folder):
    return _rounded(_report(spark, folder))


@query(
    "quality_verdict",
    "Q7",
    f"""WITH {QUALITY} SELECT count(*) FILTER (NOT passed AND level = 'error') = 0 AS passed,
      coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed AND level = 'error'), '') AS errors,
      coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed AND level = 'warning'), '') AS warnings FROM checks""",
)
def quality_verdict(spark, folder):
    return Q.report_verdict(_report(spark, folder))


@query(
    "quality_score",
    "D10",
    f"""WITH {QUALITY}, w AS (SELECT passed, CASE WHEN level = 'error' THEN 2.0 ELSE 1.0 END AS w FROM checks)
    SELECT round(sum(CASE WHEN passed THEN w ELSE 0 END) / sum(w), 6) AS score, sum(CASE WHEN passed THEN w ELSE 0 END) / sum(w) >= 0.8 AS acceptable FROM w""",
)
def quality_score(spark, folder):
    return _rounded(Q.quality_score(_report(spark, folder)))


@query(
    "required_features",
    "Q8",
    "SELECT count(*) AS row_count, 'l_colour,l_weight' AS missing FROM lineitem",
)
def required_features(spark, folder):
    li = table(spark, folder, "lineitem")
    absent = Q.missing_features(li, ["l_tax", "l_colour", "l_quantity", "l_weight"])
    return li.agg(F.count(F.lit(1)).alias("row_count")).withColumn("missing", F.lit(",".join(absent)))


@query(
    "class_balance",
    "D6",
    """WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic)
    SELECT CAST(sum(n) AS BIGINT) AS samples, sum(n) >= 1000 AS enough_samples, round(max(n) / min(n), 6) AS imbalance, max(n) / min(n) <= 10 AS balanced FROM c""",
)
def class_balance(spark, folder):
    return _rounded(Q.class_balance(table(spark, folder, "labels"), "toxic"))


@query(
    "outliers_iqr",
    "D7",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} < a - 0.3 * (b - a) OR {c} > b + 0.3 * (b - a)) AS outliers
        FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM lineitem)"""
        for c in NUMBERS
    ),
)
def outliers_iqr(spark, folder):
    return Q.iqr_outliers(table(spark, folder, "lineitem"), NUMBERS, 0.3)


@query(
    "outliers_zscore",
    "D7",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER (abs({c} - m) > s * 1.55) AS outliers
        FROM lineitem, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM lineitem)"""
        for c in NUMBERS
    ),
)
def outliers_zscore(spark, folder):
    return Q.zscore_outliers(table(spark, folder, "lineitem"), NUMBERS, 1.55)


KS = """d AS (SELECT value AS v, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS a, count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS b FROM events GROUP BY value),
c AS (SELECT sum(a) OVER w / (SELECT sum(a) FROM d) AS fa, sum(b) OVER w / (SELECT sum(b) FROM d) AS fb FROM d WINDOW w AS (ORDER BY v)),
k AS (SELECT max(abs(fa - fb)) AS statistic, 1.3581 * sqrt((SELECT sum(a) + sum(b) FROM d) / (SELECT sum(a) * CAST(sum(b) AS DOUBLE) FROM d)) AS critical FROM c)"""


@query("drift_ks", "D8", f"WITH {KS} SELECT round(statistic, 6) AS statistic, round(critical, 6) AS critical, statistic > critical AS drifted FROM k")
def drift_ks(spark, folder):
    return _rounded(Q.ks_statistic(table(spark, folder, "events"), "value", reference_period()))


@query(
    "drift_psi",
    "D8",
    """WITH e AS (SELECT min(value) FILTER (ts < TIMESTAMP '2024-01-15') AS lo, max(value) FILTER (ts < TIMESTAMP '2024-01-15') AS hi FROM events),
    c AS (SELECT greatest(0, least(floor((value - lo) / (hi - lo) * 10), 9)) AS bin, count(*) FILTER (ts < TIMESTAMP '2024-01-15') AS a,
            count(*) FILTER (ts >= TIMESTAMP '2024-01-15') AS b FROM events, e GROUP BY 1),
    p AS (SELECT greatest(1e-4, coalesce(a, 0) / (SELECT sum(a) FROM c)) AS p, greatest(1e-4, coalesce(b, 0) / (SELECT sum(b) FROM c)) AS q
          FROM range(0, 10) t(i) LEFT JOIN c ON c.bin = i)
    SELECT round(sum((p - q) * ln(p / q)), 6) AS psi FROM p""",
)
def drift_psi(spark, folder):
    return _rounded(Q.population_stability(table(spark, folder, "events"), "value", reference_period()))


@query(
    "drift_categories",
    "D8 A4",
    """WITH o AS (SELECT event_type AS l, ts < TIMESTAMP '2024-01-15' AS y, count(*) AS o FROM events GROUP BY ALL),
    m AS (SELECT l, y, o, sum(o) OVER (PARTITION BY l) * sum(o) OVER (PARTITION BY y) / sum(o) OVER () AS e FROM o)
    SELECT 'event_type' AS feature, round(sum((o - e) ** 2 / e), 6) AS statistic,
      CAST((count(DISTINCT l) - 1) * (count(DISTINCT y) - 1) AS INT) AS dof FROM m""",
)
def drift_categories(spark, folder):
    out = Q.category_drift(table(spark, folder, "events"), ["event_type"], reference_period())
    return _rounded(out.select("feature", "statistic", "dof"))


@query(
    "drift_target",
    "D10",
    """WITH a AS (SELECT avg(value) FILTER (ts < TIMESTAMP '2024-01-15') AS r, avg(value) FILTER (ts >= TIMESTAMP '2024-01-15') AS c FROM events)
    SELECT round(r, 6) AS reference, round(c, 6) AS current, round(c - r, 6) AS change FROM a""",
)
def drift_target(spark, folder):
    return _rounded(Q.target_drift(table(spark, folder, "events"), "value", reference_period()))


RUNS = f"""{SUMMARY}, runs AS (SELECT model_name, id, created_at, CAST(f1_score AS DOUBLE) AS f1_score FROM summary WHERE f1_score IS NOT NULL),
lagged AS (SELECT *, lag(f1_score) OVER (PARTITION BY model_name ORDER BY created_at, id) AS previous FROM runs)"""


def _runs(spark, folder):
    return summary(spark, folder).filter("f1_score is not null").select("model_name", "id", "created_at", F.col("f1_score").cast("double"))


@query(
    "retrain_triggers",
    "D9",
    f"WITH {RUNS} SELECT id, model_name, coalesce(previous - f1_score > abs(previous) * 0.05, false) AS retrain FROM lagged",
)
def retrain_triggers(spark, folder):
    out = Q.retrain_triggers(_runs(spark, folder), "model_name", "created_at", "id", "f1_score")
    return out.select("id", "model_name", "retrain")


@query(
    "metric_trend",
    "D15",
    f"WITH {RUNS} SELECT id, model_name, round(f1_score, 5) AS f1_score, round(previous, 5) AS previous, round(f1_score - previous, 5) AS change FROM lagged",
)
def metric_trend(spark, folder):
    out = Q.metric_trend(_runs(spark, folder), "model_name", "created_at", "id", "f1_score").drop("created_at")
    return _rounded(out, 5)


@query("freshness", "D10", "SELECT max(ts) AS newest, CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-03-01') AS INT) AS age_days FROM events")
def freshness(spark, folder):
    return Q.freshness(table(spark, folder, "events"), "ts", F.lit("2024-03-01").cast("date"))


@query(
    "keep_snapshots",
    "D11",
    f"WITH {MODELS} SELECT id, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, id) <= 5 AS kept FROM models",
)
def keep_snapshots(spark, folder):
    m = models(spark, folder).select("id", "model_name", "created_at")
    return Q.keep_snapshots(m, "model_name", "created_at", "id", 5).select("id", "kept")


@query(
    "weighted_winner",
    "D12",
    f"""WITH {BOARD}, s AS (SELECT model_type, id, created_at, round(CAST(primary_metric AS DOUBLE) * 0.7 + CAST(f1_score AS DOUBLE) * 0.2 + (1 - hyperparameters_count / 4) * 0.1, 9) AS score
      FROM summary WHERE status = 'active' AND primary_metric IS NOT NULL AND f1_score IS NOT NULL)
    SELECT model_type, id AS winner, round(score, 5) AS score FROM (SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY score DESC, created_at DESC, id DESC) AS r FROM s) WHERE r = 1""",
)
def weighted_winner(spark, folder):
    live = summary(spark, folder).filter("status = 'active' and primary_metric is not null and f1_score is not null")
    df = live.select(
        "model_type", "id", "created_at", F.col("primary_metric").cast("double"), F.col("f1_score").cast("double"),
        (F.col("hyperparameters_count") / 4).alias("complexity"),
    )
    return _rounded(Q.weighted_winner(df, "model_type", "primary_metric", "f1_score", "complexity", "created_at", "id"), 5)


@query(
    "select_all_features",
    "A9",
    f"""WITH {TRADES} SELECT finished, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_discount), 2) AS l_discount FROM trades GROUP BY finished""",
)
def select_all_features(spark, folder):
    from tablewright.operators.association import select_features

    df = trades(spark, folder)
    kept = select_features(df, ["l_quantity", "l_discount"], "finished", method="none")
    return df.groupBy("finished").agg(*[F.round(F.sum(c), 2).alias(c) for c in kept])
