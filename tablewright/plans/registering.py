"""Queries for the model registry. Suppliers play the registered models, their line items the metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import registry as R
from tablewright.plans.registry import query
from tablewright.plans.tables import table

ALGORITHMS = ["forest", "ridge", "boosting"]


def models(spark, folder):
    s = table(spark, folder, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("m"), F.col("s_suppkey") % 10).alias("model_name"),
        F.when(F.col("s_suppkey") % 2 == 0, "regression").otherwise("classification").alias("model_type"),
        F.element_at(F.array(*[F.lit(a) for a in ALGORITHMS]), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("algorithm"),
        F.concat(F.lit("1.0."), F.floor(F.col("s_suppkey") / 10)).alias("version"),
        R.content_hash(F.col("s_name"), F.col("s_nationkey") % 5).alias("model_hash"),
        F.timestamp_add("DAY", F.col("s_suppkey").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("created_at"),
        F.concat(F.lit("u"), F.col("s_nationkey")).alias("created_by"),
        F.when(F.col("s_suppkey") % 7 == 0, "archived").otherwise("active").alias("status"),
        F.col("s_name").alias("description"),
        F.create_map(F.lit("nation"), F.col("s_nationkey").cast("string")).alias("tags"),
        F.col("s_acctbal").alias("balance"),
    )


def model_metrics(spark, folder):
    li = table(spark, folder, "lineitem")
    thousands = F.col("l_extendedprice") / 1000 - F.col("l_quantity") * 1.5
    y, p = F.col("l_returnflag") == "R", F.col("l_discount") >= 0.05
    wide = li.groupBy(F.col("l_suppkey").alias("model_id")).agg(
        (1 - F.try_divide(F.avg(thousands**2), F.nullif(F.var_pop(F.col("l_extendedprice") / 1000), F.lit(0.0)))).alias("r2_score"),
        F.avg((y == p).cast("double")).alias("accuracy"),
        F.avg(thousands**2).alias("mean_squared_error"),
        F.try_divide(2.0 * F.count_if(y & p), F.count_if(y) + F.count_if(p)).alias("f1_score"),
    )
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("decimal(15,8)").alias("metric_value"))
            for m in ("r2_score", "accuracy", "mean_squared_error", "f1_score")
        ]
    )
    kind = F.when((F.col("model_id") % 13 == 0) & (F.col("metric_name") == "accuracy"), "train").otherwise("test")
    return wide.select("model_id", F.inline(cells)).filter("metric_value is not null").withColumn("dataset_type", kind)


def model_parameters(spark, folder):
    s = table(spark, folder, "supplier")
    cells = F.array(
        F.struct(F.lit("neighbors").alias("parameter_name"), F.col("s_nationkey").cast("string").alias("parameter_value"), F.lit("int").alias("parameter_type")),
        F.struct(F.lit("alpha").alias("parameter_name"), F.format_string("%.2f", "s_acctbal").alias("parameter_value"), F.lit("float").alias("parameter_type")),
        F.struct(F.lit("shuffle").alias("parameter_name"), F.when(F.col("s_suppkey") % 2 == 0, "True").otherwise("False").alias("parameter_value"), F.lit("bool").alias("parameter_type")),
        F.struct(F.lit("kernel").alias("parameter_name"), F.when(F.col("s_suppkey") % 5 != 0, "rbf").alias("parameter_value"), F.lit("str").alias("parameter_type")),
    )
    return s.select(F.col("s_suppkey").alias("model_id"), F.inline(cells)).filter("parameter_value is not null")


def comparisons(spark, folder):
    s = table(spark, folder, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("cmp"), k).alias("comparison_name"),
        F.lit("performance").alias("comparison_type"),
        F.timestamp_add("HOUR", k.cast("int"), F.lit("2024-06-01").cast("timestamp_ntz")).alias("created_at"),
        F.concat(F.lit("u"), F.col("s_nationkey")).alias("created_by"),
        F.when(k % 4 != 0, k).alias("winner_model_id"),
        F.slice(F.array(k, k + 1, k + 2), 1, (k % 3 + 1).cast("int")).alias("model_ids"),
    )


def audit_log(spark, folder):
    ev = table(spark, folder, "events")
    return ev.select(
        F.col("user_id").alias("model_id"),
        F.col("event_type").alias("action"),
        F.concat(F.lit("u"), F.col("user_id")).alias("changed_by"),
        F.col("ts").alias("changed_at"),
        F.col("props").alias("reason"),
    )


MODELS = """models AS (SELECT s_suppkey AS id, 'm' || (s_suppkey % 10) AS model_name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'regression' ELSE 'classification' END AS model_type,
  ['forest', 'ridge', 'boosting'][s_suppkey % 3 + 1] AS algorithm, '1.0.' || (s_suppkey // 10) AS version,
  sha256(s_name || '|' || (s_nationkey % 5)) AS model_hash, TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey AS INT)) AS created_at,
  'u' || s_nationkey AS created_by, CASE WHEN s_suppkey % 7 = 0 THEN 'archived' ELSE 'active' END AS status,
  s_name AS description, s_nationkey, s_acctbal AS balance FROM supplier)"""
METRICS = """wide AS (SELECT l_suppkey AS model_id,
  1 - avg((l_extendedprice / 1000 - l_quantity * 1.5) ** 2) / nullif(var_pop(l_extendedprice / 1000), 0) AS r2_score,
  avg(CAST((l_returnflag = 'R') = (l_discount >= 0.05) AS INT)) AS accuracy,
  avg((l_extendedprice / 1000 - l_quantity * 1.5) ** 2) AS mean_squared_error,
  2 * count(*) FILTER (l_returnflag = 'R' AND l_discount >= 0.05) /
    (count(*) FILTER (l_returnflag = 'R') + count(*) FILTER (l_discount >= 0.05)) AS f1_score
  FROM lineitem GROUP BY l_suppkey),
long AS (SELECT model_id, 'r2_score' AS metric_name, r2_score AS v FROM wide UNION ALL SELECT model_id, 'accuracy', accuracy FROM wide
  UNION ALL SELECT model_id, 'mean_squared_error', mean_squared_error FROM wide UNION ALL SELECT model_id, 'f1_score', f1_score FROM wide),
metrics AS (SELECT model_id, metric_name, CAST(v AS DECIMAL(15,8)) AS metric_value,
  CASE WHEN model_id % 13 = 0 AND metric_name = 'accuracy' THEN 'train' ELSE 'test' END AS dataset_type FROM long WHERE v IS NOT NULL)"""
PARAMETERS = """parameters AS (SELECT s_suppkey AS model_id, 'neighbors' AS parameter_name, CAST(s_nationkey AS VARCHAR) AS parameter_value, 'int' AS parameter_type FROM supplier
  UNION ALL SELECT s_suppkey, 'alpha', format('{:.2f}', s_acctbal), 'float' FROM supplier
  UNION ALL SELECT s_suppkey, 'shuffle', CASE WHEN s_suppkey % 2 = 0 THEN 'True' ELSE 'False' END, 'bool' FROM supplier
  UNION ALL SELECT s_suppkey, 'kernel', 'rbf', 'str' FROM supplier WHERE s_suppkey % 5 <> 0)"""
SUMMARY = f"""{MODELS}, {METRICS}, {PARAMETERS},
summary AS (SELECT m.*,
  CASE WHEN model_type = 'regression' THEN (SELECT max(metric_value) FROM metrics x WHERE x.model_id = m.id AND metric_name = 'r2_score' AND dataset_type = 'test')
       ELSE (SELECT max(metric_value) FROM metrics x WHERE x.model_id = m.id AND metric_name = 'accuracy' AND dataset_type = 'test') END AS primary_metric,
  (SELECT max(metric_value) FROM metrics x WHERE x.model_id = m.id AND metric_name = 'mean_squared_error' AND dataset_type = 'test') AS mse,
  (SELECT max(metric_value) FROM metrics x WHERE x.model_id = m.id AND metric_name = 'f1_score' AND dataset_type = 'test') AS f1_score,
  (SELECT count(*) FROM metrics x WHERE x.model_id = m.id) AS metrics_count,
  (SELECT count(*) FROM parameters x WHERE x.model_id = m.id) AS hyperparameters_count
  FROM models m)"""
BOARD = f"""{SUMMARY}, board AS (SELECT model_type, algorithm, model_name, version, primary_metric, created_at, status,
  rank() OVER (PARTITION BY model_type ORDER BY primary_metric DESC NULLS LAST) AS rank
  FROM summary WHERE status = 'active' AND primary_metric IS NOT NULL)"""


def summary(spark, folder):
    return R.model_summary(models(spark, folder), model_metrics(spark, folder), model_parameters(spark, folder))


def _plain(df, digits=5):
    """Decimals as rounded doubles, so that the last stored digit does not depend on summation order."""
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def _num(c):
    return f"round(CAST({c} AS DOUBLE), 5) AS {c}"


@query(
    "model_summary",
    "G1",
    f"""WITH {SUMMARY} SELECT id, model_name, model_type, algorithm, version, status, created_at, created_by, description,
       {_num('primary_metric')}, {_num('mse')}, {_num('f1_score')}, metrics_count, hyperparameters_count FROM summary""",
)
def model_summary(spark, folder):
    return _plain(summary(spark, folder).drop("tags"))


BOARD_COLUMNS = f"model_type, algorithm, model_name, version, {_num('primary_metric')}, rank, created_at, status"


@query("model_leaderboard", "G2", f"WITH {BOARD} SELECT {BOARD_COLUMNS} FROM board")
def model_leaderboard(spark, folder):
    return _plain(R.leaderboard(summary(spark, folder)))


@query(
    "leaderboard_top",
    "G3",
    f"WITH {BOARD} SELECT {BOARD_COLUMNS} FROM (SELECT * FROM board WHERE model_type = 'regression' ORDER BY rank, model_name, version LIMIT 10)",
)
def leaderboard_top(spark, folder):
    return _plain(R.top_models(R.leaderboard(summary(spark, folder)), "regression", 10))


@query(
    "leaderboard_combined",
    "G4",
    f"""WITH {BOARD} SELECT {BOARD_COLUMNS}, TIMESTAMP '2025-01-01' AS generated_at FROM
       ((SELECT * FROM board WHERE model_type = 'regression' ORDER BY rank, model_name, version LIMIT 10)
        UNION ALL (SELECT * FROM board WHERE model_type = 'classification' ORDER BY rank, model_name, version LIMIT 10))""",
)
def leaderboard_combined(spark, folder):
    stamp = F.lit("2025-01-01").cast("timestamp_ntz")
    return _plain(R.combined_leaderboard(R.leaderboard(summary(spark, folder)), stamp))


COMPARISONS = """comparisons AS (SELECT 'cmp' || s_suppkey AS comparison_name, 'performance' AS comparison_type,
  TIMESTAMP '2024-06-01' + to_hours(CAST(s_suppkey AS INT)) AS created_at, 'u' || s_nationkey AS created_by,
  CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey END AS winner_model_id,
  [s_suppkey, s_suppkey + 1, s_suppkey + 2][1:s_suppkey % 3 + 1] AS model_ids FROM supplier)"""
RECENT = f"""{MODELS}, {COMPARISONS}, recent AS (SELECT comparison_name, comparison_type, c.created_at, c.created_by, model_name AS winner_model_name,
  algorithm AS winner_algorithm, version AS winner_version, CAST(len(model_ids) AS INT) AS models_compared
  FROM comparisons c LEFT JOIN models m ON c.winner_model_id = m.id)"""


@query("recent_comparisons", "G5", f"WITH {RECENT} SELECT * FROM recent")
def recent_comparisons(spark, folder):
    return R.recent_comparisons(comparisons(spark, folder), models(spark, folder))


@query("recent_comparisons_newest", "S3 G5", f"WITH {RECENT} SELECT * FROM recent ORDER BY created_at DESC, comparison_name LIMIT 20")
def recent_comparisons_newest(spark, folder):
    return R.recent_comparisons(comparisons(spark, folder), models(spark, folder), newest=20)


AUDIT = f"""{MODELS}, audit AS (SELECT model_name, version, event_type AS action, 'u' || user_id AS changed_by, ts AS changed_at, props AS reason
  FROM events JOIN models ON user_id = id)"""


@query("audit_summary", "G6", f"WITH {AUDIT} SELECT * FROM audit")
def audit_summary(spark, folder):
    return R.audit_summary(audit_log(spark, folder), models(spark, folder))


@query("audit_summary_newest", "S3 G6", f"WITH {AUDIT} SELECT * FROM audit ORDER BY changed_at DESC, model_name, version, action, changed_by LIMIT 100")
def audit_summary_newest(spark, folder):
    return R.audit_summary(audit_log(spark, folder), models(spark, folder), newest=100)


@query(
    "audit_changes",
    "G7 G8",
    f"""WITH {MODELS}, a AS (SELECT id, model_name, version, status FROM models WHERE id % 3 <> 0),
    b AS (SELECT id, model_name, version, CASE WHEN id % 5 = 0 THEN 'archived' ELSE status END AS status FROM models WHERE id % 4 <> 1),
    j AS (SELECT coalesce(a.id, b.id) AS id,
      CASE WHEN a.id IS NULL THEN NULL ELSE to_json({{'id': a.id, 'model_name': a.model_name, 'version': a.version, 'status': a.status}}) END AS old_values,
      CASE WHEN b.id IS NULL THEN NULL ELSE to_json({{'id': b.id, 'model_name': b.model_name, 'version': b.version, 'status': b.status}}) END AS new_values
      FROM a FULL JOIN b ON a.id = b.id)
    SELECT id, CASE WHEN old_values IS NULL THEN 'created' WHEN new_values IS NULL THEN 'deleted' ELSE 'updated' END AS action,
      CAST(old_values AS VARCHAR) AS old_values, CAST(new_values AS VARCHAR) AS new_values FROM j WHERE old_values IS DISTINCT FROM new_values""",
)
def audit_changes(spark, folder):
    m = models(spark, folder).select("id", "model_name", "version", "status")
    after = m.filter("id % 4 <> 1").withColumn("status", F.when(F.col("id") % 5 == 0, "archived").otherwise(F.col("status")))
    return R.audit_changes(m.filter("id % 3 <> 0"), after, "id")


@query(
    "touch_updated",
    "G8",
    f"WITH {MODELS} SELECT id, CASE WHEN status = 'archived' THEN TIMESTAMP '2025-01-01' ELSE created_at END AS updated_at FROM models",
)
def touch_updated(spark, folder):
    m = models(spark, folder).withColumn("updated_at", F.col("created_at"))
    return R.touch(m, F.col("status") == "archived", F.lit("2025-01-01").cast("timestamp_ntz")).select("id", "updated_at")


NEWEST = f"""{MODELS}, newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, id DESC) AS r FROM models) WHERE r = 1)"""


@query("latest_versions", "G9", f"WITH {NEWEST} SELECT model_name, id, version, created_at FROM newest")
def latest_versions(spark, folder):
    return R.latest_versions(models(spark, folder).drop("tags")).select("model_name", "id", "version", "created_at")


@query(
    "next_versions",
    "G10",
    f"""WITH {NEWEST}, want AS (SELECT DISTINCT 'm' || (s_nationkey % 15) AS model_name FROM supplier)
    SELECT model_name, CASE WHEN version IS NULL THEN '1.0.0' ELSE '1.0.' || (CAST(split_part(version, '.', 3) AS INT) + 1) END AS next_version
    FROM want LEFT JOIN newest USING (model_name)""",
)
def next_versions(spark, folder):
    want = table(spark, folder, "supplier").select(F.concat(F.lit("m"), F.col("s_nationkey") % 15).alias("model_name")).distinct()
    return R.next_versions(want, models(spark, folder).drop("tags"))


@query(
    "registration_summary",
    "G11",
    f"""WITH {MODELS}, old AS (SELECT DISTINCT model_name FROM models WHERE id % 10 < 4), f AS (SELECT * FROM models ANTI JOIN old USING (model_name))
    SELECT (SELECT count(*) FROM models) AS candidates, count(*) AS registered, (SELECT count(*) FROM models) - count(*) AS skipped,
      count(*) FILTER (model_type = 'regression') AS regression, count(*) FILTER (model_type = 'classification') AS classification FROM f""",
)
def registration_summary(spark, folder):
    m = models(spark, folder).withColumn("r2_score", F.lit(None).cast("double"))
    return R.registration(m, m.filter("id % 10 < 4"), ["balance", "r2_score"])["summary"]


@query(
    "registration_metrics",
    "G11",
    f"""WITH {MODELS}, old AS (SELECT DISTINCT model_name FROM models WHERE id % 10 < 4), f AS (SELECT * FROM models ANTI JOIN old USING (model_name))
    SELECT id AS model_id, 'balance' AS metric_name, round(CAST(CAST(balance AS DECIMAL(15,8)) AS DOUBLE), 5) AS metric_value, 'test' AS dataset_type FROM f""",
)
def registration_metrics(spark, folder):
    m = models(spark, folder).withColumn("r2_score", F.lit(None).cast("double"))
    return _plain(R.registration(m, m.filter("id % 10 < 4"), ["balance", "r2_score"])["metrics"])


# Models of one algorithm and author count as one content here; every tenth model is registered already.
ACCEPTED = f"""{MODELS}, hashed AS (SELECT id, model_name, sha256(algorithm || '|' || created_by) AS h FROM models),
  known AS (SELECT * FROM hashed WHERE id % 10 < 1),
  fresh AS (SELECT * FROM hashed WHERE model_name NOT IN (SELECT model_name FROM known) AND h NOT IN (SELECT h FROM known)),
  accepted AS (SELECT min(id) AS id, h AS model_hash FROM fresh GROUP BY h)"""


def _accepted(spark, folder):
    m = models(spark, folder).withColumn("model_hash", R.content_hash(F.col("algorithm"), F.col("created_by")))
    return R.accepted_models(m, m.filter("id % 10 < 1"))


@query("registration_accepted", "G11 G12", f"WITH {ACCEPTED} SELECT a.id, m.model_name, a.model_hash FROM accepted a JOIN models m USING (id)")
def registration_accepted(spark, folder):
    return _accepted(spark, folder).select("id", "model_name", "model_hash")


@query("registration_parameters", "G11 M21", f"WITH {ACCEPTED}, {PARAMETERS} SELECT p.* FROM parameters p WHERE model_id IN (SELECT id FROM accepted)")
def registration_parameters(spark, folder):
    return R.registered_parameters(_accepted(spark, folder), model_parameters(spark, folder))


@query(
    "duplicate_hashes",
    "G12",
    f"WITH {MODELS} SELECT id, model_hash FROM models WHERE model_hash IN (SELECT model_hash FROM models WHERE id % 3 = 0)",
)
def duplicate_hashes(spark, folder):
    m = models(spark, folder)
    return R.duplicates(m, m.filter("id % 3 = 0")).select("id", "model_hash")


@query("list_models", "G13", f"WITH {MODELS} SELECT id, model_name, version FROM models WHERE status = 'active' AND model_type = 'regression' AND algorithm = 'ridge'")
def list_models(spark, folder):
    return R.list_models(models(spark, folder), "regression", "ridge").select("id", "model_name", "version")


@query(
    "decode_parameters",
    "G14",
    f"""WITH {PARAMETERS} SELECT model_id, parameter_name, parameter_type, CASE WHEN parameter_type = 'int' THEN TRY_CAST(parameter_value AS BIGINT) END AS int_value,
      CASE WHEN parameter_type = 'float' THEN TRY_CAST(parameter_value AS DOUBLE) END AS float_value,
      CASE WHEN parameter_type = 'bool' THEN lower(parameter_value) = 'true' END AS bool_value,
      CASE WHEN parameter_type = 'str' THEN parameter_value END AS text_value FROM parameters""",
)
def decode_parameters(spark, folder):
    return R.decode_parameters(model_parameters(spark, folder))


@query(
    "archive_old",
    "G15",
    f"""WITH {MODELS}, r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, id) AS age FROM models)
    SELECT id, CASE WHEN age > 10 THEN 'archived' ELSE status END AS status FROM r""",
)
def archive_old(spark, folder):
    return R.archive_old(models(spark, folder).select("id", "model_name", "created_at", "status")).select("id", "status")


_RULES = ", ".join(
    f"('{kind}', '{m}', {lo}, {'NULL' if hi is None else hi}, {w}, '{b}')" for kind, many in R.METRIC_RULES.items() for m, lo, hi, w, b in many
)


@query(
    "validate_metrics",
    "G16",
    f"""WITH {MODELS}, {METRICS}, rules(model_type, metric_name, lo, hi, warn_at, better) AS (VALUES {_RULES}),
    x AS (SELECT model_id, model_name, metric_name, coalesce(metric_value < lo, false) OR coalesce(metric_value > hi, false) AS bad,
            CASE WHEN better = 'lower' THEN metric_value > warn_at ELSE metric_value < warn_at END AS warn
          FROM metrics JOIN models ON model_id = id JOIN rules USING (model_type, metric_name))
    SELECT model_id, model_name, count(*) FILTER (bad) = 0 AS is_valid,
      coalesce(string_agg(metric_name, ',' ORDER BY metric_name) FILTER (bad), '') AS violations,
      coalesce(string_agg(metric_name, ',' ORDER BY metric_name) FILTER (warn), '') AS warnings FROM x GROUP BY model_id, model_name""",
)
def validate_metrics(spark, folder):
    return R.validate_metrics(model_metrics(spark, folder), models(spark, folder), R.metric_rules(spark))


@query(
    "lineage_rows",
    "G17",
    f"""WITH {MODELS} SELECT id AS model_id, 'training' AS pipeline_name, '1.0.0' AS pipeline_version, 'abc' AS git_commit_hash,
       'train,test' AS input_datasets, TIMESTAMP '2025-01-01' AS created_at FROM models""",
)
def lineage_rows(spark, folder):
    out = R.lineage_rows(models(spark, folder), "training", "1.0.0", "abc", ["train", "test"], F.lit("2025-01-01").cast("timestamp_ntz"))
    return out.withColumn("input_datasets", F.array_join("input_datasets", ","))


@query(
    "best_per_type",
    "G18",
    f"""WITH {BOARD} SELECT model_type, model_name, version, algorithm, {_num('primary_metric')} FROM
      (SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY primary_metric DESC, model_name, version) AS r FROM board) WHERE r = 1""",
)
def best_per_type(spark, folder):
    return _plain(R.best_per_type(summary(spark, folder)))


@query(
    "registry_statistics",
    "G19",
    f"""WITH {SUMMARY} SELECT count(*) AS total_models, count(*) FILTER (model_type = 'regression') AS regression_models,
      count(*) FILTER (model_type = 'classification') AS classification_models, count(*) FILTER (status = 'active') AS active_models,
      count(*) FILTER (status = 'archived') AS archived_models,
      round(CAST(max(primary_metric) FILTER (status = 'active' AND model_type = 'regression') AS DOUBLE), 5) AS best_regression_r2_score,
      round(CAST(max(primary_metric) FILTER (status = 'active' AND model_type = 'classification') AS DOUBLE), 5) AS best_classification_accuracy
    FROM summary""",
)
def registry_statistics(spark, folder):
    return _plain(R.registry_statistics(summary(spark, folder)))


@query("algorithm_counts", "G19", f"WITH {MODELS} SELECT algorithm, count(*) AS n FROM models GROUP BY algorithm")
def algorithm_counts(spark, folder):
    return R.algorithm_counts(models(spark, folder))


@query(
    "constraint_violations",
    "G20",
    f"""WITH {MODELS}, {METRICS}, {PARAMETERS}, {COMPARISONS},
    twice AS (SELECT model_name, CASE WHEN id % 11 = 0 THEN '1.0.0' ELSE version END AS version,
                     CASE WHEN id % 6 = 0 THEN 'lost' ELSE status END AS status, model_type FROM models)
    SELECT 'unique_model_version' AS constraint_name, count(*) AS violations FROM (SELECT 1 FROM twice GROUP BY model_name, version HAVING count(*) > 1)
    UNION ALL SELECT 'unique_metric', count(*) FROM (SELECT 1 FROM metrics GROUP BY model_id, metric_name, dataset_type HAVING count(*) > 1)
    UNION ALL SELECT 'unique_parameter', count(*) FROM (SELECT 1 FROM parameters GROUP BY model_id, parameter_name HAVING count(*) > 1)
    UNION ALL SELECT 'model_type_known', count(*) FROM twice WHERE model_type NOT IN ('regression', 'classification', 'clustering', 'other')
    UNION ALL SELECT 'status_known', count(*) FROM twice WHERE status NOT IN ('active', 'deprecated', 'archived', 'failed')
    UNION ALL SELECT 'dataset_type_known', count(*) FROM metrics WHERE dataset_type NOT IN ('train', 'validation', 'test')
    UNION ALL SELECT 'parameter_type_known', count(*) FROM parameters WHERE parameter_type NOT IN ('int', 'float', 'str', 'bool', 'dict', 'list')
    UNION ALL SELECT 'two_models_compared', count(*) FROM comparisons WHERE len(model_ids) < 2""",
)
def constraint_violations(spark, folder):
    m = models(spark, folder)
    m = m.withColumns(
        {
            "version": F.when(F.col("id") % 11 == 0, "1.0.0").otherwise(F.col("version")),
            "status": F.when(F.col("id") % 6 == 0, "lost").otherwise(F.col("status")),
        }
    )
    return R.constraint_violations(m, model_metrics(spark, folder), model_parameters(spark, folder), comparisons(spark, folder))


@query(
    "archive_stale",
    "D13",
    f"""WITH {MODELS} SELECT id, CASE WHEN status = 'active' AND date_diff('day', CAST(created_at AS DATE), DATE '2024-05-01') > 90
      THEN 'archived' ELSE status END AS status FROM models""",
)
def archive_stale(spark, folder):
    return R.archive_stale(models(spark, folder), F.lit("2024-05-01").cast("date"), 90).select("id", "status")
