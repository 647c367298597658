"""The model registry as tables: summary, leaderboard, versions, registration, audit, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ordered import positions
from tablewright.functions.scalar import col

# Allowed codes.
ALLOWED_MODEL_TYPES = ("regression", "classification", "clustering", "other")
STATUSES = ("active", "deprecated", "archived", "failed")
DATASET_TYPES = ("train", "validation", "test")
PARAMETER_TYPES = ("int", "float", "str", "bool", "dict", "list")
# The model types that are ranked.
MODEL_TYPES = ("regression", "classification")
# Metric that ranks each model type.
PRIMARY_METRIC = {"regression": "r2_score", "classification": "accuracy"}
FIRST_VERSION = "1.0.0"

REGISTRY_SCHEMA = (
    "id bigint, model_name string, model_type string, algorithm string, version string, model_hash string,"
    " created_at timestamp, created_by string, status string, description string, tags map<string,string>,"
    " updated_at timestamp"
)
METRICS_SCHEMA = (
    "model_id bigint, metric_name string, metric_value decimal(15,8), dataset_type string, created_at timestamp"
)
PARAMETERS_SCHEMA = (
    "model_id bigint, parameter_name string, parameter_value string, parameter_type string, created_at timestamp"
)

# Metric rules (metric, minimum, maximum, warning threshold, better direction).
METRIC_RULES = {
    "regression": [
        ("r2_score", -10.0, 1.0, 0.5, "higher"),
        ("mean_squared_error", 0.0, None, 1000.0, "lower"),
        ("mean_absolute_error", 0.0, None, 100.0, "lower"),
    ],
    "classification": [
        ("accuracy", 0.0, 1.0, 0.6, "higher"),
        ("precision", 0.0, 1.0, 0.6, "higher"),
        ("recall", 0.0, 1.0, 0.6, "higher"),
        ("f1_score", 0.0, 1.0, 0.6, "higher"),
        ("roc_auc", 0.0, 1.0, 0.7, "higher"),
    ],
}


def model_summary(registry: DataFrame, metrics: DataFrame, parameters: DataFrame) -> DataFrame:
    """Every model with its primary metric, mse, f1 and the number of metrics and parameters.

    One conditional aggregate per fact table replaces five per-row lookups; both aggregates are
    hashed on the model id, like the joins that follow.
    """
    on_test = F.col("dataset_type") == "test"

    def pick(name: str) -> Column:
        return F.max(F.when(on_test & (F.col("metric_name") == name), F.col("metric_value")))

    facts = metrics.groupBy(F.col("model_id").alias("id")).agg(
        pick("r2_score").alias("_r2"),
        pick("accuracy").alias("_accuracy"),
        pick("mean_squared_error").alias("mse"),
        pick("f1_score").alias("f1_score"),
        F.count(F.lit(1)).alias("_metrics"),
    )
    counts = parameters.groupBy(F.col("model_id").alias("id")).agg(F.count(F.lit(1)).alias("_parameters"))
    primary = F.when(F.col("model_type") == "regression", F.col("_r2")).when(F.col("model_type") == "classification", F.col("_accuracy"))
    return (
        registry.join(facts, "id", "left")
        .join(counts, "id", "left")
        .select(
            "id", "model_name", "model_type", "algorithm", "version", "status", "created_at", "created_by", "description", "tags",
            primary.alias("primary_metric"),
            "mse",
            "f1_score",
            F.coalesce("_metrics", F.lit(0)).alias("metrics_count"),
            F.coalesce("_parameters", F.lit(0)).alias("hyperparameters_count"),
        )
    )


def leaderboard(summary: DataFrame) -> DataFrame:
    """Active models with a primary metric, ranked inside their type; equal metrics share a rank."""
    live = summary.filter((F.col("status") == "active") & F.col("primary_metric").isNotNull()).select(
        "model_type", "algorithm", "model_name", "version", "primary_metric", "created_at", "status", "id"
    )
    return positions(live, "primary_metric", "id", ["model_type"], descending=True, name="rank", method="rank").drop("id")


def top_models(board: DataFrame, model_type: str, n: int = 10) -> DataFrame:
    return board.filter(F.col("model_type") == model_type).orderBy("rank", "model_name", "version").limit(n)


def top_models_of(summary: DataFrame, model_type: str, n: int = 10) -> DataFrame:
    """The best ``n`` of one type straight from the summary: a top-n, no full ranking."""
    live = summary.filter((F.col("status") == "active") & (F.col("model_type") == model_type) & F.col("primary_metric").isNotNull())
    return live.orderBy(F.desc("primary_metric"), "model_name", "version").limit(n)


def combined_leaderboard(board: DataFrame, stamp: Column, n: int = 10) -> DataFrame:
    """Top rows of every model type, stacked, with the time of the run."""
    out: DataFrame | None = None
    for kind in MODEL_TYPES:
        part = top_models(board, kind, n)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("generated_at", stamp)


def recent_comparisons(comparisons: DataFrame, registry: DataFrame, newest: int | None = None) -> DataFrame:
    """Comparisons with their winner, newest first."""
    winners = registry.select(
        F.col("id").alias("winner_model_id"),
        F.col("model_name").alias("winner_model_name"),
        F.col("algorithm").alias("winner_algorithm"),
        F.col("version").alias("winner_version"),
    )
    out = comparisons.join(winners, "winner_model_id", "left").select(
        "comparison_name", "comparison_type", "created_at", "created_by", "winner_model_name", "winner_algorithm", "winner_version",
        F.size("model_ids").alias("models_compared"),
    )
    return out if newest is None else out.orderBy(F.desc("created_at"), "comparison_name").limit(newest)


def audit_summary(audit: DataFrame, registry: DataFrame, newest: int | None = None) -> DataFrame:
    """Audit entries of known models, newest first."""
    names = registry.select(F.col("id").alias("model_id"), "model_name", "version")
    out = audit.join(names, "model_id", "inner").select("model_name", "version", "action", "changed_by", "changed_at", "reason")
    if newest is None:
        return out
    return out.orderBy(F.desc("changed_at"), "model_name", "version", "action", "changed_by").limit(newest)


def audit_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What changed between two snapshots: (key, action, old_values, new_values); equal rows are left out."""

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(col(key), F.to_json(F.struct(*[col(c) for c in df.columns])).alias(name))

    both = packed(before, "old_values").join(packed(after, "new_values"), key, "full_outer")
    action = F.when(F.col("old_values").isNull(), "created").when(F.col("new_values").isNull(), "deleted").otherwise("updated")
    changed = ~F.col("old_values").eqNullSafe(F.col("new_values"))
    return both.filter(changed).select(col(key), action.alias("action"), "old_values", "new_values")


def touch(df: DataFrame, changed: Column, now: Column) -> DataFrame:
    """Set ``updated_at`` where a row changed."""
    return df.withColumn("updated_at", F.when(changed, now).otherwise(F.col("updated_at")))


def latest_versions(registry: DataFrame) -> DataFrame:
    """Newest row of every model name: an arg-max aggregate, so a name with most rows is combined early."""
    others = [c for c in registry.columns if c != "model_name"]
    newest = registry.groupBy("model_name").agg(F.max_by(F.struct(*[col(c) for c in others]), F.struct("created_at", "id")).alias("_row"))
    return newest.select("model_name", *[F.col("_row")[c].alias(c) for c in others])


def exact_version(registry: DataFrame, name: str, version: str | None = None) -> DataFrame:
    """One model by name: the given version, or the newest."""
    rows = registry.filter(F.col("model_name") == name)
    if version is not None:
        return rows.filter(F.col("version") == version)
    return rows.orderBy(F.desc("created_at"), F.desc("id")).limit(1)


def version_parts(version: Column) -> Column:
    """[major, minor, patch] as integers; null when the text is no version."""
    found = F.regexp_extract(version, r"^(\d+)\.(\d+)\.(\d+)$", 0) != ""
    return F.when(found, F.transform(F.split(version, r"\."), lambda p: p.cast("int")))


def bump(version: Column, part: str = "patch") -> Column:
    """The next major, minor or patch version."""
    v = version_parts(version)
    forms = {
        "major": [v[0] + 1, F.lit(0), F.lit(0)],
        "minor": [v[0], v[1] + 1, F.lit(0)],
        "patch": [v[0], v[1], v[2] + 1],
    }
    return F.when(v.isNotNull(), F.concat_ws(".", *[p.cast("string") for p in forms[part]]))


def next_versions(names: DataFrame, registry: DataFrame, part: str = "patch") -> DataFrame:
    """Next version for every (distinct) name: 1.0.0 for new names."""
    newest = latest_versions(registry).select("model_name", "version")
    return names.join(newest, "model_name", "left").select(
        "model_name", F.coalesce(bump(F.col("version"), part), F.lit(FIRST_VERSION)).alias("next_version")
    )


def content_hash(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in columns]), 256)


def duplicates(candidates: DataFrame, registry: DataFrame, hash_column: str = "model_hash") -> DataFrame:
    return candidates.join(registry.select(hash_column), hash_column, "left_semi")


def new_models(candidates: DataFrame, registry: DataFrame, key: str = "model_name") -> DataFrame:
    """Candidates whose key is not registered yet."""
    return candidates.join(registry.select(key), key, "left_anti")


def accepted_models(candidates: DataFrame, registry: DataFrame, key: str = "model_name", hash_column: str = "model_hash", model_id: str = "id") -> DataFrame:
    """Candidates that may be registered: neither their key nor their content is registered yet, and of
    candidates with one content the one with the smallest id. A null content hash repeats nothing.

    A batch that was registered has nothing left to accept, so that a repeated run changes nothing.
    """
    fresh = new_models(candidates, registry, key).join(registry.select(hash_column), hash_column, "left_anti")
    first = fresh.filter(col(hash_column).isNotNull()).groupBy(col(hash_column)).agg(F.min(col(model_id)).alias("_first"))
    marked = fresh.join(first, hash_column, "left").filter(F.col("_first").isNull() | (F.col("_first") == col(model_id)))
    return marked.select(*candidates.columns)


def registered_parameters(accepted: DataFrame, parameters: DataFrame) -> DataFrame:
    """The rows of the long parameter table (by model_id) that belong to the accepted models."""
    return parameters.join(accepted.select(F.col("id").alias("model_id")), "model_id", "left_semi")


def registration(candidates: DataFrame, registry: DataFrame, metric_columns: Sequence[str]) -> dict[str, DataFrame]:
    """A registration batch: rows for the registry, rows for the metric table, and a one-row summary.

    Names already present are skipped. Metrics that are null are not written.
    """
    fresh = new_models(candidates, registry)
    cells = F.array(*[F.struct(F.lit(m).alias("metric_name"), col(m).cast("decimal(15,8)").alias("metric_value")) for m in metric_columns])
    metrics = fresh.select(F.col("id").alias("model_id"), F.inline(cells), F.lit("test").alias("dataset_type")).filter("metric_value is not null")
    total = candidates.agg(F.count(F.lit(1)).alias("n")).scalar()
    summary = fresh.agg(
        F.count(F.lit(1)).alias("registered"),
        *[F.count_if(F.col("model_type") == t).alias(t) for t in MODEL_TYPES],
    ).select(total.alias("candidates"), "registered", (total - F.col("registered")).alias("skipped"), *MODEL_TYPES)
    return {"registry": fresh, "metrics": metrics, "summary": summary}


def list_models(registry: DataFrame, model_type: str | None = None, algorithm: str | None = None) -> DataFrame:
    """Active models; order by ``created_at`` descending at the point of display."""
    out = registry.filter(F.col("status") == "active")
    if model_type is not None:
        out = out.filter(F.col("model_type") == model_type)
    if algorithm is not None:
        out = out.filter(F.col("algorithm") == algorithm)
    return out


def decode_parameters(parameters: DataFrame) -> DataFrame:
    """Typed columns for the stored text: int_value, float_value, bool_value, text_value."""
    kind, text = F.col("parameter_type"), F.col("parameter_value")
    return parameters.select(
        "model_id",
        "parameter_name",
        "parameter_type",
        F.when(kind == "int", text.try_cast("bigint")).alias("int_value"),
        F.when(kind == "float", text.try_cast("double")).alias("float_value"),
        F.when(kind == "bool", F.lower(text) == "true").alias("bool_value"),
        F.when(kind.isin("str", "dict", "list"), text).alias("text_value"),
    )


def archive_old(registry: DataFrame, keep: int = 10) -> DataFrame:
    """Archive all but the newest ``keep`` versions of every name."""
    ranked = positions(registry, "created_at", "id", ["model_name"], descending=True, name="_age")
    return ranked.withColumn("status", F.when(F.col("_age") > keep, "archived").otherwise(F.col("status"))).drop("_age")


def archive_version(registry: DataFrame, name: str, version: str) -> DataFrame:
    hit = (F.col("model_name") == name) & (F.col("version") == version)
    return registry.withColumn("status", F.when(hit, "archived").otherwise(F.col("status")))


def archive_stale(registry: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    old = F.datediff(as_of, F.col("created_at")) > days
    return registry.withColumn("status", F.when(old & (F.col("status") == "active"), "archived").otherwise(F.col("status")))


def metric_rules(spark, rules=METRIC_RULES) -> DataFrame:
    rows = [(kind, *rule) for kind, many in rules.items() for rule in many]
    return spark.createDataFrame(
        rows, "model_type string, metric_name string, min_value double, max_value double, warn_at double, better string"
    )


def validate_metrics(metrics: DataFrame, registry: DataFrame, rules: DataFrame, directed: bool = True) -> DataFrame:
    """Violations and warnings per model. ``directed`` warns above the threshold for error metrics.

    The rule table is configuration (a few rows); a model has a handful of metrics, so its messages
    stay short.
    """
    typed = metrics.join(registry.select(F.col("id").alias("model_id"), "model_name", "model_type"), "model_id", "inner")
    found = typed.join(rules, ["model_type", "metric_name"], "inner")
    value = F.col("metric_value").cast("double")
    low = F.coalesce(value < F.col("min_value"), F.lit(False))
    high = F.coalesce(value > F.col("max_value"), F.lit(False))
    below, above = value < F.col("warn_at"), value > F.col("warn_at")
    warn = F.coalesce(F.when(F.col("better") == "lower", above).otherwise(below) if directed else below, F.lit(False))
    return found.groupBy("model_id", "model_name").agg(
        (F.count_if(low | high) == 0).alias("is_valid"),
        F.array_join(F.array_sort(F.collect_list(F.when(low | high, F.col("metric_name")))), ",").alias("violations"),
        F.array_join(F.array_sort(F.collect_list(F.when(warn, F.col("metric_name")))), ",").alias("warnings"),
    )


def lineage_rows(registered: DataFrame, pipeline: str, version: str, commit: str, inputs: Sequence[str], stamp: Column) -> DataFrame:
    """One lineage row per registered model; run facts are given by the caller."""
    return registered.select(
        F.col("id").alias("model_id"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(version).alias("pipeline_version"),
        F.lit(commit).alias("git_commit_hash"),
        F.array(*[F.lit(i) for i in inputs]).alias("input_datasets"),
        stamp.alias("created_at"),
    )


def best_per_type(summary: DataFrame) -> DataFrame:
    """The leading active model of every type: an arg-min aggregate."""
    live = summary.filter((F.col("status") == "active") & F.col("primary_metric").isNotNull())
    key = F.struct((-F.col("primary_metric")).alias("k"), "model_name", "version", "algorithm", "primary_metric")
    best = live.groupBy("model_type").agg(F.min(key).alias("b"))
    return best.select("model_type", *[F.col("b")[c].alias(c) for c in ("model_name", "version", "algorithm", "primary_metric")])


def registry_statistics(summary: DataFrame) -> DataFrame:
    """Totals by type and status and the best metric per type, in one aggregation over all rows."""
    live = (F.col("status") == "active") & F.col("primary_metric").isNotNull()
    return summary.agg(
        F.count(F.lit(1)).alias("total_models"),
        *[F.count_if(F.col("model_type") == t).alias(f"{t}_models") for t in MODEL_TYPES],
        F.count_if(F.col("status") == "active").alias("active_models"),
        F.count_if(F.col("status") == "archived").alias("archived_models"),
        *[F.max(F.when(live & (F.col("model_type") == t), F.col("primary_metric"))).alias(f"best_{t}_{m}") for t, m in PRIMARY_METRIC.items()],
    )


def algorithm_counts(registry: DataFrame) -> DataFrame:
    return registry.groupBy("algorithm").agg(F.count(F.lit(1)).alias("n"))


def constraint_violations(registry: DataFrame, metrics: DataFrame, parameters: DataFrame, comparisons: DataFrame) -> DataFrame:
    """(constraint_name, violations) over all tables. Unique keys are counted, never collected."""

    def repeated(df: DataFrame, name: str, *keys: str) -> DataFrame:
        many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        return many.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint_name"), "violations")

    def broken(df: DataFrame, **rules: Column) -> DataFrame:
        wide = df.agg(*[F.count_if(F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()])
        cells = F.array(*[F.struct(F.lit(n).alias("constraint_name"), F.col(n).alias("violations")) for n in rules])
        return wide.select(F.inline(cells))

    return (
        repeated(registry, "unique_model_version", "model_name", "version")
        .unionByName(repeated(metrics, "unique_metric", "model_id", "metric_name", "dataset_type"))
        .unionByName(repeated(parameters, "unique_parameter", "model_id", "parameter_name"))
        .unionByName(
            broken(registry, model_type_known=~F.col("model_type").isin(*ALLOWED_MODEL_TYPES), status_known=~F.col("status").isin(*STATUSES))
        )
        .unionByName(broken(metrics, dataset_type_known=~F.col("dataset_type").isin(*DATASET_TYPES)))
        .unionByName(broken(parameters, parameter_type_known=~F.col("parameter_type").isin(*PARAMETER_TYPES)))
        .unionByName(broken(comparisons, two_models_compared=F.size("model_ids") < 2))
    )
