"""Feature selection: correlation, mutual information, chi-square, importances, elimination, voting."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.scalar import attach_scalars, chi_square_tail, col, correlation, unpivot
from tablewright.operators.project import require_columns
from tablewright.session import durable, reused

# Rows of one partition of a learner's input, and the most partitions: an iteration costs a task for each of them, and
# each task's result goes to the driver.
LAYOUT_ROWS, LAYOUT_PARTS = 20_000, 256
# Rows of a learner's input above which equal ones are made one: where the partitions would begin to grow.
COMBINED_ROWS = LAYOUT_ROWS * LAYOUT_PARTS
# Parts of such a table that one row may stand for where a learner's deviations take weights for something else than rows.
COMBINED_PARTS = 1_000_000

# Weight of each selection method, in voting order.
VOTE_WEIGHTS = {"correlation": 1, "mutual_info": 2, "chi_square": 1, "feature_importance": 2, "rfe": 3}


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, correlation, abs_correlation) for all features from one aggregation; constants drop out."""
    wide = df.agg(*[correlation(col(c), col(target)).alias(c) for c in features])
    long = unpivot(wide, [], features, "feature", "correlation", "double")
    return long.filter("correlation is not null").withColumn("abs_correlation", F.abs("correlation"))


def top_correlated(df: DataFrame, features: Sequence[str], target: str, k: int = 20, threshold: float = 0.0) -> DataFrame:
    scores = target_correlation(df, features, target).filter(F.col("abs_correlation") >= threshold)
    return scores.orderBy(F.desc("abs_correlation"), "feature").limit(k)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long (a, b, r) over all ordered pairs; each pair uses the rows where both are present."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[correlation(col(a), col(b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"_{i}").alias("r")))
    return wide.select(F.inline(F.array(*cells)))


def _named(counted: DataFrame, features: Sequence[str]) -> DataFrame:
    """Counts by a feature's number (``_f``), by its name."""
    return counted.withColumn("feature", F.element_at(F.array(*[F.lit(c) for c in features]), F.col("_f") + 1)).drop("_f")


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) of equal-width bins against the target.

    This is a binned estimate: it is not the nearest-neighbour estimator, and its values differ from
    that one. Only (feature, bin, class) counts are shuffled.
    """
    values = [col(c).cast("double") for c in features]
    edges = df.agg(F.array(*[F.min(v) for v in values]).alias("lo"), F.array(*[F.max(v) for v in values]).alias("hi"))
    # Values come apart before they are binned: one short expression for all features. They are counted by a feature's
    # number, which groups faster than its name does.
    apart = df.select(col(target).alias("y"), F.posexplode(F.array(*values)).alias("_f", "_v"))
    lo, hi = (F.get(F.col(f"_e.{side}"), F.col("_f")) for side in ("lo", "hi"))
    spot = F.least(F.floor((F.col("_v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    at = F.when(hi == lo, F.lit(0)).otherwise(spot).cast("int")
    long = attach_scalars(apart, edges, "_e").select("y", "_f", at.alias("bin")).filter("y is not null and bin is not null")
    joint = _named(long.groupBy("_f", "bin", "y").agg(F.count(F.lit(1)).alias("n")), features)
    # From here on there are at most features * bins * classes rows.
    whole = Window.partitionBy("feature")
    parts = joint.select(
        "feature",
        (F.col("n") / F.sum("n").over(whole)).alias("p"),
        (F.sum("n").over(Window.partitionBy("feature", "bin")) / F.sum("n").over(whole)).alias("px"),
        (F.sum("n").over(Window.partitionBy("feature", "y")) / F.sum("n").over(whole)).alias("py"),
    )
    return parts.groupBy("feature").agg(F.sum(F.col("p") * F.log(F.col("p") / (F.col("px") * F.col("py")))).alias("mi"))


def top_mutual_information(df: DataFrame, features: Sequence[str], target: str, k: int = 10, bins: int = 10) -> DataFrame:
    return mutual_information(df, features, target, bins).orderBy(F.desc("mi"), "feature").limit(k)


def chi_square(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Independence test of each category against the target, with Yates' correction when dof = 1.

    Columns: feature, statistic, dof, p_value, significant. A feature that cannot be tested gives
    (0, 0, 1, false). Levels are only ever counted: rows are combined to one count per (feature,
    level, class), and no feature's levels are gathered in one task. Empty cells are accounted for in
    closed form, so the full contingency table is never built.
    """
    levels = F.array(*[col(c).cast("string") for c in features])
    long = df.select(col(target).cast("string").alias("y"), F.posexplode(levels).alias("_f", "level")).filter("y is not null and level is not null")
    counted = _named(long.groupBy("_f", "level", "y").agg(F.count(F.lit(1)).alias("o")), features)
    by_level = Window.partitionBy("feature", "level")
    observed = counted.withColumns(
        {
            "r": F.sum("o").over(by_level),
            "first": F.row_number().over(by_level.orderBy("y")) == 1,
        }
    )
    # One row per (feature, class).
    classes = counted.groupBy("feature", "y").agg(F.sum("o").alias("c"))
    totals = classes.groupBy("feature").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("classes"), F.sum(1.0 / F.col("c")).alias("inv_c")
    )
    table = observed.join(classes, ["feature", "y"]).join(totals, "feature")
    expected = F.col("r") * F.col("c") / F.col("n")
    sums = table.groupBy("feature").agg(
        F.first("n").alias("n"),
        F.first("classes").alias("classes"),
        F.first("inv_c").alias("inv_c"),
        F.count_if("first").alias("levels"),
        F.sum(F.when(F.col("first"), 1.0 / F.col("r"))).alias("inv_r"),
        F.sum((F.col("o") - expected) ** 2 / expected - expected).alias("seen"),
        F.max(F.abs(F.col("o") - expected)).alias("gap"),
    )
    dof = ((F.col("levels") - 1) * (F.col("classes") - 1)).cast("int")
    yates = (F.col("gap") - F.least(F.lit(0.5), F.col("gap"))) ** 2 * F.col("n") * F.col("inv_r") * F.col("inv_c")
    tested = sums.select("feature", "n", "seen", dof.alias("dof"), yates.alias("yates")).select(
        "feature",
        F.when(F.col("dof") == 0, 0.0).when(F.col("dof") == 1, F.col("yates")).otherwise(F.col("seen") + F.col("n")).alias("statistic"),
        "dof",
    )
    tested = tested.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("dof")))
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return names.join(tested, "feature", "left").select(
        "feature",
        F.coalesce("statistic", F.lit(0.0)).alias("statistic"),
        F.coalesce("dof", F.lit(0)).alias("dof"),
        F.coalesce("p_value", F.lit(1.0)).alias("p_value"),
        F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("significant"),
    )


def training_rows(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feature vector, label and kept columns of the labelled rows."""
    slim = df.select(*[col(c) for c in dict.fromkeys([label, *keep, *features])]).na.drop(subset=[label])
    return assemble(slim, features, keep=[label, *keep])


def fit_on(learner, rows: DataFrame):
    """Fit an MLlib learner on rows in a layout that only the data decide.

    Learners read their input several times before they start, so it is kept. The learner is given a filter of
    the kept table, which is another plan (a projection of all columns counts as the same): on an input that is itself marked as kept it would skip storing its
    blocked form and rebuild that in every iteration.
    """
    with reused(fixed_layout(rows)) as kept:
        return learner.fit(kept.filter(F.lit(True)))


def fixed_layout(rows: DataFrame, digest: str | None = None) -> DataFrame:
    """Rows dealt out by their own hash, into as many partitions as their number asks for (256 at most), and sorted there.

    MLlib samples by partition and place, so a model depends on the layout of its input: with this one it
    is the same on any number of cores and for any way the table is stored. ``digest`` names a column that holds the hash.
    """
    digest = F.xxhash64(*[col(c) for c in rows.columns]) if digest is None else col(digest)
    parts = min(max(4, math.ceil(rows.count() / LAYOUT_ROWS)), LAYOUT_PARTS)
    return rows.repartition(parts, digest).sortWithinPartitions(digest)


def combined(rows: DataFrame, many: str = "_n", parts: int | None = None) -> DataFrame | None:
    """Equal rows of a large table as one, with their number, for a learner that takes weights: its loss stays the same sum.

    None for a table of few rows, or of rows that are mostly different, which a learner gets as they are. MLlib divides a
    weighted variance by (w - sum of squared weights / w), which is w less one row's share only if no weight is large. For
    a penalty that goes by it, ``parts`` says how many rows of like weight at least the whole table is divided into.
    """
    total, different = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*[col(c) for c in rows.columns]))).first()
    if total <= COMBINED_ROWS or 2 * different > total:
        return None
    few = rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count(F.lit(1)).cast("double").alias(many))
    if parts is None:
        return few
    shared = few.withColumn("_times", F.ceil(col(many) / max(1.0, total / parts)).cast("int"))
    return shared.select(*[col(c) for c in rows.columns], (col(many) / F.col("_times")).alias(many), F.explode(F.array_repeat(F.lit(0), F.col("_times")))).drop("col")


def assemble(df: DataFrame, features: Sequence[str], output: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    require_columns(df, *features, *keep)
    slim = df.select(*[col(c) for c in dict.fromkeys([*keep, *features])]).na.fill(0, subset=list(features))
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(slim)


def forest_importance(
    df: DataFrame, features: Sequence[str], target: str, trees: int = 100, depth: int | None = None, k: int = 10, seed: int = 42
) -> tuple[DataFrame, float]:
    """Top features of a random forest fitted on all rows, and its accuracy on them. The trees stay on the executors."""
    from tablewright.operators import growing
    from tablewright.operators import trees as learners

    model = growing.fit(
        df, features, target, learners._classes(df, target), trees, depth or growing.DEEPEST, subset="sqrt", bootstrap=True, seed=seed, keep="leaves"
    )
    return importance_frame(df, features, model.importances).limit(k), model.accuracy


def importance_frame(df: DataFrame, features: Sequence[str], values: Sequence[float]) -> DataFrame:
    """(feature, value, abs_value), largest magnitude first; one row per feature."""
    rows = [(f, float(v), abs(float(v))) for f, v in zip(features, values, strict=True)]
    out = df.sparkSession.createDataFrame(rows, "feature string, value double, abs_value double")
    return out.orderBy(F.desc("abs_value"), "feature")


def eliminate_features(
    df: DataFrame, features: Sequence[str], target: str, keep: int = 10, trees: int = 50, depth: int | None = None, step: int = 1, seed: int = 42
) -> DataFrame:
    """Recursive elimination by forest importance: (feature, rank), 1 = kept, 2 = dropped last.

    The labelled rows with all features are stored once, and the cut points of the bins are found once; every
    round reads the columns that are left. The bins of a small table (``growing.gather``) stay in memory for all rounds.
    ``step`` drops several features per round.
    """
    from tablewright.operators import growing
    from tablewright.operators import trees as learners

    numbers = [F.coalesce(col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    rows = durable(df.filter(col(target).isNotNull()).select(col(target), *numbers, F.xxhash64(*[col(c) for c in df.columns]).alias("_key")))
    classes = learners._classes(rows, target)
    cuts = dict(zip(features, growing.limits(rows, features), strict=True))
    left, dropped = list(features), []
    held = growing.gather(rows, features, target, list(cuts.values()), classes) if len(left) > keep and classes else None
    while len(left) > keep:
        model = growing.fit(
            rows, left, target, classes, trees, depth or growing.DEEPEST, subset="sqrt", bootstrap=True, seed=seed, cuts=[cuts[f] for f in left], keep="gains",
            held=held,
        )
        scores = dict(zip(left, model.importances, strict=True))
        worst = sorted(left, key=lambda f: (scores[f], f))[: min(step, len(left) - keep)]
        dropped.append(worst)
        left = [f for f in left if f not in worst]
    ranks = [(f, 1) for f in left] + [(f, len(dropped) - i + 1) for i, batch in enumerate(dropped) for f in batch]
    return df.sparkSession.createDataFrame(ranks, "feature string, rank int").orderBy("rank", "feature")


def vote(ranked: DataFrame, weights: Mapping[str, int] = VOTE_WEIGHTS, per_method: int = 10, take: int = 15) -> DataFrame:
    """Weighted vote over (method, feature, place): feature, votes, place, threshold.

    Features are ordered by votes; ties keep the order in which the methods, in the order of
    ``weights``, first named them. The elimination method counts all of its features, the others
    their first ``per_method``. There is one row per method and feature.
    """
    order = list(weights)
    weight = F.element_at(F.create_map(*[F.lit(x) for m in order for x in (m, weights[m])]), F.col("method"))
    turn = F.element_at(F.create_map(*[F.lit(x) for i, m in enumerate(order) for x in (m, i)]), F.col("method"))
    counted = ranked.filter((F.col("method") == "rfe") | (F.col("place") <= per_method))
    votes = counted.groupBy("feature").agg(
        F.sum(weight).cast("int").alias("votes"), F.min(F.struct(turn.alias("turn"), F.col("place").alias("place"))).alias("seen")
    )
    places = votes.withColumn("place", F.row_number().over(Window.orderBy(F.desc("votes"), "seen")))
    cut = places.agg(F.coalesce(F.max(F.when(F.col("place") == take, F.col("votes"))), F.lit(0)).alias("t")).scalar()
    return places.filter(F.col("place") <= take).select("feature", "votes", "place", cut.alias("threshold"))


def selection_report(ranked: DataFrame, top: int = 5) -> DataFrame:
    """Per method: number of features named and the first ``top`` of them."""
    best = ranked.filter(F.col("place") <= top).groupBy("method").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "feature"))), lambda x: x["feature"]), ",").alias("top_features")
    )
    counts = ranked.groupBy("method").agg(F.count(F.lit(1)).alias("features_named"))
    return counts.join(best, "method", "left")


def select_features(
    df: DataFrame, features: Sequence[str], target: str, method: str = "correlation", k: int = 20, threshold: float = 0.0
) -> list[str]:
    """Configured selector; ``none`` and unknown methods keep everything. At most ``k`` names reach the driver."""
    if method == "correlation":
        chosen = top_correlated(df, features, target, k, threshold)
    elif method == "mutual_info":
        chosen = top_mutual_information(df, features, target, k)
    elif method == "chi2":
        chosen = chi_square(df, features, target).filter("significant").orderBy(F.desc("statistic"), "feature").limit(k)
    elif method == "rfe":
        chosen = eliminate_features(df, features, target, keep=min(k, len(features))).filter("rank = 1")
    else:
        return list(features)
    return [row["feature"] for row in chosen.select("feature").collect()]
