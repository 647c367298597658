"""Feature engineering, encoders and scalers. Encoders and scalers are ordinary tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ordered import exact_quantiles, positions
from tablewright.functions.scalar import attach_scalars, col, datetime_columns, numeric_columns
from tablewright.operators.project import REGRESSION_NAMES, rename, require_columns

# A one-hot table with more levels than this stops being a sensible wide table.
MAX_LEVELS = 1000


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """year, month, day and day_of_week with Monday = 0."""
    moment = col(column)
    return df.withColumns(
        {
            "year": F.year(moment),
            "month": F.month(moment),
            "day": F.dayofmonth(moment),
            "day_of_week": F.weekday(moment),
        }
    )


def levels(df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct levels of each column, found in one pass.

    At most ``limit + 1`` levels per column are fetched; more is an error, because the result would
    be that many columns wide. Use ``one_hot_sparse`` there.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("c"), col(c).cast("string").alias("v")) for c in columns])
    distinct = df.select(F.inline(cells)).filter("v is not null").distinct()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in distinct.limit(limit * len(columns) + 1).collect():
        found[row["c"]].append(row["v"])
    for c, values in found.items():
        if len(values) > limit:
            raise ValueError(f"{c} has more than {limit} levels; use one_hot_sparse")
    if sum(map(len, found.values())) > limit * len(columns):
        raise ValueError(f"more than {limit} levels per column; use one_hot_sparse")
    return {c: sorted(v) for c, v in found.items()}


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = True, known: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Boolean column per level, ``<column>_<level>``; the first level is dropped and so is the source.

    A null row is false everywhere. ``known`` re-applies the levels of a training table.
    """
    require_columns(df, *columns)
    found = dict(known) if known is not None else levels(df, columns)
    kept = [col(c) for c in df.columns if c not in columns]
    dummies = [
        col(c).cast("string").eqNullSafe(F.lit(v)).alias(f"{c}_{v}")
        for c in columns
        for v in list(found[c])[1 if drop_first else 0 :]
    ]
    return df.select(*kept, *dummies)


def one_hot_sparse(df: DataFrame, column: str, output: str):
    """High-cardinality form: a sparse vector column, and the fitted pipeline that makes it."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    steps = [
        StringIndexer(inputCol=column, outputCol="_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="_index", outputCol=output, dropLast=True),
    ]
    model = Pipeline(stages=steps).fit(df)
    return model.transform(df).drop("_index"), model


def yes_flag(column: Column, yes: str = "Yes") -> Column:
    """1 for yes, 0 for anything else, null included."""
    return column.eqNullSafe(F.lit(yes)).cast("int")


# Output -> (left, right); every output is left - right.
WEATHER_DIFFERENCES = {
    "temp_diff": ("max_temp", "min_temp"),
    "humidity_diff": ("humidity_9am", "humidity_3pm"),
    "pressure_diff": ("pressure_9am", "pressure_3pm"),
    "temp_diff_9am_3pm": ("temp_3pm", "temp_9am"),
}


def differences(df: DataFrame, pairs: Mapping[str, tuple[str, str]] = WEATHER_DIFFERENCES) -> DataFrame:
    """Add left - right for every pair whose columns both exist."""
    have = set(df.columns)
    return df.withColumns({out: col(a) - col(b) for out, (a, b) in pairs.items() if a in have and b in have})


def interactions(
    df: DataFrame,
    products: Mapping[str, tuple[str, str]] | None = None,
    averages: Mapping[str, tuple[str, str]] | None = None,
    ranges: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Products, pairwise means and ranges of columns that exist."""
    have = set(df.columns)

    def both(pairs):
        return {k: v for k, v in (pairs or {}).items() if set(v) <= have}

    return df.withColumns(
        {k: col(a) * col(b) for k, (a, b) in both(products).items()}
        | {k: (col(a) + col(b)) / 2 for k, (a, b) in both(averages).items()}
        | {k: col(a) - col(b) for k, (a, b) in both(ranges).items()}
    )


def weather_interactions(df: DataFrame) -> DataFrame:
    """The regression features of the weather table, under the names the regression table uses."""
    out = interactions(
        df,
        products={"RainTempInteraction": ("rainfall", "max_temp"), "HumidityInteraction": ("humidity_9am", "humidity_3pm")},
        averages={"WindSpeedAvg": ("wind_speed_9am", "wind_speed_3pm")},
        ranges={"TempRange": ("max_temp", "min_temp")},
    )
    return rename(out, REGRESSION_NAMES)


def transform_table(
    df: DataFrame,
    date: str,
    categorical: Sequence[str],
    flags: Sequence[str],
    last_categorical: str,
    pairs: Mapping[str, tuple[str, str]] = WEATHER_DIFFERENCES,
) -> DataFrame:
    """Date parts, dummies, yes/no flags, median fill, differences, then the location dummies.

    Dummies are made before the median fill, so null categories are all-false rows. Flag columns are
    replaced by ``<name>_binary``. Levels of both dummy groups come from one pass.
    """
    from tablewright.operators.clean import impute_median

    numeric = numeric_columns(df)
    known = levels(df, [*categorical, last_categorical])
    out = date_parts(df, date)
    out = one_hot(out, categorical, known=known)
    out = out.withColumns({f"{c}_binary": yes_flag(col(c)) for c in flags}).drop(*flags)
    if numeric:
        out = impute_median(out, numeric, fit_on=df)
    out = differences(out, pairs).drop(*datetime_columns(df))
    return one_hot(out, [last_categorical], known=known)


# ------------------------------------------------------------------ label encoding


def fit_labels(train: DataFrame, column: str) -> DataFrame:
    """Lookup (value, id): ids run 0.. in alphabetical order of the training values.

    Distinct values come first, so the ordering step sees one row per level; many levels are numbered
    in chunks.
    """
    distinct = train.filter(col(column).isNotNull()).select(col(column).cast("string").alias("value")).distinct()
    return positions(distinct, "value", name="id").withColumn("id", (F.col("id") - 1).cast("int"))


def apply_labels(df: DataFrame, column: str, labels: DataFrame, output: str, on_unseen: str = "next_id") -> DataFrame:
    """Left join on the lookup. Unseen values take the next free id, or raise with ``on_unseen='error'``."""
    count = labels.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    found = df.join(labels.select(F.col("value").alias("_v"), F.col("id").alias("_id")), col(column).cast("string") == F.col("_v"), "left")
    if on_unseen == "error":
        unseen = F.raise_error(F.concat(F.lit(f"unseen label in {column}: "), F.coalesce(col(column).cast("string"), F.lit("null"))))
        value = F.when(F.col("_id").isNull(), unseen.cast("int")).otherwise(F.col("_id"))
    else:
        value = F.coalesce(F.col("_id"), count)
    return found.withColumn(output, value).drop("_v", "_id")


# ------------------------------------------------------------------ scaling


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard", small: bool | None = None) -> DataFrame:
    """Scaler as a table (feature, center, scale). A constant feature gets scale 1.

    ``standard``: mean and population deviation; ``minmax``: minimum and range; ``robust``: median
    and interquartile range. All features share one pass.
    """
    if method == "standard":
        stats = df.agg(
            *[F.struct(F.avg(col(c)).alias("center"), F.stddev_pop(col(c)).alias("scale")).alias(c) for c in columns]
        )
    elif method == "minmax":
        low = {c: F.min(col(c).cast("double")) for c in columns}
        stats = df.agg(
            *[F.struct(low[c].alias("center"), (F.max(col(c).cast("double")) - low[c]).alias("scale")).alias(c) for c in columns]
        )
    elif method == "robust":
        q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], small=small)
        stats = q.select(*[F.struct(col(c)[1].alias("center"), (col(c)[2] - col(c)[0]).alias("scale")).alias(c) for c in columns])
    else:
        raise ValueError(f"unknown scaling method {method}")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), col(c)["center"].alias("center"), col(c)["scale"].alias("scale")) for c in columns])
    long = stats.select(F.inline(cells))
    return long.select("feature", "center", F.when(F.col("scale") == 0, F.lit(1.0)).otherwise(F.col("scale")).alias("scale"))


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - center) / scale. The scaler has one row per feature, so it fits one map in a subquery."""
    packed = scaler.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("center", "scale")))).alias("params")
    )
    wide = attach_scalars(df, packed, "_scaler")
    return wide.select(
        *[
            ((col(c) - F.col("_scaler.params")[c]["center"]) / F.col("_scaler.params")[c]["scale"]).alias(c)
            if c in columns
            else col(c)
            for c in df.columns
        ]
    )


def features_by_name(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The stored features in stored order; a missing one is an error, extra columns are dropped."""
    require_columns(df, *features)
    return df.select(*[col(c) for c in features])


def feature_metadata(train: DataFrame, test: DataFrame, features: Sequence[str], scaled: bool) -> DataFrame:
    """One row: feature count and names, table shapes, scaler flag."""
    n_test = test.agg(F.count(F.lit(1)).alias("n")).scalar()
    return train.agg(F.count(F.lit(1)).alias("train_rows")).select(
        F.lit(len(features)).alias("feature_count"),
        F.concat_ws(",", F.array(*[F.lit(c) for c in features])).alias("feature_names"),
        "train_rows",
        n_test.alias("test_rows"),
        F.lit(len(train.columns)).alias("train_columns"),
        F.lit(len(test.columns)).alias("test_columns"),
        F.lit(scaled).alias("scaled"),
    )


# ------------------------------------------------------------------ declared options


def polynomial(df: DataFrame, columns: Sequence[str], degree: int = 2, include_bias: bool = False) -> DataFrame:
    """All products of up to ``degree`` columns, as ``a``, ``a*a``, ``a*b`` ..."""
    from itertools import combinations_with_replacement

    made: dict[str, Column] = {"bias": F.lit(1.0)} if include_bias else {}
    for d in range(2, degree + 1):
        for combo in combinations_with_replacement(columns, d):
            product = col(combo[0])
            for c in combo[1:]:
                product = product * col(c)
            made["*".join(combo)] = product
    return df.withColumns(made)


def target_encode(train: DataFrame, df: DataFrame, column: str, target: str, output: str, smoothing: float = 0.0) -> DataFrame:
    """Mean of the target per training level; unseen levels take the overall mean.

    One row per level joins unhinted; a hot level is only hot on the row side, which adaptive
    execution can split.
    """
    per_level = train.groupBy(col(column).alias("_level")).agg(
        F.sum(col(target)).alias("_sum"), F.count(col(target)).alias("_n")
    )
    overall = train.agg(F.avg(col(target)).alias("m")).scalar()
    encoded = per_level.select("_level", F.try_divide(F.col("_sum") + overall * smoothing, F.col("_n") + smoothing).alias("_mean"))
    joined = df.join(encoded, col(column) == F.col("_level"), "left")
    return joined.withColumn(output, F.coalesce(F.col("_mean"), overall)).drop("_level", "_mean")
