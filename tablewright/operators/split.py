"""Train/test splits, folds and cross-validation summaries.

Every split is a function of a key, so re-running a lost task gives the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.ordered import at_or_before, hash_thresholds, nth_key, nth_keys, positions
from tablewright.functions.scalar import col, md5_bits

TWO_POW_32 = 4294967296


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def chronological_split(df: DataFrame, order: str, tie: str, test_size: float = 0.2, output: str = "is_train") -> DataFrame:
    """The first int(n * (1 - test_size)) rows by (order, tie) are train.

    Null order values come last, so they are test rows. The boundary row is found from counts; the split itself is then a filter on (order, tie), with
    no shuffle of the data.
    """
    cut = nth_key(df, order, tie, int(row_count(df) * (1 - test_size)))
    return df.withColumn(output, at_or_before(col(order), col(tie), cut))


def tail_split(df: DataFrame, order: str, tie: str, share: float = 0.2) -> DataFrame:
    """The last ``share`` of the rows in (order, tie) order."""
    return chronological_split(df, order, tie, share).filter(~F.col("is_train")).drop("is_train")


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, output: str = "is_train") -> DataFrame:
    """Random split by key hash: map-side only, sizes are approximate."""
    return df.withColumn(output, md5_bits(col(key)) >= F.lit(int(test_size * TWO_POW_32)))


def _within(hash_: Column, key: Column, cut: Column) -> Column:
    """Null keys hash to 0 and sort first, as in hash_thresholds."""
    own = F.coalesce(hash_, F.lit(0))
    same = F.coalesce(key <= cut["key"], key.isNull())
    return F.coalesce((own < cut["hash"]) | ((own == cut["hash"]) & same), F.lit(False))


def stratified_split(
    df: DataFrame, key: str, label: str | None, test_size: float = 0.2, output: str = "is_train"
) -> DataFrame:
    """In each label the ceil(test_size * n) rows with the smallest key hash are test rows.

    Without a label this is a random split of exact size. Only one threshold per label is joined
    back, so a label holding most rows costs no extra.
    """
    group = [] if label is None else [label]
    wanted = F.array(F.ceil(F.round(F.col("n") * F.lit(test_size), 9)).cast("bigint"))
    cuts = hash_thresholds(df, key, wanted, group)
    if label is None:
        joined = df.withColumn("cuts", cuts.scalar())
    else:
        cuts = cuts.select(col(label).alias("_label"), "cuts")
        joined = df.join(cuts, col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
    return joined.withColumn(output, ~_within(md5_bits(col(key)), col(key), F.col("cuts")[0])).drop("cuts")


def contiguous_folds(df: DataFrame, order: str, tie: str, k: int, output: str = "fold") -> DataFrame:
    """fold = floor(k * (rank - 1) / n) by (order, tie): k - 1 boundary rows, then a plain projection."""
    n = row_count(df)
    fold = F.lit(0)
    # The first rank of fold i is ceil(i * n / k) + 1; all ranks up to the one before are below i.
    borders = nth_keys(df, order, tie, [math.ceil(i * n / k) for i in range(1, k)])
    for i, last_before in enumerate(borders, 1):
        fold = F.when(~at_or_before(col(order), col(tie), last_before), i).otherwise(fold)
    return df.withColumn(output, fold)


def hashed_folds(df: DataFrame, key: str, k: int, output: str = "fold") -> DataFrame:
    """Shuffled folds by key hash, map-side only."""
    return df.withColumn(output, (md5_bits(col(key)) % k).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int, output: str = "fold") -> DataFrame:
    """Folds whose sizes differ by at most one inside each label: k - 1 hash thresholds per label."""
    wanted = F.array(*[F.ceil(F.col("n") * i / k).cast("bigint") for i in range(1, k)])
    cuts = hash_thresholds(df, key, wanted, [label]).select(col(label).alias("_label"), "cuts")
    joined = df.join(cuts, col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
    hash_ = md5_bits(col(key))
    fold = F.lit(0)
    for i in range(1, k):
        fold = F.when(_within(hash_, col(key), F.col("cuts")[i - 1]), fold).otherwise(F.lit(i))
    return joined.withColumn(output, fold).drop("cuts")


def regression_cv(predictions: DataFrame, fold: str, actual: str, predicted: str) -> DataFrame:
    """cv_rmse = sqrt(mean of the folds' mean squared errors)."""
    per_fold = predictions.groupBy(col(fold)).agg(F.avg((col(actual) - col(predicted)) ** 2).alias("mse"))
    return per_fold.agg(F.count(F.lit(1)).alias("folds"), F.sqrt(F.avg("mse")).alias("cv_rmse"))


def classification_cv(predictions: DataFrame, fold: str, truth: str, predicted: str) -> DataFrame:
    """Mean and population deviation of the folds' accuracies."""
    per_fold = predictions.groupBy(col(fold)).agg(F.avg((col(truth) == col(predicted)).cast("double")).alias("acc"))
    return per_fold.agg(
        F.count(F.lit(1)).alias("folds"), F.avg("acc").alias("cv_mean"), F.stddev_pop("acc").alias("cv_std")
    )


def numbered(df: DataFrame, order: str, tie: str, group: Sequence[str] = (), name: str = "row_id") -> DataFrame:
    """Explicit row number for tables that need one."""
    return positions(df, order, tie, group, name=name)
