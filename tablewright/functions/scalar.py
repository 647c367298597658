"""Column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MD5_BITS = 32


def col(name: str) -> Column:
    """Reference a column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def md5_bits(*keys: Column) -> Column:
    """First 32 bits of the md5 of the key, as a long. Uniform, and the same in any SQL engine."""
    text = keys[0].cast("string") if len(keys) == 1 else F.concat_ws("|", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def row_digest(df: DataFrame) -> Column:
    """32-bit digest of a whole row; nulls are marked so that they differ from empty strings."""
    return md5_bits(F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("\\N")) for c in df.columns]))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def datetime_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, cast: str) -> DataFrame:
    """Wide to long with one output type; rows are expanded in place, nothing is shuffled."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), col(c).cast(cast).alias(value)) for c in columns])
    return df.select(*[col(i) for i in ids], F.inline(pairs))


def attach_scalars(df: DataFrame, stats: DataFrame, name: str = "_stats") -> DataFrame:
    """Add a one-row statistics frame to every row as a struct, through a scalar subquery."""
    return df.withColumn(name, stats.select(F.struct(*[col(c) for c in stats.columns]).alias(name)).scalar())


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows where both are present; null when either is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def chi_square_tail(statistic: Column, dof: Column) -> Column:
    """P(X > statistic) for a chi-square variable, from the series of the lower incomplete gamma.

    The series P(a, x) = x^a e^-x sum_n x^n / gamma(a + n + 1) has positive terms only. Gamma at a
    half-integer is built up from gamma(1) = 1 or gamma(1/2) = sqrt(pi).
    """
    a, x = dof / 2.0, statistic / 2.0
    odd = dof % 2 == 1
    start = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    log_gamma = F.aggregate(
        F.when(a > start, F.sequence(F.lit(0), (a - start).cast("int"))).otherwise(F.array(F.lit(0))),
        F.when(odd, F.log(F.sqrt(F.lit(3.141592653589793)))).otherwise(F.lit(0.0)),
        lambda acc, i: acc + F.log(start + i),
    )
    # log_gamma now holds log(gamma(a + 1)): the product of start, start + 1, ..., a.
    first = F.exp(a * F.log(x) - x - log_gamma)
    lower = F.aggregate(
        F.sequence(F.lit(1), (F.lit(200) + x * 3).cast("int")),
        F.struct(first.alias("term"), first.alias("total")),
        lambda acc, n: F.struct(
            (acc["term"] * x / (a + n)).alias("term"),
            (acc["total"] + acc["term"] * x / (a + n)).alias("total"),
        ),
    )["total"]
    # Beyond this point the tail is below 1e-12 and the series only costs time.
    far = statistic > dof + F.sqrt(dof * 2.0) * 10 + 100
    return (
        F.when(dof <= 0, F.lit(1.0))
        .when(statistic <= 0, F.lit(1.0))
        .when(far, F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - lower)))
    )
