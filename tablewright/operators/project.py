"""Renames, casts, column selection and row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.scalar import col, datetime_columns, numeric_columns, string_columns

# Raw weather header -> clean name.
WEATHER_COLUMNS = {
    "Date": "date",
    "Location": "location",
    "MinTemp": "min_temp",
    "MaxTemp": "max_temp",
    "Rainfall": "rainfall",
    "Evaporation": "evaporation",
    "Sunshine": "sunshine",
    "WindGustDir": "wind_gust_dir",
    "WindGustSpeed": "wind_gust_speed",
    "WindDir9am": "wind_dir_9am",
    "WindDir3pm": "wind_dir_3pm",
    "WindSpeed9am": "wind_speed_9am",
    "WindSpeed3pm": "wind_speed_3pm",
    "Humidity9am": "humidity_9am",
    "Humidity3pm": "humidity_3pm",
    "Pressure9am": "pressure_9am",
    "Pressure3pm": "pressure_3pm",
    "Cloud9am": "cloud_9am",
    "Cloud3pm": "cloud_3pm",
    "Temp9am": "temp_9am",
    "Temp3pm": "temp_3pm",
    "RainToday": "rain_today",
    "RISK_MM": "risk_mm",
    "RainTomorrow": "rain_tomorrow",
}

# Columns that get their raw name back in the regression table.
REGRESSION_NAMES = {
    "humidity_3pm": "Humidity3pm",
    "pressure_3pm": "Pressure3pm",
    "wind_gust_speed": "WindGustSpeed",
    "sunshine": "Sunshine",
    "temp_9am": "Temp9am",
    "pressure_9am": "Pressure9am",
    "wind_speed_9am": "WindSpeed9am",
    "cloud_3pm": "Cloud3pm",
    "cloud_9am": "Cloud9am",
    "evaporation": "Evaporation",
    "max_temp": "MaxTemp",
    "min_temp": "MinTemp",
}


class MissingColumnError(ValueError):
    """A required column is absent."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise MissingColumnError(f"missing columns: {absent}; present: {df.columns}")
    return df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Bulk rename; names that are not present are left out."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def to_moment(df: DataFrame, column: str, pattern: str | None = None) -> DataFrame:
    """Text to timestamp; text that is no date becomes null."""
    parsed = F.try_to_timestamp(col(column), F.lit(pattern)) if pattern else F.try_to_timestamp(col(column))
    return df.withColumn(column, parsed)


def select_kind(df: DataFrame, kind: str) -> DataFrame:
    """Keep the columns of one kind: ``numeric``, ``string`` or ``datetime``."""
    pick = {"numeric": numeric_columns, "string": string_columns, "datetime": datetime_columns}[kind]
    return df.select(*[col(c) for c in pick(df)])


def feature_frame(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Everything but the targets and the datetime columns."""
    return df.drop(*targets, *datetime_columns(df))


def select_existing(df: DataFrame, wanted: Sequence[str], target: str) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, then the target; also returns the names that were absent."""
    require_columns(df, target)
    present = [c for c in wanted if c in df.columns]
    absent = [c for c in wanted if c not in df.columns]
    return df.select(*[col(c) for c in present], col(target)), absent


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def keep_equal(df: DataFrame, **values: object) -> DataFrame:
    """Equality filter over the given columns; a None value means no restriction."""
    for name, value in values.items():
        if value is not None:
            df = df.filter(col(name) == F.lit(value))
    return df


def round_half_even(column: Column, digits: int) -> Column:
    return F.bround(column, digits)


def round_numbers(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column, halves to even."""
    floats = (T.DoubleType, T.FloatType, T.DecimalType)
    return df.select(
        *[
            round_half_even(col(f.name), digits).alias(f.name) if isinstance(f.dataType, floats) else col(f.name)
            for f in df.schema.fields
        ]
    )
