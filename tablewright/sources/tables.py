"""Readers and writers."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.scalar import col

# Texts that mean "no value" in the raw files.
NULL_TOKENS = ("NA", "NaN", "", "null")
VERSION_COLUMN = "version"
EXTRA = "_field_too_many"


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS, header: bool = True
) -> DataFrame:
    """CSV with null tokens; lines with too many fields are skipped, short ones are padded with nulls.

    Columns are read as text first: with a typed schema a line holding ``NA`` in a number column
    would count as malformed. Text that does not parse becomes null. One more column takes the first
    field too many and is read whatever is selected, so the rows are the same for every selection.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in [*schema.fields, T.StructField(EXTRA, T.StringType())]])
    reader = spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
    raw = reader.csv(path).filter(F.col(EXTRA).isNull())
    cleaned = []
    for f in schema.fields:
        value = F.when(~col(f.name).isin(*tokens), col(f.name))
        cleaned.append((value if isinstance(f.dataType, T.StringType) else value.try_cast(f.dataType)).alias(f.name))
    return raw.select(*cleaned)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table or query. Give a numeric partition column to read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**properties)
    is_query = table_or_query.lstrip().lower().startswith("select")
    reader = reader.option("dbtable", f"({table_or_query}) AS q" if is_query else table_or_query)
    if partition_column is not None:
        low, high = bounds or (0, partitions)
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).mode(mode).save()


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A SQL query over the catalog, or over frames given by name."""
    return spark.sql(text, **(views or {}))


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null: str = "NA") -> None:
    df.write.mode(mode).option("header", True).option("nullValue", null).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per row; nulls are kept as fields."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def json_text(value: Any) -> str:
    """A report as JSON text: timestamps in ISO form, decimals and array scalars as numbers."""

    def plain(x: Any) -> Any:
        if isinstance(x, (datetime, date)):
            return x.isoformat()
        if isinstance(x, Decimal):
            return float(x)
        if hasattr(x, "tolist"):
            return x.tolist()
        if hasattr(x, "asDict"):
            return x.asDict(recursive=True)
        return str(x)

    return json.dumps(value, default=plain, ensure_ascii=False)


def save_version(df: DataFrame, path: str, version: str) -> None:
    """Write a version, a partition folder of its own; a version that exists is replaced, others stay."""
    rows = df.withColumn(VERSION_COLUMN, F.lit(version))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION_COLUMN).parquet(path)


def load_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """One version, by default the newest; the filter prunes to that version's folder."""
    every = spark.read.option("basePath", path).schema(_versioned_schema(spark, path)).parquet(path)
    if version is not None:
        return every.filter(F.col(VERSION_COLUMN) == version).drop(VERSION_COLUMN)
    newest = every.agg(F.max(VERSION_COLUMN).alias("v")).scalar()
    return every.filter(F.col(VERSION_COLUMN) == newest).drop(VERSION_COLUMN)


def _versioned_schema(spark: SparkSession, path: str) -> T.StructType:
    """The stored schema with the version kept as text, whatever it looks like."""
    found = spark.read.parquet(path).schema
    fields = [f for f in found.fields if f.name != VERSION_COLUMN]
    return T.StructType([*fields, T.StructField(VERSION_COLUMN, T.StringType())])


def save_model(model: Any, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type, path: str) -> Any:
    return kind.load(path)


def create_if_missing(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def alias(df: DataFrame, name: str) -> DataFrame:
    """Give a frame a second name; nothing is copied."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
