"""The tables the queries read, and the same derivations as SQL text for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def gappy_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with nulls injected by key arithmetic; users whose id ends in 00 or 50 have no value at all."""
    ev = table(spark, folder, "events")
    gap = (F.col("event_id") * 7919 % 11 < 3) | (F.col("user_id") % 50 == 0)
    return ev.select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.col("event_id") * 31 % 13 != 0, F.col("event_type")).alias("event_type"),
        F.when(~gap, F.col("value")).alias("value"),
        F.when(F.col("event_id") * 17 % 7 >= 2, F.col("value") * 2).alias("level"),
    )


GAPPY = """
gappy AS (
  SELECT event_id, ts, user_id,
         CASE WHEN (event_id * 31) % 13 <> 0 THEN event_type END AS event_type,
         CASE WHEN (event_id * 7919) % 11 < 3 OR user_id % 50 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN (event_id * 17) % 7 >= 2 THEN value * 2 END AS level
  FROM events)
"""

# 32-bit md5 slot of a key, as in functions.scalar.md5_bits.
def md5_sql(key: str) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem numbers with two 0/1 targets and a linear response with known coefficients."""
    li = table(spark, folder, "lineitem")
    return li.select(
        "l_orderkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_linestatus") == "F").cast("int").alias("finished"),
    )


TRADES = """
trades AS (
  SELECT l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
         CAST(l_returnflag = 'R' AS INT) AS returned, CAST(l_linestatus = 'F' AS INT) AS finished
  FROM lineitem)
"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """A prediction table: truth, score with heavy ties, thresholded label, and a numeric pair."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        (F.col("l_discount") >= 0.05).cast("int").alias("y_pred"),
        F.col("l_discount").alias("score"),
        F.col("l_returnflag").alias("class_true"),
        F.when(F.col("l_quantity") < 20, "A").when(F.col("l_tax") < 0.04, "N").otherwise("Z").alias("class_pred"),
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 1500.0).alias("predicted"),
        F.col("l_linestatus").alias("part"),
    )


SCORED = """
scored AS (
  SELECT CAST(l_returnflag = 'R' AS INT) AS y_true, CAST(l_discount >= 0.05 AS INT) AS y_pred, l_discount AS score,
         l_returnflag AS class_true,
         CASE WHEN l_quantity < 20 THEN 'A' WHEN l_tax < 0.04 THEN 'N' ELSE 'Z' END AS class_pred,
         l_extendedprice AS actual, l_quantity * 1500.0 AS predicted, l_linestatus AS part
  FROM lineitem)
"""
