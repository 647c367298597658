"""Queries that write whole tables in each format and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import linear as L
from tablewright.operators.compare import collect_metrics
from tablewright.operators.project import WEATHER_COLUMNS, rename
from tablewright.plans.registry import query
from tablewright.plans.tables import GAPPY, gappy_events, table, trades
from tablewright.session import shared_folder
from tablewright.sources import tables as S


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared folder."""
    return f"{shared_folder(spark)}/tablewright-{uuid.uuid4().hex}"


@query("csv_round_trip", "S1 S8", f"WITH {GAPPY} SELECT event_id, user_id, event_type, value, level FROM gappy")
def csv_round_trip(spark, folder):
    ev = gappy_events(spark, folder).drop("ts")
    path = scratch(spark) + "/csv"
    S.write_csv(ev, path)
    return S.read_csv(spark, path, ev.schema)


@query("sql_over_frames", "S2 S3 S12", "SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY event_type")
def sql_over_frames(spark, folder):
    ev = S.alias(table(spark, folder, "events"), "tablewright_events")
    out = S.run_sql(spark, "SELECT event_type, count(*) AS n, avg(value) AS mean FROM {ev} GROUP BY event_type", {"ev": ev})
    return out.withColumn("mean", F.round("mean", 4))


@query(
    "parquet_append",
    "S4 S5 S6",
    "SELECT o_orderstatus, count(*) * 2 AS n, round(sum(o_totalprice) * 2, 2) AS total FROM orders GROUP BY o_orderstatus",
)
def parquet_append(spark, folder):
    o = table(spark, folder, "orders").select("o_orderstatus", "o_totalprice")
    path = scratch(spark) + "/orders"
    S.write_parquet(o, path)
    S.write_parquet(o, path, mode="append")
    return S.read_parquet(spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("json_round_trip", "S7", f"WITH {GAPPY} SELECT event_id, event_type, value FROM gappy")
def json_round_trip(spark, folder):
    ev = gappy_events(spark, folder).select("event_id", "event_type", "value")
    path = scratch(spark) + "/json"
    S.write_json(ev, path)
    return spark.read.schema(ev.schema).json(path)


@query("versioned_dataset", "S9", "SELECT s_suppkey, s_acctbal * 2 AS s_acctbal FROM supplier")
def versioned_dataset(spark, folder):
    s = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    path = scratch(spark) + "/supplier"
    S.save_version(s, path, "20250101_000000")
    S.save_version(s.withColumn("s_acctbal", F.col("s_acctbal") * 2), path, "20250201_000000")
    return S.load_version(spark, path)


@query("create_then_fill", "S11 S4", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def create_then_fill(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    path = scratch(spark) + "/customer"
    name = f"tablewright_{uuid.uuid4().hex}"
    S.create_if_missing(spark, name, c.schema, path)
    S.create_if_missing(spark, name, c.schema, path)
    c.write.mode("append").insertInto(name)
    return S.read_table(spark, name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("model_store", "S10", "SELECT l_returnflag, count(*) AS n, CAST(0 AS DOUBLE) AS largest_difference FROM lineitem GROUP BY l_returnflag")
def model_store(spark, folder):
    from pyspark.ml.regression import LinearRegressionModel

    df = trades(spark, folder)
    names = ["l_quantity", "l_tax"]
    model = L.fit_ols(df, names, "l_extendedprice")
    path = scratch(spark) + "/model"
    S.save_model(model, path)
    again = S.load_model(LinearRegressionModel, path)
    both = L.predict(again, L.predict(model, df, names, "p"), names, "q")
    return both.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max(F.abs(F.col("p") - F.col("q"))), 6).alias("largest_difference")
    )


@query(
    "metric_documents",
    "K1 S7",
    """SELECT 'model_' || l_linenumber AS model, round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) AS mae,
      round(avg((l_extendedprice - l_quantity * 1500) ** 2), 1) AS mse, CAST(NULL AS DOUBLE) AS r2 FROM lineitem GROUP BY l_linenumber""",
)
def metric_documents(spark, folder):
    """Metrics of every model written as JSON documents, then collected from the files."""
    error = F.col("l_extendedprice") - F.col("l_quantity") * 1500
    scores = table(spark, folder, "lineitem").groupBy("l_linenumber").agg(F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"))
    home = scratch(spark)
    paths = {}
    # One document per model, written on the driver as the reports are: the table has one row per model.
    for row in scores.collect():
        name = f"model_{row['l_linenumber']}"
        paths[name] = f"{home}/{name}.json"
        text = S.json_text({"mae": row["mae"], "mse": row["mse"], "model": name})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(paths[name])
    out = collect_metrics(spark, paths)
    return out.select("model", F.round("mae", 4).alias("mae"), F.round("mse", 1).alias("mse"), "r2")


@query(
    "raw_weather_layout",
    "S1 P1 P2",
    f"""WITH {GAPPY} SELECT 'u' || user_id AS location, count(*) AS n, round(sum(value), 4) AS min_temp,
      count(event_type) AS rain_tomorrow, min(ts) AS first_date FROM gappy GROUP BY 1""",
)
def raw_weather_layout(spark, folder):
    """Events written in the raw weather layout, read with its null tokens and renamed."""
    raw = gappy_events(spark, folder).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date"),
        F.concat(F.lit("u"), F.col("user_id")).alias("Location"),
        F.col("value").alias("MinTemp"),
        F.col("event_type").alias("RainTomorrow"),
    )
    path = scratch(spark) + "/weather"
    S.write_csv(raw, path)
    schema = T.StructType.fromDDL("Date timestamp_ntz, Location string, MinTemp double, RainTomorrow string")
    out = rename(S.read_csv(spark, path, schema), WEATHER_COLUMNS)
    return out.groupBy("location").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("min_temp"), 4).alias("min_temp"),
        F.count("rain_tomorrow").alias("rain_tomorrow"),
        F.min("date").alias("first_date"),
    )
