"""Queries for projections, imputation and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import clean as C
from tablewright.operators import project as P
from tablewright.plans.registry import query
from tablewright.plans.tables import GAPPY, gappy_events, table

EVENT_NAMES = {"event_id": "EventId", "user_id": "UserId", "event_type": "EventType", "value": "Value", "nothing": "Nothing"}


@query(
    "rename_columns",
    "P1",
    """SELECT event_id AS "EventId", ts, user_id AS "UserId", event_type AS "EventType", value AS "Value", props
       FROM events""",
)
def rename_columns(spark, folder):
    return P.rename(table(spark, folder, "events"), EVENT_NAMES)


@query(
    "parse_dates",
    "P2",
    """SELECT date_part('year', d) AS y, count(*) AS n, count(d) AS parsed
       FROM (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS d FROM orders) GROUP BY 1""",
)
def parse_dates(spark, folder):
    o = table(spark, folder, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = P.to_moment(o.select(text.alias("d")), "d")
    return parsed.groupBy(F.year("d").cast("bigint").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.count("d").alias("parsed")
    )


@query("select_numeric", "P3", "SELECT event_id, user_id, value FROM events")
def select_numeric(spark, folder):
    return P.select_kind(table(spark, folder, "events"), "numeric")


@query("feature_columns", "P4", "SELECT event_id, user_id, event_type, props FROM events")
def feature_columns(spark, folder):
    return P.feature_frame(table(spark, folder, "events"), ["value"])


@query(
    "select_existing",
    "P5 P6",
    "SELECT l_quantity, l_discount, l_extendedprice FROM lineitem",
)
def select_existing(spark, folder):
    li = table(spark, folder, "lineitem")
    return P.select_existing(li, ["l_quantity", "not_there", "l_discount"], "l_extendedprice")[0]


@query(
    "drop_null_rows",
    "P7",
    f"WITH {GAPPY} SELECT event_id, value FROM gappy WHERE value IS NOT NULL AND event_type IS NOT NULL",
)
def drop_null_rows(spark, folder):
    return P.drop_null_rows(gappy_events(spark, folder), ["value", "event_type"]).select("event_id", "value")


@query(
    "filter_equal",
    "P8",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
)
def filter_equal(spark, folder):
    o = table(spark, folder, "orders")
    return P.keep_equal(o, o_orderstatus="F", o_orderpriority="2-HIGH", o_custkey=None).select("o_orderkey", "o_totalprice")


@query(
    "round_half_even",
    "P9",
    "SELECT s_suppkey, round_even(CAST(s_suppkey * 0.125 AS DOUBLE), 2) AS eighth FROM supplier",
)
def round_half_even(spark, folder):
    s = table(spark, folder, "supplier")
    return P.round_numbers(s.select("s_suppkey", (F.col("s_suppkey") * 0.125).alias("eighth")), 2)


@query(
    "null_profile",
    "C1",
    f"""WITH {GAPPY}
    SELECT 'event_type' AS column_name, count(*) - count(event_type) AS null_count,
           round(100.0 * (count(*) - count(event_type)) / count(*), 4) AS null_percent FROM gappy
    UNION ALL SELECT 'value', count(*) - count(value), round(100.0 * (count(*) - count(value)) / count(*), 4) FROM gappy
    UNION ALL SELECT 'level', count(*) - count(level), round(100.0 * (count(*) - count(level)) / count(*), 4) FROM gappy
    UNION ALL SELECT 'user_id', count(*) - count(user_id), round(100.0 * (count(*) - count(user_id)) / count(*), 4) FROM gappy""",
)
def null_profile(spark, folder):
    out = C.null_profile(gappy_events(spark, folder), ["event_type", "value", "level", "user_id"])
    return out.withColumn("null_percent", F.round("null_percent", 4))


@query(
    "impute_mode",
    "C2",
    f"""WITH {GAPPY},
    best AS (SELECT event_type AS m FROM gappy WHERE event_type IS NOT NULL
             GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
    SELECT event_id, coalesce(event_type, (SELECT m FROM best), 'Unknown') AS event_type FROM gappy""",
)
def impute_mode(spark, folder):
    return C.impute_mode(gappy_events(spark, folder), ["event_type"]).select("event_id", "event_type")


@query("impute_zero", "C3 C9", f"WITH {GAPPY} SELECT event_id, coalesce(value, 0) AS value, coalesce(level, 0) AS level FROM gappy")
def impute_zero(spark, folder):
    return C.impute_constant(gappy_events(spark, folder), ["value", "level"]).select("event_id", "value", "level")


@query(
    "impute_median",
    "C4",
    f"""WITH {GAPPY}, m AS (SELECT median(value) AS v, median(level) AS l FROM gappy)
    SELECT event_id, round(coalesce(value, (SELECT v FROM m)), 6) AS value, round(coalesce(level, (SELECT l FROM m)), 6) AS level
    FROM gappy""",
)
def impute_median(spark, folder):
    out = C.impute_median(gappy_events(spark, folder), ["value", "level"])
    return out.select("event_id", F.round("value", 6).alias("value"), F.round("level", 6).alias("level"))


@query(
    "impute_group_median",
    "C5",
    f"""WITH {GAPPY}, g AS (SELECT user_id, median(value) AS m FROM gappy GROUP BY user_id),
    f AS (SELECT event_id, coalesce(gappy.value, g.m) AS value FROM gappy JOIN g USING (user_id))
    SELECT event_id, round(coalesce(value, (SELECT median(value) FROM f)), 6) AS value FROM f""",
)
def impute_group_median(spark, folder):
    out = C.impute_group_median(gappy_events(spark, folder), "user_id", ["value"])
    return out.select("event_id", F.round("value", 6).alias("value"))


INTERPOLATED = f"""{GAPPY},
numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM gappy),
around AS (SELECT event_id, user_id, p, value,
    last_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER w AS p0,
    last_value(value IGNORE NULLS) OVER w AS v0,
    first_value(CASE WHEN value IS NOT NULL THEN p END IGNORE NULLS) OVER x AS p1,
    first_value(value IGNORE NULLS) OVER x AS v1
  FROM numbered
  WINDOW w AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         x AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
interpolated AS (SELECT event_id, user_id,
    CASE WHEN value IS NOT NULL THEN value WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN v0
         ELSE v0 + (v1 - v0) / (p1 - p0) * (p - p0) END AS value
  FROM around)
"""


@query("interpolate_groups", "C6", f"WITH {INTERPOLATED} SELECT event_id, round(value, 6) AS value FROM interpolated")
def interpolate_groups(spark, folder):
    out = C.interpolate(gappy_events(spark, folder), "user_id", "ts", "event_id", ["value"])
    return out.select("event_id", F.round("value", 6).alias("value"))


SPEC = C.CleanSpec(
    mode=("event_type",),
    median=("level",),
    interpolate=("value",),
    group="user_id",
    order="ts",
    tie="event_id",
    required=("event_type",),
)


@query(
    "clean_by_spec",
    "C7 C6 C5 C2 C4",
    f"""WITH {INTERPOLATED},
    g AS (SELECT user_id, median(value) AS m FROM interpolated GROUP BY user_id),
    f AS (SELECT event_id, coalesce(interpolated.value, g.m) AS value FROM interpolated JOIN g USING (user_id)),
    best AS (SELECT event_type AS m FROM gappy WHERE event_type IS NOT NULL
             GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
    SELECT event_id, coalesce(event_type, (SELECT m FROM best)) AS event_type,
           round(coalesce(f.value, (SELECT median(value) FROM f)), 6) AS value,
           round(coalesce(level, (SELECT median(level) FROM gappy)), 6) AS level
    FROM gappy JOIN f USING (event_id)""",
)
def clean_by_spec(spark, folder):
    out = C.clean(gappy_events(spark, folder), SPEC)
    return out.select("event_id", "event_type", F.round("value", 6).alias("value"), F.round("level", 6).alias("level"))


@query(
    "winsorize",
    "C8",
    """WITH q AS (SELECT quantile_cont(l_quantity, [0.01, 0.99]) AS a, quantile_cont(l_extendedprice, [0.01, 0.99]) AS b,
              quantile_cont(l_tax, [0.01, 0.99]) AS c FROM lineitem)
    SELECT l_returnflag, count(*) AS n,
           round(sum(greatest(least(l_quantity, a[2]), a[1])), 2) AS quantity,
           round(sum(greatest(least(l_extendedprice, b[2]), b[1])), 2) AS price,
           round(max(greatest(least(l_extendedprice, b[2]), b[1])), 4) AS top_price,
           round(min(greatest(least(l_extendedprice, b[2]), b[1])), 4) AS low_price,
           round(sum(greatest(least(l_tax, c[2]), c[1])), 2) AS tax
    FROM lineitem, q GROUP BY l_returnflag""",
)
def winsorize(spark, folder):
    li = table(spark, folder, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", "l_tax")
    out = C.winsorize(li, ["l_quantity", "l_extendedprice", "l_tax"])
    return out.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.max("l_extendedprice"), 4).alias("top_price"),
        F.round(F.min("l_extendedprice"), 4).alias("low_price"),
        F.round(F.sum("l_tax"), 2).alias("tax"),
    )


@query(
    "retention_summary",
    "C10",
    f"""WITH {GAPPY}
    SELECT count(*) AS rows_in, count(value) AS rows_out, count(*) - count(value) AS rows_dropped,
           round(100.0 * count(value) / count(*), 4) AS kept_percent FROM gappy""",
)
def retention_summary(spark, folder):
    ev = gappy_events(spark, folder)
    out = C.retention(ev, P.drop_null_rows(ev, ["value"]))
    return out.withColumn("kept_percent", F.round("kept_percent", 4))


@query(
    "fill_mean_unknown",
    "D1",
    f"""WITH {GAPPY} SELECT event_id, coalesce(event_type, 'Unknown') AS event_type,
         round(coalesce(level, (SELECT avg(level) FROM gappy)), 4) AS level FROM gappy""",
)
def fill_mean_unknown(spark, folder):
    ev = gappy_events(spark, folder)
    sparse_gone = C.drop_sparse_columns(ev, 0.3)
    out = C.fill_missing(sparse_gone, ["level"], ["event_type"], "mean", "unknown")
    return out.select("event_id", "event_type", F.round("level", 4).alias("level"))


@query(
    "fill_mode_number",
    "D1",
    f"""WITH {GAPPY}, r AS (SELECT event_id, floor(level / 10) AS band, event_type FROM gappy),
    best AS (SELECT band AS m FROM r WHERE band IS NOT NULL GROUP BY band ORDER BY count(*) DESC, band LIMIT 1)
    SELECT event_id, CAST(coalesce(band, (SELECT m FROM best)) AS BIGINT) AS band FROM r WHERE event_type IS NOT NULL""",
)
def fill_mode_number(spark, folder):
    """Mode for numbers, drop for text."""
    ev = gappy_events(spark, folder).select("event_id", "event_type", F.floor(F.col("level") / 10).alias("band"))
    return C.fill_missing(ev, ["band"], ["event_type"], "mode", "drop").select("event_id", "band")


@query("fill_drop", "D1", f"WITH {GAPPY} SELECT event_id FROM gappy WHERE level IS NOT NULL AND event_type IS NOT NULL")
def fill_drop(spark, folder):
    return C.fill_missing(gappy_events(spark, folder), ["level"], ["event_type"], "drop", "drop").select("event_id")
