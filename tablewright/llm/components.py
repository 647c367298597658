"""Connected components of a link table, by alternating large-star and small-star steps.

Links never meet on one machine: each step is one aggregation (combined before its shuffle) and one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v): the smallest node that it reaches."""
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    before = _state(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
