"""As-of joins that split hot keys: for every left row the latest earlier row of the right side.

Times of one key are reduced to distinct ones first. The time line is then cut at quantiles of all these
points into chunks of about ``limit`` points, so no window holds more than that of any key, however common;
the latest right row of every chunk is carried over to the chunks behind it.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import stored

LIMIT = 100_000


def latest_before(left: DataFrame, right: DataFrame, by: str, at: str, row: str, out: str, limit: int = LIMIT) -> DataFrame:
    """``left`` with column ``out``: the ``row`` value of the right row with equal ``by`` and the greatest
    ``at`` (whole seconds) strictly before the left one's; of several at that time the greatest ``row``.

    Null keys or times on either side match nothing and give a null.
    """
    known = F.col(by).isNotNull() & F.col(at).isNotNull()
    theirs = right.filter(known).groupBy(by, at).agg(F.max(row).alias("_have"))
    ours = left.filter(known).select(by, at).distinct()
    points = stored(ours.join(theirs, [by, at], "full"))
    parts = math.ceil(points.count() / limit)
    cuts: list[float] = []
    if parts > 1:
        probs = [i / parts for i in range(1, parts)]
        cuts = sorted({float(c) for c in points.select(F.percentile_approx(F.col(at), probs, 10 * parts + 10_000)).first()[0]})
    placed = points.withColumn("_time", F.col(at).cast("double"))
    splits = [-math.inf, *(cuts or [0.0]), math.inf]
    chunked = Bucketizer(splits=splits, inputCol="_time", outputCol="_chunk").transform(placed).drop("_time")
    inside = Window.partitionBy(by, "_chunk").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.withColumn("_local", F.last("_have", ignorenulls=True).over(inside))
    ends = chunked.groupBy(by, "_chunk").agg(F.max(F.when(F.col("_have").isNotNull(), F.struct(at, "_have")))["_have"].alias("_end"))
    before = Window.partitionBy(by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(by, "_chunk", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    found = local.join(carried, [by, "_chunk"]).select(by, at, F.coalesce("_local", "_carried").alias(out))
    return left.drop(out).join(found, [by, at], "left")
