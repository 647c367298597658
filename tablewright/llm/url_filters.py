"""URL filters with dated lists: every capture against the entries that were active when it was fetched.

Method: a temporal list join. List events (add, remove) of one entry become validity intervals, and an as-of
join meets every capture with the intervals that hold its fetch time. Intervals are cut at the borders of
fixed time buckets, so the join is an equality on (kind, pattern, bucket) that leaves a few intervals to
compare, and a host with a third of all captures is split like any skewed join.

Entries match a capture by ``host`` (the whole host), ``domain`` (the host or any parent domain) or ``url``
(the URL without its fragment). An interval holds its first instant and not its last.

Defined cases: a null URL or one without a host meets no entry and is allowed; a null fetch time meets none;
events with a null in any field are ignored; repeated events and repeated adds change nothing; of an add and
a remove at one instant the remove counts; repeated captures give a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
BUCKET_DAYS = 30
KEY = ["list", "kind", "pattern"]


def intervals(events: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to) from events (list, kind, pattern, action, at); times are
    seconds, and an open interval has a null ``valid_to``."""
    known = events.filter(" and ".join(f"{c} is not null" for c in [*KEY, "action", "at"]))
    state = known.groupBy(*KEY, "at").agg(F.max(F.when(F.col("action") == "remove", 1).otherwise(0)).alias("removed"))
    by = Window.partitionBy(*KEY).orderBy("at")
    changes = state.withColumn("before", F.lag("removed", 1, 1).over(by)).filter("removed <> before")
    spans = changes.withColumn("valid_to", F.lead("at").over(by)).filter("removed = 0")
    return spans.select(*KEY, F.col("at").alias("valid_from"), "valid_to")


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return F.when(found != "", found)


def keys(url: Column) -> Column:
    """The (kind, pattern) pairs that an entry may have to match this URL."""
    labels = F.split(host(url), r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    )
    whole = F.array(
        F.struct(F.lit("host").alias("kind"), host(url).alias("pattern")),
        F.struct(F.lit("url").alias("kind"), F.regexp_replace(url, "#.*$", "").alias("pattern")),
    )
    return F.when(host(url).isNotNull(), F.concat(whole, parents))


def active(captures: DataFrame, spans: DataFrame, url: str, at: str, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Captures (all their columns) with the entries active at second ``at``: one row per capture and entry."""
    width = bucket_days * DAY
    # Open intervals end with the last capture, so that the number of buckets is bounded by the data.
    last = captures.agg(F.max(at).alias("last")).scalar()
    bounded = spans.withColumn("last", last).filter("last is not null and valid_from <= last")
    ends = F.least(F.coalesce(F.col("valid_to"), F.col("last") + 1), F.col("last") + 1)
    buckets = F.explode(F.sequence(F.floor(F.col("valid_from") / width), F.floor((ends - 1) / width)))
    right = bounded.select(*KEY, "valid_from", "valid_to", buckets.alias("_bucket"))
    left = captures.withColumn("_key", F.explode(keys(F.col(url)))).withColumn("_bucket", F.floor(F.col(at) / width))
    left = left.select(*captures.columns, F.col("_key.kind").alias("_kind"), F.col("_key.pattern").alias("_pattern"), "_bucket")
    right = right.withColumnsRenamed({"kind": "_kind", "pattern": "_pattern", "list": "_list"})
    met = left.join(right, ["_kind", "_pattern", "_bucket"])
    met = met.filter((F.col("valid_from") <= F.col(at)) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))))
    return met.select(*captures.columns, "_list", "_kind", "_pattern", "valid_from")


def judged(captures: DataFrame, events: DataFrame, key: str, url: str, at: str) -> DataFrame:
    """(key, url, at, blocked, lists, n_entries): lists are the names of the lists that block, sorted and
    joined by commas."""
    slim = captures.select(key, url, at)
    met = active(slim.select(url, at).filter(F.col(url).isNotNull() & F.col(at).isNotNull()).distinct(), intervals(events), url, at)
    found = met.groupBy(url, at).agg(F.array_sort(F.collect_set("_list")).alias("_lists"), F.count(F.lit(1)).alias("n_entries"))
    joined = slim.join(found, [url, at], "left")
    return joined.select(
        key,
        url,
        at,
        F.col("_lists").isNotNull().alias("blocked"),
        F.coalesce(F.array_join("_lists", ","), F.lit("")).alias("lists"),
        F.coalesce("n_entries", F.lit(0)).cast("bigint").alias("n_entries"),
    )
