"""Web-archive records: not-modified revisits resolved to the response that they stand for.

Method: an as-of join by canonical URL. A revisit of the server-not-modified profile (a 304 answer) belongs to
the latest earlier full response of the same URL. The validators of the two are checked, and the header
fields that a 304 may update are merged over those of the response.

Records have: record_id, type (response or revisit), url, at (seconds), etag, last_modified, headers
(map<string,string>), payload_digest. ``parse`` reads them from the bytes of a WARC file.

Validators (RFC 9110): an ETag in the 304 must equal the response's, weak marks aside; without an ETag a
Last-Modified must equal the response's; with neither, nothing contradicts and the revisit is resolved.

Defined cases: a revisit without URL or time, or without an earlier response, is ``no_response``; with
contradicting validators ``changed``; else ``resolved``. Of several responses at one time the greatest id
counts; a response at the revisit's own time does not. Null headers count as none. Equal revisits give a row each.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.asof import LIMIT, latest_before

# Fixed: header fields that a 304 answer updates in the stored response (RFC 9110, section 15.4.5).
UPDATED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, query arguments sorted; a path at least."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(host, F.when(scheme == "https", F.lit(":443$")).otherwise(F.lit(":80$")), F.lit(""))
    path = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    arguments = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda a: a != "")), "&")
    whole = F.concat(
        scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(arguments == "", "").otherwise(F.concat(F.lit("?"), arguments))
    )
    return F.when((scheme != "") & (host != ""), whole)


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored header fields (names in lower case) with those of UPDATED taken from ``update`` if present."""

    def lowered(m: Column) -> Column:
        entries = F.transform(F.map_entries(m), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        return F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))

    allowed = F.filter(lowered(update), lambda e: e["key"].isin(*UPDATED) & e["value"].isNotNull())
    names = F.transform(allowed, lambda e: e["key"])
    kept = F.filter(lowered(stored), lambda e: ~F.array_contains(names, e["key"]))
    # Names that differ in case only: the last value counts.
    every = F.concat(kept, allowed)
    order = F.array_sort(F.array_distinct(F.transform(every, lambda e: e["key"])))
    return F.map_from_entries(
        F.transform(order, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(every, lambda e: e["key"] == k), -1)["value"].alias("value")))
    )


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve(records: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per revisit: record_id, url, at, state, response_id, response_digest and the merged headers."""
    keyed = records.withColumn("_url", canonical_url(F.col("url")))
    responses = keyed.filter("type = 'response'")
    revisits = keyed.filter("type = 'revisit'")
    found = latest_before(revisits, responses.select("_url", "at", "record_id"), "_url", "at", "record_id", "response_id", limit)
    theirs = responses.groupBy(F.col("record_id").alias("response_id")).agg(
        F.max(F.struct(F.col("etag"), F.col("last_modified"), F.col("payload_digest"), F.to_json("headers").alias("headers"))).alias("_r")
    )
    joined = found.join(theirs, "response_id", "left")
    same = (
        F.when(F.col("etag").isNotNull(), _weak(F.col("etag")).eqNullSafe(_weak(F.col("_r.etag"))))
        .when(F.col("last_modified").isNotNull(), F.col("last_modified").eqNullSafe(F.col("_r.last_modified")))
        .otherwise(True)
    )
    state = F.when(F.col("response_id").isNull(), "no_response").when(same, "resolved").otherwise("changed")
    resolved = joined.withColumn("state", state)
    theirs_headers = F.from_json("_r.headers", "map<string,string>")
    return resolved.select(
        "record_id",
        "url",
        "at",
        "state",
        F.when(F.col("state") != "no_response", F.col("response_id")).alias("response_id"),
        F.when(F.col("state") == "resolved", F.col("_r.payload_digest")).alias("response_digest"),
        F.when(F.col("state") == "resolved", merged_headers(theirs_headers, F.col("headers"))).alias("headers"),
    )


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records (header fields in lower case, block) of a WARC file, compressed by record or not.

    For files read whole, as by Spark's binaryFile source; a cut record ends the file.
    """
    stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length") or 0)
        block = stream.read(size)
        if len(block) < size:
            return
        yield fields, block
