"""One query per operator over its whole table, beside the SQL that checks it where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.scalar import md5_bits
from tablewright.llm import bpe, chat, decontaminate, jaccard, licenses, quality, token_counts, token_files, url_filters, warc
from tablewright.llm.common import new_folder, stored, table
from tablewright.llm.registry import ORACLES, QUERIES, query
from tablewright.llm.shared_queries import op11_prefix_trie, op12_source_mix, op13_spelling_variants

__all__ = ["ORACLES", "QUERIES", "op11_prefix_trie", "op12_source_mix", "op13_spelling_variants"]

@query("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), path)
    decoded = bpe.decode(encoded.select("doc_id", "ids"), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    counted = token_counts.count_tokens(docs, path)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    measured = stored(quality.features(docs, keep_text=False))
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept quality_posterior"
    return quality.judged(measured, quality.fit(measured)).select(*columns.split())


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = new_folder(spark)
    token_files.write_files(table(spark, folder, "documents"), files, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_digests(spark, files)


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op3_jaccard_join",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common WHERE 100 * k >= 75 * (n + m - k)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce((SELECT min(v) FROM reach WHERE u = s.doc_id), s.doc_id)) AS component_id
FROM sets s
""",
)
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents"))


@query("op5_license_scans")
def op5_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


START = 1_704_067_200  # 2024-01-01, in seconds


def fetched() -> Column:
    """Pages carry no fetch time; theirs is spread over two years by the page's number."""
    return F.lit(START) + (F.col("page_id") * 7919 % 730) * url_filters.DAY


def list_events(pages: DataFrame) -> DataFrame:
    """Dated entries made from the pages: hosts listed once or twice, whole domains, and single URLs."""
    day = url_filters.DAY
    hosts = pages.select(url_filters.host(F.col("url")).alias("pattern")).filter("pattern is not null").distinct()
    code = md5_bits(F.col("pattern"))
    added = F.lit(START) + (F.floor(code / 5) % 300) * day
    host = hosts.filter(code % 5 == 0).select(
        F.lit("malware").alias("list"),
        F.lit("host").alias("kind"),
        "pattern",
        F.explode(
            F.array(
                F.struct(F.lit("add").alias("action"), added.alias("at")),
                F.struct(F.when(code % 2 == 0, "remove").alias("action"), (added + 120 * day).alias("at")),
                F.struct(F.when(code % 3 == 0, "add").alias("action"), (added + 240 * day).alias("at")),
            )
        ).alias("e"),
    )
    domains = hosts.select(F.regexp_extract("pattern", r"[^.]+(\.[^.]+)?$", 0).alias("pattern")).distinct()
    late = F.lit(START) + (100 + md5_bits(F.col("pattern")) % 200) * day
    domain = domains.select(
        F.lit("adult").alias("list"),
        F.lit("domain").alias("kind"),
        "pattern",
        F.explode(
            F.array(
                F.struct(F.lit("add").alias("action"), late.alias("at")),
                F.struct(F.lit("remove").alias("action"), (late + 90 * day).alias("at")),
            )
        ).alias("e"),
    )
    single = pages.filter("page_id % 17 = 0").select(
        F.lit("spam").alias("list"),
        F.lit("url").alias("kind"),
        F.regexp_replace("url", "#.*$", "").alias("pattern"),
        F.struct(F.lit("add").alias("action"), (fetched() - 10 * day).alias("at")).alias("e"),
    )
    return host.unionAll(domain).unionAll(single).select("list", "kind", "pattern", "e.action", "e.at")


OP6_SQL = r"""
WITH captures AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919 % 730) * 86400 AS fetched_at,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '') AS host,
         regexp_replace(url, '#.*$', '') AS bare FROM pages),
hosts AS (
  SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 8))::BIGINT AS code FROM captures WHERE host IS NOT NULL),
domains AS (
  SELECT DISTINCT regexp_extract(host, '[^.]+(\.[^.]+)?$', 0) AS d FROM hosts),
late AS (SELECT d, 1704067200 + (100 + ('0x' || substr(md5(d), 1, 8))::BIGINT % 200) * 86400 AS moment FROM domains),
added AS (SELECT host, code, 1704067200 + ((code // 5) % 300) * 86400 AS moment FROM hosts WHERE code % 5 = 0),
events AS (
  SELECT 'malware' AS list, 'host' AS kind, host AS pattern, 'add' AS action, moment FROM added
  UNION ALL SELECT 'malware', 'host', host, 'remove', moment + 120 * 86400 FROM added WHERE code % 2 = 0
  UNION ALL SELECT 'malware', 'host', host, 'add', moment + 240 * 86400 FROM added WHERE code % 3 = 0
  UNION ALL SELECT 'adult', 'domain', d, 'add', moment FROM late
  UNION ALL SELECT 'adult', 'domain', d, 'remove', moment + 90 * 86400 FROM late
  UNION ALL SELECT 'spam', 'url', bare, 'add', fetched_at - 10 * 86400 FROM captures WHERE page_id % 17 = 0),
entries AS (SELECT DISTINCT list, kind, pattern FROM events),
state AS (
  SELECT list, kind, pattern, moment, CASE WHEN bool_or(action = 'remove') THEN 'remove' ELSE 'add' END AS action
  FROM events GROUP BY ALL),
met AS (
  SELECT c.page_id, e.list, e.kind, e.pattern, arg_max(s.action, s.moment) AS action
  FROM captures c JOIN entries e ON c.host IS NOT NULL AND (
      (e.kind = 'host' AND e.pattern = c.host) OR (e.kind = 'url' AND e.pattern = c.bare)
      OR (e.kind = 'domain' AND (c.host = e.pattern OR ends_with(c.host, '.' || e.pattern))))
  JOIN state s ON s.list = e.list AND s.kind = e.kind AND s.pattern = e.pattern AND s.moment <= c.fetched_at
  GROUP BY ALL),
found AS (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n FROM met WHERE action = 'add' GROUP BY 1)
SELECT c.page_id, c.url, c.fetched_at, f.n IS NOT NULL AS blocked, coalesce(f.lists, '') AS lists,
       CAST(coalesce(f.n, 0) AS BIGINT) AS n_entries
FROM captures c LEFT JOIN found f USING (page_id)
"""


@query("op6_url_filters", OP6_SQL)
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url").withColumn("fetched_at", fetched())
    return url_filters.judged(pages, list_events(pages), "page_id", "url", "fetched_at")


def archive_records(pages: DataFrame) -> DataFrame:
    """Every page as a full response, and as a 304 revisit: most of them later with the
    same ETag or date, some before any response, some with another ETag, some without validators."""
    n = F.col("page_id")
    at = F.lit(START) + n * 37 % 1000 * 3600
    etag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 8), F.lit('"'))
    modified = F.concat(F.lit("day "), (n % 365).cast("string"))
    digest = F.md5("html")
    text = F.lit(None).cast("string")
    responses = pages.select(
        (n * 2).alias("record_id"),
        F.lit("response").alias("type"),
        "url",
        at.alias("at"),
        etag.alias("etag"),
        modified.alias("last_modified"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), etag, F.lit("Date"), at.cast("string"), F.lit("X-Served"), n.cast("string")
        ).alias("headers"),
        digest.alias("payload_digest"),
    )
    later = at + F.when(n % 10 == 0, -7200).otherwise(F.lit(1800) + n % 7 * 86400)
    revisits = pages.select(
        (n * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("type"),
        "url",
        later.alias("at"),
        F.when(n % 12 == 0, '"other"').when(n % 3 == 1, F.concat(F.lit("W/"), etag)).alias("etag"),
        F.when(n % 3 == 2, modified).alias("last_modified"),
        F.create_map(
            F.lit("date"), later.cast("string"), F.lit("Expires"), F.lit("0"), F.lit("Content-Length"), F.lit("0")
        ).alias("headers"),
        text.alias("payload_digest"),
    )
    return responses.unionAll(revisits)


OP7_SQL = r"""
WITH p AS (
  SELECT page_id AS n, url, md5(html) AS digest, '"' || substr(md5(html), 1, 8) || '"' AS etag,
         1704067200 + page_id * 37 % 1000 * 3600 AS moment, 'day ' || (page_id % 365) AS modified,
         regexp_replace(trim(url), '#.*$', '') AS bare FROM pages),
q AS (
  SELECT *, lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
         lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) AS host,
         regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1) AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda a: a <> '')), '&') AS args
  FROM p),
c AS (
  SELECT *, scheme || '://' || regexp_replace(host, CASE WHEN scheme = 'https' THEN ':443$' ELSE ':80$' END, '')
         || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN coalesce(args, '') = '' THEN '' ELSE '?' || args END AS key
  FROM q),
v AS (
  SELECT n, key, url, moment + CASE WHEN n % 10 = 0 THEN -7200 ELSE 1800 + n % 7 * 86400 END AS moment,
         CASE WHEN n % 12 = 0 THEN '"other"' WHEN n % 3 = 1 THEN 'W/' || etag END AS etag,
         CASE WHEN n % 3 = 2 THEN modified END AS modified
  FROM c),
best AS (
  SELECT v.n, max((c.moment, c.n)) AS b FROM v JOIN c ON c.key = v.key AND c.moment < v.moment GROUP BY 1),
j AS (
  SELECT v.n, v.url, v.moment, v.etag AS ve, v.modified AS vm, r.n AS rn, r.etag AS re, r.modified AS rm, r.digest, r.moment AS rt
  FROM v LEFT JOIN best ON best.n = v.n LEFT JOIN c r ON r.n = best.b[2]),
s AS (
  SELECT *, CASE WHEN rn IS NULL THEN 'no_response'
    WHEN CASE WHEN ve IS NOT NULL THEN regexp_replace(ve, '^W/', '') = re WHEN vm IS NOT NULL THEN vm = rm ELSE true END
    THEN 'resolved' ELSE 'changed' END AS state FROM j)
SELECT n * 2 + 1 AS record_id, url, moment AS "at", state, rn * 2 AS response_id,
       CASE WHEN state = 'resolved' THEN digest END AS response_digest,
       CASE WHEN state = 'resolved' THEN 'content-type=text/html;date=' || moment || ';etag=' || re || ';expires=0;x-served=' || rn END AS headers
FROM s
"""


@query("op7_warc_revisits", OP7_SQL)
def op7_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    resolved = warc.resolve(stored(archive_records(table(spark, folder, "pages"))))
    fields = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return resolved.withColumn("headers", F.array_join(fields, ";"))


def tool_logs(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and schemas made from the conversations: every assistant turn calls a tool with its
    whole text as an argument and waits for an earlier call; the user turns after it answer, some of them
    to a call that nobody made."""
    turn, conv = F.col("turn"), F.col("conv_id")
    mix = conv * 31 + turn * 7
    words = F.filter(F.split("text", "[ \\n]"), lambda w: w != "")
    made = F.map_from_entries(
        F.filter(
            F.array(
                F.struct(F.lit("query").alias("key"), F.col("text").alias("value")),
                F.struct(F.when(mix % 5 != 0, "limit").alias("key"), F.when(mix % 11 == 0, "many").otherwise((mix % 50).cast("string")).alias("value")),
                F.struct(F.when(mix % 4 == 0, "exact").alias("key"), F.when(mix % 8 == 0, "true").otherwise("false").alias("value")),
                F.struct(F.when(mix % 13 == 0, "extra").alias("key"), F.size(words).cast("string").alias("value")),
            ),
            lambda e: e["key"].isNotNull(),
        )
    )
    calls = turns.filter("role = 'assistant'").select(
        "conv_id",
        "turn",
        F.concat(F.lit("c"), turn.cast("string")).alias("call_id"),
        F.when(mix % 17 == 0, "unlisted").when(mix % 2 == 0, "search").otherwise("lookup").alias("tool"),
        made.alias("arguments"),
        F.when(mix % 3 != 0, F.concat(F.lit("c"), (turn - 2).cast("string"))).alias("after"),
    )
    known = F.when((conv + turn) % 7 == 0, "unknown").otherwise("c")
    results = turns.filter("role = 'user'").select(
        "conv_id", (turn + 0).alias("turn"), F.concat(known, (turn - 1).cast("string")).alias("call_id"), F.col("text").alias("content")
    )
    spark = turns.sparkSession
    schemas = spark.createDataFrame(
        [
            ("search", "query", "string", True),
            ("search", "limit", "integer", True),
            ("search", "exact", "boolean", False),
            ("lookup", "query", "string", True),
            ("lookup", "limit", "integer", False),
            ("lookup", "exact", "boolean", False),
        ],
        "tool string, field string, kind string, required boolean",
    )
    return calls, results, schemas


def _json_sql(text: str) -> str:
    out = f"replace(replace({text}, '\\', '\\\\'), '\"', '\\\"')"
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    for code in range(1, 32):
        out = f"replace({out}, chr({code}), '{short.get(code, f'\\u{code:04x}')}')"
    return f"'\"' || {out} || '\"'"


OP10_SQL = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, role, text, conv_id * 31 + turn * 7 AS mix, 'c' || turn AS call_id,
         len(list_filter(regexp_split_to_array(text, '[ \n]'), lambda w: w <> '')) AS n_words
  FROM conversations),
every_call AS (
  SELECT *, CASE WHEN mix % 17 = 0 THEN 'unlisted' WHEN mix % 2 = 0 THEN 'search' ELSE 'lookup' END AS tool,
         CASE WHEN mix % 3 <> 0 THEN 'c' || (turn - 2) END AS after,
         row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn) AS nth
  FROM base WHERE role = 'assistant'),
calls AS (SELECT * FROM every_call WHERE nth = 1),
parts AS (
  SELECT *, text AS q, CASE WHEN mix % 11 = 0 THEN 'many' ELSE CAST(mix % 50 AS VARCHAR) END AS lim,
         CASE WHEN mix % 8 = 0 THEN 'true' ELSE 'false' END AS ex FROM calls),
judged AS (
  SELECT *, '{{' || array_to_string(list_filter([
      CASE WHEN mix % 4 = 0 THEN '"exact":' || CASE WHEN tool = 'unlisted' THEN '"' || ex || '"' ELSE ex END END,
      CASE WHEN mix % 13 = 0 THEN '"extra":"' || n_words || '"' END,
      CASE WHEN mix % 5 <> 0 THEN '"limit":' || CASE WHEN tool = 'unlisted' OR mix % 11 = 0 THEN '"' || lim || '"' ELSE lim END END,
      '"query":' || {_json_sql("q")}], lambda x: x IS NOT NULL), ',') || '}}' AS arguments,
    CASE WHEN tool = 'unlisted' THEN 'unknown tool' ELSE array_to_string(list_filter([
      CASE WHEN tool = 'search' AND mix % 5 = 0 THEN 'missing limit' END,
      CASE WHEN mix % 5 <> 0 AND mix % 11 = 0 THEN 'type limit' END,
      CASE WHEN mix % 13 = 0 THEN 'unknown extra' END], lambda x: x IS NOT NULL), ';') END AS problems
  FROM parts),
chain(conv_id, call_id, depth) AS (
  SELECT c.conv_id, c.call_id, 0 FROM calls c LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.call_id = c.after WHERE p.call_id IS NULL
  UNION ALL SELECT c.conv_id, c.call_id, k.depth + 1 FROM chain k JOIN calls c ON c.conv_id = k.conv_id AND c.after = k.call_id),
results AS (
  SELECT conv_id, CASE WHEN (conv_id + turn) % 7 = 0 THEN 'unknown' ELSE 'c' END || (turn - 1) AS call_id, count(*) AS n, min((turn, text)) AS r
  FROM base WHERE role = 'user' GROUP BY ALL)
SELECT j.conv_id, j.call_id, j.turn, CAST(k.depth AS BIGINT) AS depth,
       CASE WHEN r.n IS NULL THEN 'open' WHEN r.r[1] < j.turn THEN 'early' ELSE 'answered' END AS status,
       CAST(coalesce(r.n, 0) AS BIGINT) AS n_results, j.problems = '' AS valid, j.problems,
       '{{"arguments":' || arguments || ',"id":"' || j.call_id || '","name":"' || j.tool || '","result":'
         || coalesce({_json_sql("r.r[2]")}, 'null') || '}}' AS json
FROM judged j LEFT JOIN chain k USING (conv_id, call_id) LEFT JOIN results r USING (conv_id, call_id)
"""


@query("op10_chat_formatting", OP10_SQL)
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.linked(*tool_logs(table(spark, folder, "conversations")))


query("op10_whole_turns", OP10_SQL)(op10_chat_formatting)  # the name that earlier versions gave to whole turns
