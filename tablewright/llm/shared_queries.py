"""Queries of op11, op12 and op13 over their whole tables, beside the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.ordered import positions
from tablewright.llm import mixing, prefix_trie, spelling
from tablewright.llm.common import stored, table
from tablewright.llm.registry import query


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: every one starts with up to three turns of the first of its twenty.

    (conv_id, pos, role, text) and (seq) of all conversations. Turns go by number, null first, then role and text.
    """
    c = F.col("conv_id")
    filled = turns.filter(c.isNotNull()).select("conv_id", "turn", *[F.coalesce(x, F.lit("")).alias(x) for x in ("role", "text")])
    ordered = filled.withColumns({"_at": F.struct("turn"), "_tie": F.struct("role", "text")})
    placed = stored(positions(ordered, "_at", "_tie", ["conv_id"], name="pos").select("conv_id", "pos", "role", "text"))
    sizes = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = sizes.select("conv_id", (c - c % 20).alias("base"), F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)).alias("h"))
    bases = sizes.select(c.alias("base"), F.col("n").alias("there"))
    plan = stored(heads.join(bases, "base", "left").withColumn("lead", F.least("h", F.coalesce("there", F.lit(0)))).drop("there"))
    first = placed.filter((c % 20 == 0) & (F.col("pos") <= 3)).withColumnRenamed("conv_id", "base")
    lead = first.join(plan, "base").filter("pos <= h").select("conv_id", "pos", "role", "text")
    rest = placed.join(plan, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "role", "text")
    return lead.unionByName(rest), plan.select(c.alias("seq"))


OP11_SQL = rf"""
WITH base AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
             lambda x, c: list_reduce(list_prepend(xor(x, c), range(8)), lambda y, i: xor(y // 2, 3988292384 * (y % 2))))) % 4 AS h
  FROM base GROUP BY conv_id),
plan AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS lead FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT p.conv_id, b.pos, b.role, b.text FROM plan p JOIN base b ON b.conv_id = p.base AND b.pos <= p.h
  UNION ALL SELECT p.conv_id, b.pos - p.h + p.lead, b.role, b.text FROM plan p JOIN base b ON b.conv_id = p.conv_id AND b.pos > p.h),
seqs AS (
  SELECT c.conv_id, list((r.role, r.text) ORDER BY r.pos) FILTER (r.pos IS NOT NULL) AS s
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id),
paths AS (SELECT conv_id, s, coalesce(len(s), 0) AS n, unnest(range(coalesce(len(s), 0) + 1)) AS d FROM seqs),
prefixes AS (SELECT conv_id, n, d, coalesce(s[1:d], []) AS p FROM paths),
nodes AS (
  SELECT d, p, min(conv_id) AS name, count(*) AS n_convs, sha256(coalesce(string_agg(CASE WHEN n = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d][2], '[^\x20\x09-\x0D]+')) END AS words
  FROM prefixes GROUP BY d, p),
linked AS (SELECT x.conv_id, x.d, x.n, y.name, y.n_convs, y.words FROM prefixes x JOIN nodes y ON x.d = y.d AND x.p = y.p),
kids AS (
  SELECT a.d, a.name, count(DISTINCT b.name) AS k FROM linked a JOIN linked b ON a.conv_id = b.conv_id AND b.d = a.d + 1 GROUP BY ALL),
parents AS (SELECT DISTINCT b.d, b.name, a.name AS parent FROM linked a JOIN linked b ON a.conv_id = b.conv_id AND b.d = a.d + 1),
pairs AS (
  SELECT DISTINCT a.d, a.name, b.d AS bd, b.name AS bname, b.n_convs, b.words FROM linked a JOIN linked b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
  SELECT p.d, p.name, count(*) FILTER (k.k IS NULL) AS leaves, sum((p.n_convs - 1) * p.words) AS saved
  FROM pairs p LEFT JOIN kids k ON k.d = p.bd AND k.name = p.bname GROUP BY ALL)
SELECT n.name AS conv_id, n.d AS depth, p.parent AS parent_conv_id, n.n_convs, CAST(coalesce(k.k, 0) AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.name = n.name
LEFT JOIN parents p ON p.d = n.d AND p.name = n.name LEFT JOIN kids k ON k.d = n.d AND k.name = n.name
"""


@query("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, keys = rebuilt(table(spark, folder, "conversations"))
    words = F.regexp_count("text", F.lit(mixing.WORD))
    return prefix_trie.trie(prefix_trie.symbols(turns, "conv_id", "pos", ["role", "text"], words), keys)


PRIME = mixing.PRIME


def _scrambled(value: str, key: str) -> str:
    a = f"(({value}) % {PRIME} + ({value}) // {PRIME} + ({key})) % {PRIME}"
    b = f"(({a}) * 48271 + 11) % {PRIME}"
    return f"((({b}) * ({b}) + ({key})) % {PRIME} * 69621) % {PRIME}"


def _keys(n: str, stream: str) -> str:
    one, two = (_scrambled(f"({stream}) * 64 + r", str(mixing.SEED + i)) for i in (0, 1))
    return f"list_transform(range({mixing.ROUNDS}), lambda r: (({one}) * {PRIME} + ({two})) % ({n}))"


def _permuted(index: str, n: str, keys: str) -> str:
    other = f"(k - x + {n}) % {n}"
    coin = f"(({_scrambled(f'greatest(x, {other})', f'k % {PRIME}')}) // 65536) % 2"
    return f"list_reduce(list_prepend({index}, {keys}), lambda x, k: CASE WHEN {coin} = 1 THEN {other} ELSE x END)"


OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
numbered AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS idx FROM sums),
weighed AS (SELECT *, idx % 3 + 1 AS weight, 3 * source_size AS cap FROM numbered),
before AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
         sum(weight) OVER (ORDER BY cap / weight DESC, idx DESC) AS weights, sum(source_size) OVER () AS total FROM weighed),
level AS (SELECT max(CAST(total - taken AS DOUBLE) / weights) AS level FROM before),
src AS (SELECT w.*, CASE WHEN cap <= weight * level THEN CAST(cap AS DOUBLE) ELSE weight * level END AS target FROM weighed w, level),
epochs AS (
  SELECT *, (source_size + 63) // 64 AS n, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole FROM src),
quota AS (
  SELECT *, CASE WHEN whole < 3 THEN least(n, CAST(floor((target - source_size * whole) / 64 + 0.5) AS BIGINT)) ELSE 0 END AS part FROM epochs),
slots AS (
  SELECT idx, e AS epoch, n, unnest(range(CASE WHEN e < whole THEN n WHEN e = whole THEN part ELSE 0 END)) AS i, idx * 4 + e + 1 AS stream
  FROM quota, range(4) AS r(e) WHERE n > 0),
ks AS (SELECT idx, epoch, any_value({_keys('n', 'stream')}) AS ks FROM (SELECT DISTINCT idx, epoch, n, stream FROM slots) GROUP BY ALL),
taken AS (
  SELECT idx, {_permuted('i', 'n', 'ks')} AS block, count(*) AS times FROM slots JOIN ks USING (idx, epoch) GROUP BY ALL),
rows_ AS (
  SELECT idx, doc_id, size, ({_scrambled(f'(coalesce(doc_id, 0) % {PRIME} + {PRIME}) % {PRIME}', f'size % {PRIME}')}) % ((n_rows + 4095) // 4096) AS chunk
  FROM d JOIN src ON src.source IS NOT DISTINCT FROM d.source),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY idx ORDER BY chunk, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         row_number() OVER () AS rid FROM rows_),
pieces AS (
  SELECT idx, rid, start, size, unnest(range(CAST(start // 64 AS BIGINT), CAST((start + size - 1) // 64 + 1 AS BIGINT))) AS block FROM placed WHERE size > 0),
got AS (
  SELECT rid, sum((least(block * 64 + 64, start + size) - greatest(block * 64, start)) * times) AS taken
  FROM pieces JOIN taken USING (idx, block) GROUP BY rid)
SELECT p.doc_id, p.size, s.source_size, s.target, CAST(coalesce(g.taken, 0) AS BIGINT) AS taken
FROM placed p JOIN src s USING (idx) LEFT JOIN got g USING (rid)
"""


@query("op12_source_mix", OP12_SQL)
def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {b}), lambda x, c: list_reduce(list_prepend(xor(x, c), range(8)), lambda y, i: xor(y // 2, 3988292384 * (y % 2)))))"
# Letters beyond ASCII are U+00C0 to U+00FF: two bytes, 195 and the code point less 64.
BYTES = "flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, (ord(c) - 64)::BIGINT] END))"
OP13_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents) GROUP BY ALL),
marked AS (SELECT run, n, {CRC.format(b=BYTES)} AS h FROM runs),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word, n FROM marked),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON y.word = x.a || x.b),
best AS (SELECT word, count(*) AS n_near, min((-n, other)) AS b FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b[1] >= 2 * w.n THEN b[2] END AS form, CASE WHEN -b[1] >= 2 * w.n THEN -b[1] END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain(word, last, step) AS (
  SELECT word, word, 0 FROM forms UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(last, step) AS last FROM chain GROUP BY word) c USING (word)
"""


@query("op13_spelling_variants", OP13_SQL)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.variants(table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
