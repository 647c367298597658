"""The corpus pipeline: from raw documents to token ids, one operator of ``tablewright.llm`` a stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last give the columns of
documents back. A table without rows passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm import bpe, decontaminate, jaccard, quality
from tablewright.llm.common import set_aside, stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and that the weighed quality rules find good."""
    own = [*quality.FEATURES, "base_failed", "quality_posterior", "kept"]
    plain, names = set_aside(docs, own)
    measured = stored(quality.features(plain))
    judged = quality.judged(measured, quality.fit(measured))
    return judged.filter("kept").drop(*own).withColumnsRenamed(names).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest doc_id; of rows with one doc_id one."""
    found = stored(jaccard.similar(docs.select("doc_id", "text")))
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    out = jaccard.join_ids(docs, gone, "doc_id", "left_anti")
    repeated = stored(found.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id"))
    if repeated.isEmpty():
        return out
    once = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    plain, names = set_aside(jaccard.join_ids(out, repeated, "doc_id", "left_semi"), ["_row"])
    first = plain.withColumn("_row", F.row_number().over(once)).filter("_row = 1").drop("_row").withColumnsRenamed(names)
    return jaccard.join_ids(out, repeated, "doc_id", "left_anti").unionByName(first.select(*docs.columns))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs within its number of edits."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the token ids, their number, and the digest of the text decoded from them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path)
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("quality_rules", keep_quality),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode_tokens),
]

# The estimated quality model, edit distances inside texts and the vocabulary's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
