"""Documents to packed sequences: language, quality rules, near duplicates, packing, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.llm import language_id, packing, quality_rules, queries, simhash_ring
from siftlake.llm.common import table
from siftlake.session import scratch_path

#: A document goes if no language has at least this probability.
LEAST_LANGUAGE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in one of the learned languages."""
    found = language_id.with_language(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").cast("string").alias("text")),
                                      language_id.fit(docs), "_lang", "_score")
    return found.filter((F.col("_lang") != "und") & (F.col("_score") >= LEAST_LANGUAGE)).select("_row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return quality_rules.keep_good(docs, queries.trusted(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_ring.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packing.pack(docs, queries.WORD_VOCABULARY, queries.END_OF_PACKED)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", pack)]
#: Neither the network, the hashes nor the tokenizer can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
