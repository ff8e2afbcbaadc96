"""The training-data operators as queries over the given tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.llm import (
    byte_bpe, hard_negatives, html_consensus, language_id, packing, permutation_index, quality_mil, quality_rules, simhash_ring, token_alignment, token_files, url_filter, warc,
)
from siftlake.llm.common import table

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_OF_DOCUMENT, END_OF_PACKED = 2, 1
#: The pages have no date of their own.
CAPTURED = "1970-01-01T00:00:00Z"
RULES = [
    url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"), url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"), url_filter.Rule("com", "/de/", "block"),
]


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled as good."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, END_OF_DOCUMENT)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY, END_OF_PACKED)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.bpe_digests(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return permutation_index.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivative_digests(table(spark, sf_dir, "pages"), CAPTURED)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op8_simhash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, sf_dir, "documents"), trusted(spark, sf_dir))


def op10_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shifted)


def op13_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract(table(spark, sf_dir, "pages"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (op1_token_files, op2_packing, op3_byte_bpe, op4_permutation_index, op5_url_filter, op6_warc_derivatives,
           op7_language_id, op8_simhash_ring, op9_quality_rules, op10_quality_mil, op11_token_alignment, op12_hard_negatives, op13_html_consensus)
    return {**{f.__name__: f for f in own}, "pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return {"op5_url_filter": url_filter.judge_urls_sql(RULES)}
