"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.bpe import round_trip
from tidewatch.llm.decontaminate import contamination
from tidewatch.llm.exact_dedup import copy_groups
from tidewatch.llm.hard_negatives import hard_negatives, whole_vectors
from tidewatch.llm.html_extract import extracted
from tidewatch.llm.phrases import phrase_report
from tidewatch.llm.quality import quality_report
from tidewatch.llm.quality_rules import rule_report
from tidewatch.llm.secret_scan import secret_report
from tidewatch.llm.shared import read
from tidewatch.llm.sharding import shard
from tidewatch.llm.simhash import near_report
from tidewatch.llm.substring_dedup import deduplicated
from tidewatch.llm.token_files import read_report, write_shards

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = 50_257
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), 16)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    shards = write_shards(
        docs, TOKENIZER, public_tokenizers.PATTERN, VOCABULARY, encode_special_tokens=False
    )
    return read_report(spark, shards)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(read(spark, sf_dir, "documents"), length=13)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_report(read(spark, sf_dir, "documents"), shingle=3, radius=2)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), 0.3)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = whole_vectors(rows.withColumn("label", moved), scale=256)
    return hard_negatives(vectors, F.col("id") % 100 == 0, positives=5, negatives=10)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_report(read(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_report(read(spark, sf_dir, "documents"), top=2000, least=10, max_words=3)


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_sharding": op2_sharding,
    "op3_token_files": op3_token_files,
    "op4_bpe": op4_bpe,
    "op5_html_extraction": op5_html_extraction,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_secret_scan": op10_secret_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_phrases": op13_phrases,
}
