"""From raw documents to token ids: the corpus operators in the order they are run.

Each stage takes the documents its predecessor kept, as written to Parquet, and returns those it
keeps, in the same columns; the last one returns their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.bpe import round_trip
from tidewatch.llm.decontaminate import decontaminate
from tidewatch.llm.exact_dedup import exact_dedup
from tidewatch.llm.quality import good_documents
from tidewatch.llm.queries import RANKS, public_tokenizers
from tidewatch.llm.shared import read, write_once
from tidewatch.llm.simhash import near_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    return good_documents(docs, read(spark, sf_dir, "labels"), threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every group of near copies."""
    return near_dedup(docs, shingle=3, radius=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a window of ten words with a benchmark item."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"), window=10)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of them and of the text decoded from them."""
    return round_trip(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("benchmark decontamination", benchmark),
    ("bpe encoding and decoding", tokens),
]

#: SQL can't express the classifier, the fingerprints or the tokens; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = write_once(docs)
    return docs
