"""Corpus pipeline: quality rules, SimHash near-dedup, secret scans, mixing, tokenizing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from actiflow.llm import mixing, pieces, quality_rules, secrets, simhash
from actiflow.llm.common import scratch
from actiflow.session import work_root
from actiflow.sinks.files import delete
from actiflow.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host fails, go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced, n_chars follows."""
    return secrets.redact(docs, length_col="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that each source meets its target."""
    return mixing.mix(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str,
              model_path: str | None = None) -> DataFrame:
    """Documents with the SentencePiece ids of their text."""
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs, model_path)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("sentencepiece", tokenized),
]

#: Fingerprints, regular expressions and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = work_root(spark, f"pipeline_{name}")
        with scratch(spark):  # the operators' own tables go once the stage is written
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
