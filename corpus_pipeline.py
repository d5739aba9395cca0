"""Documents to token ids in five stages; each works on all rows that the stage before kept.

All stages take nulls in any column, empty and very long texts, repeated rows and empty tables, and keep extra columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import bpe, jaccard_join, mixing, quality_rules, secret_scan
from lexspark.llm.common import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text fails the base (fewer than 10 words); rows that repeat are judged alike."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, similarity 0.8 and more.

    The smallest doc_id stays, null last; rows without words are no duplicates, and rows that repeat stay once.
    """
    return jaccard_join.first_documents(docs, words=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced and n_chars counted anew; null texts stay null."""
    return secret_scan.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them, repeated or left out. A null source is a source; rows without words stay once."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, with ids and the byte offset after each id; the ids decode to the text, a null one to the empty text."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("source_mixing", mixture),
    ("byte_bpe", tokens),
]

#: Posterior probabilities, links and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written as Parquet in the shared folder and read again.

    staging.remove_staged(spark) deletes these tables when the result is no longer read.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
