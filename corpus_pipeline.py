"""The corpus pipeline: quality rules, exact dedup, near-duplicate dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldspark.llm.byte_bpe import encode_checked
from fieldspark.llm.exact_dedup import dedup_documents
from fieldspark.llm.jaccard_join import drop_near_duplicates
from fieldspark.llm.mixing import mix_documents
from fieldspark.llm.quality_rules import filter_documents, train_quality
from fieldspark.session import ensure_importable, materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the classifier reject go."""
    ensure_importable(spark)
    return filter_documents(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    ensure_importable(spark)
    return dedup_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, similarity 0.8)."""
    ensure_importable(spark)
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or cut to their target words."""
    ensure_importable(spark)
    return mix_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip of every document of the mix."""
    import public_tokenizers

    ensure_importable(spark)
    return encode_checked(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

#: A trained classifier and byte-pair merges are beyond SQL; the stages are held against brute force in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
