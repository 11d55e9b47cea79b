"""The registered query of each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldspark.session import ensure_importable, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.token_output import read_token_files, write_token_files

    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.mixing import mixing_plan

    return mixing_plan(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.jaccard_join import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents")).drop("text_hash", "group_key")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.quality_rules import score_quality, train_quality

    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.toxicity import score_toxicity, train_toxicity

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.chat_format import format_chats

    return format_chats(table(spark, sf_dir, "conversations"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.byte_bpe import round_trip_digests

    return round_trip_digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from fieldspark.llm.warc import archive_pages
    from fieldspark.session import shared_folder

    return archive_pages(table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.merkle import merkle_manifest, tampered_text

    return merkle_manifest(table(spark, sf_dir, "documents"), tampered_text())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


_QUERIES = (
    op1_token_output,
    op2_mixing,
    op3_token_counts,
    op4_exact_dedup,
    op5_jaccard_join,
    op6_quality_rules,
    op7_lm_scoring,
    op8_toxicity,
    op9_chat_format,
    op10_byte_bpe,
    op11_warc,
    op12_merkle_manifest,
    op13_prefix_trie,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(f):
        return lambda spark, sf_dir: f(ensure_importable(spark), sf_dir)

    return {f.__name__: ready(f) for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    from fieldspark.llm.oracles import ORACLES

    return dict(ORACLES)
