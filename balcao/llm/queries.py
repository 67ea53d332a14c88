"""One query per operator, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the file of a public tokenizer lies, on every executor."""
    from public_tokenizers import path

    return path(name)


def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.packing import pack_documents

    docs = table(spark, folder, "documents")
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), last_id=1)


def op2_multiset_hash(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.multiset_hash import fingerprint_digest

    return fingerprint_digest(table(spark, folder, "documents"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.minhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"), width=3, least_percent=85)


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.pii import personal_data_digest

    return personal_data_digest(table(spark, folder, "documents"))


def op5_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.secrets import secret_digest

    return secret_digest(table(spark, folder, "documents"))


def op6_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.ann import nearest

    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, most=20)


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.suffix_dedup import removal_digest

    return removal_digest(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.toxicity import toxicity_digest

    return toxicity_digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.piece_codec import encode_checked

    return encode_checked(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.spelling import spelling_variants

    return spelling_variants(table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.hard_negatives import hard_negatives

    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from balcao.llm.quality_rules import quality_digest

    return quality_digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_multiset_hash": op2_multiset_hash,
    "op3_minhash": op3_minhash,
    "op4_personal_data": op4_personal_data,
    "op5_secret_forest": op5_secret_forest,
    "op6_multi_index_hashing": op6_multi_index_hashing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_piece_codec": op10_piece_codec,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_quality_rules": op13_quality_rules,
}

SQL: dict[str, str] = {}
