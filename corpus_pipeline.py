"""A training corpus from raw documents, stage by stage.

Every stage works on whole texts of all rows that the stage before has kept. All but the last
return the columns of ``documents``, with ``n_chars`` brought up to date.

Null texts count as empty; they are near nothing, hold nothing to cut or mask and are packed as
an empty document. A null ``doc_id`` is a value like any other and counts as the largest. Rows
alike in id and text leave the near-duplicates as one row; rows that share an id only are
judged one by one. Very long texts are handled whole. Further columns pass through all stages
but the last, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.llm.minhash import near_duplicates
from balcao.llm.packing import pack_documents
from balcao.llm.queries import table, tokenizer_path
from balcao.llm.secrets import without_secrets
from balcao.llm.suffix_dedup import without_repeats
from balcao.llm.toxicity import PREDICT_AT, toxicity_scores
from balcao.sources.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


_USED = ("doc_id", "text", "source", "n_chars")


def _others_hidden(stage: Stage) -> Stage:
    """Columns that no stage uses have neutral names meanwhile: theirs may be an operator's too."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in _USED else f"__column_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).select(*names).toDF(*docs.columns)

    return run


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))


@_others_hidden
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("toxicity") < PREDICT_AT).select(*docs.columns)


@_others_hidden
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the smallest id stays.

    Of rows that are alike in id and text, one stays.
    """
    kept = near_duplicates(docs, width=5, least_percent=80).where("kept")
    kept = kept.select(F.col("doc_id").alias("__kept")).distinct()
    rows = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")
    rows = rows.withColumn("__tag", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.dropDuplicates(["doc_id", "__tag"]).select(*docs.columns)


@_others_hidden
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that an earlier document holds are cut out; all rows stay."""
    found = without_repeats(docs, as_text=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return _with_text(found, text).select(*docs.columns)


@_others_hidden
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all rows stay."""
    return _with_text(without_secrets(docs), F.col("text")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences for training: one row per piece of a document."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), last_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", drop_repeats),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Classifiers, signatures and tokenizers are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
