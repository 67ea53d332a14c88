"""Quality of documents: fixed rules, and an isolation forest over the rules' statistics.

A document fails the fixed rules if it has fewer than ``LEAST_WORDS`` words, or if more than
half of its words stand in runs of three words that it holds twice or more. What passes is
judged by the forest (``isolation.py``): it is grown on the statistics of documents labelled
good, and documents whose statistics random splits part from those sooner than the threshold
allows are rejected. The threshold comes from all labelled rows that pass the fixed rules: it is
the one that catches the largest share of bad rows, less ``GOOD_WEIGHT`` times the share of good
rows lost.

The forest is grown on at most ``FIT_ROWS`` different rows (the lowest hashes, copies counted
once); statistics, threshold and verdicts cover all rows. Where no good row is labelled it is
grown on documents that pass the fixed rules; without both labels, or where all rows are alike,
only the fixed rules decide.

Null texts count as empty and so fail. Rows that share an id are judged one by one; each has the
label of its id, and an id with several labels counts under each. Null ids and null labels teach
nothing. An empty table gives an empty result. Other columns are kept; one that is named like
a column of the result gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from balcao.llm.isolation import Forest, grow_forest
from balcao.llm.rule_statistics import COUNTS, SHARES, rule_statistics
from balcao.llm.word_ids import slices
from balcao.sources.staging import staged

LEAST_WORDS = 50
FIT_ROWS = 20_000
TREES, TREE_ROWS, SEED = 100, 1_024, 11
STEPS = 1_000  # thresholds that are tried, from 0 to 1
GOOD_WEIGHT = 2


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, with those of ``COUNTS`` and ``SHARES``."""
    given_way = {text_column, *COUNTS, *SHARES, "base_failed", "anomaly", "kept"}
    kept = [f for f in docs.schema.fields if f.name not in given_way]
    schema = StructType(
        [*kept, *[StructField(c, LongType()) for c in COUNTS], *[StructField(c, DoubleType()) for c in SHARES]]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(0)):
                part = batch.slice(first, last - first)
                found = rule_statistics(part.column(0))
                columns = [*part.columns[1:], *[pa.array(found[c]) for c in (*COUNTS, *SHARES)]]
                yield pa.record_batch(columns, names=schema.names)

    rows = docs.select(F.col(f"`{text_column}`").cast("string"), *[F.col(f"`{f.name}`") for f in kept])
    return rows.mapInArrow(count, schema)


def fails_rules() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fitted_forest(passing: DataFrame, known: DataFrame) -> Forest | None:
    """Grown on the good rows of ``known``, or on ``passing`` if there are none."""
    good = known.where("quality = 1")
    rows = passing if good.isEmpty() else good
    some = rows.select(*SHARES).distinct().orderBy(F.xxhash64(*SHARES), *SHARES).limit(FIT_ROWS).toArrow()
    values = np.column_stack([np.asarray(some.column(c)) for c in SHARES])
    return grow_forest(values, TREES, TREE_ROWS, SEED)


def with_anomaly(statistics: DataFrame, forest: Forest) -> DataFrame:
    """Add ``anomaly`` (0 to 1)."""
    schema = StructType([*statistics.schema.fields, StructField("anomaly", DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([np.asarray(batch.column(c)) for c in SHARES])
            yield pa.record_batch([*batch.columns, pa.array(forest.anomaly(rows), pa.float64())], names=schema.names)

    return statistics.mapInArrow(judge, schema)


def best_threshold(known: DataFrame) -> float | None:
    """From all rows with ``anomaly`` and ``quality``; none if one of the labels has no row."""
    step = F.floor(F.col("anomaly") * STEPS).cast("int")
    counted = known.groupBy(step.alias("step"), "quality").count().collect()  # two for each step at most
    bad, good = np.zeros(STEPS + 2), np.zeros(STEPS + 2)
    for row in counted:
        (good if row.quality else bad)[row.step] += row["count"]
    if not bad.sum() or not good.sum():
        return None
    # Rows at or above each step are rejected.
    caught = bad[::-1].cumsum()[::-1] / bad.sum()
    lost = good[::-1].cumsum()[::-1] / good.sum()
    worth = caught - GOOD_WEIGHT * lost
    best = np.flatnonzero(worth == worth.max())
    return float(best[len(best) // 2]) / STEPS


def quality_verdicts(docs: DataFrame, labels: DataFrame, text_column: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, its statistics, ``base_failed``, ``anomaly`` and ``kept``.

    ``docs`` has ``doc_id``; ``labels`` has ``doc_id`` and ``quality`` (1: good, 0: bad).
    ``anomaly`` is null where only the fixed rules decide.
    """
    statistics = staged(with_statistics(docs, text_column), "statistics").withColumn("base_failed", fails_rules())
    passing = statistics.where("not base_failed")
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").alias("__id"), "quality").distinct()
    inputs = passing.select("doc_id", *SHARES).join(known, F.col("doc_id") == F.col("__id")).select("quality", *SHARES)
    inputs = staged(inputs, "labelled")
    forest = fitted_forest(passing, inputs)
    threshold = best_threshold(with_anomaly(inputs, forest)) if forest else None
    if threshold is None:
        return statistics.withColumns({"anomaly": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    judged = with_anomaly(statistics, forest)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``anomaly`` of every row of ``documents``."""
    found = quality_verdicts(docs.select("doc_id", "text"), labels)
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")
