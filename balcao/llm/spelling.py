"""Spelling variants: words one edit apart, and the common form each rare word goes back to.

Words are counted over all texts first. Their letter-count vectors are dealt by a k-d tree
(``letter_tree.py``) whose boxes are the tasks' shares: a word lies in its own box, and is asked
for in every box that holds words which can be one edit away. Within a box, words of each pair of
lengths meet in a k-d tree of their own, and what lies near is compared letter by letter. Of each
asked word a box returns the number of near words and the best of them, never the pairs.

The upper tree is grown from the ``SAMPLE_WORDS`` words with the lowest hashes and has at most
``LEAVES`` boxes, for about ``BOX_WORDS`` words each; all words are dealt and asked for. Boxes
that hold more are cut into blocks of words and of asked words, each pair of which is one group,
so a box may hold any number of words of the same letters.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. The
form of a word is the near word that occurs most (ties: the smallest in code-point order), if
that occurs ``FORM_TIMES`` times as often as the word; its root is where following forms ends.

Null and empty texts hold no words. Rows that share an id are counted one by one; a null id
counts as an empty one where words depend on it. Very long words are words like others. An empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.letter_tree import REACH, Boxes, code_points, grow_boxes, near_in_order, packed_counts, pairs_within
from balcao.sources.staging import staged

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST_COUNT, FORM_TIMES = 7, 2, 10
DELETE_EVERY = 31
SAMPLE_WORDS = 65_536
BOX_WORDS, LEAVES = 8_192, 2_048
BLOCK_WORDS, BLOCK_ASKED = 32_768, 262_144
PAIRS = 1_000_000  # letters compared at a time
SLICE_WORDS = 4_096  # dealt at a time


def words_of(docs: DataFrame, delete_every: int = DELETE_EVERY) -> DataFrame:
    """``word`` and ``n`` of all words of ``SHORTEST`` letters or more that occur often enough.

    A maximal run of letters is lower-cased in A to Z. Where the checksum of id and run is a
    multiple of ``delete_every`` the run loses one letter, chosen by the same checksum.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # Shorter runs cannot become words.
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{SHORTEST},}}+"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    found = found.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    gone = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))
    word = F.when(F.col("h") % delete_every == 0, shorter).otherwise(F.col("run"))
    counted = found.select(word.alias("word")).where(F.length("word") >= SHORTEST).groupBy("word")
    return counted.agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter counts as bits, and lengths."""
    letters, starts = code_points(words)
    return packed_counts(letters, starts), np.diff(starts)


def _each_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), SLICE_WORDS):
            yield batch.slice(first, SLICE_WORDS)


def _box_sizes(words: DataFrame, boxes: Boxes) -> tuple[np.ndarray, np.ndarray]:
    """Words in each box, and words that are asked for in it (one row for each box at the end)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, boxes.leaves), dtype=np.int64)
        for part in _each_slice(batches):
            points = _points(part.column(0).to_pylist())
            for i, reach in enumerate((0, REACH)):
                totals[i] += np.bincount(boxes.reached(*points, reach)[1], minlength=boxes.leaves)
        columns = [pa.array(np.arange(boxes.leaves)), *map(pa.array, totals)]
        yield pa.record_batch(columns, names=["box", "held", "asked"])

    counted = words.select("word").mapInArrow(count, "box bigint, held bigint, asked bigint")
    sizes = np.zeros((2, boxes.leaves), dtype=np.int64)
    for row in counted.groupBy("box").agg(F.sum("held").alias("held"), F.sum("asked").alias("asked")).collect():
        sizes[:, row.box] = row.held, row.asked
    return sizes[0], sizes[1]


def _dealt(words: DataFrame, boxes: Boxes, held: np.ndarray, asked: np.ndarray) -> DataFrame:
    """Words under every (box, block of words, block of asked words) they belong to."""
    held_blocks, asked_blocks = -(-held // BLOCK_WORDS), -(-asked // BLOCK_ASKED)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _each_slice(batches):
            points = _points(part.column(0).to_pylist())
            tag = np.asarray(part.column(2)).view(np.uint64)
            for reach, own, others in ((0, held_blocks, asked_blocks), (REACH, asked_blocks, held_blocks)):
                who, box = boxes.reached(*points, reach)
                times = others[box]
                copy = np.repeat(np.arange(len(who)), times)
                block = (tag[who] % np.maximum(own[box], 1).astype(np.uint64)).astype(np.int64)[copy]
                other = np.arange(len(copy)) - np.repeat(np.cumsum(times) - times, times)
                of, which = (block, other) if reach == 0 else (other, block)
                rows = part.take(pa.array(who[copy]))
                yield pa.record_batch(
                    [
                        pa.array(box[copy]), pa.array(of), pa.array(which),
                        pa.array(np.full(len(copy), reach > 0)), rows.column(0), rows.column(1),
                    ],
                    names=["box", "of", "which", "asks", "word", "n"],
                )

    tagged = words.select("word", "n", F.xxhash64("word").alias("tag"))
    return tagged.mapInArrow(deal, "box bigint, of bigint, which bigint, asks boolean, word string, n bigint")


def _near(words: list[str], asks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asking word, held word) of every pair one edit apart, by their places, some at a time."""
    letters, starts = code_points(words)
    codes, sizes = packed_counts(letters, starts), np.diff(starts)
    held, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
    asking_by = {int(s): asking[sizes[asking] == s] for s in np.unique(sizes[asking])}
    for size in map(int, np.unique(sizes[held])):
        own = held[sizes[held] == size]
        for other in (size - 1, size, size + 1):
            asked = asking_by.get(other)
            if asked is None:
                continue
            short, long = min(size, other), max(size, other)
            step = max(PAIRS // long, 1)
            for q, p in pairs_within(codes[own], codes[asked], REACH if size == other else REACH - 1):
                q, p = asked[q], own[p]
                a, b = (q, p) if other <= size else (p, q)
                for first in range(0, len(a), step):
                    some = slice(first, first + step)
                    right = near_in_order(letters, starts[a[some]], starts[b[some]], short, long)
                    yield q[some][right], p[some][right]


_FOUND = "word string, n bigint, n_near bigint, best_n bigint, best string"


def _of_box(group: pa.Table) -> pa.Table:
    """Each asking word with the number of near words held here and the best of them."""
    words = group.column("word").to_pylist()
    n, asks = np.asarray(group.column("n")), np.asarray(group.column("asks"))
    # Held words by rank: most first, then in code-point order.
    ranked = sorted(np.flatnonzero(~asks).tolist(), key=lambda i: (-n[i], words[i]))
    rank = np.full(len(words), len(words))
    rank[ranked] = np.arange(len(ranked))
    n_near, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(words))
    for q, p in _near(words, asks):
        np.add.at(n_near, q, 1)
        np.minimum.at(best, q, rank[p])
    who = np.flatnonzero(n_near)
    chosen = np.array(ranked, dtype=np.int64)[best[who]]
    return pa.table(
        {
            "word": pa.array([words[i] for i in who], pa.string()),
            "n": pa.array(n[who], pa.int64()),
            "n_near": pa.array(n_near[who], pa.int64()),
            "best_n": pa.array(n[chosen], pa.int64()),
            "best": pa.array([words[i] for i in chosen], pa.string()),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``best``, ``best_n`` of every word with a near word.

    ``words`` has distinct ``word`` and their counts ``n``.
    """
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS).toArrow()
    points = _points(sample.column(0).to_pylist())
    total = words.count()
    share = max(1, BOX_WORDS * len(points[0]) // max(total, 1))
    boxes = grow_boxes(*points, share, LEAVES)
    dealt = _dealt(words, boxes, *_box_sizes(words, boxes))
    found = dealt.groupBy("box", "of", "which").applyInArrow(_of_box, _FOUND)
    # The most below zero comes first, then the smallest word in UTF-8, as in code points.
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (
        found.groupBy("word")
        .agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
        .select("word", "n", "n_near", F.col("b.w").alias("best"), (-F.col("b.m")).alias("best_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word with a form: pointers are doubled until none moves.

    Counts rise by a factor along forms, so paths and rounds are few.
    """
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = at.join(further, "root", "left")
        if joined.where("next is not null").isEmpty():
            return at
        at = staged(joined.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variant_groups(words: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of all ``words``."""
    words = staged(words, "words")
    near = staged(near_words(words), "near")
    enough = F.col("best_n") >= FORM_TIMES * F.col("n")
    found = near.select(
        "word", "n_near", F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")
    )
    roots = _roots(found.where("form is not null"))
    return (
        words.join(found, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            "form_n",
        )
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Groups of the words of ``documents``."""
    return variant_groups(words_of(docs.select("doc_id", "text")))
