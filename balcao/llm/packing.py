"""Harmonic packing of documents into sequences of a fixed capacity.

Documents are cut into pieces. Lengths fall into reciprocal-capacity classes: a piece longer
than capacity/(j+1) and no longer than capacity/j is of class j, and a bin of class j takes
exactly j pieces. Which bin a piece goes to depends only on its rank in its class, so workers
rank their own pieces and need nothing but each other's counts per class.

Cutting makes the classes tight. A document gives full sequences, then powers of two, the
largest first, until a tail of ``TAIL`` to 2 * ``TAIL`` tokens is left. Pieces of a power of
two fill their bins to the last token; the last, unfinished bin of such a class is split into
sequences whose lengths are powers of two, which need no padding either. Tails go into the
bins of their class, which is where the padding is. What the unfinished bins of tails leave
over, fewer than j pieces of each class however large the table, is packed first-fit by
falling length.

Null texts count as empty; an empty document is the closing id alone. Rows that share an id
are packed each on their own. An empty table gives an empty result; other columns do not
matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm.word_ids import slices, word_encoder
from balcao.sources.staging import staged

CAPACITY = 2048
TAIL = 64
_BINS = 1 << 40  # more bins than a class can have

_PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_RANKED = f"{_PIECE}, class int, worker int, rank bigint"


def cut_lengths(tokens: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """Lengths of a document's pieces, in order. The capacity is a power of two."""
    pieces = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest >= 2 * tail:
        piece = 1 << (rest.bit_length() - 1)
        if 0 < rest - piece < tail:
            piece //= 2
        pieces.append(piece)
        rest -= piece
    return pieces + [rest] * (rest > 0)


def piece_class(length: int, capacity: int = CAPACITY) -> int:
    """Minus the length for powers of two, which fill bins of their own; else j."""
    return -length if length & (length - 1) == 0 else capacity // length


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    last_id: int = 1,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents with their class and their rank in it within their worker.

    ``with_ids`` adds the piece's ids as an array.
    """
    id_type = dict(docs.dtypes)[id_column]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, worker = word_encoder(tokenizer_path), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        try:
            for batch in batches:
                for first, last in slices(batch.column(1)):
                    part = batch.slice(first, last - first)
                    ids, starts = encoder.encode(part.column(1), last_id)
                    ids = ids.astype("<u4")
                    rows, made, lists = [], [], []
                    for row, (begin, end) in enumerate(zip(starts.tolist(), starts[1:].tolist())):
                        at = begin
                        for length in cut_lengths(end - begin, capacity):
                            kind = piece_class(length, capacity)
                            rank = seen.get(kind, 0)
                            seen[kind] = rank + 1
                            piece = ids[at : at + length]
                            rows.append(row)
                            made.append((at - begin, length, zlib.crc32(piece), end - begin, kind, worker, rank))
                            if with_ids:
                                lists.append(piece.astype(np.int32))
                            at += length
                    kinds = (pa.int64(),) * 4 + (pa.int32(), pa.int32(), pa.int64())
                    columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                    names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "class", "worker", "rank"]
                    columns = [part.column(0).take(pa.array(rows)), *columns]
                    if with_ids:
                        columns.append(pa.array(lists, pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.record_batch(columns, names=names)
        finally:
            encoder.forget()

    schema = f"`{id_column}` {id_type}, {_RANKED}" + ", ids array<int>" * with_ids
    return docs.select(id_column, text_column).mapInArrow(cut, schema)


def _first_fit(capacity: int):
    """Bins for pieces of mixed classes, the longest first."""

    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(
            ["length", "class", "worker", "rank"], ascending=[False, True, True, True]
        )
        room: list[int] = []
        bins, offsets = [], []
        for length in pieces["length"]:
            found = next((i for i, left in enumerate(room) if left >= length), None)
            if found is None:
                found = len(room)
                room.append(capacity)
            bins.append(found)
            offsets.append(capacity - room[found])
            room[found] -= length
        return pieces.assign(sequence_id=np.array(bins, dtype=np.int64), offset=np.array(offsets, dtype=np.int64))

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give ranked pieces their ``sequence_id`` and ``offset``. Reads ``pieces`` several times."""
    kept = [c for c in pieces.columns if c not in ("class", "worker", "rank")]
    counts = pieces.groupBy("class", "worker").agg(F.count("*").alias("pieces"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "class",
        "worker",
        F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("pieces_before"),
        F.sum("pieces").over(Window.partitionBy("class")).alias("pieces_in_class"),
    )
    ranked = pieces.join(starts, ["class", "worker"]).withColumns(
        {
            "number": F.col("pieces_before") + F.col("rank"),
            "slots": F.when(F.col("class") < 0, F.floor(capacity / -F.col("class"))).otherwise(F.col("class")),
        }
    )
    ranked = ranked.withColumns(
        {
            "slot": F.col("number") % F.col("slots"),
            "bin": F.floor(F.col("number") / F.col("slots")),
            "left_over": F.col("pieces_in_class") % F.col("slots"),
        }
    ).withColumn("is_full", F.col("bin") < F.floor(F.col("pieces_in_class") / F.col("slots")))

    # Powers of two. In an unfinished bin of m pieces the binary digits of m cut it up: the
    # highest digit in which a slot differs from m is the size of the slot's part.
    exact = ranked.where(F.col("class") < 0)
    digit = F.length(F.bin(F.col("slot").bitwiseXOR(F.col("left_over")))) - 1
    size = F.when(F.col("is_full"), F.col("slots")).otherwise(F.expr("shiftleft(1L, digit)"))
    class_number = F.col("length")  # above every other class number, as 1 is added to each
    exact = (
        exact.withColumn("digit", F.when(F.col("is_full"), F.lit(0)).otherwise(digit).cast("int"))
        .withColumn("size", size.cast("bigint"))
        .select(
            *kept,
            (
                (class_number + capacity + 1) * _BINS
                + F.when(F.col("is_full"), F.col("bin")).otherwise(F.lit(_BINS - 64) + F.col("digit"))
            ).alias("sequence_id"),
            ((F.col("slot") % F.col("size")) * F.col("length")).alias("offset"),
        )
    )
    # Tails: the bin is known, the place in it is the sum of the lengths before.
    tails = ranked.where((F.col("class") > 0) & F.col("is_full")).withColumn(
        "sequence_id", F.col("class") * F.lit(_BINS) + F.col("bin")
    )
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select(
        *kept, "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    )
    rest = ranked.where((F.col("class") > 0) & ~F.col("is_full")).select(*pieces.columns)
    schema = ", ".join(f"`{n}` {t}" for n, t in rest.dtypes) + ", sequence_id bigint, offset bigint"
    rest = rest.groupBy(F.lit(0).alias("all")).applyInPandas(_first_fit(capacity), schema)
    return exact.unionByName(tails).unionByName(rest.select(*kept, "sequence_id", "offset"))


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    last_id: int = 1,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All documents in sequences: one row per piece.

    ``id_column``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``,
    ``doc_tokens`` (with the closing id), ``sequence_id``, ``offset`` in the sequence, and
    ``ids`` if wanted. The cut pieces are written once, so that ranks and counts agree.
    """
    pieces = cut_documents(docs, tokenizer_path, last_id, capacity, with_ids, id_column, text_column)
    return pack_pieces(staged(pieces, "pieces"), capacity)
