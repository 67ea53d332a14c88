"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors get one coordinate more that evens out their norms, so that the largest inner product
is the smallest angle. ``ROTATIONS`` rotations are learned so that signs keep as much as
possible (iterative quantisation), on at most ``TRAINING_VECTORS`` vectors; every row is
indexed. Codes are cut into substrings of ``SUBSTRING_BITS`` bits, each with an index of its
own. Two codes within a Hamming radius are, by the pigeonhole principle, close in one of the
substrings: probing all values near the query's substrings retrieves every such code. What is
retrieved and truly within the radius is ranked by the original vectors.

The radius is measured, not set: for ``CALIBRATION_QUERIES`` queries the true neighbours are
found by brute force over all rows, and the radius holds ``CODES_WITHIN`` of them.

Rows and queries are dealt into blocks of bounded size, and each pair of blocks is one task's
work that returns the best of each query; only these meet again. Where nothing is near, as
with random vectors, the radius is wide and probing reaches most of a block.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part. Neighbours never have the query's own id. Equal scores go to the
smaller id; of rows with the same id the best counts. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.sources.staging import staged

ROTATIONS = 4
SUBSTRING_BITS = 8
TRAINING_VECTORS = 10_000
TRAINING_ROUNDS = 20
CALIBRATION_QUERIES = 128
CODES_WITHIN = 0.97
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 2_048


@dataclass
class Coder:
    """Binary codes of vectors: signs after learned rotations."""

    norm: float  # largest of all rows
    mean: np.ndarray
    rotations: np.ndarray  # one column per bit

    @property
    def bits(self) -> int:
        return self.rotations.shape[1]

    def codes(self, vectors: np.ndarray, as_queries: bool) -> np.ndarray:
        """One byte per substring."""
        squares = (vectors * vectors).sum(axis=1)
        extra = np.zeros(len(vectors)) if as_queries else np.sqrt(np.maximum(self.norm**2 - squares, 0))
        scale = np.sqrt(squares) if as_queries else self.norm
        points = np.hstack([vectors, extra[:, None]]) / np.reshape(scale, (-1, 1))
        return np.packbits((points - self.mean) @ self.rotations > 0, axis=1)


def learn(vectors: np.ndarray, norm: float) -> Coder:
    """Iterative quantisation from several random starts."""
    extra = np.sqrt(np.maximum(norm**2 - (vectors * vectors).sum(axis=1), 0))
    points = np.hstack([vectors, extra[:, None]]) / norm
    mean = points.mean(axis=0)
    points = points - mean
    rng = np.random.default_rng(7)
    found = []
    for _ in range(ROTATIONS):
        turn = np.linalg.qr(rng.normal(size=(points.shape[1],) * 2))[0]
        for _ in range(TRAINING_ROUNDS):
            u, _, v = np.linalg.svd(points.T @ np.where(points @ turn > 0, 1.0, -1.0))
            turn = u @ v
        found.append(turn)
    return Coder(norm, mean, np.hstack(found))


def _near_values(radius: int) -> np.ndarray:
    """Bit patterns to flip for every value within the radius of a substring."""
    values = np.arange(1 << SUBSTRING_BITS)
    return values[np.bitwise_count(values) <= radius]


class SubstringIndex:
    """Codes of a block of rows, found by any of their substrings."""

    def __init__(self, codes: np.ndarray):
        self.rows, self.parts = codes.shape
        padded = np.zeros((self.rows, -(-self.parts // 8) * 8), dtype=np.uint8)
        padded[:, : self.parts] = codes
        self.words = padded.view(np.uint64)
        self.orders = [np.argsort(codes[:, j], kind="stable") for j in range(self.parts)]
        counts = [np.bincount(codes[:, j], minlength=1 << SUBSTRING_BITS) for j in range(self.parts)]
        self.counts = np.array(counts)
        self.firsts = np.cumsum(self.counts, axis=1) - self.counts

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs from ``code`` in at most ``radius`` bits."""
        least, more = divmod(radius, self.parts)
        reached = np.zeros(self.rows, dtype=bool)
        for j in range(self.parts):
            # If all parts up to ``more`` differ by more than ``least`` and all others by
            # ``least`` or more, the codes differ by more than ``radius``.
            near = least if j <= more else least - 1
            if near < 0:
                continue
            values = _NEAR[min(near, SUBSTRING_BITS)] ^ code[j]
            counts = self.counts[j, values]
            ends = np.cumsum(counts)
            at = np.repeat(self.firsts[j, values] - (ends - counts), counts) + np.arange(ends[-1])
            reached[self.orders[j][at]] = True
        rows = np.flatnonzero(reached)
        padded = np.zeros(self.words.shape[1] * 8, dtype=np.uint8)
        padded[: self.parts] = code
        differ = np.bitwise_count(self.words[rows] ^ padded.view(np.uint64)).sum(axis=1)
        return rows[differ <= radius]


_NEAR = [_near_values(r) for r in range(SUBSTRING_BITS + 1)]


def inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, summed in the same order for every row."""
    return (vectors * query).sum(axis=1)


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best ``most`` different ids: highest scores, then smallest ids."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:most]]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = len(column)
    return np.asarray(column.flatten()).astype(np.float64).reshape(size, -1) if size else np.empty((0, 0))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part."""
    values = F.col(vector_column).cast("array<double>")
    limit = F.lit(float("inf"))
    rows = vectors.select(F.col(id_column).alias("vec_id"), values.alias("embedding")).where(
        F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
        & F.exists("embedding", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("embedding").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), "length").first()
    return rows if common is None else rows.where(F.size("embedding") == common.length)


def _dealt(rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int) -> tuple[DataFrame, DataFrame]:
    """Every pair of a block of rows and a block of queries under one ``pair`` number."""
    row_blocks, query_blocks = -(-n_rows // BLOCK_ROWS), -(-n_queries // BLOCK_QUERIES)

    def deal(df: DataFrame, blocks: int, others: int, step: int, other_step: int) -> DataFrame:
        own: Column = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) * step
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumn("other", other).withColumn("pair", own + F.col("other") * other_step).drop("other")

    return (
        deal(rows, row_blocks, query_blocks, query_blocks, 1),
        deal(queries, query_blocks, row_blocks, 1, query_blocks),
    )


_FOUND = "query_id bigint, vec_id bigint, score double"


def _searcher(most: int, coder: Coder | None, radius: int):
    """Best rows of a block for each query of another; all rows compared if no coder is given."""

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]).empty_table()
        ids, vectors = np.asarray(rows.column("vec_id")), _matrix(rows.column("embedding"))
        asked, points = np.asarray(queries.column("vec_id")), _matrix(queries.column("embedding"))
        if coder is not None:
            index = SubstringIndex(coder.codes(vectors, as_queries=False))
            codes = coder.codes(points, as_queries=True)
        found_ids, found_scores, sizes = [], [], []
        for number, (own, point) in enumerate(zip(asked, points)):
            near = np.arange(len(ids)) if coder is None else index.within(codes[number], radius)
            near = near[ids[near] != own]
            scores = inner_products(vectors[near], point)
            kept = _best(scores, ids[near], most)
            found_ids.append(ids[near][kept])
            found_scores.append(scores[kept])
            sizes.append(len(kept))
        return pa.table(
            {
                "query_id": pa.array(np.repeat(asked, sizes)),
                "vec_id": pa.array(np.concatenate(found_ids)),
                "score": pa.array(np.concatenate(found_scores)),
            }
        )

    return search


def _search(
    rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int, most: int, coder: Coder | None, radius: int
) -> DataFrame:
    dealt_rows, dealt_queries = _dealt(rows, queries, n_rows, n_queries)
    found = dealt_rows.groupBy("pair").cogroup(dealt_queries.groupBy("pair")).applyInArrow(
        _searcher(most, coder, radius), _FOUND
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= most)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    most: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's nearest rows found.

    ``is_query`` is a condition on ``vec_id``.
    """
    rows = staged(usable(vectors, id_column, vector_column), "vectors")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x))
    facts = rows.agg(
        F.count("*").alias("rows"), F.count_if(is_query).alias("queries"), F.max(norm).alias("norm")
    ).first()
    queries = rows.where(is_query)
    if not facts.queries:
        return _search(rows, queries, 1, 1, most, None, 0)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRAINING_VECTORS).select("embedding")
    coder = learn(_matrix(sample.toArrow().column(0)), facts.norm)
    # The radius, from true neighbours.
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES)
    true = _search(rows, staged(asked, "asked"), facts.rows, CALIBRATION_QUERIES, most, None, 0)
    true = true.join(
        rows.select("vec_id", "embedding").dropDuplicates(["vec_id"]), "vec_id"
    ).select("query_id", "embedding")
    points = {r.vec_id: r.embedding for r in asked.collect()}
    known = true.toArrow()
    if len(known):
        far = coder.codes(_matrix(known.column("embedding")), as_queries=False)
        near = coder.codes(np.array([points[q] for q in known.column("query_id").to_pylist()]), as_queries=True)
        distances = np.bitwise_count(far ^ near).sum(axis=1)
        radius = int(np.quantile(distances, CODES_WITHIN, method="higher"))
    else:
        radius = 0
    return _search(rows, queries, facts.rows, facts.queries, most, coder, radius)
