"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

A score is the inner product of two rows whose components are ``floor(SCALE * x)``, a whole
number. An anchor's positives are its first rows of the same label, highest scores first; its
hard negatives for a positive are the first rows of other labels whose score is within
``least_percent`` and 100 percent of the positive's.

Scores are worked out only where they can matter. Every row stores its angles to a few reference
directions. By the triangle inequality on the sphere, two rows' angle lies between the difference
and the sum of their angles to each reference; the cosines of the tightest bounds, multiplied by
the norms and widened by what rounding can take, bound the score. Rows are dealt to the cell of
their nearest reference. An anchor goes only to cells whose rows can reach a score it looks for,
and inside a cell only rows whose bounds overlap the window of a few neighbouring anchors are
scored. Windows come from two earlier searches: the anchor's own cell gives a score that its
positives must reach, then all cells that can reach it give the positives themselves. On
vectors without any structure, as random ones, the bounds exclude nothing and all rows are scored.

Cells are cut into blocks of ``BLOCK_ROWS`` rows and ``BLOCK_ANCHORS`` anchors, so neither a cell
nor a label needs to fit into one task, and each task returns only the best of each anchor.
``REFERENCES`` directions are picked from at most ``SAMPLE_ROWS`` rows (the lowest hashes);
every row is indexed and the result is exact whatever they are.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no part.
Of rows that share an id one takes part, the one with the smallest label and then the smallest
vector. Shorter vectors are filled with zeros. Equal scores go to the smaller id. An anchor with
fewer positives or negatives has those it has. Scores beyond ``LARGEST`` are cut to it. An empty
table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.sources.staging import staged

SCALE = 256
REFERENCES = 32
SAMPLE_ROWS = 4_096
BLOCK_ROWS, BLOCK_ANCHORS = 32_768, 8_192
TILE = 64  # anchors whose windows are taken together
SLACK = 1e-5  # radians: stored angles are single precision
LARGEST = 1 << 60
EXACT = 1 << 53  # whole numbers below are exact in double precision


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components of the rows that are scored, as doubles."""
    return np.floor(SCALE * vectors)


def exact_scores(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, cut at ``LARGEST``."""
    if not len(rows) or not len(others):
        return np.zeros((len(rows), len(others)), dtype=np.int64)
    reach = np.sqrt((rows * rows).sum(axis=1).max() * (others * others).sum(axis=1).max())
    if reach < EXACT / 2:  # no partial sum is larger
        return (rows @ others.T).astype(np.int64)
    exact = np.frompyfunc(int, 1, 1)
    found = exact(rows).dot(exact(others).T)
    return np.clip(found, -LARGEST, LARGEST).astype(np.int64)


def directions(vectors: np.ndarray, most: int) -> np.ndarray:
    """Unit vectors far from each other, each the one farthest from those before it."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    units = vectors[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, vectors.shape[1])
    picked = [units[0]]
    nearest = units @ units[0]
    while len(picked) < most and nearest.min() < 1 - 1e-6:
        picked.append(units[nearest.argmin()])
        nearest = np.maximum(nearest, units @ picked[-1])
    return np.array(picked)


def angles_to(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references (a zero vector's are right angles)."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    units = vectors / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(units @ references.T, -1, 1)).astype(np.float32)


def score_bounds(
    low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray, norms: np.ndarray, other: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Safe bounds of the scores between two kinds of rows.

    ``low`` and ``high`` are the angles of one kind to each reference (last axis), ``least`` and
    ``most`` those of the other; ``norms`` and ``other`` have the least and the largest norm of
    either on the last axis.
    """
    nearest = np.maximum(np.maximum(least - high, low - most), 0).max(axis=-1)
    farthest = np.minimum(high + most, 2 * np.pi - low - least).min(axis=-1)
    top = np.cos(np.clip(nearest - 2 * SLACK, 0, np.pi))
    bottom = np.cos(np.clip(farthest + 2 * SLACK, 0, np.pi))
    small, large = norms[..., 0] * other[..., 0], norms[..., 1] * other[..., 1]
    widened = 1 + 1e-9 * large
    return (
        bottom * np.where(bottom > 0, small, large) - widened,
        top * np.where(top > 0, large, small) + widened,
    )


@dataclass
class Cells:
    """What is known of each cell's rows: counts, the range of norms and of angles."""

    rows: np.ndarray
    norms: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def reached(self, angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each anchor and cell whether some row's score may lie within ``low`` and ``high``."""
        at = angles[:, None, :].astype(np.float64)
        own = np.repeat(norms[:, None, None], 2, axis=2)
        bottom, top = score_bounds(at, at, self.least, self.most, own, self.norms)
        return (top >= low[:, None]) & (bottom <= high[:, None]) & (self.rows > 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists of numbers as rows, filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten()).astype(np.float64)
    out = np.zeros((len(column), size))
    firsts = np.cumsum(lengths) - lengths
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(firsts, lengths)] = flat
    return out


def taking_part(vectors: DataFrame) -> DataFrame:
    """One row for each id, with ``vec_id``, ``label`` and ``embedding``."""
    limit = F.lit(float("inf"))
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding").where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    )
    # Only ids travel to see whether any is repeated.
    if rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        return rows
    first = F.min(F.struct("label", "embedding"))
    return rows.groupBy("vec_id").agg(first.alias("r")).select("vec_id", "r.*")


def _indexed(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """Rows with ``cell``, ``norm`` and ``angles``."""
    size = references.shape[1]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, angles = angles_to(whole(_matrix(batch.column(2), size)), references)
            yield pa.record_batch(
                [
                    *batch.columns,
                    pa.array(angles.argmin(axis=1).astype(np.int32)),
                    pa.array(norms),
                    pa.FixedSizeListArray.from_arrays(pa.array(angles.ravel()), angles.shape[1]).cast(pa.list_(pa.float32())),
                ],
                names=["vec_id", "label", "embedding", "cell", "norm", "angles"],
            )

    kind = dict(rows.dtypes)["embedding"]
    return rows.select("vec_id", "label", "embedding").mapInArrow(
        index, f"vec_id bigint, label bigint, embedding {kind}, cell int, norm double, angles array<float>"
    )


def _cells(rows: DataFrame, references: int) -> Cells:
    """One row for each reference comes to the driver."""
    places = [F.get("angles", F.lit(i)) for i in range(references)]
    found = (
        rows.groupBy("cell")
        .agg(
            F.count("*").alias("rows"),
            F.array(F.min("norm"), F.max("norm")).alias("norms"),
            F.array(*[F.min(p) for p in places]).alias("least"),
            F.array(*[F.max(p) for p in places]).alias("most"),
        )
        .collect()
    )
    cells = Cells(
        np.zeros(references, dtype=np.int64), np.zeros((references, 2)), *np.zeros((2, references, references))
    )
    for row in found:
        cells.rows[row.cell], cells.norms[row.cell] = row.rows, row.norms
        cells.least[row.cell], cells.most[row.cell] = row.least, row.most
    return cells


def _routed(anchors: DataFrame, cells: Cells | None) -> DataFrame:
    """Anchors with ``at``, once for each cell they must visit: their own if no cells are given."""
    if cells is None:
        return anchors.withColumn("at", F.col("cell"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1_024):
                part = batch.slice(first, 1_024)
                names = part.schema.names
                low, high = (np.asarray(part.column(names.index(n)), dtype=np.float64) for n in ("low", "high"))
                angles = _matrix(part.column(names.index("angles")), len(cells.rows))
                norms = np.asarray(part.column(names.index("norm")))
                reached = cells.reached(angles, norms, low, high)
                who, where = np.nonzero(reached)
                yield pa.record_batch(
                    [*part.take(pa.array(who)).columns, pa.array(where.astype(np.int32))], names=[*names, "at"]
                )

    kinds = ", ".join(f"{name} {kind}" for name, kind in anchors.dtypes)
    return anchors.mapInArrow(route, f"{kinds}, at int")


def _dealt(rows: DataFrame, anchors: DataFrame, cells: Cells) -> tuple[DataFrame, DataFrame]:
    """Blocks of each cell's rows and of the anchors that visit it: every pair is one group."""
    visits = {r["at"]: r["count"] for r in anchors.groupBy("at").count().collect()}  # one for each cell
    row_blocks = F.array(*[F.lit(int(-(-n // BLOCK_ROWS))) for n in cells.rows])
    anchor_blocks = F.array(*[F.lit(int(-(-visits.get(c, 0) // BLOCK_ANCHORS))) for c in range(len(cells.rows))])

    def deal(df: DataFrame, cell: str, own: Column, others: Column, name: str, other: str) -> DataFrame:
        df = df.withColumns({"at": F.col(cell), "own": F.get(own, F.col(cell)), "others": F.get(others, F.col(cell))})
        df = df.where("own > 0 and others > 0")
        df = df.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("own")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col("others") - 1))).drop("own", "others")

    return (
        deal(rows, "cell", row_blocks, anchor_blocks, "rows_block", "anchors_block"),
        deal(anchors, "at", anchor_blocks, row_blocks, "anchors_block", "rows_block"),
    )


def _tiles(rows: pa.Table, anchors: pa.Table, size: int, references: int) -> Iterator[tuple]:
    """Anchors of a block, a few at a time, with the rows whose score bounds overlap their windows."""
    angles = _matrix(rows.column("angles"), references)
    norms = np.asarray(rows.column("norm"))
    vectors = whole(_matrix(rows.column("embedding"), size))
    seen = _matrix(anchors.column("angles"), references)
    order = np.lexsort((seen.min(axis=1), seen.argmin(axis=1)))
    lengths = np.asarray(anchors.column("norm"))
    points = whole(_matrix(anchors.column("embedding"), size))
    low, high = (np.asarray(anchors.column(n), dtype=np.float64) for n in ("low", "high"))
    both = np.repeat(norms[:, None], 2, axis=1)
    for first in range(0, len(order), TILE):
        at = order[first : first + TILE]
        span = np.array([lengths[at].min(), lengths[at].max()])
        bottom, top = score_bounds(
            angles, angles, seen[at].min(axis=0), seen[at].max(axis=0), both, np.broadcast_to(span, both.shape)
        )
        near = np.flatnonzero((top >= low[at].min()) & (bottom <= high[at].max()))
        yield at, near, exact_scores(points[at], vectors[near])


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most``: highest scores, then smallest ids."""
    if len(scores) > 8 * most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:most]]
    return np.lexsort((ids, -scores))[:most]


_POSITIVES = "anchor_id bigint, positive_id bigint, score bigint"


def _positives_of(size: int, references: int, most: int):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, labels = np.asarray(rows.column("vec_id")), np.asarray(rows.column("label"))
        own, kinds = np.asarray(anchors.column("vec_id")), np.asarray(anchors.column("label"))
        found: list[tuple] = []
        for at, near, scores in _tiles(rows, anchors, size, references) if len(rows) and len(anchors) else ():
            alike = labels[near] == kinds[at][:, None]
            alike &= ids[near] != own[at][:, None]
            for i, a in enumerate(at):
                some = np.flatnonzero(alike[i])
                best = some[_first(scores[i, some], ids[near[some]], most)]
                found.append((np.full(len(best), own[a]), ids[near[best]], scores[i, best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, dtype=np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "positive_id", "score"])

    return search


_NEGATIVES = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, score bigint"


def _negatives_of(size: int, references: int, most: int, least_percent: int):
    def search(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, labels = np.asarray(rows.column("vec_id")), np.asarray(rows.column("label"))
        own, kinds = np.asarray(anchors.column("vec_id")), np.asarray(anchors.column("label"))
        lists = anchors.column("positives").combine_chunks()
        ends = np.asarray(lists.offsets)
        ends = ends - ends[0]
        positives = np.asarray(lists.flatten().field("positive_id"))
        wanted = np.asarray(lists.flatten().field("score"))
        found: list[tuple] = []
        for at, near, scores in _tiles(rows, anchors, size, references) if len(rows) and len(anchors) else ():
            differ = labels[near] != kinds[at][:, None]
            for i, a in enumerate(at):
                tops = wanted[ends[a] : ends[a + 1]]
                # Everything in one of the windows, in order; Python's whole numbers do not overflow.
                inside = differ[i] & (scores[i] <= tops.max())
                inside &= scores[i] >= -(-least_percent * int(tops.min()) // 100)
                some = np.flatnonzero(inside)
                some = some[np.lexsort((ids[near[some]], -scores[i, some]))]
                ranked = scores[i, some]
                for p, top in zip(positives[ends[a] : ends[a + 1]], tops):
                    start = np.searchsorted(-ranked, -top)
                    best = some[start : start + most]
                    best = best[scores[i, best] >= -(-least_percent * int(top) // 100)]
                    k = len(best)
                    found.append((np.full(k, own[a]), np.full(k, p), np.full(k, top), ids[near[best]], scores[i, best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, dtype=np.int64)] * 5
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    return search


def _searched(rows: DataFrame, anchors: DataFrame, cells: Cells, search, schema: str) -> DataFrame:
    keys = ["at", "rows_block", "anchors_block"]
    left, right = _dealt(rows, anchors, cells)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on ``vec_id``.
    """
    part = taking_part(vectors)
    sample = part.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("embedding").toArrow()
    size = part.agg(F.max(F.size("embedding"))).first()[0] or 1
    references = directions(whole(_matrix(sample.column(0), size)), REFERENCES)
    count = len(references)
    rows = staged(_indexed(part, references), "vectors")
    cells = _cells(rows, count)
    anchors = rows.where(is_anchor)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")

    def searched_positives(visitors: DataFrame, at: Cells | None) -> DataFrame:
        routed = staged(_routed(visitors, at), "visits")
        found = _searched(rows, routed, cells, _positives_of(size, count, positives), _POSITIVES)
        return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)

    # First in the anchor's own cell: what its positives score at least.
    anywhere = {"low": F.lit(float("-inf")), "high": F.lit(float("inf"))}
    near = searched_positives(anchors.withColumns(anywhere), None)
    floors = near.where(F.col("n") == positives).select(F.col("anchor_id").alias("__id"), F.col("score").alias("floor"))
    known = anchors.join(floors, F.col("vec_id") == F.col("__id"), "left")
    low = F.coalesce(F.col("floor").cast("double"), F.lit(float("-inf")))
    # Scores at the limit may lie beyond it.
    low = F.when(F.col("floor") >= F.lit(LARGEST), F.lit(float("-inf"))).otherwise(low)
    known = known.withColumns({"low": low, "high": F.lit(float("inf"))}).drop("__id", "floor")
    chosen = searched_positives(known, cells).groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "positive_id", "score"))).alias("positives")  # a few
    )
    windows = staged(chosen, "positives")
    scores = F.col("positives.score")
    asked = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    smallest, largest = F.array_min(scores).cast("double"), F.array_max(scores).cast("double")
    asked = asked.withColumns(
        {
            "low": F.when(F.abs(smallest) < F.lit(float(LARGEST)), smallest * least_percent / 100 - 1).otherwise(float("-inf")),
            "high": F.when(F.abs(largest) < F.lit(float(LARGEST)), largest).otherwise(float("inf")),
        }
    ).where("high >= 0")  # below zero the window is empty: less than all of it is more
    routed = staged(_routed(asked, cells), "visits")
    found = _searched(rows, routed, cells, _negatives_of(size, count, negatives, least_percent), _NEGATIVES)
    ranked = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
