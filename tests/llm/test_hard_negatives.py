"""Hard negatives against all scores of all rows."""

import random

import numpy as np
import pytest

from balcao.llm import hard_negatives as module
from balcao.llm.hard_negatives import angles_to, directions, exact_scores, hard_negatives, score_bounds, whole
from tests.conftest import MEDIUM, rows


def expected(table, is_anchor, positives=5, negatives=5, least_percent=80):
    """``table`` has (id, label, vector) with the rules for null and repeated rows applied."""
    size = max((len(v) for _, _, v in table), default=0)
    scaled = {}
    for i, label, vector in table:
        scaled[i] = label, [int(np.floor(256 * float(x))) for x in vector] + [0] * (size - len(vector))
    found = []
    for a in sorted(filter(is_anchor, scaled)):
        label, point = scaled[a]
        ranked = sorted((-sum(x * y for x, y in zip(point, v)), i, k) for i, (k, v) in scaled.items() if i != a)
        for top, p, _ in [r for r in ranked if r[2] == label][:positives]:
            inside = [r for r in ranked if r[2] != label and least_percent * -top <= 100 * -r[0] <= 100 * -top]
            found += [(a, p, k, i, -top, -s) for k, (s, i, _) in enumerate(inside[:negatives], 1)]
    return sorted(found)


KIND = "vec_id bigint, label int, embedding array<float>, cell string, at int, low double"


def given(frame, table):
    return frame(KIND, *[(i, k, None if v is None else [None if x is None else float(x) for x in v], "x", 0, 0.0) for i, k, v in table])


def single(x):
    return [float(np.float32(c)) for c in x]


def clustered(n, size, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    return [(int(i), int(rng.integers(4)), single(centres[rng.integers(12)] + spread * rng.normal(size=size))) for i in range(n)]


@pytest.mark.parametrize("blocks", [(32_768, 8_192), (40, 9)])
def test_clustered_vectors(spark, frame, monkeypatch, blocks):
    monkeypatch.setattr(module, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(module, "BLOCK_ANCHORS", blocks[1])
    table = clustered(700, 12, 5)
    found = hard_negatives(given(frame, table), module.F.col("vec_id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    wanted = expected(table, lambda i: i % 10 == 0)
    assert rows(found) == sorted(wanted, key=repr) and len(wanted) > 500


def test_ties_copies_and_odd_rows(frame):
    rng = random.Random(2)
    table = [(i, rng.randrange(3), [float(rng.randrange(-2, 3)) / 4 for _ in range(3)]) for i in range(200)]
    table += [(i, i % 2, [0.5, 0.5, 0.5]) for i in range(300, 420)]  # a group of copies
    table += [(500, 0, [0.0, 0.0, 0.0]), (510, 0, []), (520, 1, [0.75])]  # zero, empty and short vectors
    table += [(530, 1, [-0.001, -0.0, 1e-30]), (-10, 1, [0.3, 0.3, 0.3])]
    odd = [(None, 0, [1.0, 0.0, 0.0]), (600, None, [1.0, 0.0, 0.0]), (610, 0, None), (620, 0, [1.0, None, 0.0])]
    odd += [(630, 0, [float("nan"), 0.0, 0.0]), (640, 0, [float("inf"), 0.0, 0.0])]
    repeated = [(0, 2, [0.9, 0.9, 0.9]), (0, 2, [0.9, 0.9, 0.9]), (10, 0, [-9.0, 0.0, 0.0]), (20, 7, [8.0, 8.0, 8.0])]
    one = {}
    for i, k, v in table + repeated:
        one[i] = min(one.get(i, (k, v)), (k, v))
    wanted = expected([(i, k, single(v)) for i, (k, v) in one.items()], lambda i: i % 10 == 0)
    found = hard_negatives(given(frame, table + odd + repeated), module.F.col("vec_id") % 10 == 0)
    assert rows(found) == sorted(wanted, key=repr)


def test_none(frame):
    anchors = module.F.col("vec_id") % 10 == 0
    assert hard_negatives(given(frame, []), anchors).collect() == []
    assert hard_negatives(given(frame, [(1, 0, [1.0]), (2, 1, [1.0])]), anchors).collect() == []
    assert hard_negatives(given(frame, [(10, 0, [1.0]), (2, 1, [1.0])]), anchors).collect() == []  # no positive
    assert hard_negatives(given(frame, [(10, 0, [0.0]), (2, 1, [0.0]), (3, 0, [0.0])]), anchors).count() == 1


def test_huge_scores_are_exact_or_cut():
    a, b = np.array([[2.0**30, 3.0]]), np.array([[2.0**29, 1.0], [-(2.0**100), 0.0]])
    assert exact_scores(a, b).tolist() == [[2**59 + 3, -(1 << 60)]]


def test_bounds_are_safe():
    rng = np.random.default_rng(8)
    vectors = whole(rng.normal(size=(300, 6)) * rng.uniform(0, 3, size=(300, 1)))
    references = directions(vectors, 8)
    norms, angles = angles_to(vectors, references)
    at = angles[:40, None, :].astype(float)
    both = np.repeat(norms[:, None], 2, axis=1)
    low, high = score_bounds(at, at, angles, angles, both[:40, None], both[None])
    scores = exact_scores(vectors[:40], vectors)
    assert (low <= scores).all() and (scores <= high).all()
    assert (high - low < 2 * norms[:40, None] * norms).mean() > 0.9  # and they do bound


def test_cells_are_left_out(spark, frame):
    """Anchors visit only cells that can hold what they look for."""
    table = clustered(600, 24, 3, spread=0.01)
    part = given(frame, table).select("vec_id", module.F.col("label").cast("bigint").alias("label"), "embedding")
    vectors = whole(np.array([v for _, _, v in table]))
    references = directions(vectors, 12)
    indexed = module._indexed(part, references).cache()
    cells = module._cells(indexed, len(references))
    assert cells.rows.sum() == 600
    floor = module.F.col("norm") * module.F.col("norm") * 0.9
    asked = indexed.withColumns({"low": floor, "high": module.F.lit(float("inf"))})
    assert module._routed(asked, cells).count() < 2 * 600
    indexed.unpersist()


def test_whole_table(spark):
    from balcao.llm.queries import op12_hard_negatives

    data = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()
    table = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in data if r.label is not None and r.embedding]
    wanted = expected(table, lambda i: i % 100 == 0)
    assert rows(op12_hard_negatives(spark, MEDIUM)) == sorted(wanted, key=repr)
