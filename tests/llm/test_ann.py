"""Recall against brute force, and the index against comparing all codes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from balcao.llm import ann
from balcao.llm.ann import SubstringIndex, inner_products, nearest
from tests.conftest import MEDIUM


def brute(ids, vectors, asked, most):
    found = {}
    for q in asked:
        own = ids == ids[q]
        scores = np.where(own, -np.inf, inner_products(vectors, vectors[q]))
        order = np.lexsort((ids, -scores))[: min(most, (~own).sum())]
        found[ids[q]] = [(int(ids[i]), float(scores[i])) for i in order]
    return found


def results(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_recall_on_the_table(spark):
    rows = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    data = sorted((r.vec_id, r.embedding) for r in rows.collect())
    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data], dtype=np.float64)
    true = brute(ids, vectors, np.flatnonzero(ids % 20 == 0), 20)
    found = results(nearest(rows, F.col("vec_id") % 20 == 0))
    assert set(found) == set(true)
    exact = {q: dict(zip(ids.tolist(), inner_products(vectors, vectors[ids == q][0]))) for q in found}
    assert all(score == exact[q][i] for q, best in found.items() for i, score in best)
    assert all(best == sorted(best, key=lambda p: (-p[1], p[0])) for best in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in true[q]}) for q in true)
    assert hits >= 0.9 * sum(map(len, true.values()))


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 9), dtype=np.uint8)
    codes[:100] = codes[0] ^ np.packbits(rng.random((100, 72)) < 0.05, axis=1)
    index = SubstringIndex(codes)
    for radius in (0, 1, 5, 9, 13, 30, 72):
        for query in codes[:20]:
            wanted = np.flatnonzero(np.bitwise_count(codes ^ query).sum(axis=1) <= radius)
            assert np.array_equal(index.within(query, radius), wanted)


@pytest.mark.parametrize("blocks", [(8192, 2048), (7, 2)])
def test_ties_copies_and_unusable_vectors(frame, monkeypatch, blocks):
    monkeypatch.setattr(ann, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(ann, "BLOCK_QUERIES", blocks[1])
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(30)] + [(i, [0.2, float(i), 0.0]) for i in range(30, 45)]
    rows += [(60, None), (61, [0.0, 0.0, 0.0]), (80, [1.0, None, 1.0]), (81, [float("nan"), 1.0, 1.0]),
             (82, [float("inf"), 1.0, 1.0]), (83, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (100, []), (20, [1.0, 0.0, 0.5])]
    df = frame("vec_id bigint, embedding array<double>, pair int, score string", *[(i, v, 1, "") for i, v in rows])
    found = results(nearest(df, F.col("vec_id") % 20 == 0, most=5))
    assert set(found) == {0, 20, 40}
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in found[20]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in found[40]] == [44, 43, 42, 41, 39]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
