"""Removal against brute force over all 50-byte strings."""

import hashlib
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from balcao.llm import suffix_dedup
from balcao.llm.suffix_blocks import LENGTH, smallest_owners
from balcao.llm.suffix_dedup import removal_digest
from tests.conftest import MEDIUM


def expected(rows):
    data = [(i, (text or "").encode()) for i, text in rows]
    least = {}
    for i, text in data:
        for p in range(len(text) - LENGTH + 1):
            s = text[p : p + LENGTH]
            if least.get(s, i) >= i:
                least[s] = i
    found = []
    for i, text in data:
        covered = np.zeros(len(text) + 1, dtype=bool)
        for p in range(len(text) - LENGTH + 1):
            if least[text[p : p + LENGTH]] < i:
                covered[p : p + LENGTH] = True
        covered[-1] = False
        kept = bytes(b for b, gone in zip(text, covered) if not gone)
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        found.append((i, len(text), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found)


def found(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def made_up():
    rng = random.Random(11)
    alphabet = "abé\n \U0001f600"
    passages = ["".join(rng.choices(alphabet, k=rng.randint(40, 90))) for _ in range(12)]
    texts = [None, "", "x" * 49, "x" * 50, "x" * 50, "x" * 400, "ab" * 200, "ab" * 199 + "a", "y\x00" * 60, "y\x00" * 61]
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcdefgh ", k=rng.randint(0, 80))) for _ in range(rng.randint(1, 8))]
        texts.append("".join(parts))
    texts += [texts[20], texts[20], "".join(rng.choices("abcdefgh ", k=3000)) + texts[20]]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("settings", [{}, {"_SEGMENT": 64, "BUCKET_BYTES": 1000}])
def test_made_up_texts(frame, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = made_up()
    docs = frame("doc_id bigint, text string, id int, tag int", *[(i, t, 0, 0) for i, t in rows])
    assert found(removal_digest(docs.repartition(5))) == expected(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(removal_digest(docs)) == expected(rows)


def test_shared_and_null_ids(frame):
    long, other = "q" * 30 + "r" * 30, "s" * 30 + "t" * 30
    docs = frame("doc_id bigint, text string", (1, long), (1, long), (1, other + "u"), (2, other), (None, long), (None, None))
    rows = sorted(((r.doc_id or 99, r.n_bytes, r.n_removed) for r in removal_digest(docs).collect()))
    assert rows == [(1, 60, 0), (1, 60, 0), (1, 61, 0), (2, 60, 60), (99, 0, 0), (99, 60, 60)]
    assert removal_digest(docs.limit(0)).collect() == []


def test_suffix_order_with_long_ties():
    rng = random.Random(2)
    strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 140))) for _ in range(200)] + [b"a" * 130, b"a" * 129]
    owners = rng.sample(range(1000), len(strings))
    least = {}
    for s, o in zip(strings, owners):
        for p in range(len(s) - LENGTH + 1):
            least[s[p : p + LENGTH]] = min(o, least.get(s[p : p + LENGTH], o))
    starts, got = smallest_owners(b"".join(strings), np.array([len(s) for s in strings]), np.array(owners))
    wanted = [least[s[p : p + LENGTH]] for s in strings for p in range(len(s) - LENGTH + 1)]
    assert got.tolist() == wanted


def test_anchors_do_not_depend_on_segments(monkeypatch):
    texts = [(t or "").encode() for _, t in made_up()]
    data, bounds = b"".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def strings():
        runs = zip(*(c.tolist() for c in suffix_dedup.anchor_runs(data, bounds)))
        return {(t, p, h) for t, a, b, h in runs for p in range(a, b + 1)}

    whole = strings()
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 64)
    assert strings() == whole
    assert {(t, p) for t, p, _ in whole} == {
        (t, int(bounds[t]) + p) for t, text in enumerate(texts) for p in range(len(text) - LENGTH + 1)
    }
    by_string = {}
    for _, p, h in whole:
        assert by_string.setdefault(data[p : p + LENGTH], h) == h


@pytest.mark.parametrize("least", [1, 30])
def test_many_blocks_and_a_frequent_anchor(frame, monkeypatch, least):
    for name, value in {"BLOCK_BYTES": 2000, "BUCKET_BYTES": 3000, "LEAST_PARTS": least}.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(5)
    # One passage with ever other bytes beside it, whole copies, and copies of copies cut short.
    texts = [t for _, t in made_up()]
    texts += [f"{rng.random()}{'in every document '[: rng.randint(14, 18)]}{rng.random()}" * 2 for _ in range(40)]
    texts += [texts[-1], texts[-2][:70], texts[-3][9:], texts[-4] + "é", None, ""]
    ids = rng.sample(range(-500, 500), len(texts))
    docs = frame("doc_id bigint, text string", *zip(ids, texts))
    assert found(removal_digest(docs.repartition(7))) == expected(list(zip(ids, texts)))


def test_rows_of_one_id_in_many_blocks(frame):
    same = ["z%d" % i + "q" * 30 + "r" * 40 for i in range(25)]
    docs = frame("doc_id bigint, text string", *[(7, t) for t in same], (9, same[3]), (None, same[4]), (None, same[5]))
    gone = [r.n_removed for r in removal_digest(docs).orderBy(F.col("doc_id").asc_nulls_last()).collect()]
    assert gone == [0] * 25 + [72, 72, 72]


def test_segments_do_not_cut_runs(monkeypatch):
    texts = [(t or "").encode() for _, t in made_up()]

    def pieces(order):
        data, bounds = b"".join(order), np.concatenate([[0], np.cumsum([len(t) for t in order])])
        _, starts, lasts, names = suffix_dedup.anchor_runs(data, bounds)
        numbers = suffix_dedup.piece_numbers(data, starts, lasts - starts + LENGTH)
        bodies = [data[a : b + LENGTH] for a, b in zip(starts.tolist(), lasts.tolist())]
        assert len(set(zip(bodies, numbers.tolist()))) == len(set(bodies)) == len(set(numbers.tolist()))
        return sorted(zip(names.tolist(), bodies))

    whole = pieces(texts)
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 64)
    assert pieces(texts[::-1]) == whole


def shuffled_bytes(df):
    """Bytes that the exchanges of a query write, after it has run."""
    df.collect()
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                total += plan.metrics().apply("shuffleBytesWritten").value()
            children = plan.children()
            plans += [children.apply(i) for i in range(children.size())]
    return total


def test_shuffles_little_more_than_texts_and_shared_pieces(spark, tmp_path):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(5000)]
    passages = [" ".join(rng.choices(words, k=60)) for _ in range(50)]
    texts = [" ".join([*rng.choices(words, k=300), rng.choice(passages), *rng.choices(words, k=200)]) for _ in range(2000)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(path)
    size = sum(part.stat().st_size for part in pathlib.Path(path).glob("*.parquet"))
    assert 0.5 * size < shuffled_bytes(removal_digest(spark.read.parquet(path))) < 1.25 * size
