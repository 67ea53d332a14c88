"""Fingerprints: algebra, neighbours, and agreement with plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from balcao.llm import multiset_hash as mh
from balcao.llm.multiset_hash import combined, fingerprint_digest, fingerprints, multiset_vector, without
from tests.conftest import SMALL


def vectors(frame, *texts):
    docs = frame("i int, text string", *enumerate(texts))
    return [r.v for r in docs.select("i", multiset_vector(docs.text).alias("v")).orderBy("i").collect()]


def test_order_does_not_matter_but_paragraphs_do(frame):
    a, b, c, d, e = vectors(frame, "one\ntwo\nthree", "three\n\none\ntwo", "one two\nthree", "one\ntwo\ntwo", "one\ntwo")
    assert a == b and a != c and d != e


def plain_hash(spark, values, seed):
    """Spark's own hash of texts, one by one."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    column = F.xxhash64("v") if seed is None else F.xxhash64(F.lit(seed), "v")
    found = {r.i: r.h for r in rows.select("i", column.alias("h")).collect()}
    return [found[i] for i in range(len(values))]


def plain_blocks(spark, text):
    words = text.split(" ")
    ends = plain_hash(spark, words, None)
    blocks, run = [], ""
    for i, (word, h) in enumerate(zip(words, ends)):
        *before, word = word.split("\n")
        for part in before:
            blocks.append(run + part)
            run = ""
        run += word
        if h % 8 == 0 or i == len(words) - 1:
            blocks.append(run)
            run = ""
        else:
            run += " "
    return [b for b in blocks if b]


def test_vector_is_that_of_plain_loops(spark, frame):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)] + ["é", ""]
    for text in ["", "one", "a b\n\nc d e\n", " ".join(rng.choices(words, k=300)), "\n".join(" ".join(rng.choices(words, k=9)) for _ in range(30))]:
        blocks = plain_blocks(spark, text)
        lanes = [[0, 0, 0, 0] for _ in range(45)]
        for seed in range(3):
            for h in plain_hash(spark, blocks, seed) if blocks else []:
                for j in range(15):
                    for k in range(4):
                        lanes[15 * seed + j][k] += (h % 2**64) >> (j + 15 * k) & 1
        near = [sum((v % 2**14) << (15 * k) for k, v in enumerate(four)) for four in lanes]
        exact = [0] * 8
        parts = [p for p in text.split("\n") if p]
        for i in range(8):
            for h in plain_hash(spark, parts, i) if parts else []:
                low, high = h % 2**64 & (2**30 - 1), h % 2**64 >> 31 & (2**30 - 1)
                exact[i] += low | high << 31
                exact[i] &= (2**30 - 1) | (2**30 - 1) << 31
        (found,) = vectors(frame, text)
        assert list(found) == [len(blocks), *near, *exact], text[:30]


def near(frame, *pairs):
    docs = frame("i int, a string, b string", *[(i, a, b) for i, (a, b) in enumerate(pairs)])
    value = mh.likeness(multiset_vector(docs.a), multiset_vector(docs.b))
    return [r.v for r in docs.select("i", value.alias("v")).orderBy("i").collect()]


def test_likeness_follows_what_is_shared(frame):
    rng = random.Random(5)

    def text(n=550):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n))

    texts = [text() for _ in range(30)]
    put_in = [(t, t[:at] + "x" + t[at:]) for t in texts for at in (0, rng.randrange(len(t)), len(t))]
    assert min(len(t) for t in texts) > 2_500 and min(near(frame, *put_in)) > 0.9
    assert max(near(frame, *zip(texts, texts[1:]))) < 0.3
    halves = [(t, t[: len(t) // 2] + text(275)) for t in texts]
    found = near(frame, *halves)
    assert all(0.25 < v < 0.75 for v in found) and 0.45 < sum(found) / len(found) < 0.55
    assert near(frame, ("", ""), ("a", ""), ("a", "a")) == [1.0, 0.0, 1.0]


def test_putting_in_and_taking_out(frame):
    docs = frame("t string, u string, both string", ("a b\nc" * 50, "d\ne" * 70, "a b\nc" * 50 + "\n" + "d\ne" * 70))
    t, u, both = (multiset_vector(docs[c]) for c in docs.columns)
    r = docs.select(
        combined(t, u).alias("sum"), both.alias("both"), without(both, u).alias("less"), t.alias("t")
    ).first()
    assert r.sum == r.both and r.less == r.t


def test_null_empty_long_and_clashing_columns(frame):
    docs = frame(
        "doc_id bigint, text string, range int, head string",
        (1, None, 0, ""), (2, "", 0, ""), (3, "\n\n", 0, ""), (None, "z" * 300_000, 0, ""), (4, "same", 0, ""), (4, "same", 0, ""),
    )
    rows = fingerprint_digest(docs).collect()
    found = {(r.doc_id, r.n_chars): r for r in rows}
    assert found[1, 0].fingerprint == found[2, 0].fingerprint == found[3, 2].fingerprint
    assert set(found[2, 0].fingerprint) == {"0"} and len(found) == 5
    assert max(r.near_next for r in rows if r.doc_id == 4) == 1.0
    assert fingerprint_digest(docs.limit(0)).collect() == []
    assert fingerprints(docs).count() == 6


def check_neighbours(spark, docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in fingerprint_digest(docs).collect()}
    assert set(found) == set(texts)
    wins = 0
    for i, doc_id in enumerate(order):
        own, other = texts[doc_id], texts[order[(i + 1) % len(order)]]
        cut = len(own) // 3
        edited = own[: len(own) - cut] + other[:cut]
        r = found[doc_id]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        wins += r.near_edited > r.near_next
    by_text = {}
    for doc_id, text in texts.items():
        assert by_text.setdefault(text, found[doc_id].fingerprint) == found[doc_id].fingerprint
    assert wins > 0.9 * len(order)


def test_neighbours_in_one_range(spark):
    check_neighbours(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))


@pytest.mark.parametrize("quantiles", [512, 3])
def test_neighbours_across_ranges(spark, monkeypatch, quantiles):
    monkeypatch.setattr(mh, "ROWS_PER_RANGE", 13)
    monkeypatch.setattr(mh, "QUANTILES", quantiles)
    check_neighbours(spark, spark.read.parquet(f"{SMALL}/documents.parquet").where(F.col("doc_id") % 7 != 3))
