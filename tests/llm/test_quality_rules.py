"""Rule statistics against plain loops, the forest against its definition, verdicts on held-out labels."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from balcao.llm.isolation import grow_forest, usual_path
from balcao.llm.quality_rules import best_threshold, quality_digest, quality_verdicts
from tests.conftest import MEDIUM

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    words = WORD.findall(text or "")
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, run in enumerate(runs) if runs.count(run) > 1 for k in range(3)} if len(runs) < 3_000 else None
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    repeats = None if covered is None else len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, repeats


ODD = (
    None, "", " \t\n", "a a a a", "x y z x y z", "one\ntwo\none\n\n \n \none", "é#ü* $%&|<>   　x", "a b c " * 40,
    "tab\tand\x0bvertical\x0cfeed\rreturn a b", " lead", "trail \n lead\n lead", "𝄞𝄞 𝄞𝄞 𝄞𝄞 𝄞𝄞",
)


def test_counts(frame):
    rng = random.Random(3)
    texts = [*ODD, *["".join(rng.choices("ab #\n\t<é", k=rng.randrange(400))) for _ in range(300)]]
    docs = frame("doc_id bigint, text string", *enumerate(texts))
    rows = {r.doc_id: r for r in quality_digest(docs, frame("doc_id bigint, quality int")).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected(text), repr(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed) and r.anomaly is None  # nothing is labelled


def test_very_long_text(frame):
    words = [f"w{i}" for i in range(2_200_000)]  # more distinct words than fit into 21 bits
    text = " ".join([*words, *words[:1_000]])
    (row,) = quality_digest(frame("doc_id bigint, text string", (1, text)), frame("doc_id bigint, quality int")).collect()
    assert (row.n_words, row.n_repeat_words) == (2_201_000, 2_000)


def test_paths_of_the_forest():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(600, 3))
    rows[0] = 30, 30, 30
    forest = grow_forest(rows, 50, 256, 4)
    anomaly = forest.anomaly(rows)
    assert anomaly.argmax() == 0 and anomaly[0] > 0.7 > 0.6 > np.median(anomaly)

    def path(tree, row):
        at, length = 0, 0
        while tree.below[at] != at:
            at = tree.below[at] if row[tree.column[at]] < tree.cut[at] else tree.above[at]
            length += 1
        return length, tree.path[at]

    for tree in forest.trees[:5]:
        for row in rows[:40]:
            length, found = path(tree, row)
            assert length <= found <= length + usual_path(256) and tree.paths(row[None])[0] == found
    wanted = [2 ** -(np.mean([path(t, row)[1] for t in forest.trees]) / usual_path(256)) for row in rows[:20]]
    assert np.allclose(anomaly[:20], wanted)
    assert grow_forest(rows[:1], 5, 256, 1) is None and grow_forest(np.ones((9, 2)), 5, 256, 1) is None
    assert usual_path(1) == 0 and usual_path(2) == 1


def test_threshold(frame):
    rows = [(0.40 + i / 1000, 1) for i in range(100)] + [(0.7, 0)] * 30 + [(0.45, 0)]
    assert 0.5 < best_threshold(frame("anomaly double, quality int", *rows)) <= 0.7
    assert best_threshold(frame("anomaly double, quality int", (0.5, 1))) is None


@pytest.mark.parametrize("part", [0, 1])
def test_held_out_labels(spark, part):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 2 == part
    rows = quality_digest(docs, labels.where(~held_out)).join(labels.where(held_out), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [not r.kept for r in rows if r.quality == 0]
    assert len(bad) > 5 and sum(bad) >= 0.95 * len(bad) and sum(good) >= 0.97 * len(good)


def test_nulls_repeats_and_clashing_names(spark, frame):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "a", 1.0), (1, text, "a", 1.0), (1, "other", "b", 2.0), (None, text, "c", 3.0), (2, None, None, None)]
    docs = frame("doc_id bigint, text string, kept string, quality double", *rows)
    labels = frame("doc_id bigint, quality int, text string", (1, 1, ""), (1, 0, ""), (None, 0, ""), (2, None, ""), (1, 7, ""))
    found = quality_verdicts(docs, labels)
    assert sorted((r.doc_id or 0, r.n_words) for r in found.collect()) == [(0, 60), (1, 1), (1, 60), (1, 60), (2, 0)]
    assert found.columns.count("kept") == 1 and "quality" in found.columns
    assert quality_digest(docs.limit(0), labels).collect() == []


def test_whole_table(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_digest(docs, labels).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        wanted = expected(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == wanted[:4]
        assert wanted[4] in (None, r.n_repeat_words)
        assert not (r.base_failed and r.kept)
