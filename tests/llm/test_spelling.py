"""Words, near words and roots against loops over all pairs."""

import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from balcao.llm import spelling as module
from balcao.llm.letter_tree import code_points, grow_boxes, letter_counts, packed_counts, pairs_within
from balcao.llm.spelling import spelling_variants, variant_groups, words_of
from tests.conftest import MEDIUM

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected_words(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))



def expected(words):
    by_hole = {}
    for w in words:
        for i in range(len(w)):
            by_hole.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by_hole.setdefault(w, set()).add(w)
    form, near = {}, {}
    for w, n in words.items():
        some = set().union(by_hole[w], *(by_hole[w[:i] + w[i + 1 :]] for i in range(len(w))))
        some = {o for o in some if one_apart(w, o)}
        near[w] = len(some)
        best = min(some, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    rows = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (w, form[w], root, n, near[w], words.get(form[w]))
    return rows


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r) for r in rows}


def family(rng, size):
    """Words of few letters with many near ones, in three orders of frequency."""
    words = {}
    while len(words) < size:
        word = "".join(rng.choices("abé", k=rng.randrange(7, 10)))
        words[word] = rng.choice([2, 3, 25, 300, 4_000])
    return words


@pytest.mark.parametrize("small", [False, True])
def test_dense_words(frame, monkeypatch, small):
    if small:  # many boxes, cut into blocks
        for name, value in (("BOX_WORDS", 40), ("BLOCK_WORDS", 16), ("BLOCK_ASKED", 64), ("SAMPLE_WORDS", 500)):
            monkeypatch.setattr(module, name, value)
    words = family(random.Random(4), 1_500)
    words |= {"a" * 40: 2, "a" * 41: 30, "a" * 20 + "é" + "a" * 19: 20, "\U0001d11e" * 8: 2, "\U0001d11e" * 9: 50}
    df = frame("word string, n bigint", *words.items())
    assert found(variant_groups(df)) == expected(words)


def test_anagrams_share_a_box(frame, monkeypatch):
    monkeypatch.setattr(module, "BOX_WORDS", 50)
    monkeypatch.setattr(module, "BLOCK_WORDS", 64)
    rng, letters, words = random.Random(6), list("abcdefghi"), {}
    while len(words) < 1_000:
        rng.shuffle(letters)
        words["".join(letters)] = rng.choice([2, 20])
    some = list(words)
    words |= {w[:3] + w[4:]: 40 for w in some[:50]} | {w + "a": 400 for w in some[20:60]}
    assert found(variant_groups(frame("word string, n bigint", *words.items()))) == expected(words)


def test_words_of_documents(frame):
    texts = ["Spelling spellings SPELLING spelling", "ÀÀrdvark àÀrdvark", "x" * 100_000, None, "", "sh×rt÷run shorter-run_shorter"]
    docs = [(i, t) for i, t in enumerate(texts * 3)] + [(None, "without without"), (None, "without")]
    df = frame("doc_id bigint, text string, word string, n int", *[(i, t, "x", 0) for i, t in docs])
    words = {r.word: r.n for r in words_of(df).collect()}
    assert words == expected_words(docs) and {"spelling", "shorter", "without"} <= set(words)
    assert found(spelling_variants(df)) == expected(words)
    assert spelling_variants(df.limit(0)).collect() == []


def test_deleted_letters(frame):
    docs = [(i, "spelling variant grouping " * (i % 3)) for i in range(400)]
    words = {r.word: r.n for r in words_of(frame("doc_id bigint, text string", *docs)).collect()}
    assert words == expected_words(docs) and len(words) > 5


def test_boxes_hold_and_reach():
    rng = random.Random(1)
    words = list(family(rng, 800))
    points = packed_counts(*code_points(words)), np.array([len(w) for w in words])
    boxes = grow_boxes(*points, 30, 64)
    who, own = boxes.reached(*points, 0)
    assert sorted(who.tolist()) == list(range(len(words))) and boxes.leaves > 10
    box = dict(zip(who.tolist(), own.tolist()))
    who, reached = boxes.reached(*points, 2)
    pairs = set(zip(who.tolist(), reached.tolist()))
    for i in rng.sample(range(len(words)), 60):
        assert all((i, box[j]) in pairs for j in range(len(words)) if one_apart(words[i], words[j]) or i == j)
    assert len(pairs) < 0.7 * len(words) * boxes.leaves


def test_pairs_within_reach():
    rng = random.Random(9)
    words = list(family(rng, 400)) + ["a" * n for n in range(1, 9)] + ["ab" * 30, "ab" * 30 + "a"]
    codes, counts = packed_counts(*code_points(words)), np.minimum(letter_counts(*code_points(words)), 4)
    apart = np.abs(counts[:, None, :] - counts[None, :, :]).sum(axis=2)
    for reach in (0, 1, 2):
        found = {(int(q), int(p)) for q, p in ((q, p) for qs, ps in pairs_within(codes, codes[:150], reach) for q, p in zip(qs, ps))}
        assert found == {(int(q), int(p)) for q, p in zip(*np.nonzero(apart[:150] <= reach))}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    words = expected_words([(r.doc_id, r.text) for r in docs.collect()])
    assert found(spelling_variants(docs)) == expected(words) and len(words) > 5_000
