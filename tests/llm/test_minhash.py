"""Components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from balcao.llm import minhash
from balcao.llm.components import components
from balcao.llm.minhash import near_duplicates
from tests.conftest import MEDIUM


def members(text, width):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def expected(rows, width, percent):
    sets = [members(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        for other in {j for t in s for j in index.get(t, ())}:
            common = len(s & sets[other])
            if 100 * common >= percent * len(s | sets[other]):
                a, b = find(i), find(other)
                parent[max(a, b, key=lambda k: rows[k][0])] = min(a, b, key=lambda k: rows[k][0])
        for t in s:
            index.setdefault(t, []).append(i)
    return {(rows[i][0], len(sets[i]), rows[find(i)][0], find(i) == i or rows[find(i)][0] == rows[i][0]) for i in range(len(rows))}


def found(df):
    return {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def made_up():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \t", "one", "ONE", "one two", "two one", "One\x0btwo", "é É", "x y z"]
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(3, 120))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("block", [2_000, 3])
def test_made_up_families(frame, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    rows = made_up()
    docs = frame("doc_id bigint, text string, node int, label int", *[(i, t, 0, 0) for i, t in rows])
    assert found(near_duplicates(docs, width=3)) == expected(rows, 3, 85)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(near_duplicates(docs, width=3)) == expected(rows, 3, 85)


def test_null_ids_repeated_rows_and_no_rows(frame):
    docs = frame("doc_id bigint, text string", (1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, ""))
    rows = near_duplicates(docs, width=3).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("1", "1", True), ("1", "1", True), ("None", "1", False), ("None", "None", True)
    ]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(frame):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    rows = components(frame("u bigint, v bigint", *edges)).collect()
    labels = {r.node: r.label for r in rows}
    assert len(rows) == len(labels) == 100
    assert {labels[i] for i in range(1, 41)} == {1} and {labels[i] for i in range(100, 160)} == {100}


@pytest.mark.parametrize("linked", [0, 150, 297])
def test_nodes_of_a_hot_value_meet_once_in_bounded_groups(frame, monkeypatch, linked):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 40)
    postings = frame("key bigint, node bigint", *[(7, i) for i in range(300)], (8, 1), (8, 299))
    labels = frame("node bigint, label bigint", (-1, -1), *[(i, 0) for i in range(linked)])
    groups, met = {}, {}
    for r in minhash._blocks(postings, labels).collect():
        groups.setdefault((r.key, r.block), []).append(r)
    for (key, _), rows in groups.items():
        assert len(rows) <= 3 * 40  # two blocks, dealt by hash
        for i, a in enumerate(rows):
            for b in rows[:i]:
                if a.label != b.label and (a.side != b.side or a.side == 0):
                    pair = (key, min(a.node, b.node), max(a.node, b.node))
                    met[pair] = met.get(pair, 0) + 1
    wanted = {(7, i, j) for i in range(300) for j in range(i + 1, 300) if j >= linked}
    assert met == dict.fromkeys(wanted | {(8, 1, 299)}, 1)


def test_boilerplate_below_the_limit(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 8)
    rng = random.Random(8)
    shared = [f"b{i}" for i in range(60)]
    texts = [" ".join(shared + [f"own{i}x{j}" for j in range(14)]) for i in range(60)]
    texts += [" ".join(shared + [f"own{i}x{j}" for j in range(13)] + [f"new{i}"]) for i in rng.sample(range(60), 9)]
    rows = list(enumerate(texts))
    assert found(near_duplicates(frame("doc_id bigint, text string", *rows), width=3)) == expected(rows, 3, 85)


@pytest.mark.parametrize("block", [2_000, 60])
def test_many_texts_around_the_limit(frame, monkeypatch, block):
    """A family of which few pairs are linked: all its pairs are looked at, few rows come out."""
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    edges = []

    def counted(links):
        edges.append(links.select("u", "v").distinct().count())
        return components(links)

    monkeypatch.setattr(minhash, "components", counted)
    rng = random.Random(21)
    shared = [f"b{i}" for i in range(100)]
    texts = []
    for i in range(500):
        words = list(shared)
        for _ in range(rng.choice([2, 2, 3, 3, 4])):
            words[rng.randrange(100)] = f"own{i}x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    wanted = expected(rows, 3, 85)
    assert found(near_duplicates(frame("doc_id bigint, text string", *rows), width=3)) == wanted
    assert 1 < len({w[2] for w in wanted}) < 500 and sum(edges) < 40 * len(texts)


def test_sets_are_compared_with_many_as_with_one():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(80)]
    for percent in (50, 85):
        own = minhash._Sets(sets)
        for one in range(80):
            for others in (np.arange(80), np.array([one, 3])):
                assert list(own.reached(one, others, percent)) == [k for k in others if minhash._reaches(sets[one], sets[k], percent)]
