"""Stages against what they must do, and the registered queries' names."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from balcao.sources.staging import staged
from tests.conftest import SMALL
from tests.llm.test_minhash import expected, members


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(staged(stage(spark, found[-1], SMALL), name))
    return found


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_columns_and_names(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "repeated_strings", "secrets", "packing"
    ]
    for docs in steps[1:-1]:
        assert docs.dtypes == steps[0].dtypes
        assert docs.where(F.col("n_chars") != F.length("text")).isEmpty()


def test_near_duplicates_stage(steps):
    rows = list(texts(steps[1]).items())
    wanted = {r[0] for r in expected(rows, 5, 80) if r[3]}
    assert set(texts(steps[2])) == wanted
    assert members(" a b c d e", 5)


def test_repeated_strings_stage(steps):
    before, after = texts(steps[2]), texts(steps[3])
    assert set(before) == set(after)
    seen = {}
    for doc_id in sorted(before):
        data = before[doc_id].encode()
        covered = bytearray(len(data))
        for p in range(len(data) - 49):
            if seen.get(data[p : p + 50], doc_id) < doc_id:
                covered[p : p + 50] = b"\1" * 50
        for p in range(len(data) - 49):
            seen.setdefault(data[p : p + 50], doc_id)
        kept = bytes(b for b, gone in zip(data, covered) if not gone)
        assert after[doc_id] == kept.decode(errors="ignore")


def test_secrets_stage(steps):
    before, after = texts(steps[3]), texts(steps[4])
    named = re.compile(r'(token = ")[0-9a-f]{40}(?=")|(password=)[0-9a-f]{18}\b|()\bAKIA[0-9A-Z]{16}\b')
    assert after == {i: named.sub(lambda m: (m[1] or m[2] or "") + "[SECRET]", t) for i, t in before.items()}


def test_packing_holds_every_document(steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(texts(steps[4]))
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert all(sum(p.length for p in pieces) == pieces[0].doc_tokens for pieces in by_doc.values())


def test_run_and_registered_names(spark, steps):
    assert corpus_pipeline.run(spark, SMALL).count() == steps[-1].count()
    names = queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(oracle_sql()) <= set(names)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.collect() == []


def test_nulls_repeats_long_texts_and_clashing_names(spark, frame):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    clashes = ("kept", "n_bytes", "n_removed", "n_spans", "toxicity", "label", "tag", "found", "a.b")
    long = " ".join(f"word{i}" for i in range(60_000))
    given = [
        (900_001, None, "en", "s", 0), (900_002, "", None, None, 0), (None, "no id at all", "en", "s", 12),
        (900_003, "twice the same row", "en", "s", 18), (900_003, "twice the same row", "en", "s", 18),
        (900_004, long, "en", "s", len(long)), (900_005, f"{long} password=Winter2024!", "en", "s", len(long) + 21),
    ]
    made = frame(kind, *given).withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in clashes})
    small = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    docs = staged(made.unionByName(small, allowMissingColumns=True), "clashes")
    found = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = staged(stage(spark, found, SMALL), name)
        assert found.dtypes == docs.dtypes
        for c in clashes:
            wanted = F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
            assert found.where(F.col("lang").isNotNull() & (F.col("doc_id") > 900_000) & ~F.col(f"`{c}`").eqNullSafe(wanted)).isEmpty()
    rows = [r for r in found.collect() if r.doc_id is None or r.doc_id > 900_000]
    assert sorted((r.doc_id or 0, (r.text or "")[:12]) for r in rows) == [
        (0, "no id at all"), (900_001, ""), (900_002, ""), (900_003, "twice the sa"), (900_004, "word0 word1 "),
    ]
    pieces = corpus_pipeline.STAGES[-1][1](spark, found, SMALL)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in found.collect()}


def test_all_queries_in_one_session(spark):
    """Queries share a session, its caches and its shared folder."""
    names = [n for n in queries() if n.startswith("op") and n[2].isdigit()] + ["pipeline"]
    assert len(names) == 14
    for name in names:
        rows = queries()[name](spark, SMALL)
        assert rows.columns and rows.count() >= 0, name
