"""Packing against what any packing must satisfy, and the ids against the library's own."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from balcao.llm.packing import CAPACITY, cut_lengths, pack_documents, piece_class
from balcao.llm.queries import tokenizer_path
from tests.conftest import SMALL

PATH = tokenizer_path("word_bpe_49k.json")


def texts():
    return [
        None, "", " ", "word", "A b\tc\n\nd\x0be\x1cf", "näive d'accord it's 123", " x y",
        "one " * 5000, "x" * 3000, "<|endoftext|> mid<|startoftext|>dle", "\U0001f600 你好",
        *["short text number %d" % i for i in range(300)], *["lorem ipsum dolor " * i for i in range(60)],
    ]


def check(rows, texts_by_id, most_padding):
    library = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts_by_id)
    for doc_id, pieces in by_doc.items():
        ids = library.encode(texts_by_id[doc_id] or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], dtype="<u4"))
            at += p.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= CAPACITY
        padding += 0 if at & (at - 1) == 0 else CAPACITY - at
        total += at
    assert padding <= most_padding * total + CAPACITY


def test_pieces_and_sequences(frame):
    docs = frame("doc_id bigint, text string, class int", *[(i, t, 0) for i, t in enumerate(texts())])
    rows = pack_documents(docs.repartition(5), PATH).collect()
    check(rows, dict(enumerate(texts())), 0.1)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = {r.doc_id: r.text for r in docs.collect()}
    check(pack_documents(docs, PATH).collect(), known, 0.01)


def test_with_ids_and_no_rows(frame):
    docs = frame("doc_id bigint, text string", (1, "a few words"), (1, "a few words"))
    rows = pack_documents(docs, PATH, with_ids=True).collect()
    assert len(rows) == 2 and all(len(r.ids) == r.length == r.doc_tokens for r in rows)
    assert pack_documents(docs.limit(0), PATH).collect() == []


@pytest.mark.parametrize("tokens", [1, 63, 64, 127, 128, 130, 1030, 2047, 2048, 2049, 10_000])
def test_cuts_add_up_and_leave_no_crumbs(tokens):
    lengths = cut_lengths(tokens)
    assert sum(lengths) == tokens
    assert all(n >= 64 or n == tokens or tokens > 2048 for n in lengths)


def test_classes():
    assert [piece_class(n) for n in (2048, 1024, 64, 65, 127, 3)] == [-2048, -1024, -64, 31, 16, 682]


def test_words_straight_from_the_model_equal_the_library():
    from balcao.llm.word_ids import WordEncoder

    encoder = WordEncoder(PATH)
    assert encoder._by_model
    for code in [*range(33, 0x500), 0x2019, 0x2028, 0x4E2D]:
        for word in (chr(code), f"a{chr(code)}", f"Éx{chr(code)}", f"A{chr(code)}b", f"a,{chr(code)}"):
            found = encoder._simple(word)
            assert found is None or found == encoder._library(word), repr(word)
