"""Token counts against plain dynamic programming; piece ids against the SentencePiece library."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from balcao.llm import token_counts as tc
from balcao.llm.piece_codec import PieceCodec, decode_pieces, encode_checked, encode_pieces, rebuild, stays_in_words
from balcao.llm.pretokens import distinct_words, spaced_words, sums_per_text
from balcao.llm.queries import tokenizer_path
from balcao.llm.spmodel import BPE, MARKER, NORMAL, UNIGRAM, UNKNOWN, PieceModel, load_model, parse_model
from balcao.llm.token_counts import TrieCounter, token_counts
from tests.conftest import SMALL

PATH = tokenizer_path("piece_bpe_32k.model")


def texts():
    rng = random.Random(8)
    edge = [None, "", " ", "   ", "a", " a", "a ", "a  b", "▁ ▁x", "\n", "naïve 𝕏\tz", "한국어 梦", "x" * 5000, "  " * 40 + "end"]
    return edge + ["".join(rng.choices("  ab\né▁한𝕏.", k=rng.randint(0, 60))) for _ in range(200)]


def plain_count(counter, text):
    """Best segmentation of a whole text, without pre-tokens or sharing."""
    marked = (MARKER + text.replace(" ", MARKER)) if text else ""
    best = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        options = []
        for start in range(max(0, end - counter.longest), end):
            if marked[start:end] in counter.scores:
                options.append((best[start][0] + counter.scores[marked[start:end]], best[start][1] - 1))
        if marked[end - 1] not in counter.scores:
            size = len(marked[end - 1].encode()) if counter.byte_fallback else 1
            options.append((best[end - 1][0] + counter.unknown, best[end - 1][1] - size))
        best.append(max(options))
    return -best[-1][1]


def test_counts_equal_plain_dynamic_programming(frame):
    rows = [(i, t, 0) for i, t in enumerate(texts())]
    docs = frame("doc_id bigint, text string, n_tokens int", *rows)
    counter = TrieCounter(load_model(PATH))
    found = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts(docs, PATH).collect()}
    assert found == {i: (len(spaced_words(t or "")), plain_count(counter, t or "")) for i, t, _ in rows}
    assert token_counts(docs.limit(0), PATH).collect() == []


def test_counts_equal_the_unigram_library_on_a_small_model():
    from tokenizers import Tokenizer, models

    pieces = [("<unk>", 0.0, UNKNOWN)] + [
        (p, s, NORMAL) for p, s in [(MARKER, -3.1), ("a", -2.3), ("b", -2.7), ("ab", -3.9), (MARKER + "a", -4.4), ("bab", -6.2), ("aab", -5.05)]
    ]
    counter = TrieCounter(PieceModel(pieces, UNIGRAM))
    library = Tokenizer(models.Unigram([(p, s) for p, s, _ in pieces], 0, False))
    rng = random.Random(1)
    words = [MARKER + "".join(rng.choices("ab", k=rng.randint(1, 14))) for _ in range(300)]
    found = counter.counts(words)
    assert found == {w: len(library.encode(w).ids) for w in words}


def test_words_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr(tc, "KEPT_WORDS", 3)
    counter, fresh = TrieCounter(load_model(PATH)), TrieCounter(load_model(PATH))
    for words in (["▁a", "▁ab", "▁abc", "▁b"], ["▁ab", "▁zebra"], ["▁zebras", "▁a"]):
        assert counter.counts(words) == fresh.counts(words)


def test_distinct_words():
    values = texts()
    words, numbers, starts = distinct_words(pa.array(values))
    for i, text in enumerate(values):
        assert [words[n] for n in numbers[starts[i] : starts[i + 1]]] == spaced_words(text or "")
    ones = np.ones(len(words), dtype=np.int64)
    assert sums_per_text(ones, numbers, starts).tolist() == [len(spaced_words(t or "")) for t in values]


def test_ids_equal_the_library_and_decode_back(frame):
    values = texts()
    judge = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = frame("doc_id bigint, text string, ids string", *[(i, t, "") for i, t in enumerate(values)])
    encoded = encode_pieces(docs, PATH)
    found = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert found == {i: judge.encode(t or "") for i, t in enumerate(values)}
    back = {r.doc_id: r.text for r in decode_pieces(encoded, PATH).collect()}
    # The marker itself reads as a space, there as here.
    assert back == {i: (t or "").replace(MARKER, " ") for i, t in enumerate(values)}
    digests = {r.doc_id: r for r in encode_checked(docs, PATH).collect()}
    assert all(r.parity for r in digests.values())
    assert all(digests[i].round_trip == (MARKER not in (t or "")) for i, t in enumerate(values))
    assert encode_checked(docs.limit(0), PATH).collect() == []


def test_parity_on_the_table(spark):
    rows = encode_checked(spark.read.parquet(f"{SMALL}/documents.parquet"), PATH).collect()
    assert len(rows) == 200 and all(r.parity and r.round_trip for r in rows)


def test_model_files_are_read():
    model = load_model(PATH)
    judge = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(model.pieces) == judge.vocab_size() and model.byte_fallback
    for i in (0, 1, 5, 300, 31_999):
        assert model.pieces[i][0] == judge.id_to_piece(i)
        assert model.pieces[i][1] == pytest.approx(judge.get_score(i))
    assert parse_model(b"").pieces == []


def test_unigram_models_are_rebuilt():
    pieces = [("<unk>", 0.0, UNKNOWN), ("▁", -3.0, NORMAL), ("▁a", -1.0, NORMAL), ("b", -2.0, NORMAL), ("a", -4.0, NORMAL)]
    tokenizer = rebuild(PieceModel(pieces, UNIGRAM, remove_extra_whitespaces=False))
    assert tokenizer.encode("ab a").tokens == ["▁a", "b", "▁a"]
    with pytest.raises(ValueError, match="kind"):
        rebuild(PieceModel(pieces, kind=4))


def test_long_batches_are_cut(monkeypatch):
    from balcao.llm import piece_codec

    values = pa.array(["some words here"] * 50 + ["", None])
    whole = [ids.tolist() for ids in PieceCodec(PATH).encode(values)]
    monkeypatch.setattr(piece_codec, "SLICE_CHARACTERS", 40)
    assert [ids.tolist() for ids in PieceCodec(PATH).encode(values)] == whole and len(whole) == 52


def test_ids_of_words_are_those_of_whole_texts(monkeypatch):
    from balcao.llm import piece_codec

    codec, judge = PieceCodec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(12)
    values = ["".join(rng.choices(" ab▁é\n\t.☃𝄞0", k=rng.randrange(60))) for _ in range(3_000)] + ["  ", " a", "a ", "", " ▁ "]
    values += ["nul\0in a\0 word \0", "\0"]
    assert codec.words is not None
    found = [ids.tolist() for ids in codec.encode(pa.array(values))]
    assert found == judge.encode(values) == [codec.encode_whole(v).tolist() for v in values]
    back = codec.decode(found)
    assert [right for _, right in codec.encode_and_back(pa.array(values))] == [b == v for b, v in zip(back, values)]
    monkeypatch.setattr(piece_codec, "KEPT_BYTES", 1_000)
    assert [ids.tolist() for v in range(0, 300, 50) for ids in codec.encode(pa.array(values[v : v + 50]))] == found[:300]
    reaching = PieceModel([*codec.model.pieces, ("a▁b", -1.0, NORMAL)], BPE, True)
    assert not stays_in_words(reaching) and not stays_in_words(PieceModel(codec.model.pieces, BPE, character_map=b"x"))
