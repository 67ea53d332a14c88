"""Encode and decode texts with a SentencePiece model through the Tokenizers library.

The model file is parsed here (``spmodel``) and rebuilt as a Tokenizers pipeline: normaliser,
space marker, unigram scores or merges in score order, byte fallback. Batches are encoded
multithreaded in bounded slices. Where no piece reaches across the start of a word, a
task encodes every distinct word once, with the spaces before it, many to a string and many
strings to a batch, and puts the texts together from what it remembers (up to ``KEPT_BYTES``).
``parity`` compares the ids of every whole text with those of the SentencePiece library itself.

Null texts count as empty, and empty texts have no ids. Repeated rows are encoded each on
their own, an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

from balcao.llm.pretokens import distinct_words
from balcao.llm.spmodel import (
    BPE,
    BYTE,
    MARKER,
    NORMAL,
    UNIGRAM,
    USER_DEFINED,
    PieceModel,
    load_model,
)
from balcao.llm.word_ids import plain_texts

SLICE_CHARACTERS = 1_000_000  # encodings take about a hundred bytes a token while they exist
JUDGED = 64  # texts compared in one call
JOINED = 256  # words encoded as one string
KEPT_BYTES = 96_000_000  # of words, ids and their numbers
SEPARATOR = "\0"  # one byte piece of its own


def _texts(column: pa.Array) -> list[str]:
    return column.cast(pa.large_string()).fill_null("").to_pylist()


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs of pieces that make up a piece, the best-scored piece first."""
    known = {text: score for text, score, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    ranked = sorted(
        ((text, score, i) for i, (text, score, kind) in enumerate(model.pieces) if kind == NORMAL),
        key=lambda piece: (-piece[1], piece[2]),
    )
    return [
        (text[:cut], text[cut:])
        for text, _, _ in ranked
        for cut in range(1, len(text))
        if text[:cut] in known and text[cut:] in known
    ]


def rebuild(model: PieceModel) -> Tokenizer:
    """A Tokenizers pipeline with the model's ids."""
    unknown = model.pieces[model.unk_id][0]
    if model.kind == UNIGRAM:
        vocabulary = [(text, score) for text, score, _ in model.pieces]
        core = models.Unigram(vocabulary, model.unk_id, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {text: i for i, (text, _, _) in enumerate(model.pieces)},
            _merges(model),
            unk_token=unknown,
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"models of kind {model.kind} are not supported")
    tokenizer = Tokenizer(core)
    steps = []
    if model.character_map:
        steps.append(normalizers.Precompiled(model.character_map))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARKER))
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    undo = [decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.add_dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    fixed = [text for text, _, kind in model.pieces if kind == USER_DEFINED]
    if fixed:
        tokenizer.add_tokens([AddedToken(text, normalized=False) for text in fixed])
    return tokenizer


def stays_in_words(model: PieceModel) -> bool:
    """Whether a text's ids are those of its words, each with the spaces before it."""
    plain = model.escape_whitespaces and model.add_dummy_prefix and model.byte_fallback
    plain = plain and not model.character_map and not model.remove_extra_whitespaces
    return plain and not any(
        kind == USER_DEFINED or SEPARATOR in text or MARKER in text.lstrip(MARKER) for text, _, kind in model.pieces
    )


class WordPieces:
    """Ids of words with the spaces before them, remembered up to a bounded size."""

    def __init__(self, model: PieceModel):
        self.tokenizer = rebuild(model)
        # Words come with their markers.
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.separator = next(i for i, (text, _, kind) in enumerate(model.pieces) if kind == BYTE and text == "<0x00>")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.bytes = 0
        self.firsts = np.zeros(1 << 12, dtype=np.int64)  # of each word, and one more
        self.right = np.zeros(1 << 12, dtype=bool)  # decoding gives the word back
        self.pool = np.empty(1 << 14, dtype=np.int32)

    def _coded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spoken(self, batches: list[list[int]]) -> list[str]:
        """What ids stand for, the space before the first word included."""
        # One by one: threads cost the library more than they save here.
        return [f" {self.tokenizer.decode(ids, skip_special_tokens=False)}" for ids in batches]

    def _learn(self, words: list[str]) -> None:
        plain = [word for word in words if SEPARATOR not in word]
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        joined = [SEPARATOR.join(group) for group in groups]
        coded = self._coded([text.replace(" ", MARKER) for text in joined])
        for group, text, ids, spoken in zip(groups, joined, coded, self._spoken(coded)):
            ids = np.array(ids, dtype=np.int32)
            cuts = np.flatnonzero(ids == self.separator)
            bounds = np.concatenate([[-1], cuts, [len(ids)]])
            right = np.full(len(group), spoken == text)
            if spoken != text:
                parts = [ids[a + 1 : b].tolist() for a, b in zip(bounds, bounds[1:])]
                right[:] = [back == word for back, word in zip(self._spoken(parts), group)]
            self._add(group, ids[ids != self.separator], np.diff(bounds) - 1, right)
        odd = [word for word in words if SEPARATOR in word]
        for word, ids in zip(odd, self._coded([word.replace(" ", MARKER) for word in odd])):
            right = np.array([self._spoken([ids])[0] == word])
            self._add([word], np.array(ids, dtype=np.int32), np.array([len(ids)]), right)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray, right: np.ndarray) -> None:
        count = len(self.known)
        first, last = int(self.firsts[count]), count + len(words)
        if first + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (first + len(ids)))
        if last + 1 > len(self.firsts):
            self.firsts, self.right = np.resize(self.firsts, 2 * (last + 1)), np.resize(self.right, 2 * (last + 1))
        self.pool[first : first + len(ids)] = ids
        self.firsts[count + 1 : last + 1] = first + np.cumsum(sizes)
        self.right[count:last] = right
        self.known.update(zip(words, range(count, last)))
        self.bytes += 200 * len(words) + 5 * sum(map(len, words)) + 4 * len(ids)

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of each text, and whether decoding them gives all its words back."""
        if self.bytes > KEPT_BYTES:
            self.forget()
        words, numbers, starts = distinct_words(texts)
        known = self.known
        self._learn([word for word in words if word not in known])
        places = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))[numbers]
        firsts = self.firsts[places]
        wanted = self.firsts[places + 1] - firsts
        reached = np.concatenate([[0], np.cumsum(wanted)])
        ids = self.pool[np.repeat(firsts - reached[:-1], wanted) + np.arange(reached[-1])]
        ends = reached[starts].tolist()
        wrong = np.concatenate([[0], np.cumsum(~self.right[places])])
        return [ids[a:b] for a, b in zip(ends, ends[1:])], wrong[starts[1:]] == wrong[starts[:-1]]


class PieceCodec:
    """Encoder and decoder of batches for one model file."""

    def __init__(self, path: str):
        self.model = load_model(path)
        self.tokenizer = rebuild(self.model)
        self.words = WordPieces(self.model) if stays_in_words(self.model) else None

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.int32) for e in found]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; encodes a bounded number of bytes at a time."""
        return (ids for ids, _ in self.encode_and_back(texts))

    def encode_and_back(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether decoding them gives the text back."""
        sizes = np.asarray(pc.binary_length(plain_texts(texts)), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_CHARACTERS)) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
            part = texts.slice(first, last - first)
            if self.words is not None:
                coded, right = self.words.encode(part)
                # The marker itself reads as a space.
                plain = ~np.asarray(pc.match_substring(plain_texts(part), MARKER))
                yield from zip(coded, (right & plain).tolist())
            else:
                values = _texts(part)
                coded = self._whole(values)
                back = self.decode([ids.tolist() for ids in coded])
                yield from ((ids, text == value) for ids, text, value in zip(coded, back, values))

    def forget(self) -> None:
        """Drop all words: workers outlive their tasks, and others need the room."""
        if self.words is not None:
            self.words.forget()

    def encode_whole(self, text: str) -> np.ndarray:
        """Ids of one text, put through all steps at once."""
        return self._whole([text])[0]

    def decode(self, batches: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(batches, skip_special_tokens=False)


@lru_cache(maxsize=2)
def _codec(path: str) -> PieceCodec:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    return PieceCodec(path)


def encode_pieces(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column`` and ``ids``, the text's piece ids."""
    id_type = dict(docs.dtypes)[id_column]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            lists = pa.array(codec.encode(batch.column(1)), pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), lists], names=[id_column, "ids"])
        codec.forget()

    schema = f"`{id_column}` {id_type}, ids array<int>"
    return docs.select(id_column, text_column).mapInArrow(encode, schema)


def decode_pieces(encoded: DataFrame, model_path: str, id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``text``: what the ids stand for. Null ids give a null text."""
    id_type = dict(encoded.dtypes)[id_column]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            texts = codec.decode([ids or [] for ids in lists])
            kept = [None if ids is None else text for ids, text in zip(lists, texts)]
            yield pa.record_batch([batch.column(0), pa.array(kept, pa.string())], names=[id_column, "text"])

    schema = f"`{id_column}` {id_type}, text string"
    return encoded.select(id_column, "ids").mapInArrow(decode, schema)


@lru_cache(maxsize=2)
def _judge(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def encode_checked(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Digest of every text's ids: ``n_ids``, ``ids_crc32`` (little-endian 32-bit ids),
    ``parity`` (the SentencePiece library gives the same ids) and ``round_trip`` (decoding
    gives the text back)."""
    id_type = dict(docs.dtypes)[id_column]

    def judged(codec: PieceCodec, judge, texts: list[str], coded: list) -> Iterator[tuple]:
        """Digests of a few texts, which the library takes all at once."""
        for text, (ids, back), wanted in zip(texts, coded, judge.encode(texts, num_threads=1)):
            parity = ids.tolist() == wanted
            if not parity:
                ids = codec.encode_whole(text)
                parity, back = ids.tolist() == wanted, codec.decode([ids.tolist()])[0] == text
            yield len(ids), zlib.crc32(ids.astype("<u4")), parity, back

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, judge = _codec(model_path), _judge(model_path)
        for batch in batches:
            texts, found = batch.column(1), []
            coded = codec.encode_and_back(texts)
            for first in range(0, len(texts), JUDGED):
                some = _texts(texts.slice(first, JUDGED))
                found += judged(codec, judge, some, list(islice(coded, len(some))))
            columns = list(zip(*found)) if found else [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.record_batch(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=[id_column, "n_ids", "ids_crc32", "parity", "round_trip"],
            )
        codec.forget()

    schema = f"`{id_column}` {id_type}, n_ids bigint, ids_crc32 bigint, parity boolean, round_trip boolean"
    return docs.select(F.col(id_column), F.col(text_column)).mapInArrow(digest, schema)
