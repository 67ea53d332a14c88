"""Token ids of texts for tokenizers that never join characters across white space.

Each distinct word is encoded once and remembered by the worker, up to a bounded number of
words; texts are then put together from their words' ids.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

KEPT_WORDS = 1_000_000  # distinct words whose ids a worker remembers, about 200 bytes each
SLICE_CHARACTERS = 4_000_000  # texts put together at a time
# A word of Latin letters with one sign behind it, at most: cut where the tokenizer cuts it.
_SIMPLE = re.compile(r"([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~])?")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {byte: chr(byte) for byte in shown}
    for byte in range(256):
        if byte not in table:
            table[byte] = chr(256 + len(table) - len(shown))
    return table


def plain_texts(texts: pa.Array) -> pa.Array:
    """Texts without nulls in buffers of their own (string functions misread some slices)."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()), pa.nulls(0, pa.large_string())])
    return texts.fill_null("")


class WordEncoder:
    """Ids of whole texts, word by word, without special tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = _byte_letters()
        # Lower-cased Latin letters as the model sees them; capitals are lower-cased.
        self._seen = {c: "".join(letters[b] for b in chr(c).lower().encode()) for c in range(65, 256)}
        self._signs: dict[str, list[int]] = {}
        self.forget()
        probe = ["Word,", "\u00c9t\u00e9.", "na\u00efve", "x"]
        self._by_model = all(self._simple(w) == self._library(w) for w in probe)

    def forget(self) -> None:
        """Drop all words: workers outlive their tasks, and others need the room."""
        self._first: dict[str, int] = {}
        self._pool = np.empty(1 << 16, dtype=np.uint32)
        self._starts = np.zeros(1 << 16, dtype=np.int64)

    def _library(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _simple(self, word: str) -> list[int] | None:
        """Ids straight from the model, for words whose normal form and cuts are known."""
        match = _SIMPLE.fullmatch(word)
        if match is None:
            return None
        ids = [t.id for t in self.model.tokenize(match[1].translate(self._seen))]
        sign = match[2]
        if sign:
            if sign not in self._signs:
                self._signs[sign] = self._library(sign)
            ids += self._signs[sign]
        return ids

    def _learn(self, words: list[str]) -> None:
        count, used = len(self._first), int(self._starts[len(self._first)])
        for word in words:
            ids = self._simple(word) if self._by_model else None
            if ids is None:
                ids = self._library(word)
            end = used + len(ids)
            if end > len(self._pool):
                self._pool = np.resize(self._pool, 2 * end)
            if count + 2 > len(self._starts):
                self._starts = np.resize(self._starts, 2 * (count + 2))
            self._pool[used:end] = ids
            self._first[word] = count
            count, used = count + 1, end
            self._starts[count] = used

    def _known(self, words: list[str]) -> np.ndarray:
        """Numbers of the words, encoding those not seen before."""
        if len(self._first) > KEPT_WORDS:
            self.forget()
        first = self._first
        self._learn([word for word in words if word not in first])
        return np.fromiter(map(first.__getitem__, words), dtype=np.int64, count=len(words))

    def encode(self, texts: pa.Array, last_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with ``last_id`` after each text, and each text's first place (one more)."""
        lists = pc.ascii_split_whitespace(plain_texts(texts))
        encoded = lists.flatten().dictionary_encode()
        places = self._known(encoded.dictionary.to_pylist())
        firsts = self._starts[places]
        sizes = self._starts[places + 1] - firsts
        # The closing id is one more word at the end of each text.
        counts = np.asarray(pc.list_value_length(lists), dtype=np.int64) + 1
        ends = np.cumsum(counts)
        numbers = np.full(int(counts.sum()), len(sizes), dtype=np.int64)
        closing = np.zeros(len(numbers), dtype=bool)
        closing[ends - 1] = True
        numbers[~closing] = np.asarray(encoded.indices)
        sizes, firsts = np.append(sizes, 1), np.append(firsts, 0)
        wanted = sizes[numbers]
        reached = np.cumsum(wanted)
        total = int(reached[-1]) if len(reached) else 0
        at = np.repeat(firsts[numbers] - (reached - wanted), wanted)
        at += np.arange(total)
        ids = self._pool[at]
        ids[reached[ends - 1] - 1] = last_id
        return ids, np.concatenate([[0], reached[ends - 1]]).astype(np.int64)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of a bounded number of bytes (a longer text is a range of its own)."""
    sizes = np.asarray(pc.binary_length(plain_texts(texts)), dtype=np.int64)
    group = np.cumsum(sizes) // SLICE_CHARACTERS
    cuts = np.flatnonzero(np.diff(group)) + 1
    bounds = [0, *cuts.tolist(), len(sizes)]
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]
