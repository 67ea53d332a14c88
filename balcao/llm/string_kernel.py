"""Subsequence kernel between words and a set of landmark words.

Two words are alike in as far as they share subsequences of three letters; a subsequence
that spans n letters of a word weighs ``DECAY ** n``, so gaps and inserted characters cost
likeness but do not end it. The kernel is normalised to 1 for equal words; likeness is
its power ``POWER``, a kernel too, which tells the likely from the possible. Kernels below
``FLOOR`` count as none.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import combinations

import numpy as np

DECAY = 0.6
FLOOR = 0.25
POWER = 2
LONGEST = 24  # longer words are looked at through windows of this many letters
_LETTERS = 32
_CELLS = 1 << 21
_AT_ONCE = 1_024  # words whose sums are worked out together: tens of MB


_NUMBERS = bytes((c | 32) - 96 if chr(c).isascii() and chr(c).isalpha() else 0 for c in range(256))
_NOT_LETTERS = bytes(c for c in range(256) if not _NUMBERS[c])


def letters_of(word: str) -> bytes:
    """The word's letters as numbers below 32, accents taken off.

    Words without a Latin letter keep a rough trace: one of five numbers for each letter.
    """
    if not word.isascii():
        folded = unicodedata.normalize("NFKD", word.casefold())
        found = folded.encode("ascii", "ignore").translate(_NUMBERS, _NOT_LETTERS)
        return found or bytes(27 + ord(c) % 5 for c in folded if c.isalpha())
    return word.encode().translate(_NUMBERS, _NOT_LETTERS)


@lru_cache(maxsize=None)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    places = np.array(list(combinations(range(length), 3)), dtype=np.int64).reshape(-1, 3)
    return places, (DECAY ** (places[:, 2] - places[:, 0] + 1)).astype(np.float32)


def _codes(words: np.ndarray, length: int) -> np.ndarray:
    places, _ = _triples(length)
    wide = words.astype(np.uint16)
    return (wide[:, places[:, 0]] << 10) | (wide[:, places[:, 1]] << 5) | wide[:, places[:, 2]]


def _own_norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself."""
    order = np.argsort(codes, axis=1, kind="stable")
    ranked = np.take_along_axis(codes, order, axis=1).astype(np.int64)
    flat = (ranked + (np.arange(len(codes)) << 15)[:, None]).ravel()
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    sums = np.add.reduceat(weights[order].ravel(), starts)
    return np.sqrt(np.bincount(flat[starts] >> 15, sums * sums, len(codes)))


def _windows(word: bytes) -> list[bytes]:
    if len(word) <= LONGEST:
        return [word]
    last = len(word) - LONGEST
    return [word[i : i + LONGEST] for i in [*range(0, last, LONGEST // 2), last]]


class Landmarks:
    """Likeness of any words to a fixed list of words of three letters or more."""

    def __init__(self, words: list[str]):
        self.words = words
        table = np.zeros((_LETTERS**3, len(words)), dtype=np.float32)
        for column, word in enumerate(words):
            word = letters_of(word)[:LONGEST]
            codes = _codes(np.frombuffer(word, dtype=np.uint8)[None, :], len(word))[0]
            np.add.at(table[:, column], codes, _triples(len(word))[1])
        norms = np.sqrt((table * table).sum(axis=0))
        table /= np.maximum(norms, 1e-9)
        # Few landmarks hold one subsequence: lists of (landmark, value), code after code.
        codes, self.columns = np.nonzero(table)
        self.values = table[codes, self.columns]
        self.counts = np.bincount(codes, minlength=len(table))
        self.firsts = np.cumsum(self.counts) - self.counts
        self.most = table.max(axis=1, initial=0)

    def _sums(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Kernel of each row's word with each landmark, not yet divided by the word's norm."""
        rows, places = np.nonzero(self.counts[codes])
        found = codes[rows, places]
        counts = self.counts[found]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.firsts[found] - (ends - counts), counts)
        width = len(self.words)
        cells = np.repeat(rows * width, counts) + self.columns[at]
        amounts = np.repeat(weights[places], counts) * self.values[at]
        return np.bincount(cells, amounts, len(codes) * width).reshape(-1, width)

    def _same_length(self, words: list[bytes], length: int) -> np.ndarray:
        places, weights = _triples(length)
        least = FLOOR * np.sqrt((weights * weights).sum())
        found = np.zeros((len(words), len(self.words)), dtype=np.float32)
        step = max(1, _CELLS // len(places))
        for first in range(0, len(words), step):
            letters = np.frombuffer(b"".join(words[first : first + step]), dtype=np.uint8)
            codes = _codes(letters.reshape(-1, length), length)
            # No landmark can be nearer than the sum of each subsequence's largest value.
            near = np.flatnonzero(self.most[codes] @ weights >= least)
            for a in range(0, len(near), _AT_ONCE):
                some = near[a : a + _AT_ONCE]
                sums = self._sums(codes[some], weights)
                kept = sums.max(axis=1, initial=0) >= least
                some, sums = some[kept], sums[kept]
                if len(some):
                    alike = sums / _own_norms(codes[some], weights)[:, None]
                    found[first + some] = np.where(alike >= FLOOR, alike**POWER, 0)
        return found

    def likeness(self, words: list[bytes]) -> np.ndarray:
        """One row per word (as ``letters_of`` gives them), one column per landmark."""
        by_length: dict[int, tuple[list[bytes], list[int]]] = {}
        for number, word in enumerate(words):
            for window in _windows(word):
                if len(window) >= 3:
                    parts, owners = by_length.setdefault(len(window), ([], []))
                    parts.append(window)
                    owners.append(number)
        found = np.zeros((len(words), len(self.words)), dtype=np.float32)
        if not self.words:
            return found
        for length, (parts, owners) in by_length.items():
            alike = self._same_length(parts, length)
            if length == LONGEST:
                np.maximum.at(found, np.array(owners), alike)
            else:
                found[owners] = alike
        return found
