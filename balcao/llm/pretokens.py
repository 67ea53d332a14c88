"""Texts of a batch as runs over its distinct pre-tokens.

A pre-token is a word with the spaces before it. Encoders need each distinct one only once
per batch; every text is then a run of numbers that point at them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from balcao.llm.spmodel import MARKER
from balcao.llm.word_ids import plain_texts

_BLANK = pa.scalar("", pa.large_string())
_SPACED = re.compile(" *[^ ]+| +")


def spaced_words(text: str) -> list[str]:
    """Words with the spaces before them; one space is put before the text.

    The marker of piece models stands for a space.
    """
    return _SPACED.findall(f" {text.replace(MARKER, ' ')}") if text else []


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens, the number of each occurrence, and each text's first occurrence.

    The last array has one entry more than there are texts. Null texts count as empty.
    """
    texts = pc.replace_substring(plain_texts(texts), MARKER, " ")
    odd = pc.or_(
        pc.match_substring(texts, "  "),
        pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")),
    )
    odd = pc.or_(odd, pc.equal(texts, _BLANK))
    spaced = pc.binary_join_element_wise(_BLANK, texts, pa.scalar(" ", pa.large_string()))
    plain = pc.split_pattern(pc.if_else(odd, _BLANK, spaced), " ")
    counts = np.asarray(pc.list_value_length(plain), dtype=np.int64) - 1
    rows = np.flatnonzero(np.asarray(odd))
    special = [spaced_words(texts[i].as_py()) for i in rows]
    counts[rows] = [len(words) for words in special]
    starts = np.concatenate([[0], np.cumsum(counts)])
    # Each plain list begins with one blank, from the space put before the text.
    flat = plain.flatten()
    lengths = np.asarray(pc.list_value_length(plain), dtype=np.int64)
    first = np.zeros(len(flat), dtype=bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    encoded = flat.filter(pa.array(~first)).dictionary_encode()
    words = [f" {word}" for word in encoded.dictionary.to_pylist()]
    numbers = np.empty(starts[-1], dtype=np.int64)
    is_special = np.zeros(len(texts), dtype=bool)
    is_special[rows] = True
    numbers[~np.repeat(is_special, counts)] = np.asarray(encoded.indices)
    known = {word: i for i, word in enumerate(words)} if any(special) else {}
    for row, found in zip(rows, special):
        for at, word in enumerate(found):
            number = known.setdefault(word, len(known))
            if number == len(words):
                words.append(word)
            numbers[starts[row] + at] = number
    return words, numbers, starts


def sums_per_text(amounts: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text the sum of its pre-tokens' amounts."""
    total = np.concatenate([[0], np.cumsum(amounts[numbers], dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]
