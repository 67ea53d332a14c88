"""Statistics that quality rules look at, text by text, worked out for a batch at a time.

Words are runs of characters other than ASCII white space. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from balcao.llm.word_ids import plain_texts

# What rules count (integers), and shares of it that documents of all lengths have alike.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "word_length", "symbols", "dup_lines", "repeat_words", "distinct_words", "letters", "signs", "ended_lines"
)

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
_BYTES = np.arange(256)
# Every character beyond ASCII counts as a letter, once: by its first byte.
_LETTERS = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 192)
_DIGITS = (_BYTES >= 48) & (_BYTES <= 57)
_SIGNS = (_BYTES > 32) & (_BYTES < 127) & ~_LETTERS & ~_DIGITS
_ENDS = pa.array(list(".!?:;\"')"), pa.large_string())
_TRIPLE_BITS = 21  # three word numbers below 2^21 make one 63-bit number


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def _data(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and each text's first place (one more)."""
    starts = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(texts) + 1]
    values = texts.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, dtype=np.uint8)
    return data, starts


def _triples(numbers: np.ndarray) -> np.ndarray:
    """One number for each three words that follow each other, equal for equal words."""
    a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
    if len(numbers) and numbers.max() >= 1 << _TRIPLE_BITS:
        # Pairs get numbers of their own, fewer than there are words.
        pairs = np.unique(a << np.int64(31) | b, return_inverse=True)[1].astype(np.int64)
        return pairs << np.int64(31) | c
    return (a << np.int64(2 * _TRIPLE_BITS)) | (b << np.int64(_TRIPLE_BITS)) | c


def _repeated_words(numbers: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    """Words of each text that stand in a run of three which the text holds twice or more."""
    if len(numbers) < 3:
        return np.zeros(texts, dtype=np.int64)
    whole = np.flatnonzero(owners[:-2] == owners[2:])
    keys, of = _triples(numbers)[whole], owners[whole]
    order = np.lexsort((keys, of))
    same = (keys[order][1:] == keys[order][:-1]) & (of[order][1:] == of[order][:-1])
    repeated = np.zeros(len(order), dtype=bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    at = whole[order[repeated]]
    covered = np.zeros(len(numbers), dtype=bool)
    for step in range(3):
        covered[at + step] = True
    return np.bincount(owners[covered], minlength=texts)


def _duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with a word that an earlier line equals, all lines with a word, those a sign ends."""
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    owners = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists), dtype=np.int64))
    trimmed = pc.ascii_trim_whitespace(lines)
    filled = np.asarray(pc.greater(pc.binary_length(trimmed), 0))
    lines, owners = lines.filter(pa.array(filled)), owners[filled]
    ended = np.asarray(pc.is_in(pc.utf8_slice_codeunits(trimmed.filter(pa.array(filled)), -1), _ENDS))
    numbers = np.asarray(lines.dictionary_encode().indices, dtype=np.int64)
    n = np.bincount(owners, minlength=len(texts))
    distinct = np.unique(owners << np.int64(32) | numbers) >> np.int64(32)
    return n - np.bincount(distinct, minlength=len(texts)), n, np.bincount(owners[ended], minlength=len(texts))


def rule_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of ``COUNTS`` (whole numbers) and of ``SHARES`` (doubles) for each text."""
    texts = plain_texts(texts)
    n = len(texts)
    if not n:
        return {c: np.empty(0, dtype=np.int64 if c in COUNTS else np.float64) for c in (*COUNTS, *SHARES)}
    data, starts = _data(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    owners = np.repeat(np.arange(n), np.asarray(pc.list_value_length(lists), dtype=np.int64))
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))  # splitting leaves blanks at the ends
    flat, owners = flat.filter(pa.array(filled)), owners[filled]
    encoded = flat.dictionary_encode()
    numbers = np.asarray(encoded.indices, dtype=np.int64)
    n_words = np.bincount(owners, minlength=n)
    lengths = np.asarray(pc.utf8_length(encoded.dictionary), dtype=np.int64)[numbers]
    distinct = np.unique(owners << np.int64(32) | numbers) >> np.int64(32)
    word_chars = np.bincount(owners, weights=lengths, minlength=n).astype(np.int64)
    dup_lines, lines, ended = _duplicate_lines(texts)
    found = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": _per_text(_SYMBOLS[data], starts),
        "n_dup_lines": dup_lines,
        "n_repeat_words": _repeated_words(numbers, owners, n),
    }
    words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    return found | {
        "word_length": word_chars / words,
        "symbols": found["n_symbols"] / words,
        "dup_lines": dup_lines / np.maximum(lines, 1),
        "repeat_words": found["n_repeat_words"] / words,
        "distinct_words": np.bincount(distinct, minlength=n) / np.sqrt(words),
        "letters": _per_text(_LETTERS[data], starts) / chars,
        "signs": _per_text(_SIGNS[data], starts) / chars,
        "ended_lines": ended / np.maximum(lines, 1),
    }
