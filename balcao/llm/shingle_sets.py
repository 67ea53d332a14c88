"""Texts as sets of hashed word shingles.

Words are runs of characters other than ASCII white space, A-Z lower-cased. The set of a text
holds its distinct shingles of ``WIDTH`` words; a text with fewer words holds its whole
sequence as one; a text without words holds nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from balcao.llm.word_ids import plain_texts

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over 64 bits."""
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * _MIX2
    return values ^ (values >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingle hashes, sorted text by text, and each text's first place."""
    texts = pc.ascii_lower(plain_texts(texts))
    lists = pc.ascii_split_whitespace(texts)
    encoded = lists.flatten().dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in encoded.dictionary.to_pylist()], dtype=np.uint64)
    blank = pc.index(encoded.dictionary, pa.scalar("", pa.large_string())).as_py()
    numbers = np.asarray(encoded.indices, dtype=np.int64)
    owners = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists), dtype=np.int64))
    if blank >= 0:  # splitting leaves blanks at the ends
        owners, numbers = owners[numbers != blank], numbers[numbers != blank]
    words = known[numbers]
    counts = np.bincount(owners, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    # Each place starts a shingle if enough words follow; a short text is one, from its start.
    size = np.minimum(counts, width)[owners]
    place = np.arange(len(words))
    starts = place - firsts[owners] + size <= counts[owners]
    hashes = np.zeros(len(words), dtype=np.uint64)
    for step in range(width):
        at = np.minimum(place + step, max(len(words) - 1, 0))
        used = step < size
        hashes = np.where(used, mixed(hashes + words[at] + np.uint64(step + 1)), hashes)
    hashes = mixed(hashes + size.astype(np.uint64))
    owners, hashes = owners[starts], hashes[starts]
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    sizes = np.bincount(owners[fresh], minlength=len(texts))
    return hashes[fresh], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def set_ids(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit number for each set, equal for equal sets; 0 for empty sets."""
    none = np.zeros(1, dtype=np.uint64)
    total = np.concatenate([none, np.cumsum(hashes, dtype=np.uint64)])
    other = np.concatenate([none, np.cumsum(mixed(hashes), dtype=np.uint64)])
    sizes = np.diff(starts).astype(np.uint64)
    ids = mixed(mixed(total[starts[1:]] - total[starts[:-1]]) + (other[starts[1:]] - other[starts[:-1]]) + sizes)
    return np.where(sizes > 0, np.maximum(ids, np.uint64(1)), np.uint64(0))
