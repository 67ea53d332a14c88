"""Token counts under a unigram piece model, by dynamic programming over a trie.

The distinct pre-tokens of a batch make up a trie, walked depth first in sorted order. The
best score of a prefix is worked out once, however many pre-tokens share it. At the end of a
pre-token the number of its pieces is kept, and a text's count is a sum over its pre-tokens.

The best segmentation has the highest sum of piece scores; among equal sums the one with the
fewest tokens counts. A character that no piece covers becomes its UTF-8 bytes and scores
``UNKNOWN_BELOW`` less than the worst piece. Spaces read as the marker, and one marker stands
before a text. Pre-tokens are taken apart separately, as pieces never run from the end of one
word into the next; the model is checked for that.

Null and empty texts have no tokens. Repeated rows are counted each on their own, other
columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from balcao.llm.pretokens import distinct_words, sums_per_text
from balcao.llm.spmodel import MARKER, NORMAL, USER_DEFINED, PieceModel, load_model

UNKNOWN_BELOW = 10.0  # as unigram models score unknown characters
KEPT_WORDS = 500_000  # terminal counts a worker keeps from batch to batch


class TrieCounter:
    """Numbers of tokens of many pre-tokens, sharing the work on common prefixes."""

    def __init__(self, model: PieceModel):
        self.scores = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
        if any(MARKER in piece.lstrip(MARKER) for piece in self.scores):
            raise ValueError("pieces of this model run across words")
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_BELOW
        self.byte_fallback = model.byte_fallback
        self.kept: dict[str, int] = {}

    def _extend(self, word: str, end: int, best: list[tuple[float, int]]) -> tuple[float, int]:
        """Best (score, minus tokens) of the prefix that ends at ``end``."""
        scores, found = self.scores, None
        for start in range(max(0, end - self.longest), end):
            score = scores.get(word[start:end])
            if score is not None:
                before = best[start]
                reached = (before[0] + score, before[1] - 1)
                if found is None or reached > found:
                    found = reached
        char = word[end - 1]
        if char not in scores:
            before = best[end - 1]
            tokens = len(char.encode("utf-8", "surrogatepass")) if self.byte_fallback else 1
            reached = (before[0] + self.unknown, before[1] - tokens)
            if found is None or reached > found:
                found = reached
        return found

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each distinct pre-token (spaces already replaced by the marker)."""
        counts = self.kept
        if len(counts) > KEPT_WORDS:
            counts = self.kept = {}
        wanted = list(words)
        best = [(0.0, 0)]  # the path from the trie's root to the node walked last
        previous = ""
        for word in sorted({word for word in wanted if word not in counts}):
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best.append(self._extend(word, end, best))
            counts[word] = -best[len(word)][1]
            previous = word
        return {word: counts[word] for word in wanted}


@lru_cache(maxsize=2)
def _counter(path: str) -> TrieCounter:
    return TrieCounter(load_model(path))


def token_counts(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column``, ``n_pretokens`` and ``n_tokens`` of every text.

    ``model_path`` is a piece model file that every executor can open.
    """
    id_type = dict(docs.dtypes)[id_column]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            words, numbers, starts = distinct_words(batch.column(1))
            marked = [word.replace(" ", MARKER) for word in words]
            found = counter.counts(marked)
            amounts = np.array([found[word] for word in marked], dtype=np.int64)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(np.diff(starts)),
                    pa.array(sums_per_text(amounts, numbers, starts)),
                ],
                names=[id_column, "n_pretokens", "n_tokens"],
            )

    schema = f"`{id_column}` {id_type}, n_pretokens bigint, n_tokens bigint"
    return docs.select(id_column, text_column).mapInArrow(count, schema)
