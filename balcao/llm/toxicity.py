"""Toxicity of texts: a support vector machine over subsequence-kernel likeness to landmarks.

Landmarks are words that are told apart by the labels (Nyström: the kernel is approximated by
its values at the landmarks, whitened by their own kernel matrix). A sentence's kernel value
at a landmark is that of its most similar word, so gapped words and words with inserted
characters still count; spaced-out letters are read as one word. The machine is trained on
sentences of labelled documents: all sentences of clean documents are negative; of each
toxic document those that the machine itself puts on that side are positive, one at least. A document
scores as its highest sentence, put through a logistic curve.

The classifier is fitted on at most ``TRAINING_DOCUMENTS`` labelled documents (the lowest
hashes of their ids), of each at most ``TRAINING_SENTENCES`` sentences; scores cover all rows
and whole texts. Rows whose crc32 remainder is ``HELD_OUT`` are never learned from.

Null texts count as empty. A text without words gets the score of a sentence that resembles
no landmark. If there is no toxic or no clean row to learn from, or no word that toxic rows hold
more often than clean ones, all scores are 0. Labels that
are null are not learned from; of documents with both labels each row counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from balcao.llm.string_kernel import Landmarks, letters_of
from balcao.llm.word_ids import plain_texts, slices

FOLDS, HELD_OUT = 4, 2
PREDICT_AT = 0.3
TRAINING_DOCUMENTS = 4_000
TRAINING_SENTENCES = 16
CANDIDATES = 600  # words considered as landmarks, of either label
SIGNIFICANT = 4  # standard errors between the labels' shares of documents with a word
LANDMARKS = 80  # of words that speak for toxicity; half as many that do not
LONGEST_SENTENCE = 48  # words
PENALTY = 1e-4
KEPT_WORDS = 150_000  # words a task remembers, and
KEPT_ROWS = 60_000  # of them those that resemble a landmark, about 500 bytes each
SENTENCES = 1_024  # likeness worked out together
ROUNDS = 5
SURE = 0.64  # likeness to a word that speaks for toxicity, for the first guess

_ENDS = ".!?;:"
_LOOKS = str.maketrans("013457@$", "oieastas")
_DISGUISED = re.compile(r"(?<=[^\W\d_])[013457@$]+(?=[^\W\d_])")


def plain_word(raw: str) -> bytes:
    """Letters of a raw token; digits and signs between letters read as the letters they resemble."""
    if not raw[:-1].isalpha():
        raw = _DISGUISED.sub(lambda m: m[0].translate(_LOOKS), raw)
    return letters_of(raw)


@dataclass
class Words:
    """Texts of a slice as distinct words, and sentences as runs of them."""

    distinct: list[bytes]
    numbers: np.ndarray  # of the words' occurrences, text after text
    sentences: np.ndarray  # number of the sentence of each occurrence
    sentence_texts: np.ndarray  # number of the text of each sentence


def read_words(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(plain_texts(texts))
    encoded = lists.flatten().dictionary_encode()
    raw = encoded.dictionary.to_pylist()
    known: dict[bytes, int] = {}
    meaning = np.array([known.setdefault(plain_word(r), len(known)) for r in raw], dtype=np.int64)
    distinct = list(known)
    places = np.asarray(encoded.indices, dtype=np.int64)
    numbers = meaning[places]
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    owners = np.repeat(np.arange(len(texts)), counts)
    ends = np.array([r[-1:] in _ENDS and r != "" for r in raw], dtype=bool)[places]
    fresh = np.ones(len(numbers), dtype=bool)
    fresh[1:] = ends[:-1] | (owners[1:] != owners[:-1])
    first = np.flatnonzero(fresh)
    inside = np.arange(len(numbers)) - np.repeat(first, np.diff(np.append(first, len(numbers))))
    fresh |= inside % LONGEST_SENTENCE == 0
    sentences = np.cumsum(fresh) - 1
    sentence_texts = owners[np.flatnonzero(fresh)]
    # Runs of single letters are one word more, in the sentence where they end.
    single = np.array([len(word) == 1 for word in distinct], dtype=bool)[numbers]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    spaced, where = [], []
    for a, b in zip(edges[::2], edges[1::2]):
        if b - a >= 4:
            word = b"".join(distinct[n] for n in numbers[a:b])
            spaced.append(known.setdefault(word, len(known)))
            where.append(sentences[b - 1])
    if spaced:
        numbers = np.concatenate([numbers, spaced])
        sentences = np.concatenate([sentences, where])
        order = np.argsort(sentences, kind="stable")
        numbers, sentences = numbers[order], sentences[order]
    return Words(list(known), numbers, sentences, sentence_texts)


class Memory:
    """Likeness of words to landmarks, kept from slice to slice for a bounded number of words."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}  # -1 for words that resemble no landmark
        self.used = 0
        self.rows = np.zeros((1024, len(self.landmarks.words)), dtype=np.float32)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Row of each word in ``rows``, or -1."""
        if len(self.places) > KEPT_WORDS or self.used > KEPT_ROWS:
            self.clear()
        places = self.places
        new = [word for word in words if word not in places]
        if new:
            alike = self.landmarks.likeness(new)
            some = alike.any(axis=1)
            numbers = np.where(some, np.cumsum(some) - 1 + self.used, -1)
            places.update(zip(new, numbers.tolist()))
            reached = self.used + int(some.sum())
            if reached > len(self.rows):
                self.rows.resize((max(reached, 3 * len(self.rows) // 2), self.rows.shape[1]), refcheck=False)
            self.rows[self.used : reached] = alike[some]
            self.used = reached
        return np.fromiter((places[word] for word in words), dtype=np.int64, count=len(words))


def likeness_parts(words: Words, memory: Memory) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the sentences that resemble a landmark, and their likeness to each, some at a time."""
    places = memory.lookup(words.distinct)[words.numbers]
    some = places >= 0
    places, sentences = places[some], words.sentences[some]
    if not len(places):
        return
    starts = np.flatnonzero(np.concatenate([[True], sentences[1:] != sentences[:-1]]))
    bounds = np.append(starts, len(places))
    for a in range(0, len(starts), SENTENCES):
        b = min(a + SENTENCES, len(starts))
        rows = memory.rows[places[bounds[a] : bounds[b]]]
        yield sentences[starts[a:b]], np.maximum.reduceat(rows, starts[a:b] - bounds[a], axis=0)


def sentence_likeness(words: Words, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """The same for all sentences at once."""
    parts = list(likeness_parts(words, memory))
    if not parts:
        return np.empty(0, dtype=np.int64), memory.rows[:0]
    numbers, alike = zip(*parts)
    return np.concatenate(numbers), np.vstack(alike)


@dataclass
class Model:
    landmarks: Landmarks
    weights: np.ndarray  # on likeness to the landmarks, the whitening included
    bias: float
    slope: float
    shift: float

    def scores(self, texts: pa.Array, memory: Memory) -> np.ndarray:
        words = read_words(texts)
        margins = np.full(len(texts), self.bias)
        for numbers, alike in likeness_parts(words, memory):
            np.maximum.at(margins, words.sentence_texts[numbers], alike @ self.weights + self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -50, 50)))


def _separate(rows: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, both classes of equal weight: Newton's steps."""
    x = np.hstack([rows, np.ones((len(rows), 1), dtype=np.float32)])
    cost = np.where(signs > 0, 0.5 / max(1, (signs > 0).sum()), 0.5 / max(1, (signs < 0).sum()))
    ridge = np.eye(x.shape[1]) * PENALTY
    ridge[-1, -1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = signs * (x @ w) < 1
        gram, pull = ridge.copy(), np.zeros(x.shape[1])
        for part in np.array_split(np.flatnonzero(active), 1 + active.sum() // 8192):
            a = x[part].astype(np.float64)
            weighted = (a * cost[part][:, None]).T
            gram += weighted @ a
            pull += weighted @ signs[part]
        new = np.linalg.solve(gram, pull)
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + 1e-3 * w
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), gradient)
    return float(w[0]), float(w[1])


def _choose_landmarks(
    counts: list[tuple[str, int, int]], toxic: int, clean: int
) -> tuple[list[str], list[str]]:
    """Words whose documents' labels differ most either way, no two of them nearly the same.

    Of words that speak for toxicity, those that differ significantly; if there are none, as with
    few labels, the best ranked that toxic documents hold more often, down to half the best one's
    difference.
    """
    scored = []
    for word, with_toxic, with_clean in counts:
        share = (with_toxic + with_clean) / (toxic + clean)
        error = np.sqrt(share * (1 - share) * (1 / toxic + 1 / clean)) + 1e-12
        scored.append(((with_toxic / toxic - with_clean / clean) / error, word))
    chosen: list[list[str]] = [[], []]
    for side, wanted, sign in ((0, LANDMARKS, -1), (1, LANDMARKS // 2, 1)):
        ordered = [(-s * sign, w) for s, w in sorted(scored, key=lambda pair: (sign * pair[0], pair[1]))]
        ranked = [w for s, w in ordered if s > (SIGNIFICANT if side == 0 else 0)]
        ranked = (ranked or [w for s, w in ordered if s > 0 and 2 * s >= ordered[0][0]])[:CANDIDATES]
        if not ranked:
            continue
        alike = Landmarks(ranked).likeness([letters_of(w) for w in ranked])
        kept: list[int] = []
        for i in range(len(ranked)):
            if len(kept) < wanted and (not kept or alike[i, kept].max() < 0.8):
                kept.append(i)
        chosen[side] = [ranked[i] for i in kept]
    return chosen[0], chosen[1]


def is_held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS == HELD_OUT


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on labelled rows outside the held-out part; None if a class has no row or no word leans to toxic."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & ~is_held_out())
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(TRAINING_DOCUMENTS)
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", "toxic")

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                words = read_words(part.column(1))
                texts = words.sentence_texts[words.sentences]
                pairs = np.unique(words.numbers * len(part) + texts)
                labels = np.asarray(part.column(2))[pairs % len(part)]
                numbers = pairs // len(part)
                size = len(words.distinct)
                toxic = np.bincount(numbers, labels, size).astype(np.int64)
                clean = np.bincount(numbers, minlength=size) - toxic
                names = [word.decode("latin-1") for word in words.distinct]
                keep = np.array([len(n) >= 3 for n in names], dtype=bool) & (toxic + clean > 0)
                yield pa.record_batch(
                    [pa.array(np.array(names, dtype=object)[keep], pa.string()), pa.array(toxic[keep]), pa.array(clean[keep])],
                    names=["word", "toxic", "clean"],
                )

    counted = (
        rows.select("doc_id", "text", "toxic")
        .mapInArrow(vocabulary, "word string, toxic bigint, clean bigint")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return None
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    apart = F.col("toxic") / toxic - F.col("clean") / clean
    weight = apart / F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean) + 1e-24)
    counted = counted.withColumn("weight", weight)
    ends = [counted.orderBy(*o).limit(CANDIDATES) for o in ((F.desc("weight"), "word"), ("weight", "word"))]
    counts = [(_spelled(r.word), r.toxic, r.clean) for end in ends for r in end.collect()]
    speaking, other = _choose_landmarks(list(dict.fromkeys(counts)), toxic, clean)
    if not speaking:
        return None
    landmarks = Landmarks(speaking + other)

    def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(landmarks)
        for batch in batches:
            for first, last in slices(batch.column(1)):
                part = batch.slice(first, last - first)
                words = read_words(part.column(1))
                numbers, alike = sentence_likeness(words, memory)
                texts = words.sentence_texts[numbers]
                packed = []
                for row in range(len(part)):
                    own = np.unique(alike[texts == row].astype(np.float16), axis=0)
                    best = np.argsort(-own.max(axis=1), kind="stable")[:TRAINING_SENTENCES] if len(own) else []
                    packed.append(own[best].tobytes())
                yield pa.record_batch(
                    [part.column(2), pa.array(packed, pa.binary())], names=["toxic", "rows"]
                )

    found = rows.mapInArrow(sentences, "toxic int, rows binary").collect()
    width = len(landmarks.words)
    found = sorted(((r.toxic, bytes(r.rows)) for r in found), reverse=True)
    bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, width).astype(np.float32) for _, b in found]
    # A document always has a sentence like nothing, too.
    bags = [np.vstack([bag, np.zeros((1, width), dtype=np.float32)]) for bag in bags]
    return _fit(landmarks, len(speaking), bags, np.array([t for t, _ in found]))


def _spelled(word: str) -> str:
    """A word of letter numbers as one of letters (numbers above 26 stand for other letters)."""
    return "".join(chr(96 + ord(c)) if ord(c) <= 26 else _OTHER[ord(c) - 27] for c in word)


# One letter for each number above 26, so that words can be spelled and read again.
_OTHER = [next(chr(c) for c in range(0x3B1, 0x3C9) if c % 5 == rest) for rest in range(5)]


def _best(bag: np.ndarray, margins: np.ndarray) -> np.ndarray:
    """Rows with a margin above 0, or else the highest."""
    return np.flatnonzero(margins > 0) if (margins > 0).any() else np.array([np.argmax(margins)])


def _fit(landmarks: Landmarks, speaking: int, bags: list[np.ndarray], labels: np.ndarray) -> Model:
    own = landmarks.likeness([letters_of(w) for w in landmarks.words]).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    whitening = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
    raw, bags = bags, [bag @ whitening.astype(np.float32) for bag in bags]
    negatives = np.vstack([bag for bag, label in zip(bags, labels) if label == 0])
    toxic = [pair for *pair, label in zip(bags, raw, labels) if label == 1]
    # First guess: sentences with a word that speaks for toxicity. Then those on its side.
    picked = [_best(bag, raw[:, :speaking].max(axis=1) - SURE) for bag, raw in toxic]
    for _ in range(ROUNDS):
        chosen = picked
        positives = np.vstack([bag[rows] for (bag, _), rows in zip(toxic, chosen)])
        signs = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        weights, bias = _separate(np.vstack([positives, negatives]), signs)
        picked = [_best(bag, bag @ weights + bias) for bag, _ in toxic]
        if all(map(np.array_equal, picked, chosen)):
            break
    margins = np.array([(bag @ weights).max() + bias for bag in bags])
    slope, shift = _logistic(margins, labels)
    return Model(landmarks, whitening @ weights, bias, slope, shift)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with ``toxicity`` (0 to 1), learned from ``labels`` (doc_id, toxic)."""
    model = train(
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), labels
    )
    if model is None:
        return docs.withColumn("toxicity", F.lit(0.0))
    kept = [field for field in docs.schema.fields if field.name != "toxicity"]
    at = [field.name for field in kept].index(text_column)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(model.landmarks)
        for batch in batches:
            for first, last in slices(batch.column(at)):
                part = batch.slice(first, last - first)
                yield pa.record_batch(
                    [*part.columns, pa.array(model.scores(part.column(at), memory), pa.float64())],
                    names=[*part.schema.names, "toxicity"],
                )

    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(
        score, StructType([*kept, StructField("toxicity", DoubleType())])
    )


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``documents``."""
    scored = toxicity_scores(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(), F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= PREDICT_AT).cast("int").alias("predicted"),
    )
