"""Held-out accuracy, tolerance of disguised words, and the kernel against its definition."""

import random
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa

from balcao.llm import string_kernel as sk
from balcao.llm.string_kernel import Landmarks, letters_of
from balcao.llm.toxicity import read_words, toxicity_digest, toxicity_scores
from tests.conftest import MEDIUM


def plain_kernel(a, b):
    def weights(word):
        found = {}
        for places in combinations(range(len(word)), 3):
            key = bytes(word[i] for i in places)
            found[key] = found.get(key, 0) + sk.DECAY ** (places[-1] - places[0] + 1)
        return found

    x, y = weights(a), weights(b)
    common = sum(v * y.get(k, 0) for k, v in x.items())
    return common / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "anana", "aaaaaa", "stupid", "stuupid", "zebra", "abcabcabc"]
    found = Landmarks(["idiot", "stupid", "aaaa"]).likeness([letters_of(w) for w in words])
    for word, row in zip(words, found):
        for landmark, value in zip(["idiot", "stupid", "aaaa"], row):
            exact = plain_kernel(letters_of(word), letters_of(landmark))
            assert abs(value - (exact**sk.POWER if exact >= sk.FLOOR else 0)) < 1e-4


def test_words_and_sentences():
    words = read_words(pa.array(["One two. Three 1d1ot i d i o t end", None, "", "É\nx" + " w" * 100]))
    assert letters_of("idiot") in words.distinct and b"\x09\x04\x09\x0f\x14" == letters_of("idiot")
    # A text without words is one sentence of a blank word.
    assert words.sentence_texts.tolist() == [0, 0, 1, 2, 3, 3, 3]


def made_up(frame):
    rng = random.Random(4)
    clean = ["".join(rng.choices("aeiounrstl", k=rng.randint(3, 9))) for _ in range(500)]
    bad = ["moggle", "frindup", "wextrash"]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(clean, k=rng.randint(5, 60))
        toxic = int(rng.random() < 0.25)
        for _ in range(toxic * rng.randint(1, 3)):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words) + ".", "x", 0.0))
        labels.append((i, toxic))
    rest = rng.choices(clean, k=20)
    for j, word in enumerate(["m-o-g-g-l-e", "f r i n d u p", "wextr4sh", "mo.ggle", "frrindup"]):
        rows.append((1000 + j, " ".join([*rest, word, *rest]), "x", 0.0))
    rows += [(2000, " ".join(rest), "x", 0.0), (2001, None, "x", 0.0), (2002, "", "x", 0.0), (None, "no id", "x", 0.0)]
    docs = frame("doc_id bigint, text string, word string, toxicity double", *rows)
    return docs, frame("doc_id bigint, toxic int, text string", *[(i, t, "") for i, t in labels], (5, None, "")), labels


def test_disguised_words(frame):
    docs, labels, known = made_up(frame)
    rows = {r.doc_id: r for r in toxicity_digest(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(rows[1000 + j].predicted == 1 for j in range(5)), [rows[1000 + j].score for j in range(5)]
    assert all(rows[i].predicted == 0 for i in (2000, 2001, 2002, None)), [rows[i].score for i in (2000, 2001, 2002, None)]
    for i, toxic in known:
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    right = [rows[i].predicted == t for i, t in known if rows[i].held_out]
    assert sum(right) >= 0.97 * len(right)


def test_all_columns_stay(frame):
    docs, labels, _ = made_up(frame)
    scored = toxicity_scores(docs, labels)
    assert scored.columns == ["doc_id", "text", "word", "toxicity"] and scored.count() == docs.count()
    assert toxicity_digest(docs.limit(0), labels).collect() == []
    none = toxicity_digest(docs, labels.where("toxic = 0")).collect()
    assert all(r.score == 0 and r.predicted == 0 for r in none)


def auc(rows):
    """Chance that a toxic row scores above a clean one."""
    toxic, clean = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    return sum((t > c) + (t == c) / 2 for t in toxic for c in clean) / (len(toxic) * len(clean))


def test_held_out_rows_of_the_table(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity_digest(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = scored.where("held_out and toxic is not null").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.05 * (len(rows) - len(toxic))
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic) and auc(rows) > 0.65
    english = [r for r in rows if r.lang == "en"]
    assert auc(english) > 0.85 and sum(r.predicted for r in english if r.toxic) >= 0.8 * sum(r.toxic for r in english)


def test_few_labels_still_score(frame):
    rng = random.Random(6)
    clean = ["".join(rng.choices("aeiounrstl", k=6)) for _ in range(30)]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][:12]
    texts = [" ".join(rng.sample(clean, 25) + ["moggle"] * (k % 3 == 0)) + "." for k in range(12)]
    rows = [*zip(ids, texts), (1000, " ".join([*clean[:9], "moggle"])), (1001, " ".join(clean[:9]))]
    labels = frame("doc_id bigint, toxic int", *[(i, int(k % 3 == 0)) for k, i in enumerate(ids)])
    found = {r.doc_id: r for r in toxicity_digest(frame("doc_id bigint, text string", *rows), labels).collect()}
    assert found[1000].predicted == 1 and found[1000].score > found[1001].score
    assert found[1001].predicted == 0
