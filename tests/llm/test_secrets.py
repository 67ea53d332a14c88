"""Secrets that stand in texts are found and masked, ordinary strings are left alone."""

import random
import re

from balcao.llm.secrets import MARK, _any_of, dictionary, findings, rule_labels, secret_digest, with_features, without_secrets
from tests.conftest import MEDIUM


def made_up():
    rng = random.Random(9)
    words = "the quick brown fox jumps over lazy dogs and runs with many others through forest".split()

    def some(alphabet, size):
        return "".join(rng.choices(alphabet, k=size))

    texts, secrets = [None, ""], [[], []]
    for i in range(240):
        parts, hidden = [rng.choice(words) for _ in range(20)], []
        parts.append("".join(rng.choices(words, k=4)))
        parts.append(some("0123456789", 18))
        if i % 3 == 0:
            hidden = [some("0123456789abcdef", 40)]
            parts.insert(rng.randrange(20), f'token = "{hidden[0]}"')
        if i % 5 == 0:
            hidden.append("AKIA" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16))
            parts.insert(rng.randrange(20), f"é {hidden[-1]}")
        if i % 7 == 0:  # no rule speaks for it
            hidden.append(some("0123456789abcdef", 40))
            parts.insert(rng.randrange(20), f'checkin "{hidden[-1]}"')
        texts.append(" ".join(parts))
        secrets.append(hidden)
    return texts, secrets


def test_made_up_findings(frame):
    texts, secrets = made_up()
    docs = frame(
        "doc_id bigint, text string, source string, tag int, spans string, label int",
        *[(i, t, "src" if i % 2 else None, 0, "", 0) for i, t in enumerate(texts)],
    )
    rows = {r.doc_id: r for r in secret_digest(docs).collect()}
    assert len(rows) == len(texts)
    hits = wrong = 0
    for i, (text, hidden) in enumerate(zip(texts, secrets)):
        found = [tuple(map(int, s.split(":"))) for s in rows[i].secrets.split(",") if s]
        strings = [text[a:b] for a, b in found]
        hits += sum(h in strings for h in hidden)
        wrong += sum(s not in hidden for s in strings)
        assert rows[i].n_secrets == len(found) <= rows[i].n_candidates
    assert wrong == 0 and hits >= 0.95 * sum(map(len, secrets))
    masked = {r.doc_id: r for r in without_secrets(docs).collect()}
    assert masked[0].text is None and masked[1].text == "" and len(masked) == len(texts)
    assert MARK in masked[2].text and not any(h in masked[2].text for h in secrets[2])
    assert masked[3].text == texts[3]


def test_table(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    named = re.compile(r'token = "([0-9a-f]{40})"|password=([0-9a-f]{18})|(AKIA[0-9A-Z]{16})')
    rows = {r.doc_id: r for r in secret_digest(docs).collect()}
    for r in docs.collect():
        spans = {f"{m.start(m.lastindex)}:{m.end(m.lastindex)}" for m in named.finditer(r.text or "")}
        assert set(filter(None, rows[r.doc_id].secrets.split(","))) == spans


def test_nothing_to_learn_from(frame):
    docs = frame("doc_id bigint, text string, source string", (1, "plain words", "a"), (None, None, None))
    assert sorted((str(r.doc_id), r.n_secrets) for r in secret_digest(docs).collect()) == [("1", 0), ("None", 0)]
    assert secret_digest(docs.limit(0)).collect() == []


def test_dictionary_counts_all_texts_once(frame):
    # 2,500 copies of one text of 201 words of its own, and 2,100 other texts that share long words.
    copied = " ".join(f"{a}{b}copy" for a in "abcdefghijklmnop" for b in "abcdefghijklm")
    rows = [(copied,)] * 2_500 + [(f"text{i} internationalization rareWordsHere {'getUserName' * (i % 2)}",) for i in range(2_100)]
    words = dictionary(frame("text string", *rows, (None,)))
    assert words[:4] == ["here", "internationalization", "rare", "words"]
    assert {"get", "user", "name"} <= set(words) and not any(w.endswith("copy") for w in words)
    assert "text" not in words  # stands beside digits


def test_longest_word_is_taken(values):
    from pyspark.sql import functions as F

    words = ["for", "forest", "forestry", "rest", "a", "able"]
    left = values(lambda t: F.regexp_replace(t, _any_of(words), "-"), ["forestryrestabler", "foresforests", "xyz"])
    assert left == ["---r", "-es-s", "xyz"]


def test_long_names_are_the_context_of_their_values(frame):
    key, code = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY12", "0123456789abcdef0123"
    texts = [f"AWS_SECRET_ACCESS_KEY={key}", f'stripe_webhook_secret: "{code}"', "see dGhpcyBpcyBhIHRlc3Q== now", f'session_access_token="{code}="']
    docs = frame("doc_id bigint, text string, source string", *[(i, t, "s") for i, t in enumerate(texts)])
    rows = rule_labels(with_features(findings(docs), ["secret", "access", "stripe"])).collect()
    found = {(r.doc_id, r.found): r for r in rows}
    assert {f for _, f in found} >= {"AWS_SECRET_ACCESS_KEY", key, code, "dGhpcyBpcyBhIHRlc3Q==", f"{code}="}
    for row in (found[0, key], found[1, code], found[3, f"{code}="]):
        assert row.label == 1 and row.f_neighbour == 1 and row.f_assigned == 1


VALUES = {
    "password=Winter2024! and": "Winter2024!",
    "pass: hunter2xyz, then": "hunter2xyz",
    'the "api_key": "a1.b2@c3$d4:e5~f6",': "a1.b2@c3$d4:e5~f6",
    "postgres://ann:s3cr.t-pw@db/x": "s3cr.t-pw",
    "token=abc12&next=1": "abc12",
    "Password=x1;Server=y": "x1",
    "{'auth': 'q7'}": "q7",
    '{\\"secret\\":\\"k9!z\\"}': "k9!z",
    "see password=z8y7</b>": "z8y7",
    "passwd   =   v5.w6.": "v5.w6",
}


def test_assigned_values_of_any_kind_are_candidates(frame):
    docs = frame("doc_id bigint, text string, source string", *[(i, t, "s") for i, t in enumerate(VALUES)])
    found = {(r.doc_id, r.found) for r in findings(docs).collect()}
    assert found == set(enumerate(VALUES.values()))
    plain = ["http://host:8080/a@b", "a: b, c=d", "compare == other", "password"]
    docs = frame("doc_id bigint, text string, source string", *[(i, t, "s") for i, t in enumerate(plain)])
    assert findings(docs).collect() == []


def test_short_passwords_are_masked(frame):
    rng = random.Random(4)
    words = "quick brown jumps over lazy dogs and runs with many others through forest".split()
    rows, hidden = [], []
    for i in range(120):
        text, value = rng.choices(words, k=12), None
        if i % 2:
            value = "".join(rng.choices("abcdefghjkmnpqrstuvwxyzABCDEFGH", k=7)) + rng.choice("!.@") + str(rng.randrange(10, 99))
        text.insert(5, f"password={value or rng.choice(words)}" if i % 4 < 2 else f"https://ann:{value or rng.choice(words)}@host/")
        rows.append((i, " ".join(text), "s"))
        hidden.append(value)
    masked = {r.doc_id: r.text for r in without_secrets(frame("doc_id bigint, text string, source string", *rows)).collect()}
    for (i, text, _), value in zip(rows, hidden):
        assert masked[i] == (text.replace(value, MARK) if value else text)


def test_long_values_end(frame):
    text = "password=" + "a.;" * 100_000 + " " + "://" + "u" * 50_000 + ":" + "x:" * 50_000
    docs = frame("doc_id bigint, text string, source string", (1, text, "s"))
    assert findings(docs).count() >= 1


def test_after_an_observation(spark, frame):
    """A session that has observed anything holds what a fitted forest must not carry along."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    test_made_up_findings(frame)
