"""Spans against plain Python matching."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from balcao.llm.pii import passes_mod97, personal_data, personal_data_digest
from balcao.llm.spans import BLOCK, CONTEXT, located

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, d in enumerate(map(int, reversed(number))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def valid(kind, text):
    number = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 14 <= len(number) <= 19 and luhn(number)
    return kind != "phone" or 10 <= len(number) <= 15


def expected(text):
    spans = [
        (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]
    counts = [sum(s[1] == rank for s in spans) for rank in range(4)]
    joined = ",".join(s[2] for s in sorted(spans))
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def cases():
    rng = random.Random(5)
    parts = [
        "a@b.co", "x.y..z@d-e.f.g.", "@", ".", "..", "a@b", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8",
        "4111 1111 1111 1111", "4111-1111--1111-1111", "0" * 14, " ", "-", "+1 (555) 123-4567", "+",
        "+49.30.1234567-", "9", "12", "é", "\U0001f600", "_", "\n", "x", "00.0.0.007", "4 " * 16, "b.c@d.e_f@g.h",
    ]
    made = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(300)]
    long = "4 " * 30_000 + "a." * 30_000 + "@b" + ".c" * 30_000 + " +1" + "-1" * 30_000 + "1.2.3.4 " * 3_000
    return [None, "", *parts, *made, long]


def test_base_spans_equal_plain_matching(frame):
    texts = cases()
    docs = frame("doc_id bigint, text string, spans string", *[(i, t, "x") for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in personal_data_digest(docs).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == expected(text), text and text[:200]


def test_added_kinds_need_checksum_or_context(frame):
    texts = [
        "pay to IBAN DE89 3704 0044 0532 0130 00 today",
        "pay to DE89370400440532013001",
        "my SSN is 123-45-6789",
        "part 123-45-6789",
        "ssn 000-45-6789",
    ]
    docs = frame("doc_id bigint, text string", *enumerate(texts))
    found = {r.doc_id: [(s.kind, s.found) for s in r.spans] for r in personal_data(docs).collect()}
    assert ("iban", "DE89 3704 0044 0532 0130 00") in found[0]
    assert not any(kind == "iban" for kind, _ in found[1])
    assert ("national_id", "123-45-6789") in found[2]
    assert not any(kind == "national_id" for kind, _ in found[3] + found[4])


@pytest.mark.parametrize("size", [1, BLOCK, BLOCK + 1, 3 * BLOCK])
def test_positions_over_many_matches(frame, size):
    docs = frame("text string", ("é1" * size,))
    spans = docs.select(located(docs.text, "[0-9]").alias("s")).first().s
    assert [(s.start, s.end) for s in spans] == [(2 * i + 1, 2 * i + 2) for i in range(size)]


def test_empty_table(frame):
    assert personal_data_digest(frame("doc_id bigint, text string").limit(0)).collect() == []


def test_mod97(values):
    assert values(passes_mod97, ["GB82WEST12345698765432", "GB82WEST12345698765433"]) == [True, False]


@pytest.mark.parametrize("size", [2, BLOCK + 2])
def test_context_reaches_over_earlier_matches(frame, size):
    text = "é key " + "12, " * size
    spans = frame("text string", (text,)).select(located(F.col("text"), "[0-9]+").alias("s")).first().s
    assert [s.before for s in spans] == [text[max(0, s.start - CONTEXT) : s.start] for s in spans]


def test_one_context_word_for_several_numbers(frame):
    docs = frame("doc_id bigint, text string", (0, "SSN 123-45-6789, 321-54-9876"))
    found = [(s.kind, s.found) for s in personal_data(docs).first().spans]
    assert [f for f in found if f[0] == "national_id"] == [("national_id", "123-45-6789"), ("national_id", "321-54-9876")]


def test_account_numbers_before_words_and_numbers(frame):
    german, british = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    texts = {
        f"IBAN {german} BIC COBADEFFXXX": [german],
        f"{german} 17": [german],
        f"{german} {british} {german}": [german, british, german],
        f"REF AB12 {german} X": [german],
        f"{german.replace(' ', '')} {british.replace(' ', '')}": [german.replace(" ", ""), british.replace(" ", "")],
        "DE89 3704 0044 0532 0130 01 BIC": [],
        f"é {german}X": [],
    }
    # All that may follow, some of it passing mod 97 by chance.
    texts |= {f"{german} {n}": [german] for n in range(100, 400)}
    docs = frame("doc_id bigint, text string", *enumerate(texts))
    rows = {r.doc_id: [s for s in r.spans if s.kind == "iban"] for r in personal_data(docs).collect()}
    for i, (text, wanted) in enumerate(texts.items()):
        assert [s.found for s in rows[i]] == wanted, text
        assert [text[s.start : s.end] for s in rows[i]] == wanted


def test_unlisted_countries_and_overlaps(values):
    from balcao.llm.pii import _apart, account_number

    def valid(body, country):
        turned = "".join(str(int(c, 36)) for c in body + country + "00")
        return f"{country}{98 - int(turned) % 97:02d}{body}"

    code = valid("1234567890123", "ZZ")
    assert values(account_number, [f"{code} ABC"]) == [code]
    spans = [[{"start": a, "end": b} for a, b in [(0, 9), (5, 14), (10, 20), (20, 25)]], [{"start": 1, "end": 2}], []]
    found = values(_apart, spans, "array<struct<start:int,end:int>>")
    assert [[s.start for s in row] for row in found] == [[0, 10, 20], [1], []]
