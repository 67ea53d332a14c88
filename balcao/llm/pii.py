"""Personal data in texts: patterns propose, checksums confirm, context moves the score.

Every kind has a pattern that proposes spans, a check that confirms or drops them (digit
counts, Luhn, mod 97, number ranges) and words which, shortly before a span, raise its score.
A span stays if its score reaches ``KEEP_SCORE``; the kinds of ``BASE`` reach it by their
pattern and check alone, the others need more. All of it is column functions.

The patterns are written so that Java's matcher neither recurses nor rescans: repeated groups
are replaced by one character class over a copy of the text in which separators that cannot
be inside a match are exchanged for another character. The copy has the same positions.

Spans count code points from 0, ends exclusive. Null texts count as empty; empty texts and
empty tables give no spans. Repeated rows are looked at each on their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.llm.spans import let, located

KEEP_SCORE = 0.5
CONTEXT_BONUS = 0.35

_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Characters of an account number by country.
_ACCOUNT_LENGTHS = (
    "AD24AE23AL28AT20AZ28BA20BE16BG22BH22BR29BY28CH21CR22CY28CZ24DE22DK18DO28EE20EG29ES24FI18FO18FR27"
    "GB22GE22GI23GL18GR27GT28HR21HU28IE22IL23IQ23IS26IT27JO30KW30KZ20LB28LC32LI21LT20LU20LV21LY25MC27"
    "MD24ME22MK19MR27MT31MU30NL18NO15PK24PL28PS29PT25QA29RO24RS22SA24SC31SE24SI19SK24SM27ST25SV28TL23"
    "TN24TR26UA29VA22VG24XK20"
)
_SPAN = "struct<start:int,rank:int,kind:string,end:int,found:string,score:double>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Luhn's check over a string of digits."""
    size = F.length(number)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, size - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0


def passes_mod97(code: Column) -> Column:
    """The account-number check: first four characters last, letters as 10 to 35."""
    turned = F.concat(F.substring(code, 5, 1 << 20), F.substring(code, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        value = F.ascii(char)
        number = F.when(value >= 65, value - 55).otherwise(value - 48)
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _digit_count(least: int, most: int) -> Callable[[Column], Column]:
    return lambda found: F.length(digits(found)).between(least, most)


def _without_separators(found: Column) -> Column:
    return F.replace(found, F.lit(" "), F.lit(""))


def account_number(found: Column) -> Column:
    """What of ``found``, up to its end or a blank, passes mod 97: of its country's length, or else the longest."""

    def code(end: Column) -> Column:
        return _without_separators(F.substring(found, F.lit(1), end))

    def rank(end: Column) -> Column:
        place = F.instr(F.lit(_ACCOUNT_LENGTHS), F.substring(found, 1, 2))
        fixed = F.when(place > 0, F.substring(F.lit(_ACCOUNT_LENGTHS), place + 2, F.lit(2)).cast("int"))
        right = F.coalesce(F.length(code(end)) == fixed, F.lit(False))
        return F.struct(right.alias("right"), end.alias("end"))

    ends = F.filter(
        F.sequence(F.lit(15), F.length(found)),
        lambda end: F.substring(found, end + 1, F.lit(1)).isin("", " ")
        & (F.substring(found, end, F.lit(1)) != " ")
        & (F.length(code(end)) >= 15),
    )
    passing = F.filter(ends, lambda end: passes_mod97(code(end)))
    best = F.array_max(F.transform(passing, rank))
    return F.substring(found, F.lit(1), best["end"])


def _apart(spans: Column) -> Column:
    """``spans`` in text order without those that begin inside one that stays."""

    def begins_inside(span: Column, place: Column) -> Column:
        return (place > 0) & (span["start"] < F.get(spans, place - 1)["end"])

    def add(state: Column, span: Column) -> Column:
        return F.when(span["start"] < state["at"], state).otherwise(
            F.struct(span["end"].alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        )

    some = F.exists(F.transform(spans, begins_inside), lambda inside: inside)
    first = F.struct(F.lit(0).alias("at"), F.slice(spans, 1, 0).alias("spans"))
    return F.when(some, F.aggregate(spans, first, add, lambda state: state["spans"])).otherwise(spans)


@dataclass(frozen=True)
class Kind:
    """One kind of personal data; ``view`` is the text the pattern runs on."""

    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    context: str
    hint: str  # texts without this hold no span
    view: Callable[[Column], Column] = lambda text: text
    group: int = 0  # of the pattern; other than 0 where spans are sought that may overlap
    fitted: Callable[[Column], Column] | None = None  # what of a proposed span stays, null: nothing


BASE = (
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
        lambda found: F.lit(True),
        0.6,
        "mail|contact|write",
        "@",
        # A dot that no label follows ends a domain, but not the name before the sign.
        lambda text: F.regexp_replace(text, r"\.(?![A-Za-z0-9-])", "_"),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda found: found.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"),
        0.5,
        "ip|address|host|server",
        r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    ),
    Kind(
        "card",
        r"[0-9][0-9 -]*(?<=[0-9])",
        lambda found: F.when(_digit_count(14, 19)(found), passes_luhn(digits(found))),
        0.7,
        "card|visa|credit|payment",
        "[0-9](?:[ -]?[0-9]){13}",
        # Two separators in a row end a number.
        lambda text: F.regexp_replace(text, "[ -](?=[ -])|(?<=[ -])[ -]", "x"),
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        _digit_count(10, 15),
        0.6,
        "phone|call|tel|mobile|fax",
        r"\+[0-9][ ().0-9-]",
    ),
)

EXTRA = (
    Kind(
        "iban",
        "(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}",
        lambda found: found.isNotNull(),
        0.8,
        "iban|account|bank",
        "[A-Z]{2}[0-9]{2} ?[A-Z0-9]",
        group=1,
        fitted=account_number,
    ),
    # Nothing confirms such a number, so it needs its context.
    Kind(
        "national_id",
        "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda found: ~found.rlike("^(?:000|666|9)") & ~found.rlike("-00-|-0000$"),
        0.3,
        "ssn|social security",
        "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    ),
)


def _spans_of(text: Column, kind: Kind, rank: int) -> Column:
    def scored(view: Column) -> Callable[[Column], Column]:
        def score(span: Column) -> Column:
            bonus = F.when(F.lower(span["before"]).rlike(rf"\b(?:{kind.context})"), CONTEXT_BONUS)
            size = span["end"] - span["start"]
            return F.struct(
                span["start"].alias("start"),
                F.lit(rank).alias("rank"),
                F.lit(kind.name).alias("kind"),
                span["end"].alias("end"),
                F.when(view == text, span["found"])
                .otherwise(F.substring(text, span["start"] + 1, size))
                .alias("found"),
                (F.lit(kind.score) + F.coalesce(bonus, F.lit(0.0))).alias("score"),
            )

        return score

    def fit(span: Column) -> Column:
        def put(found: Column) -> Column:
            end = (span["start"] + F.length(found)).alias("end")
            return F.struct(span["start"].alias("start"), end, found.alias("found"), span["before"].alias("before"))

        return let(kind.fitted(span["found"]), put)

    def kept(view: Column) -> Column:
        proposed = located(view, kind.pattern, kind.group)
        if kind.fitted is not None:
            proposed = F.transform(proposed, fit)
        confirmed = F.filter(proposed, lambda span: kind.check(span["found"]))
        if kind.group:
            confirmed = let(confirmed, _apart)
        spans = F.transform(confirmed, scored(view))
        return F.filter(spans, lambda span: span["score"] >= KEEP_SCORE)

    none = F.array().cast(f"array<{_SPAN}>")
    spans = let(kind.view(text), kept)
    return F.when(text.rlike(kind.hint), spans).otherwise(none)


def personal_data(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    kinds: tuple[Kind, ...] = BASE + EXTRA,
) -> DataFrame:
    """``id_column`` and ``spans``: (start, rank, kind, end, found, score) in text order."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = [_spans_of(text, kind, rank) for rank, kind in enumerate(kinds)]
    return docs.select(F.col(id_column), F.array_sort(F.concat(*found)).alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``documents``."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return personal_data(docs).select(
        "doc_id",
        *[count(kind.name).alias(f"n_{kind.name}") for kind in BASE],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )
