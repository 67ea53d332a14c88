"""Text at the edge: Brazilian numbers, keys and names, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions.money import round2

# Characters treated as white space when trimming; plain ``trim`` only knows the space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NOT_A_NUMBER = r"(?i)^[+-]?(nan|inf|infinity)$"
DIGITS = r"^[0-9]+$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    stripped = strip(text)
    return F.when(stripped != "", stripped)


def _drop(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def to_number(text: Column) -> Column:
    """Plain decimal text to double; anything else, NaN and infinity become null."""
    stripped = strip(text)
    return F.when(stripped.rlike(NUMBER), _finite(stripped.try_cast("double")))


def br_to_double(text: Column) -> Column:
    """``12.345,67`` to 12345.67. Every dot is a thousands mark, so ``1234.5`` is 12345."""
    return to_number(F.replace(_drop(strip(text), "."), F.lit(","), F.lit(".")))


def br_or_zero(text: Column) -> Column:
    return F.coalesce(br_to_double(text), F.lit(0.0))


def _swap_marks(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def br_text(value: Column) -> Column:
    """-1234.5 to ``-1.234,50``; a value that rounds to zero carries no sign."""
    # With two decimals only the text as a whole can be ``-0,00``; it is written once.
    return F.replace(_swap_marks(F.format_number(value, 2)), F.lit("-0,00"), F.lit("0,00"))


def br_text_unsigned(value: Column) -> Column:
    return br_text(F.abs(value))


def br_text_in_parentheses(value: Column) -> Column:
    """Negative amounts as ``(1.234,50)``."""
    unsigned = br_text_unsigned(value)
    return F.when(value < 0, F.concat(F.lit("("), unsigned, F.lit(")"))).otherwise(unsigned)


def br_text_keep_zero_sign(value: Column) -> Column:
    """As ``br_text`` but a tiny negative stays ``-0,00``."""
    return _swap_marks(F.format_number(value, 2))


def quantity_text(text: Column) -> Column:
    """``1234`` to ``1.234``; fractions keep a dot as well (``1.234.5``); junk is unchanged."""
    number = to_number(text)
    whole = _swap_marks(F.format_number(number, 0))
    plain = F.abs(number).cast("decimal(38,10)").cast("string")
    fraction = F.rtrim(F.substring_index(plain, ".", -1), F.lit("0"))
    integer = F.replace(
        F.format_number(F.floor(F.abs(number)).cast("double"), 0), F.lit(","), F.lit(".")
    )
    sign = F.when(number < 0, "-").otherwise("")
    return (
        F.when(number.isNull(), text)
        .when(number == F.rint(number), whole)
        .otherwise(F.concat(sign, integer, F.lit("."), fraction))
    )


def _reject(text: Column, what: str) -> Column:
    message = F.concat(F.lit(f"not {what}: "), F.coalesce(text, F.lit("<missing>")))
    return F.raise_error(message)


def _percent(text: Column) -> Column:
    return strip(F.replace(_drop(text, "%"), F.lit(","), F.lit(".")))


def is_percent(text: Column) -> Column:
    """Does ``percent_to_double`` read it? Missing text is read as null."""
    plain = _percent(text)
    return plain.isNull() | (plain == "") | plain.rlike(NOT_A_NUMBER) | plain.rlike(NUMBER)


def percent_to_double(text: Column) -> Column:
    """``12,5%`` to 12.5. Blank and NaN are null; other junk fails the job."""
    plain = _percent(text)
    return (
        F.when(plain.isNull() | (plain == "") | plain.rlike(NOT_A_NUMBER), F.lit(None))
        .when(plain.rlike(NUMBER), _finite(plain.try_cast("double")))
        .otherwise(_reject(text, "a percentage"))
        .cast("double")
    )


def percent_text(points: Column) -> Column:
    """12.5 to ``12,50%``. The sign of a negative repeats on the decimals: ``-5,-25%``."""
    rounded = round2(points)
    whole = rounded.cast("bigint")
    decimals = F.rint((rounded - whole) * 100).cast("bigint").cast("string")
    padded = F.when(F.length(decimals) < 2, F.lpad(decimals, 2, "0")).otherwise(decimals)
    return F.concat(whole.cast("string"), F.lit(","), padded, F.lit("%"))


def branch_key(text: Column, keep_zeros: bool = False) -> Column:
    """``F01``, ``01``, ``1.0`` to ``1``; names such as ``MATRIZ`` stay; missing is ``""``."""
    plain = F.regexp_replace(F.upper(strip(text)), "^F", "")
    if keep_zeros:
        return F.coalesce(plain, F.lit(""))
    as_integer = to_number(plain).try_cast("bigint").cast("string")
    return F.coalesce(as_integer, plain, F.lit(""))


def branch_without_f(text: Column) -> Column:
    """Upper-case, every ``F`` dropped, trimmed; leading zeros are kept."""
    return strip(_drop(F.upper(text), "F"))


def code_key(text: Column) -> Column:
    """``20.0`` to ``20``: every ``.0`` goes, wherever it stands (``10.05`` is ``105``)."""
    return strip(_drop(text, ".0"))


def to_whole(text: Column, what: str) -> Column:
    """Whole number, or fail the job: a bad key must not disappear silently."""
    stripped = strip(text)
    return F.when(stripped.rlike(r"^[+-]?[0-9]+$"), stripped.try_cast("bigint")).otherwise(
        _reject(text, what).cast("bigint")
    )


def is_whole(text: Column) -> Column:
    """Does ``to_whole`` read a number from it?"""
    stripped = strip(text)
    return F.coalesce(stripped.rlike(r"^[+-]?[0-9]+$") & stripped.try_cast("bigint").isNotNull(), F.lit(False))


def branch_number(text: Column) -> Column:
    return to_whole(_drop(text, "F"), "a branch number")


def is_branch_number(text: Column) -> Column:
    return is_whole(_drop(text, "F"))


def code_number(text: Column) -> Column:
    return to_whole(_drop(text, ".0"), "a seller code")


def is_code_number(text: Column) -> Column:
    return is_whole(_drop(text, ".0"))


def tax_id(text: Column, pad: bool = False) -> Column:
    """Digits only. ``pad`` restores leading zeros lost upstream (11 digits)."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    if not pad:
        return digits
    return F.when((digits != "") & (F.length(digits) < 11), F.lpad(digits, 11, "0")).otherwise(
        digits
    )


def upper_name(text: Column) -> Column:
    return F.upper(strip(text))


def role_of(title: Column) -> Column:
    """``12 - GERENTE`` to ``GERENTE``: what follows the first dash."""
    return upper_name(F.regexp_replace(title, r"(?s)^[^-]*-", ""))


def zero_pad2(text: Column) -> Column:
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def person_id(branch: Column, code: Column) -> Column:
    """Branch and code side by side, without a separator: (1, 23) and (12, 3) collide."""
    return F.concat(branch.cast("string"), code.cast("string"))


def is_digits(text: Column) -> Column:
    return F.coalesce(text.rlike(DIGITS), F.lit(False))


def first_word(text: Column) -> Column:
    return F.get(F.split(strip(text), r"[\s\u00a0]+"), F.lit(0))


def clean_email(text: Column) -> Column:
    stripped = strip(text)
    return F.when(stripped.isNull() | (stripped == "nan"), "").otherwise(stripped)


def channel_share(sales: Column) -> Column:
    return round2(sales * vocab.CHANNEL_SHARE)


def export_text(text: Column) -> Column:
    """One line of plain text: missing values blank, no line breaks, no double quotes."""
    plain = F.regexp_replace(text, r"[\n\r\t]+", " ")
    plain = F.replace(plain, F.lit('"'), F.lit("'"))
    return F.when(text.isNull() | text.isin("nan", "None"), "").otherwise(plain)
