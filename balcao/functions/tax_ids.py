"""Check digits of tax ids: which ids are right, and which were right before zeros were cut off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from balcao.functions.text import tax_id

DIGITS = 11
# What became of an id.
VALID, PADDED, UNREPAIRABLE, MISSING = "valid", "padded", "unrepairable", "missing"


def check_digit(digits: Column, first: int) -> Column:
    """Modulo-11 digit over the leading digits, weighted from ``first`` down to 2."""
    weights = F.sequence(F.lit(first), F.lit(2), F.lit(-1))
    leading = F.split(F.substring(digits, 1, first - 1), "")
    products = F.zip_with(leading, weights, lambda digit, weight: digit.try_cast("int") * weight)
    left = F.aggregate(products, F.lit(0), lambda total, product: total + product) % 11
    return F.get(F.transform(F.array(left), lambda r: F.when(r < 2, F.lit(0)).otherwise(11 - r)), F.lit(0))


def is_valid(digits: Column) -> Column:
    """Eleven digits, not all the same, the last two of which follow from the others."""
    shaped = digits.rlike(r"^[0-9]{11}$") & ~digits.rlike(r"^([0-9])\1{10}$")
    wanted = F.concat(check_digit(digits, 10).cast("string"), check_digit(digits, 11).cast("string"))
    return F.coalesce(F.when(shaped, wanted == F.substring(digits, 10, 2)), F.lit(False))


def repaired(text: Column) -> Column:
    """``id`` and ``state`` of a tax id as written.

    Zeros are put in front only where the longer id has the right check digits; every other id
    keeps its digits, so no valid one changes.
    """
    digits = tax_id(text)
    padded = F.when(F.length(digits) < DIGITS, F.lpad(digits, DIGITS, "0")).otherwise(digits)
    filled = F.coalesce(digits != "", F.lit(False))
    return F.when(
        filled & is_valid(padded),
        F.struct(
            padded.alias("id"), F.when(F.length(digits) < DIGITS, PADDED).otherwise(VALID).alias("state")
        ),
    ).otherwise(F.struct(digits.alias("id"), F.when(filled, UNREPAIRABLE).otherwise(MISSING).alias("state")))
