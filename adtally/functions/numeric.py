"""Exact ratios, the two rounding rules, and numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sums of decimal(18,4) money fit; ten decimals survive a division.
_RATIO = "decimal(28,10)"
# Numbers written as text have any number of decimals.
TEXT_NUMBER = "decimal(38,18)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient with ten decimals; NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast(_RATIO), denominator.cast(_RATIO)).cast(_RATIO)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Like :func:`ratio`, but 0 when there is nothing to divide by."""
    return F.when(denominator > 0, ratio(numerator, denominator)).otherwise(F.lit(0).cast(_RATIO))


def ratio_floor_one(numerator: Column, denominator: Column) -> Column:
    """Quotient where a zero denominator counts as one, so the result is the numerator."""
    return ratio(numerator, F.when(denominator == 0, F.lit(1)).otherwise(denominator))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole)


def percent_change(new: Column, old: Column) -> Column:
    """Growth in percent; an old value of zero counts as one."""
    return (ratio_floor_one(new * 100, old) - 100).cast(_RATIO)


def half_up(value: Column, places: int) -> Column:
    """SQL NUMERIC rounding: a tie moves away from zero."""
    return F.round(value.cast(_RATIO), places)


def half_even(value: Column, places: int) -> Column:
    """Data-frame rounding: a tie moves to the even digit."""
    return F.bround(value.cast(_RATIO), places)


def clamp(value: Column, low: str, high: str) -> Column:
    """Limit to [low, high]; the bounds are decimal literals given as text."""
    bound = lambda text: F.lit(text).cast(_RATIO)
    return F.least(F.greatest(value.cast(_RATIO), bound(low)), bound(high))


def text_number(text: Column, blank: Column | None = None, infinite_as_null: bool = False,
                strict: bool = True) -> Column:
    """A number written with decimal comma and inner spaces, with all of up to 18 decimals.

    NULL or blank text gives ``blank`` (NULL by default).  ``strict`` raises on any
    other unreadable text; otherwise it becomes NULL.
    """
    trimmed = F.trim(text)
    digits = F.translate(trimmed, ", ", ".")
    number = digits.cast(TEXT_NUMBER) if strict else digits.try_cast(TEXT_NUMBER)
    empty = text.isNull() | (trimmed == "")
    fallback = F.lit(None).cast(TEXT_NUMBER) if blank is None else blank.cast(TEXT_NUMBER)
    result = F.when(empty, fallback)
    if infinite_as_null:
        result = result.when(F.lower(trimmed) == "inf", F.lit(None).cast(TEXT_NUMBER))
    return result.otherwise(number)


def number_or_zero(text: Column, type_: str) -> Column:
    """Parse, with anything unreadable counted as zero."""
    return F.coalesce(text.try_cast(type_), F.lit(0).cast(type_))
