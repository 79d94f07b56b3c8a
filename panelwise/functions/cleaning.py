"""Coercion of landed text to typed values; anything unreadable becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The texts that stand for "no value" in the landed feeds.
NULL_TOKENS = ("", "NA", "None", "nan")

# Fixed value: readings below this are the feed's "missing" marker (-999).
SENTINEL_FLOOR = -900.0


def to_number(text: Column) -> Column:
    """Text to double. Bad text and NaN become NULL.

    Java reads a trailing type letter ("1.5d") as part of a number; no feed does.
    """
    typed_literal = F.trim(text).rlike(r"[0-9.][dDfF]$")
    number = F.when(typed_literal, F.lit(None)).otherwise(text.try_cast("double"))
    return F.when(~F.isnan(number), number)


def null_if_token(text: Column) -> Column:
    """NULL when the trimmed text is one of the null tokens, else the text as it is."""
    return F.when(~F.trim(text).isin(*NULL_TOKENS), text)


def to_number_or_null_token(text: Column) -> Column:
    return to_number(null_if_token(text))


def parse_day(value: Column) -> Column:
    """An integer or text YYYYMMDD to a date; NULL when it is no calendar day."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def null_if_sentinel(value: Column, floor: float = SENTINEL_FLOOR) -> Column:
    return F.when(value >= floor, value)


def is_year(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike(r"^[0-9]{4}$"), F.lit(False))


def is_code(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike(r"^[A-Za-z]{3}$"), F.lit(False))
