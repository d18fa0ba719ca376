"""Tolerant conversions from text. Malformed text becomes NULL, under ANSI too.

A *converter* is a ``Column -> Column`` function, so that one definition serves
both the cast and the count of what the cast could not read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Converter = Callable[[Column], Column]

# Fixed value: text form of the source's timestamps.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# What a cast can read. A cast that fails raises and catches an error for every
# value, some twenty times the cost of this test; where much text is malformed it
# would rule the run time.
_INTEGER = r"^[\x00-\x20\x7f]*[+-]?\d+[\x00-\x20\x7f]*\z"
_MOMENT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
_INTEGER_TYPES = ("tinyint", "smallint", "int", "integer", "bigint", "long")

# Sums of decimals are exact and do not depend on how rows are partitioned.
MONEY = "decimal(18,2)"


def is_missing(value: Column) -> Column:
    """NULL or empty text."""
    return value.isNull() | (value == "")


def to_type(data_type: str) -> Converter:
    if data_type in _INTEGER_TYPES:
        return lambda value: F.when(value.rlike(_INTEGER), value.try_cast(data_type))
    return lambda value: value.try_cast(data_type)


def to_timestamp(fmt: str | None = TIMESTAMP_FORMAT) -> Converter:
    """With a format the whole text must match it; ``None`` means Spark's default parsing."""
    if fmt is None:
        return lambda value: F.try_to_timestamp(value)
    if fmt == TIMESTAMP_FORMAT:
        # The cast reads this shape, among others, and faster than a format does.
        return lambda value: F.when(value.rlike(_MOMENT), value.try_cast("timestamp"))
    return lambda value: F.try_to_timestamp(value, F.lit(fmt))


def blank_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def blank_as_value(data_type: str, default: Any) -> Converter:
    """NULL or empty text gives ``default``; malformed text still gives NULL."""
    read = to_type(data_type)
    return lambda value: F.when(is_missing(value), F.lit(default).cast(data_type)).otherwise(read(value))


def _fraction(number: Column) -> Column:
    """The digits after the point, without zeros at the end."""
    return F.regexp_extract(number, r"\.(\d*?)0*\s*\z", 1)


def was_rounded(text: Column, amount: Column) -> Column:
    """True where a decimal ``amount`` is not all that its ``text`` says, to the last digit."""
    # Three digits after a point need three signs after the first one; few texts go on to the patterns.
    long = F.length(text) - F.instr(text, ".") >= 3
    finer = long & text.rlike(r"\.\d{3}") & (_fraction(text) != _fraction(amount.cast("string")))
    # With an exponent the digits do not line up; numbers this small or large are told apart as doubles.
    scaled = text.try_cast("double") != amount.cast("double")
    return F.coalesce(F.when(text.contains("e") | text.contains("E"), scaled).otherwise(finer), F.lit(False))
