"""Typing of text columns, and the account of what could not be typed."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.functions.casts import (
    TIMESTAMP_FORMAT,
    Converter,
    blank_as_null,
    blank_as_value,
    is_missing,
    to_timestamp,
    to_type,
)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({name: to_type(data_type)(F.col(name)) for name, data_type in types.items()})


def parse_timestamps(
    df: DataFrame, cols: Iterable[str], fmt: str | None = TIMESTAMP_FORMAT
) -> DataFrame:
    parse = to_timestamp(fmt)
    return df.withColumns({name: parse(F.col(name)) for name in cols})


def blank_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({name: blank_as_null(F.col(name)) for name in cols})


def default_if_blank(df: DataFrame, defaults: dict[str, tuple[str, Any]]) -> DataFrame:
    """``{column: (type, default)}``: blanks take the default, malformed text becomes NULL."""
    return df.withColumns(
        {
            name: blank_as_value(data_type, default)(F.col(name))
            for name, (data_type, default) in defaults.items()
        }
    )


def cast_report(df: DataFrame, converters: dict[str, str | Converter]) -> DataFrame:
    """Rows per column: total, missing, malformed (text given, but unreadable) and valid.

    One aggregation over the input, whatever the number of columns.
    """
    parts = []
    for name, converter in converters.items():
        convert = to_type(converter) if isinstance(converter, str) else converter
        value = F.col(name)
        missing = is_missing(value)
        readable = convert(value).isNotNull()
        parts.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(F.lit(1)).alias("total"),
                F.count_if(missing).alias("missing"),
                F.count_if(~missing & ~readable).alias("malformed"),
                F.count_if(~missing & readable).alias("valid"),
            )
        )
    return df.agg(F.array(*parts).alias("report")).select(F.inline("report"))
