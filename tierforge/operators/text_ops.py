"""Text standardisation over named columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.functions.text import any_text, clean_text, map_codes


def standardize_text(
    df: DataFrame, cases: dict[str, str], collapse_whitespace: bool = False
) -> DataFrame:
    """``{column: "trim" | "title" | "upper" | "lower"}``."""
    return df.withColumns(
        {name: clean_text(F.col(name), case, collapse_whitespace) for name, case in cases.items()}
    )


def fill_text(df: DataFrame, cols: Iterable[str], value: str = "") -> DataFrame:
    """Trimmed text, with ``value`` in place of NULL."""
    return df.withColumns({name: F.coalesce(F.trim(name), F.lit(value)) for name in cols})


def map_values(
    df: DataFrame, col: str, mapping: dict[str, str], default: str | None = "keep"
) -> DataFrame:
    return df.withColumn(col, map_codes(F.col(col), mapping, default))


def has_text(df: DataFrame, cols: Iterable[str], out: str) -> DataFrame:
    return df.withColumn(out, any_text(*[F.col(name) for name in cols]))
