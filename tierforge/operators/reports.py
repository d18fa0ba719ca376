"""Grouped reports and top-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(value: str | Column, digits: int | None = None) -> Column:
    """Sum, rounded half-up; NULL for a group without values."""
    summed = F.sum(value)
    return summed if digits is None else F.round(summed, digits)


def average(value: str | Column, digits: int | None = None) -> Column:
    mean = F.avg(value)
    return mean if digits is None else F.round(mean, digits)


def non_null_count(value: str | Column) -> Column:
    return F.count(value)


def rollup_report(
    df: DataFrame,
    keys: str | Sequence[str] | dict[str, Column],
    measures: dict[str, Column],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Measures per key; NULL is a group of its own.

    ``keys`` are column names, or ``{name: expression}`` for derived keys. ``order``
    sorts the finished (small) report and may name keys and measures.
    """
    if isinstance(keys, dict):
        groups = [expression.alias(name) for name, expression in keys.items()]
    else:
        groups = [keys] if isinstance(keys, str) else list(keys)
    report = df.groupBy(*groups).agg(*[measure.alias(name) for name, measure in measures.items()])
    return report.orderBy(*order) if order else report


def top_n(
    df: DataFrame, key: str, measures: dict[str, Column], by: str, n: int
) -> DataFrame:
    """The ``n`` groups with the greatest ``by``; ties go by key, NULL key last."""
    report = rollup_report(df, key, measures)
    return report.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(key)).limit(n)
