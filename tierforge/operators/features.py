"""Delivery-time features and report labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.functions.dates import calendar_days, label_on_time, month_text, true_or_false


def flag(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    return df.withColumn(name, true_or_false(predicate))


def on_time_label(df: DataFrame, actual: str, due: str, out: str) -> DataFrame:
    return df.withColumn(out, label_on_time(F.col(actual), F.col(due)))


def days_between(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    return df.withColumn(out, calendar_days(F.col(start), F.col(end)))


def delay_features(df: DataFrame, start: str, due: str, actual: str) -> DataFrame:
    """Planned and actual calendar days, their difference (negative is early), late flag.

    The flag compares days; ``on_time_label`` compares timestamps. They differ for a
    delivery on the due day after the due time.
    """
    planned = calendar_days(F.col(start), F.col(due))
    taken = calendar_days(F.col(start), F.col(actual))
    return df.withColumns(
        {
            "delivery_days_planned": planned,
            "delivery_days_actual": taken,
            "delivery_delay_days": taken - planned,
            "is_delayed": true_or_false(taken - planned > 0),
        }
    )


def month_bucket(df: DataFrame, moment: str, out: str) -> DataFrame:
    return df.withColumn(out, month_text(F.col(moment)))
