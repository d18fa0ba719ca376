"""Flags, labels and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def true_or_false(predicate: Column) -> Column:
    """The predicate as a flag; an unknown (NULL) outcome is false."""
    return F.when(predicate, True).otherwise(False)


def label_on_time(actual: Column, due: Column, on_time: str = "On Time", late: str = "Late") -> Column:
    """Compares timestamps, not days; a missing date on either side counts as late."""
    return F.when(actual <= due, on_time).otherwise(late)


def calendar_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def month_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")
