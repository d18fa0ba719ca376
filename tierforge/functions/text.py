"""Text standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CASES = {"trim": lambda c: c, "title": F.initcap, "upper": F.upper, "lower": F.lower}


def clean_text(value: Column, case: str = "trim", collapse_whitespace: bool = False) -> Column:
    """Strip outer blanks, then apply ``trim``, ``title``, ``upper`` or ``lower``.

    ``collapse_whitespace`` also turns every inner run of white space into one blank.
    """
    if case not in _CASES:
        raise ValueError(f"unknown case {case!r}, expected one of {sorted(_CASES)}")
    if collapse_whitespace:
        value = F.regexp_replace(value, r"\s+", " ")
    return _CASES[case](F.trim(value))


def map_codes(value: Column, labels: dict[str, str], default: str | None = "keep") -> Column:
    """Label of a code. Unknown codes stay (``"keep"``) or become ``default``."""
    fallback = value if default == "keep" else F.lit(default)
    if not labels:
        return fallback
    (first, label), *rest = labels.items()
    branches = F.when(value == first, label)
    for code, label in rest:
        branches = branches.when(value == code, label)
    return branches.otherwise(fallback)


def any_text(*values: Column) -> Column:
    """1 when one of the texts is present and not empty, else 0."""
    present = F.lit(False)
    for value in values:
        present = present | F.coalesce(value != "", F.lit(False))
    return F.when(present, 1).otherwise(0)
