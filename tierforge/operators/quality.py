"""Row rules with reject accounting, and foreign-key checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.operators.lookup import spread

REASONS = "reject_reasons"


class Rule(NamedTuple):
    """Rows where ``passes`` is not true (false or NULL) break the rule."""

    name: str
    passes: Column


class RuleOutcome(NamedTuple):
    kept: DataFrame
    rejects: DataFrame
    metrics: DataFrame


def not_null(cols: Iterable[str]) -> Column:
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in cols])


def in_range(col: str, low: Any = None, high: Any = None) -> Column:
    """Non-null and within the bounds; ``None`` leaves a side open."""
    value = F.col(col)
    bounds = []
    if low is not None:
        bounds.append(value >= low)
    if high is not None:
        bounds.append(value <= high)
    # A NULL is within no bound, so it needs no test of its own.
    return reduce(Column.__and__, bounds or [value.isNotNull()])


def matches(col: str, regex: str, allow_null: bool = True, allow_blank: bool = True) -> Column:
    """Pattern test; end patterns with ``\\z``, as ``$`` also matches before a last line break."""
    value = F.col(col)
    allowed = value.rlike(regex)
    if allow_null:
        allowed = allowed | value.isNull()
    if allow_blank:
        allowed = allowed | (value == "")
    return allowed


def require_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.filter(not_null(cols))


def require_range(df: DataFrame, bounds: dict[str, tuple[Any, Any]]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [in_range(col, *limits) for col, limits in bounds.items()]))


def require_pattern(
    df: DataFrame, col: str, regex: str, allow_null: bool = True, allow_blank: bool = True
) -> DataFrame:
    return df.filter(matches(col, regex, allow_null, allow_blank))


def _breaks(rule: Rule) -> Column:
    return ~F.coalesce(rule.passes, F.lit(False))


def _flag(number: int) -> str:
    return f"__breaks_{number}"


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with one Boolean column for each rule, so that rules are evaluated once a row.

    Counters and filters made with ``judged=True`` read them; ``keep_passing`` drops them.
    """
    return df.withColumns({_flag(number): _breaks(rule) for number, rule in enumerate(rules)})


def keep_passing(df: DataFrame, rules: Sequence[Rule], judged: bool = False) -> DataFrame:
    if judged:
        flags = [_flag(number) for number in range(len(rules))]
        return df.filter(~reduce(Column.__or__, [F.col(flag) for flag in flags])).drop(*flags)
    for rule in rules:
        df = df.filter(rule.passes)
    return df


def rule_counters(rules: Sequence[Rule], judged: bool = False) -> list[Column]:
    """Aggregates of the reject account, for ``agg`` or for ``observe``.

    ``failed:<rule>`` counts every row breaking the rule, ``dropped:<rule>`` the rows it
    is the first to break, as if the rules were applied one after another.
    """
    counters = [F.count(F.lit(1)).alias("rows_in")]
    passed_so_far = F.lit(True)
    for number, rule in enumerate(rules):
        breaks = F.col(_flag(number)) if judged else _breaks(rule)
        counters.append(F.count_if(breaks).alias(f"failed:{rule.name}"))
        counters.append(F.count_if(passed_so_far & breaks).alias(f"dropped:{rule.name}"))
        passed_so_far = passed_so_far & ~breaks
    counters.append(F.count_if(passed_so_far).alias("rows_kept"))
    return counters


def rejected(judged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The judged rows that break a rule, with the names of all that they break in ``REASONS``, in the rules' order."""
    flags = [_flag(number) for number in range(len(rules))]
    reasons = F.array_compact(F.array(*[F.when(F.col(f), F.lit(r.name)) for f, r in zip(flags, rules, strict=True)]))
    # The flags are tested by themselves: a test of the array would build it for every row.
    broken = judged.filter(reduce(Column.__or__, [F.col(flag) for flag in flags], F.lit(False)))
    return broken.withColumn(REASONS, reasons).drop(*flags)


def reject_counters(rules: Sequence[Rule]) -> list[Column]:
    """``failed:`` and ``dropped:`` of ``rule_counters``, as aggregates over ``rejected`` rows alone."""
    counters = []
    for rule in rules:
        counters.append(F.count_if(F.array_contains(REASONS, rule.name)).alias(f"failed:{rule.name}"))
        counters.append(F.count_if(F.col(REASONS)[0] == rule.name).alias(f"dropped:{rule.name}"))
    return counters


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> RuleOutcome:
    """Splits ``df`` into kept rows and rejects naming every broken rule, and counts both.

    kept + rejects = input. ``metrics`` has one row per rule: ``rule``, ``rows_in``,
    ``failed``, ``dropped`` (see ``rule_counters``) and ``rows_kept``, from one pass. Each of the three is
    a plan of its own over ``df``; the rules are evaluated once a row in each.
    """
    judged = judge(df, rules)
    rejects = rejected(judged, rules)
    lines = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col("rows_in"),
                F.col(f"`failed:{rule.name}`").alias("failed"),
                F.col(f"`dropped:{rule.name}`").alias("dropped"),
                F.col("rows_kept"),
            )
            for rule in rules
        ]
    )
    metrics = judged.agg(*rule_counters(rules, judged=True)).select(F.inline(lines))
    return RuleOutcome(keep_passing(df, rules), rejects, metrics)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: ``column``, ``total``, ``nulls``; one pass."""
    parts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(name).isNull()).alias("nulls"),
        )
        for name in cols
    ]
    return df.agg(F.array(*parts).alias("report")).select(F.inline("report"))


def _key_pairs(on: str | Sequence[str] | dict[str, str]) -> dict[str, str]:
    if isinstance(on, dict):
        return on
    return {name: name for name in ([on] if isinstance(on, str) else on)}


def _known_keys(dim: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Each key of ``dim`` once: neither side of the join then suffers from a hot key."""
    keys = dim.select(*[F.col(there).alias(f"__fk_{here}") for here, there in pairs.items()])
    known = keys.groupBy(*keys.columns, spread(*keys.columns)).agg(F.lit(True).alias("__fk_found"))
    return known.drop("__spread")


def _same_key(df: DataFrame, pairs: dict[str, str]) -> Column:
    return reduce(Column.__and__, [df[here] == F.col(f"__fk_{here}") for here in pairs])


def check_fk(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str] | dict[str, str], out: str = "fk_ok"
) -> DataFrame:
    """``df`` with ``out``: true where the key exists in ``dim``; a NULL key is false.

    ``on`` names shared columns, or maps columns of ``df`` to columns of ``dim``.
    """
    pairs = _key_pairs(on)
    joined = df.join(_known_keys(dim, pairs), _same_key(df, pairs), "left")
    flagged = joined.withColumn(out, F.coalesce("__fk_found", F.lit(False)))
    return flagged.drop("__fk_found", *[f"__fk_{here}" for here in pairs])


def fk_orphans(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str] | dict[str, str]
) -> DataFrame:
    """Rows of ``df`` whose non-null key is missing in ``dim``."""
    pairs = _key_pairs(on)
    keyed = df.filter(not_null(pairs))
    return keyed.join(_known_keys(dim, pairs), _same_key(keyed, pairs), "left_anti")
