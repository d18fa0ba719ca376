"""Table statistics as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STATS = {"min": F.min, "max": F.max, "mean": F.avg}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def frequencies(df: DataFrame, col: str, out: str = "total") -> DataFrame:
    """Rows per value; NULL is a value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def summarize(
    df: DataFrame, cols: Sequence[str], stats: Sequence[str] = ("min", "max", "mean")
) -> DataFrame:
    """One row per numeric column with the chosen statistics as doubles; one pass."""
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                *[_STATS[stat](F.col(name).cast("double")).alias(f"{stat}_value") for stat in stats],
            )
            for name in cols
        ]
    )
    return df.agg(lines.alias("report")).select(F.inline("report"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row per column: ``distinct_values`` counts NULL as a value, ``distinct_non_null`` not.

    ``approx`` replaces the shuffle of all distinct values by fixed-size sketches.
    """
    count = F.approx_count_distinct if approx else F.count_distinct
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                (
                    count(F.col(name)) + F.coalesce(F.max(F.col(name).isNull().cast("long")), F.lit(0))
                ).alias("distinct_values"),
                count(F.col(name)).alias("distinct_non_null"),
            )
            for name in cols
        ]
    )
    return df.agg(lines.alias("report")).select(F.inline("report"))


def share_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``total``, ``matching`` and ``percent`` of the rows where the predicate is true.

    An empty input has no share: ``percent`` is NULL.
    """
    hit = F.coalesce(predicate, F.lit(False)).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(predicate).alias("matching"),
        (F.avg(hit) * 100).alias("percent"),
    )


def profile_table(
    df: DataFrame,
    numeric: Sequence[str] = (),
    shares: dict[str, Column] | None = None,
    distinct: Sequence[str] = (),
    top: dict[str, int | None] | None = None,
    sums: dict[str, str] | None = None,
) -> DataFrame:
    """Long-form profile: ``metric``, ``column``, ``item``, ``value`` (double).

    ``numeric``   min, max and mean of columns
    ``shares``    ``{name: predicate}``: matching rows and their percentage
    ``distinct``  number of values, NULL counted as one
    ``top``       ``{column: n}``: the n most frequent values, ``None`` for all of them
    ``sums``      ``{grouping column: summed column}``

    The scalar part is one aggregation. Every column of ``distinct`` or ``top`` costs one
    map-side combined aggregation, which both share.
    """
    shares = shares or {}
    top = top or {}
    sums = sums or {}

    def line(metric: str, column: str, value: Column, item: Column | None = None) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(column).alias("column"),
            (F.lit("") if item is None else item).alias("item"),
            value.cast("double").alias("value"),
        )

    scalars = [line("rows", "", F.count(F.lit(1)))]
    for name in numeric:
        scalars += [line(stat, name, aggregate(F.col(name))) for stat, aggregate in _STATS.items()]
    for name, predicate in shares.items():
        hit = F.coalesce(predicate, F.lit(False)).cast("double")
        scalars.append(line("matching", name, F.count_if(predicate)))
        scalars.append(line("percent", name, F.avg(hit) * 100))
    profile = df.agg(F.array(*scalars).alias("report")).select(F.inline("report"))

    for name in dict.fromkeys([*distinct, *top]):
        counted = frequencies(df, name)
        if name in distinct:
            groups = counted.agg(
                F.array(
                    line("distinct", name, F.count(F.lit(1))),
                    line("distinct_rows", name, F.coalesce(F.sum("total"), F.lit(0))),
                ).alias("report")
            )
            profile = profile.unionByName(groups.select(F.inline("report")))
        if name in top:
            if top[name] is not None:
                counted = counted.orderBy(
                    F.desc("total"), F.asc_nulls_last(name)
                ).limit(top[name])
            lines = counted.select(
                line("frequency", name, F.col("total"), F.col(name).cast("string")).alias("report")
            )
            profile = profile.unionByName(lines.select("report.*"))
    for group, summed in sums.items():
        sums_of = df.groupBy(group).agg(F.sum(summed).alias("summed"))
        lines = sums_of.select(
            line("sum", summed, F.col("summed"), F.col(group).cast("string")).alias("report")
        )
        profile = profile.unionByName(lines.select("report.*"))
    return profile
