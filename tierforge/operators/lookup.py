"""Left joins: lookups, translation with fallback, pre-aggregated fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__lookup_key"
_LABEL = "__lookup_label"
_SPREAD = "__spread"


def spread(*keys: str | Column) -> Column:
    """One more grouping column, a function of the keys, for the reduced side of a join.

    AQE splits skewed partitions only of joins that sit directly on two shuffles. A side
    grouped by its join keys is already partitioned by them and joins without another
    shuffle; grouped by this column too, it is shuffled once more, reduced as it is, and
    a hot key of the other side can be split.
    """
    return F.xxhash64(*keys).alias(_SPREAD)


def left_lookup(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Left outer join on shared key columns, taking ``columns`` of ``dim`` (default: all).

    No join hint: Spark broadcasts ``dim`` only while its size is known to stay
    below ``spark.sql.autoBroadcastJoinThreshold``. Beyond it the join is by sort
    and merge, where AQE splits skewed partitions of the left side. Where the
    *right* side repeats keys ahead of an aggregate, use ``join_preaggregated``:
    AQE cannot split the right side of a left outer join.
    """
    on = [on] if isinstance(on, str) else list(on)
    if columns is not None:
        dim = dim.select(*on, *columns)
    return df.join(dim, on, "left")


def translate(
    df: DataFrame, dim: DataFrame, key: str, label: str, out: str, fallback: bool = True
) -> DataFrame:
    """Adds ``out``, the label of ``df[key]``; codes without label keep their own text.

    Codes are compared without outer blanks on both sides. A code listed more than
    once in ``dim`` takes its greatest label, so no row of ``df`` is multiplied.
    """
    code = F.trim(key)
    labels = dim.groupBy(code.alias(_KEY), spread(code)).agg(F.max(F.trim(label)).alias(_LABEL))
    joined = df.join(labels.drop(_SPREAD), F.trim(df[key]) == F.col(_KEY), "left")
    found = F.coalesce(_LABEL, df[key]) if fallback else F.col(_LABEL)
    return joined.withColumn(out, found).drop(_KEY, _LABEL)


def join_preaggregated(
    df: DataFrame,
    many: DataFrame,
    on: str | Sequence[str],
    aggs: dict[str, Column],
    keys_repeat: bool = True,
) -> DataFrame:
    """Left join to the per-key aggregates of ``many``.

    ``many`` collapses to one row per key before it moves, map side first, so a hot
    key costs one row per task. Where the keys of ``df`` are unique, say so by
    ``keys_repeat=False``: the join then reuses the aggregate's partitioning. Else
    the aggregates are shuffled again, so that AQE can split hot keys of ``df``.
    """
    on = [on] if isinstance(on, str) else list(on)
    groups = [*on, spread(*on)] if keys_repeat else on
    per_key = many.groupBy(*groups).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return df.join(per_key.drop(_SPREAD), on, "left")
