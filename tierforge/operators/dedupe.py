"""Keep-latest de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

_ROW_NUMBER = "__row_number"


def _latest_first(order: str | Column) -> Column:
    return F.desc_nulls_last(order) if isinstance(order, str) else order


def dedupe_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Column | Sequence[str | Column],
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per key: the first by ``order_by``, names meaning descending, NULLs last.

    Rows equal in ``order_by`` are told apart by ``tie_break``, by default all
    remaining columns, so the outcome does not depend on the input's partitioning.

    Spark ranks inside every input partition first (partial ``WindowGroupLimit``),
    so a key holding any share of the table sends one row per task to the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    orders = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if tie_break is None:
        named = {*keys, *(order for order in orders if isinstance(order, str))}
        tie_break = [field.name for field in df.schema if field.name not in named]
        unsortable = [
            name for name in tie_break if isinstance(df.schema[name].dataType, (MapType, VariantType))
        ]
        if unsortable:
            raise ValueError(f"columns {unsortable} have no order, give tie_break explicitly")
    window = Window.partitionBy(*keys).orderBy(*map(_latest_first, [*orders, *tie_break]))
    return (
        df.withColumn(_ROW_NUMBER, F.row_number().over(window))
        .filter(F.col(_ROW_NUMBER) == 1)
        .drop(_ROW_NUMBER)
    )
