"""Checks of written tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

# The key of every output table.
TABLE_KEYS = {
    "silver_orders": ("order_id",),
    "silver_order_items": ("order_id", "order_item_id"),
    "silver_customers": ("customer_id",),
    "silver_sellers": ("seller_id",),
    "silver_order_payments": (),
    "silver_order_reviews": ("review_id",),
    "silver_products": ("product_id",),
    "gold_monthly_revenue": ("month",),
    "gold_top_products": ("product_category_name",),
    "gold_region_revenue": ("customer_state",),
    "gold_payment_method": ("payment_type",),
    "gold_delivery_performance": ("delivery_status",),
    "gold_review_by_delivery": ("delivery_status",),
}


def key_check(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One row: ``table``, ``table_exists``, ``total``, ``null_keys``, ``duplicate_keys``.

    ``null_keys`` counts rows with a NULL in the key, ``duplicate_keys`` rows beyond
    the first of each key. Counting is combined map side, so a hot key costs nothing.
    """
    if keys:
        incomplete = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
        summary = per_key.agg(
            F.coalesce(F.sum("__rows"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(incomplete, F.col("__rows"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("duplicate_keys"),
        )
    else:
        summary = df.agg(
            F.count(F.lit(1)).alias("total"),
            F.lit(0).cast("bigint").alias("null_keys"),
            F.lit(0).cast("bigint").alias("duplicate_keys"),
        )
    return summary.select(
        F.lit(name).alias("table"), F.lit(True).alias("table_exists"), "total", "null_keys", "duplicate_keys"
    )


def output_check(
    spark: SparkSession,
    tables: dict[str, tuple[str, Sequence[str]]],
    nullable_keys: Sequence[str] = (),
) -> DataFrame:
    """One row per table of ``{table: (path, keys)}`` with ``ok``.

    A table is ok when it exists, holds rows and its keys are unique and non-null;
    tables named in ``nullable_keys`` may have NULL as one of their keys.
    """
    checks = []
    for name, (path, keys) in tables.items():
        try:
            checks.append(key_check(spark.read.parquet(path), name, keys))
        except AnalysisException:
            checks.append(
                spark.range(1).select(
                    F.lit(name).alias("table"),
                    F.lit(False).alias("table_exists"),
                    *[F.lit(0).cast("bigint").alias(c) for c in ("total", "null_keys", "duplicate_keys")],
                )
            )
    report = reduce(DataFrame.unionByName, checks)
    complete = (F.col("null_keys") == 0) | F.col("table").isin(list(nullable_keys))
    return report.withColumn(
        "ok", F.col("table_exists") & (F.col("total") > 0) & complete & (F.col("duplicate_keys") == 0)
    )
