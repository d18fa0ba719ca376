"""The six gold reports over silver tables.

Reports over a one-to-many join count and sum *joined* rows: an order with three
payments counts three times, an order without any once. By default the many side is
reduced to one row per key before the join and its row count carried along
(``pre_aggregate``). The result is the same; the difference is that a key with any
share of the rows is combined before the shuffle, which AQE could not repair, as it
never splits the right side of a left outer join. ``order_id`` is the key of the
orders table, so the orders side has no hot key. ``pre_aggregate=False`` is the plain join,
for comparison: there one task receives all rows of a hot key of the many side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.functions.dates import calendar_days, label_on_time, month_text
from tierforge.operators.lookup import join_preaggregated, left_lookup
from tierforge.operators.reports import average, non_null_count, rollup_report, top_n, total

_SUM = "__many_sum"
_ROWS = "__many_rows"


def _amount(value: Column) -> Column:
    """Report amounts are doubles; sums of decimals stay exact up to here."""
    return F.round(value, 2).cast("double")


def _joined_rows(key: str) -> Column:
    """How many rows of a plain left join a pre-joined row with a known key stands for."""
    return F.when(F.col(key).isNotNull(), F.coalesce(_ROWS, F.lit(1))).otherwise(0)


def _order_totals(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return join_preaggregated(
        orders,
        payments,
        "order_id",
        {_SUM: total("payment_value"), _ROWS: F.count(F.lit(1))},
        keys_repeat=False,
    )


def monthly_revenue(
    orders: DataFrame,
    payments: DataFrame,
    *,
    pre_aggregate: bool = True,
    distinct_orders: bool = False,
) -> DataFrame:
    """``month``, ``total_revenue``, ``total_orders`` (and ``distinct_orders``) by month."""
    orders = orders.select("order_id", "order_purchase_timestamp")
    if pre_aggregate:
        joined = _order_totals(orders, payments)
        revenue, counted = total(_SUM), F.sum(_joined_rows("order_id"))
    else:
        joined = left_lookup(orders, payments, "order_id", ["payment_value"])
        revenue, counted = total("payment_value"), non_null_count("order_id")
    measures = {"total_revenue": _amount(revenue), "total_orders": counted}
    if distinct_orders:
        measures["distinct_orders"] = F.count_distinct("order_id")
    month = {"month": month_text(F.col("order_purchase_timestamp"))}
    return rollup_report(joined, month, measures, [F.asc_nulls_first("month")])


def top_products(
    items: DataFrame,
    products: DataFrame,
    *,
    group_by: str = "product_category_name",
    n: int = 10,
    pre_aggregate: bool = True,
) -> DataFrame:
    """The ``n`` categories with most sold items: ``total_orders``, ``total_revenue``."""
    if pre_aggregate:
        sold = items.groupBy("product_id").agg(
            non_null_count("order_id").alias(_ROWS), total("price").alias(_SUM)
        )
        counted, revenue = F.sum(_ROWS), total(_SUM)
    else:
        sold = items.select("product_id", "order_id", "price")
        counted, revenue = non_null_count("order_id"), total("price")
    joined = left_lookup(sold, products, "product_id", [group_by])
    measures = {"total_orders": counted, "total_revenue": _amount(revenue)}
    return top_n(joined, group_by, measures, "total_orders", n)


def region_revenue(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    *,
    pre_aggregate: bool = True,
) -> DataFrame:
    """``customer_state``, ``total_orders``, ``total_revenue``, greatest revenue first."""
    orders = orders.select("order_id", "customer_id")
    if pre_aggregate:
        sold = (
            _order_totals(orders, payments)
            .groupBy("customer_id")
            .agg(F.sum(_joined_rows("order_id")).alias(_ROWS), total(_SUM).alias(_SUM))
        )
        counted, revenue = F.sum(_ROWS), total(_SUM)
        joined = left_lookup(sold, customers, "customer_id", ["customer_state"])
    else:
        joined = left_lookup(
            left_lookup(orders, customers, "customer_id", ["customer_state"]),
            payments,
            "order_id",
            ["payment_value"],
        )
        counted, revenue = non_null_count("order_id"), total("payment_value")
    return rollup_report(
        joined,
        "customer_state",
        {"total_orders": counted, "total_revenue": _amount(revenue)},
        [F.desc_nulls_last("total_revenue"), F.asc_nulls_last("customer_state")],
    )


def payment_method(payments: DataFrame) -> DataFrame:
    """Payments, revenue and average installments per payment type."""
    return rollup_report(
        payments,
        "payment_type",
        {
            "total_orders": non_null_count("order_id"),
            "total_revenue": _amount(total("payment_value")),
            "avg_installments": average("payment_installments", 1),
        },
        [F.desc_nulls_last("total_revenue"), F.asc_nulls_last("payment_type")],
    )


def _delivery_status() -> dict[str, Column]:
    return {
        "delivery_status": label_on_time(
            F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        )
    }


def delivery_performance(orders: DataFrame) -> DataFrame:
    """Orders and average delivery days, on time against late."""
    days = calendar_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return rollup_report(
        orders,
        _delivery_status(),
        {"total_orders": non_null_count("order_id"), "avg_delivery_days": average(days, 1)},
    )


def review_by_delivery(
    orders: DataFrame, reviews: DataFrame, *, pre_aggregate: bool = True
) -> DataFrame:
    """Average review score, on time against late; each review has the same weight."""
    orders = orders.select(
        "order_id", "order_delivered_customer_date", "order_estimated_delivery_date"
    )
    if pre_aggregate:
        joined = join_preaggregated(
            orders,
            reviews,
            "order_id",
            {_SUM: total("review_score"), _ROWS: non_null_count("review_score")},
            keys_repeat=False,
        )
        score = F.round(F.try_divide(total(_SUM), total(_ROWS)), 2)
    else:
        joined = left_lookup(orders, reviews, "order_id", ["review_score"])
        score = average("review_score", 2)
    return rollup_report(joined, _delivery_status(), {"avg_review_score": score})
