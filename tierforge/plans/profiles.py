"""Profiles of the silver tables, in the long form of ``profile_table``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.operators.profile import profile_table


def profile_orders(orders: DataFrame) -> DataFrame:
    return profile_table(
        orders, numeric=["delivery_delay_days"], shares={"is_delayed": F.col("is_delayed")}
    )


def profile_order_items(items: DataFrame) -> DataFrame:
    return profile_table(items, numeric=["price", "freight_value"])


def profile_customers(customers: DataFrame) -> DataFrame:
    return profile_table(
        customers,
        distinct=["customer_state", "customer_city"],
        top={"customer_state": 5, "customer_city": 5},
    )


def profile_sellers(sellers: DataFrame) -> DataFrame:
    return profile_table(
        sellers,
        distinct=["seller_state", "seller_city"],
        top={"seller_state": 5, "seller_city": 10},
    )


def profile_order_payments(payments: DataFrame) -> DataFrame:
    return profile_table(
        payments, top={"payment_type": None}, sums={"payment_type": "payment_value"}
    )


def profile_order_reviews(reviews: DataFrame) -> DataFrame:
    return profile_table(reviews, numeric=["review_score"], top={"review_score": None})


def profile_products(products: DataFrame) -> DataFrame:
    return profile_table(
        products, distinct=["product_category_name"], top={"product_category_name_english": 10}
    )


PROFILES = {
    "silver_orders": profile_orders,
    "silver_order_items": profile_order_items,
    "silver_customers": profile_customers,
    "silver_sellers": profile_sellers,
    "silver_order_payments": profile_order_payments,
    "silver_order_reviews": profile_order_reviews,
    "silver_products": profile_products,
}
