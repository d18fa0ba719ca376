"""Each silver table on a few dirty bronze rows."""

from datetime import datetime

import pytest

from tierforge.plans import (
    build_silver_customers,
    build_silver_order_items,
    build_silver_order_payments,
    build_silver_order_reviews,
    build_silver_orders,
    build_silver_products,
    build_silver_sellers,
    silver_metrics,
)


def bronze(spark, columns, *lines):
    """All-string rows; the extra column stands for what a file may hold beyond ours."""
    schema = ", ".join(f"{name} string" for name in [*columns.split(), "_corrupt_record"])
    return spark.createDataFrame([(*line, None) for line in lines], schema)


def metrics(df):
    return {(r.metric, r.item): r.value for r in df.collect()}


ORDER_COLUMNS = (
    "order_id customer_id order_status order_purchase_timestamp order_approved_at "
    "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"
)


def test_orders(spark):
    raw = bronze(
        spark,
        ORDER_COLUMNS,
        ("o1", "c1", "delivered", "2020-01-01 12:00:00", "2020-01-01 13:00:00", None, "2020-01-08 09:00:00", "2020-01-10 00:00:00"),
        ("o1", "c1", "delivered", "2020-01-02 12:00:00", "junk", "", "2020-01-12 09:00:00", "2020-01-10 00:00:00"),
        ("o2", "c2", "shipped", "2020-01-02 12:00:00", None, None, None, "2020-01-10 00:00:00"),
        ("o3", "c3", "delivered", "2020-01-02 12:00:00", None, None, "2020-01-03", "2020-01-10 00:00:00"),
        ("o4", "c4", "delivered", None, None, None, "2020-01-03 00:00:00", None),
    )
    got = {r.order_id: r for r in build_silver_orders(raw).collect()}
    assert sorted(got) == ["o1", "o4"]
    assert got["o1"].order_purchase_timestamp == datetime(2020, 1, 2, 12)
    assert (got["o1"].delivery_days_planned, got["o1"].delivery_days_actual) == (8, 10)
    assert (got["o1"].delivery_delay_days, got["o1"].is_delayed) == (2, True)
    assert (got["o4"].delivery_delay_days, got["o4"].is_delayed) == (None, False)
    assert [(f.name, f.dataType.simpleString()) for f in build_silver_orders(raw).schema][2:] == [
        ("order_status", "string"),
        ("order_purchase_timestamp", "timestamp"),
        ("order_approved_at", "timestamp"),
        ("order_delivered_carrier_date", "timestamp"),
        ("order_delivered_customer_date", "timestamp"),
        ("order_estimated_delivery_date", "timestamp"),
        ("delivery_days_planned", "int"),
        ("delivery_days_actual", "int"),
        ("delivery_delay_days", "int"),
        ("is_delayed", "boolean"),
    ]
    counted = metrics(silver_metrics("silver_orders", raw))
    assert counted["rows_in", ""] == 5 and counted["rows_kept", ""] == 3
    assert counted["dropped", "delivered"] == 2
    assert counted["malformed", "order_approved_at"] == 1
    assert counted["malformed", "order_delivered_customer_date"] == 1
    assert counted["malformed", "order_delivered_carrier_date"] == 0


def test_order_items(spark, rows):
    columns = "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"
    raw = bronze(
        spark,
        columns,
        ("o1", "1", "p1", "s1", "2020-01-01 00:00:00", "10.00", "1.5"),
        ("o1", "1", "p2", "s1", "2020-01-02 00:00:00", "11.00", "0"),
        ("o1", "2", "p1", "s1", None, "0", "0"),
        ("o2", "1", "p1", "s1", None, "-1", "0"),
        ("o2", "2", None, "s1", None, "5", "1"),
        ("o2", "3", "p1", None, None, "5", "x"),
        ("o3", "1", "p1", "s1", None, "5.999", ""),
    )
    kept = build_silver_order_items(raw, money="double")
    assert rows(kept, "order_id", "order_item_id", "product_id", "price") == [
        ("o1", 1, "p2", 11.0),
        ("o1", 2, "p1", 0.0),
    ]
    assert build_silver_order_items(raw).schema["price"].dataType.simpleString() == "decimal(18,2)"
    counted = metrics(silver_metrics("silver_order_items", raw))
    assert (counted["failed", "amounts"], counted["dropped", "amounts"]) == (3, 3)
    assert (counted["failed", "seller_id"], counted["dropped", "seller_id"]) == (1, 0)
    assert counted["dropped", "product_id"] == 1 and counted["rows_kept", ""] == 3
    assert counted["malformed", "freight_value"] == 1 and counted["rounded", "price"] == 1


def test_customers_and_sellers(spark, rows):
    columns = "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"
    raw = bronze(
        spark,
        columns,
        ("c1", "u1", " 01310 ", " sao paulo ", " sp "),
        ("c1", "u2", "01311", "D'OESTE", "rj"),
        ("c1", "u3", "01312", None, "rj"),
        (None, "u4", "1", "x", "y"),
    )
    assert rows(build_silver_customers(raw)) == [("c1", "u2", "01311", "D'oeste", "RJ")]
    columns = "seller_id seller_zip_code_prefix seller_city seller_state"
    raw = bronze(spark, columns, ("s1", " 01 ", "mogi-guacu", " sp"), ("s1", "02", "Aaa", "sp"))
    assert rows(build_silver_sellers(raw)) == [("s1", "01", "Mogi-guacu", "SP")]


def test_payments_keep_every_row(spark, rows):
    columns = "order_id payment_sequential payment_type payment_installments payment_value"
    raw = bronze(
        spark,
        columns,
        ("o1", "1", "credit_card", "3", "10.10"),
        ("o1", "1", "credit_card", "3", "10.10"),
        ("o2", "1", " BOLETO ", "", "5"),
        ("o3", "x", "not_defined", None, "0"),
        ("o4", "1", None, "junk", "1"),
        ("o5", "1", "voucher", "1", "abc"),
        (None, "1", "voucher", "1", "1"),
    )
    got = rows(build_silver_order_payments(raw, money="double"))
    assert got == [
        ("o1", 1, "Credit Card", 3, 10.1),
        ("o1", 1, "Credit Card", 3, 10.1),
        ("o2", 1, "Boleto", 1, 5.0),
        ("o3", None, "not_defined", 1, 0.0),
        ("o4", 1, None, None, 1.0),
    ]
    assert build_silver_order_payments(raw, money="float").dtypes[4] == ("payment_value", "float")


def test_reviews(spark, rows):
    columns = (
        "review_id order_id review_score review_comment_title review_comment_message "
        "review_creation_date review_answer_timestamp"
    )
    day = "2020-01-0{} 00:00:00".format
    raw = bronze(
        spark,
        columns,
        ("r1", "o1", "5", None, " fine ", day(1), "2020-01-05"),
        ("r1", "o1", "4", " ", None, day(2), "junk"),
        ("r2", "o2", "9", None, None, day(1), None),
        ("r3", "o3", "5\n", None, None, day(1), None),
        ("r4", "o4", "", None, None, day(1), None),
        ("r5", "o5", None, None, None, day(1), None),
        ("r6", "o6", "1", None, None, "text", None),
        ("r7", "o7", "1", None, None, None, None),
        ("r8", None, "1", None, None, day(1), None),
        ("r9", "o9", "2", "a", "", day(3), None),
    )
    assert rows(build_silver_order_reviews(raw)) == [
        ("r1", "o1", 4, "", "", datetime(2020, 1, 2), None, 0),
        ("r9", "o9", 2, "a", "", datetime(2020, 1, 3), None, 1),
    ]
    counted = metrics(silver_metrics("silver_order_reviews", raw))
    assert [counted["dropped", rule] for rule in ("score", "creation_date", "required")] == [2, 2, 3]
    assert counted["malformed", "review_answer_timestamp"] == 1


def test_products(spark, rows):
    columns = (
        "product_id product_category_name product_name_lenght product_description_lenght "
        "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm"
    )
    raw = bronze(
        spark,
        columns,
        ("p1", "beleza", "40", "", "1", "1.1", "", None, "junk"),
        ("p1", None, "41", "", "1", "2", "3", "4", "5"),
        ("p2", " beleza ", "x", None, "1", "", "", "", ""),
        ("p3", "nova", None, None, None, None, None, None, None),
        (None, "nova", None, None, None, None, None, None, None),
    )
    translation = bronze(
        spark,
        "product_category_name product_category_name_english",
        ("beleza ", " beauty "),
        ("beleza", "a beauty"),
    )
    out = build_silver_products(raw, translation)
    assert out.columns == [
        "product_category_name",
        "product_id",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_category_name_english",
    ]
    assert rows(out) == [
        (" beleza ", "p2", None, None, 1, 0.0, 0.0, 0.0, 0.0, "beauty"),
        ("beleza", "p1", 40, None, 1, 1.1, 0.0, 0.0, None, "beauty"),
        ("nova", "p3", None, None, None, 0.0, 0.0, 0.0, 0.0, "nova"),
    ]


@pytest.mark.parametrize("parts", [1, 6])
def test_orders_do_not_depend_on_partitions(spark, rows, parts):
    day = "2020-01-01 00:00:00"
    lines = [(f"o{i % 3}", f"c{i}", "delivered", day, None, None, day, day) for i in range(12)]
    raw = bronze(spark, ORDER_COLUMNS, *lines).repartition(parts)
    assert rows(build_silver_orders(raw), "order_id", "customer_id") == [
        ("o0", "c9"),
        ("o1", "c7"),
        ("o2", "c8"),
    ]
