"""The star-schema tables seen as retail data.

``raw_*`` give bronze-shaped rows, all text, with the dirt that cleaning has to cope
with: blanks, wrong case, unreadable numbers and dates, NULL keys, repeated keys.
The dirt hangs on attribute values, so it grows with the tables. ``typed_*`` give
silver-shaped rows without any. All of them are over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.operators import join_preaggregated

MOMENT = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and plain doubles, as the SQL side returns them."""
    casts = {}
    for field in df.schema:
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif kind.startswith("decimal") or kind == "float":
            casts[field.name] = F.col(field.name).cast("double")
    return df.withColumns(casts) if casts else df


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order appears once per return flag of its lines, each time with other dates."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_returnflag")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    orders = table(spark, sf_dir, "orders").withColumn(
        "bought", F.expr("o_orderdate + make_dt_interval(0, o_custkey % 24)")
    )
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.date_format("bought", MOMENT).alias("order_purchase_timestamp"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("bought", "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.date_format(F.expr("bought + interval 1 hour"), MOMENT))
        .alias("order_approved_at"),
        F.date_format("first_ship", MOMENT).alias("order_delivered_carrier_date"),
        F.date_format("last_ship", MOMENT).alias("order_delivered_customer_date"),
        F.when(
            F.col("o_orderstatus") != "P", F.date_format(F.expr("bought + interval 30 days"), MOMENT)
        ).alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("string")
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.when(quantity != 1, F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(quantity != 2, F.col("l_suppkey").cast("string")).alias("seller_id"),
        F.when(quantity == 3, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("l_shipdate", MOMENT))
        .alias("shipping_limit_date"),
        F.when(quantity == 50, "n/a")
        .when((F.col("l_tax") == 0) & (F.col("l_returnflag") == "A"), F.concat(F.lit("-"), price))
        .otherwise(price)
        .alias("price"),
        quantity.cast("string").alias("freight_value"),
    )


def _versions(df: DataFrame) -> DataFrame:
    return df.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("version") == 1
    unknown = (F.col("c_acctbal") < -500) | ((F.col("c_acctbal") < 0) & ~first)
    segment = F.col("c_mktsegment")
    return _versions(table(spark, sf_dir, "customer")).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat_ws("-", "c_name", "version").alias("customer_unique_id"),
        F.concat(F.lit("  "), F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit(" ")).alias(
            "customer_zip_code_prefix"
        ),
        F.when(unknown, F.lit(None))
        .when(first, F.concat(F.lit("  "), F.lower(segment), F.lit(" town ")))
        .otherwise(segment)
        .alias("customer_city"),
        F.concat(F.lit(" n"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("customer_state"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("version") == 1
    return _versions(table(spark, sf_dir, "supplier")).select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.concat(F.when(first, " porto d'").otherwise("BAY "), "s_name").alias("seller_city"),
        F.when(~first | (F.col("s_acctbal") >= 0), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"))).alias(
            "seller_state"
        ),
    )


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("payment_sequential"),
        F.when(flag == "A", " Credit_Card ")
        .when(flag == "N", "BOLETO")
        .when(F.col("l_linestatus") == "F", "voucher")
        .otherwise("not_defined")
        .alias("payment_type"),
        F.when(quantity < 5, F.lit(""))
        .when(quantity <= 45, F.col("l_linenumber").cast("string"))
        .alias("payment_installments"),
        F.when(quantity == 26, F.lit("bad"))
        .when(quantity != 25, F.col("l_extendedprice").cast("string"))
        .alias("payment_value"),
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    talks = table(spark, sf_dir, "conversations").withColumn("doc_id", F.col("conv_id"))
    scores = {"quality": F.max("quality"), "toxic": F.max("toxic")}
    return join_preaggregated(talks, table(spark, sf_dir, "labels"), "doc_id", scores).select(
        F.col("conv_id").cast("string").alias("review_id"),
        F.col("conv_id").cast("string").alias("order_id"),
        F.when(role == "system", F.lit("x"))
        .when(role == "user", (F.col("quality") + F.col("toxic") + 3).cast("string"))
        .otherwise(F.lit("5"))
        .alias("review_score"),
        F.when(role == "assistant", F.lit("  ")).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.when(role == "system", F.lit("text"))
        .otherwise(F.date_format(F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, turn)"), MOMENT))
        .alias("review_creation_date"),
        F.when(role == "user", F.lit("2020-02-03")).otherwise(F.lit("junk")).alias("review_answer_timestamp"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    middle = size.between(10, 40)
    width = size.cast("string")
    return _versions(table(spark, sf_dir, "part")).select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when((F.col("version") == 1) & middle, F.col("p_type"))
        .when((F.col("version") == 2) & (size > 40), F.concat(F.lit("  "), "p_type"))
        .when((F.col("version") == 2) & (size >= 5), F.col("p_type"))
        .alias("product_category_name"),
        F.when(size == 3, F.lit(""))
        .when(size == 4, F.lit("x"))
        .otherwise(F.length("p_name").cast("string"))
        .alias("product_name_lenght"),
        F.lit("").alias("product_description_lenght"),
        width.alias("product_photos_qty"),
        F.when(size > 45, F.lit(""))
        .when(size == 20, F.lit("junk"))
        .when(size != 44, F.col("p_retailprice").cast("string"))
        .alias("product_weight_g"),
        width.alias("product_length_cm"),
        width.alias("product_height_cm"),
        width.alias("product_width_cm"),
    )


def raw_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several labels per type, blanks around both, and no label for one type."""
    labelled = table(spark, sf_dir, "part").filter("p_type <> 'PROMO'")
    return labelled.select(
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("product_category_name"),
        F.concat(F.lit(" "), F.lower("p_type"), F.lit(" "), "p_brand", F.lit(" ")).alias(
            "product_category_name_english"
        ),
    ).distinct()


RAW = {
    "orders": raw_orders,
    "products": raw_products,
    "customers": raw_customers,
    "sellers": raw_sellers,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "translation": raw_translation,
}


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered with the last shipment, due 30 days after the order."""
    shipped = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("last_ship").alias("order_delivered_customer_date"),
        F.expr("o_orderdate + interval 30 days").alias("order_estimated_delivery_date"),
    )


def typed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"),
    )


def typed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )


def typed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_category_name")
    )


def typed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("customer_state"),
    )


def typed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("review_score")
    )
