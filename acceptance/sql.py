"""Building blocks of the SQL twins: the silver tables as common table expressions.

They start from typed columns, never from the dirty text, and use plain joins, so
they check the library by another road.
"""

from __future__ import annotations


def initcap(expression: str) -> str:
    return (
        f"list_aggregate(list_transform(string_split(lower({expression}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
    )


def days(start: str, end: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


TABLES = {
    "raw_orders": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderstatus AS order_status,
       bought AS order_purchase_timestamp,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN bought + INTERVAL 1 HOUR END AS order_approved_at,
       first_ship AS order_delivered_carrier_date,
       last_ship AS order_delivered_customer_date,
       CASE WHEN o_orderstatus <> 'P' THEN bought + INTERVAL 30 DAY END AS order_estimated_delivery_date
FROM (SELECT *, CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS bought FROM orders)
LEFT JOIN (SELECT l_orderkey, l_returnflag, CAST(min(l_shipdate) AS TIMESTAMP) AS first_ship,
                  CAST(max(l_shipdate) AS TIMESTAMP) AS last_ship
           FROM lineitem GROUP BY ALL) ON o_orderkey = l_orderkey""",
    "silver_orders": f"""
SELECT *, delivery_days_actual - delivery_days_planned AS delivery_delay_days,
       coalesce(delivery_days_actual - delivery_days_planned > 0, false) AS is_delayed
FROM (SELECT *,
             {days("order_purchase_timestamp", "order_estimated_delivery_date")} AS delivery_days_planned,
             {days("order_purchase_timestamp", "order_delivered_customer_date")} AS delivery_days_actual
      FROM raw_orders WHERE order_delivered_customer_date IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp DESC NULLS LAST,
    order_delivered_carrier_date DESC NULLS LAST, order_delivered_customer_date DESC NULLS LAST) = 1""",
    "raw_order_items": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
       CASE WHEN l_quantity <> 1 THEN CAST(l_partkey AS VARCHAR) END AS product_id,
       CASE WHEN l_quantity <> 2 THEN CAST(l_suppkey AS VARCHAR) END AS seller_id,
       CASE WHEN l_quantity <> 3 THEN CAST(l_shipdate AS TIMESTAMP) END AS shipping_limit_date,
       CASE WHEN l_quantity = 50 THEN NULL
            WHEN l_tax = 0 AND l_returnflag = 'A' THEN -CAST(l_extendedprice AS DECIMAL(18, 2))
            ELSE CAST(l_extendedprice AS DECIMAL(18, 2)) END AS price,
       CAST(l_quantity AS DECIMAL(18, 2)) AS freight_value
FROM lineitem""",
    "silver_order_items": """
SELECT * FROM raw_order_items
WHERE price >= 0 AND freight_value >= 0 AND product_id IS NOT NULL AND seller_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY shipping_limit_date DESC NULLS LAST,
    product_id DESC, seller_id DESC, price DESC, freight_value DESC) = 1""",
    "silver_customers": f"""
SELECT customer_id, customer_unique_id, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       {initcap("city")} AS customer_city, 'N' || c_nationkey AS customer_state
FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS customer_id, c_name || '-' || version AS customer_unique_id,
             CASE WHEN c_acctbal < -500 OR (c_acctbal < 0 AND version = 2) THEN NULL
                  WHEN version = 1 THEN c_mktsegment || ' town' ELSE c_mktsegment END AS city
      FROM customer, (VALUES (1), (2)) v(version))
WHERE city IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id DESC) = 1""",
    "silver_sellers": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       {initcap("city")} AS seller_city, 'N' || s_nationkey AS seller_state
FROM (SELECT *, CASE WHEN version = 1 THEN 'porto d''' ELSE 'bay ' END || s_name AS city
      FROM supplier, (VALUES (1), (2)) v(version))
WHERE version = 2 OR s_acctbal >= 0
QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY city DESC) = 1""",
    "silver_order_payments": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
       CASE WHEN l_returnflag = 'A' THEN 'Credit Card' WHEN l_returnflag = 'N' THEN 'Boleto'
            WHEN l_linestatus = 'F' THEN 'Voucher' ELSE 'not_defined' END AS payment_type,
       CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_linenumber ELSE 1 END AS payment_installments,
       CAST(l_extendedprice AS DECIMAL(18, 2)) AS payment_value
FROM lineitem WHERE l_quantity NOT IN (25, 26)""",
    "silver_order_reviews": """
SELECT CAST(conv_id AS VARCHAR) AS review_id, CAST(conv_id AS VARCHAR) AS order_id,
       CAST(score AS INTEGER) AS review_score, '' AS review_comment_title,
       trim(text, ' ') AS review_comment_message,
       TIMESTAMP '2020-01-01 00:00:00' + to_minutes(CAST(turn AS INTEGER)) AS review_creation_date,
       CASE WHEN role = 'user' THEN TIMESTAMP '2020-02-03 00:00:00' END AS review_answer_timestamp,
       CASE WHEN coalesce(trim(text, ' '), '') <> '' THEN 1 ELSE 0 END AS has_comment
FROM (SELECT *, CASE WHEN role = 'user' THEN quality + toxic + 3 WHEN role <> 'system' THEN 5 END AS score
      FROM conversations
      LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id)
             ON conv_id = doc_id)
WHERE score IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "silver_products": """
SELECT category AS product_category_name, CAST(p_partkey AS VARCHAR) AS product_id,
       CASE WHEN p_size NOT IN (3, 4) THEN CAST(length(p_name) AS INTEGER) END AS product_name_lenght,
       CAST(NULL AS INTEGER) AS product_description_lenght, p_size AS product_photos_qty,
       CASE WHEN p_size = 44 OR p_size > 45 THEN 0.0::DOUBLE WHEN p_size <> 20 THEN p_retailprice END AS product_weight_g,
       CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size AS DOUBLE) AS product_height_cm,
       CAST(p_size AS DOUBLE) AS product_width_cm,
       CASE WHEN trim(category) = 'PROMO' THEN category ELSE lower(trim(category)) || ' ' || brand END
           AS product_category_name_english
FROM (SELECT *, CASE WHEN p_size > 40 THEN '  ' || p_type WHEN p_size >= 5 THEN p_type END AS category FROM part)
LEFT JOIN (SELECT p_type AS code, max(p_brand) AS brand FROM part GROUP BY p_type) ON code = trim(category)""",
    "typed_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS bought,
       last_ship AS delivered, o_orderdate + INTERVAL 30 DAY AS due
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey)
     ON o_orderkey = l_orderkey""",
    "lines": """
SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
FROM lineitem""",
}

SILVER_REPORTS = {
    "monthly_revenue": """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month,
       CAST(round(sum(payment_value), 2) AS DOUBLE) AS total_revenue, count(order_id) AS total_orders
FROM silver_orders LEFT JOIN silver_order_payments USING (order_id) GROUP BY 1""",
    "top_products": """
SELECT product_category_name, count(order_id) AS total_orders, CAST(round(sum(price), 2) AS DOUBLE) AS total_revenue
FROM silver_order_items LEFT JOIN silver_products USING (product_id)
GROUP BY 1 ORDER BY total_orders DESC, product_category_name ASC NULLS LAST LIMIT 10""",
    "region_revenue": """
SELECT customer_state, count(order_id) AS total_orders, CAST(round(sum(payment_value), 2) AS DOUBLE) AS total_revenue
FROM silver_orders LEFT JOIN silver_customers USING (customer_id) LEFT JOIN silver_order_payments USING (order_id)
GROUP BY 1""",
    "payment_method": """
SELECT payment_type, count(order_id) AS total_orders, CAST(round(sum(payment_value), 2) AS DOUBLE) AS total_revenue,
       round(avg(payment_installments), 1) AS avg_installments
FROM silver_order_payments GROUP BY 1""",
    "delivery_performance": f"""
SELECT CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'On Time' ELSE 'Late' END
           AS delivery_status, count(order_id) AS total_orders,
       round(avg({days("order_purchase_timestamp", "order_delivered_customer_date")}), 1) AS avg_delivery_days
FROM silver_orders GROUP BY 1""",
    "review_by_delivery": """
SELECT CASE WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN 'On Time' ELSE 'Late' END
           AS delivery_status, round(avg(review_score), 2) AS avg_review_score
FROM silver_orders LEFT JOIN silver_order_reviews USING (order_id) GROUP BY 1""",
}

# Which tables a table is made of.
_NEEDS = {"silver_orders": ["raw_orders"], "silver_order_items": ["raw_order_items"]}


def over(select: str, *names: str) -> str:
    """``select`` with the named tables (and those they need) in front."""
    wanted = []
    for name in names:
        wanted += [*_NEEDS.get(name, []), name]
    ctes = ",\n".join(f"{name} AS ({TABLES[name]})" for name in dict.fromkeys(wanted))
    return f"WITH {ctes}\n{select.strip()}" if ctes else select.strip()


def lake_report(name: str) -> str:
    select = SILVER_REPORTS[name]
    return over(select, *[table for table in TABLES if table.startswith("silver_") and _uses(select, table)])


def _uses(select: str, table: str) -> bool:
    return table in select.replace("(", " ").replace(")", " ").split()
