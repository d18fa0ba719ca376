"""The query registry: ``name -> (Spark query, SQL twin)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acceptance import sql, views
from acceptance.views import comparable, table
from tierforge import operators as ops
from tierforge import plans
from tierforge.functions import to_timestamp
from tierforge.plans.checks import key_check
from tierforge.plans.run import LAYERS
from tierforge.session import scratch_path, side_by_side
from tierforge.sinks import preview, publish_table, read_version, write_layer, write_version
from tierforge.sources import CORRUPT, ingest_all, land_new, read_landed, read_layer, read_table_or_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, oracle: str | None, *tables: str):
    """Registers a query; ``tables`` are the common table expressions its SQL names."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir))

        REGISTRY[name] = (run, None if oracle is None else sql.over(oracle, *tables))
        return build

    return register


# --- gold reports over typed tables -------------------------------------------


@query(
    "monthly_revenue",
    """SELECT strftime(bought, '%Y-%m') AS month, CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue,
              count(order_id) AS total_orders
       FROM typed_orders LEFT JOIN lines ON order_id = l_orderkey GROUP BY 1""",
    "typed_orders",
    "lines",
)
def _(spark, sf):
    return plans.monthly_revenue(views.typed_orders(spark, sf), views.typed_payments(spark, sf))


@query(
    "distinct_orders_by_month",
    """SELECT strftime(bought, '%Y-%m') AS month, CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue,
              count(order_id) AS total_orders, count(DISTINCT order_id) AS distinct_orders
       FROM typed_orders LEFT JOIN lines ON order_id = l_orderkey GROUP BY 1""",
    "typed_orders",
    "lines",
)
def _(spark, sf):
    return plans.monthly_revenue(
        views.typed_orders(spark, sf), views.typed_payments(spark, sf), distinct_orders=True
    )


@query(
    "top_products",
    """SELECT p_brand AS product_category_name, count(l_orderkey) AS total_orders,
              CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue
       FROM lines LEFT JOIN part ON l_partkey = p_partkey
       GROUP BY 1 ORDER BY total_orders DESC, product_category_name LIMIT 10""",
    "lines",
)
def _(spark, sf):
    return plans.top_products(views.typed_items(spark, sf), views.typed_products(spark, sf))


@query(
    "region_revenue",
    """SELECT nullif(c_mktsegment, 'BUILDING') AS customer_state, count(order_id) AS total_orders,
              CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue
       FROM typed_orders LEFT JOIN customer ON customer_id = c_custkey LEFT JOIN lines ON order_id = l_orderkey
       GROUP BY 1""",
    "typed_orders",
    "lines",
)
def _(spark, sf):
    return plans.region_revenue(
        views.typed_orders(spark, sf), views.typed_customers(spark, sf), views.typed_payments(spark, sf)
    )


@query(
    "payment_method",
    """SELECT l_returnflag AS payment_type, count(*) AS total_orders,
              CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue,
              round(avg(l_linenumber), 1) AS avg_installments
       FROM lines GROUP BY 1""",
    "lines",
)
def _(spark, sf):
    return plans.payment_method(views.typed_payments(spark, sf))


@query(
    "delivery_performance",
    f"""SELECT CASE WHEN delivered <= due THEN 'On Time' ELSE 'Late' END AS delivery_status,
               count(order_id) AS total_orders,
               round(avg({sql.days("bought", "delivered")}), 1) AS avg_delivery_days
        FROM typed_orders GROUP BY 1""",
    "typed_orders",
)
def _(spark, sf):
    return plans.delivery_performance(views.typed_orders(spark, sf))


@query(
    "review_by_delivery",
    """SELECT CASE WHEN delivered <= due THEN 'On Time' ELSE 'Late' END AS delivery_status,
              round(avg(l_linenumber), 2) AS avg_review_score
       FROM typed_orders LEFT JOIN lines ON order_id = l_orderkey GROUP BY 1""",
    "typed_orders",
    "lines",
)
def _(spark, sf):
    return plans.review_by_delivery(views.typed_orders(spark, sf), views.typed_reviews(spark, sf))


# --- silver tables ---------------------------------------------------------------


def silver(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spec = plans.SILVER[name]
    sources = [spec.source, *spec.lookups]
    return build_silver[name](*[views.RAW[source.removeprefix("bronze_")](spark, sf) for source in sources])


build_silver = {
    "silver_orders": plans.build_silver_orders,
    "silver_order_items": plans.build_silver_order_items,
    "silver_customers": plans.build_silver_customers,
    "silver_sellers": plans.build_silver_sellers,
    "silver_order_payments": plans.build_silver_order_payments,
    "silver_order_reviews": plans.build_silver_order_reviews,
    "silver_products": plans.build_silver_products,
}

_DOUBLES = {
    "silver_order_items": "REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value)",
    "silver_order_payments": "REPLACE (CAST(payment_value AS DOUBLE) AS payment_value)",
}

for _name in build_silver:
    query(_name, f"SELECT * {_DOUBLES.get(_name, '')} FROM {_name}", _name)(
        lambda spark, sf, name=_name: silver(spark, sf, name)
    )


# --- bronze text to gold reports ----------------------------------------------------


def lake(spark: SparkSession, sf: str, report: str) -> DataFrame:
    build, inputs = {
        "monthly_revenue": (plans.monthly_revenue, ("silver_orders", "silver_order_payments")),
        "top_products": (plans.top_products, ("silver_order_items", "silver_products")),
        "region_revenue": (
            plans.region_revenue,
            ("silver_orders", "silver_customers", "silver_order_payments"),
        ),
        "payment_method": (plans.payment_method, ("silver_order_payments",)),
        "delivery_performance": (plans.delivery_performance, ("silver_orders",)),
        "review_by_delivery": (plans.review_by_delivery, ("silver_orders", "silver_order_reviews")),
    }[report]
    return build(*[silver(spark, sf, name) for name in inputs])


for _name in sql.SILVER_REPORTS:
    query(f"lake_{_name}", sql.lake_report(_name))(lambda spark, sf, name=_name: lake(spark, sf, name))


# --- landing, publication and the whole run -----------------------------------------


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    writer = df.write.option("header", True).option("escape", '"').options(**options)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def landed(spark: SparkSession, sf: str, name: str, columns: list[str]) -> DataFrame:
    base = scratch_path(spark, "landing")
    write_csv(table(spark, sf, name).select(*columns), f"{base}/raw/{name}.csv")
    ingest_all(spark, [(f"{name}.csv", f"bronze_{name}")], f"{base}/raw", f"{base}/brz", strict=True)
    return read_layer(spark, f"{base}/brz", f"bronze_{name}").drop(CORRUPT)


for _name, _columns in {
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "conversations": ["conv_id", "turn", "role", "text"],
}.items():
    _texts = ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in _columns)
    query(f"bronze_{_name}", f"SELECT {_texts} FROM {_name}")(
        lambda spark, sf, name=_name, columns=_columns: landed(spark, sf, name, columns)
    )


@query(
    "ingest_status",
    """SELECT 'customer.csv' AS file, 'bronze_customer' AS "table", count(*) AS rows, CAST(5 AS INTEGER) AS cols,
              CAST(0 AS BIGINT) AS corrupt, false AS failed FROM customer
       UNION ALL SELECT 'conversations.csv', 'bronze_conversations', count(*), 4, 0, false FROM conversations
       UNION ALL SELECT 'absent.csv', 'bronze_absent', NULL, NULL, NULL, true""",
)
def _(spark, sf):
    base = scratch_path(spark, "ingest")
    write_csv(table(spark, sf, "customer"), f"{base}/raw/customer.csv")
    write_csv(table(spark, sf, "conversations"), f"{base}/raw/conversations.csv")
    files = ("customer", "absent", "conversations")
    manifest = [(f"{name}.csv", f"bronze_{name}") for name in files]
    status = ingest_all(spark, manifest, f"{base}/raw", f"{base}/brz")
    return status.withColumn("failed", F.col("error").isNotNull()).drop("error")


@query("publish_and_read", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "customer")
    name = "default.published_" + path.split("/")[-2].rpartition("-")[2]
    publish_table(table(spark, sf, "customer").limit(0), name, path)
    publish_table(table(spark, sf, "customer"), name, path, strict=True)
    published = read_table_or_path(spark, name, path)
    # The table is external: its files stay, and what was read from it stays readable.
    spark.sql(f"DROP TABLE {name}")
    return published


@query("read_without_table", "SELECT * FROM supplier")
def _(spark, sf):
    base = scratch_path(spark, "layer")
    path = write_layer(table(spark, sf, "supplier"), base, "supplier")
    return read_table_or_path(spark, "default.never_published", path)


def raw_files(spark: SparkSession, sf: str, without: str | None = None) -> str:
    """A folder whose ``raw`` holds the files of the manifest.

    They are compressed, but for the reviews: their texts have line breaks, and only plain files are read in splits.
    """
    base = scratch_path(spark, "run")
    files = {entry.table.removeprefix("bronze_"): entry.file for entry in plans.retail_manifest()}
    plain, packed = {}, {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

    def write(name: str) -> None:
        options = plain if name == "order_reviews" else packed
        write_csv(views.RAW[name](spark, sf), f"{base}/raw/{files[name]}", **options)

    # The last tasks of one file share the cluster with the first ones of the next.
    side_by_side(spark, write, [name for name in files if name != without], 4)
    return base


def whole_run(spark: SparkSession, sf: str) -> tuple[plans.PipelineResult, str]:
    base = raw_files(spark, sf)
    return plans.run_pipeline(spark, f"{base}/raw", f"{base}/lake", database=None), f"{base}/lake"


_BY_REPORT = {
    "monthly_revenue": ("month", "total_orders"),
    "top_products": ("product_category_name", "total_orders"),
    "region_revenue": ("customer_state", "total_orders"),
    "payment_method": ("payment_type", "total_orders"),
    "delivery_performance": ("delivery_status", "total_orders"),
    "review_by_delivery": ("delivery_status", "avg_review_score"),
}


@query(
    "end_to_end_run",
    "\nUNION ALL\n".join(
        f"SELECT 'gold_{name}' AS report, {key} AS item, CAST({value} AS DOUBLE) AS value "
        f"FROM ({sql.SILVER_REPORTS[name]})"
        for name, (key, value) in _BY_REPORT.items()
    ),
    *[name for name in sql.TABLES if name.startswith("silver_") and name != "silver_sellers"],
)
def _(spark, sf):
    _, lake_dir = whole_run(spark, sf)
    parts = [
        read_layer(spark, f"{lake_dir}/{LAYERS['gold']}", f"gold_{name}").select(
            F.lit(f"gold_{name}").alias("report"),
            F.col(key).alias("item"),
            F.col(value).cast("double").alias("value"),
        )
        for name, (key, value) in _BY_REPORT.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


_REPORT_COLUMNS = {
    "monthly_revenue": ("month", "total_revenue", "total_orders"),
    "top_products": ("product_category_name", "total_orders", "total_revenue"),
    "region_revenue": ("customer_state", "total_orders", "total_revenue"),
    "payment_method": ("payment_type", "total_orders", "total_revenue", "avg_installments"),
    "delivery_performance": ("delivery_status", "total_orders", "avg_delivery_days"),
    "review_by_delivery": ("delivery_status", "avg_review_score"),
}


@query(
    "end_to_end_columns",
    "\nUNION ALL\n".join(
        f"SELECT 'gold_{name}' AS report, {key} AS item, '{value}' AS measure, CAST({value} AS DOUBLE) AS value "
        f"FROM ({sql.SILVER_REPORTS[name]})"
        for name, (key, *values) in _REPORT_COLUMNS.items()
        for value in values
    ),
    *[name for name in sql.TABLES if name.startswith("silver_") and name != "silver_sellers"],
)
def _(spark, sf):
    """Every column of every report that a whole run has stored."""
    _, lake_dir = whole_run(spark, sf)
    parts = []
    for name, (key, *values) in _REPORT_COLUMNS.items():
        report = read_layer(spark, f"{lake_dir}/{LAYERS['gold']}", f"gold_{name}")
        if set(report.columns) != {key, *values}:
            raise ValueError(f"gold_{name} has columns {report.columns}")
        measures = [F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values]
        parts.append(
            report.select(F.lit(f"gold_{name}").alias("report"), F.col(key).alias("item"), F.inline(F.array(*measures)))
        )
    return reduce(DataFrame.unionByName, parts)


_SILVER_TABLES = [name for name in sql.TABLES if name.startswith("silver_")]


for _name in ("silver_sellers", "silver_products"):
    query(f"landed_{_name}", f"SELECT * FROM {_name}", _name)(
        lambda spark, sf, name=_name: read_layer(spark, f"{whole_run(spark, sf)[1]}/{LAYERS['silver']}", name)
    )

_LANDED = {
    "orders": ("raw_orders", 8),
    "products": ("part, (VALUES (1), (2))", 9),
    "customers": ("customer, (VALUES (1), (2))", 5),
    "sellers": ("supplier, (VALUES (1), (2))", 4),
    "order_items": ("lineitem", 7),
    "order_payments": ("lineitem", 5),
    "order_reviews": ("conversations", 7),
    "translation": ("(SELECT DISTINCT p_type, p_brand FROM part WHERE p_type <> 'PROMO')", 2),
}


@query(
    "run_ingest",
    "\nUNION ALL\n".join(
        f"SELECT 'bronze_{name}' AS \"table\", count(*) AS rows, CAST({cols} AS INTEGER) AS cols, "
        f"CAST(0 AS BIGINT) AS corrupt FROM {source}"
        for name, (source, cols) in _LANDED.items()
    ),
    "raw_orders",
)
def _(spark, sf):
    return whole_run(spark, sf)[0].ingest.select("table", "rows", "cols", "corrupt")


@query(
    "run_account",
    "\nUNION ALL\n".join(
        f"SELECT 'silver_{name}' AS \"table\", (SELECT count(*) FROM {source}) AS rows_in, count(*) AS rows_out, "
        f"(SELECT count(*) FROM {source}) - count(*) AS dropped_or_duplicate, CAST(0 AS BIGINT) AS corrupt FROM silver_{name}"
        for name, (source, _) in _LANDED.items()
        if name != "translation"
    ),
    *_SILVER_TABLES,
)
def _(spark, sf):
    """The account of rows of all seven silver tables."""
    metric, value = F.col("metric"), F.col("value")
    total = lambda *names: F.sum(F.when(metric.isin(*names), value).otherwise(0))
    return whole_run(spark, sf)[0].metrics.groupBy("table").agg(
        total("rows_in").alias("rows_in"),
        total("rows_out").alias("rows_out"),
        total("dropped", "duplicates").alias("dropped_or_duplicate"),
        total("corrupt").alias("corrupt"),
    )


@query(
    "run_rejects",
    """SELECT 'silver_orders' AS "table", order_id, NULL AS item, false AS unreadable, 'delivered' AS reasons
       FROM raw_orders WHERE order_delivered_customer_date IS NULL
       UNION ALL SELECT 'silver_order_items', order_id, order_item_id, price IS NULL, concat_ws(',',
              CASE WHEN coalesce(price < 0 OR freight_value < 0, true) THEN 'amounts' END,
              CASE WHEN product_id IS NULL THEN 'product_id' END, CASE WHEN seller_id IS NULL THEN 'seller_id' END)
       FROM raw_order_items
       WHERE coalesce(price < 0 OR freight_value < 0, true) OR product_id IS NULL OR seller_id IS NULL
       UNION ALL SELECT 'silver_order_payments', CAST(l_orderkey AS VARCHAR), l_linenumber, false, NULL
       FROM lineitem WHERE l_quantity IN (25, 26)""",
    "raw_orders",
    "raw_order_items",
)
def _(spark, sf):
    """The rejected rows that a whole run stores, with the rules they break."""
    lake_dir = whole_run(spark, sf)[1]
    names = {
        "silver_orders": (F.lit(None), F.lit(False)),
        "silver_order_items": (F.col("order_item_id"), F.col("raw_price") == "n/a"),
        "silver_order_payments": (F.col("payment_sequential"), F.lit(False)),
    }
    found = []
    for name, (item, unreadable) in names.items():
        reasons = F.array_join("reject_reasons", ",") if name != "silver_order_payments" else F.lit(None).cast("string")
        found.append(
            plans.read_rejects(spark, lake_dir, name).select(
                F.lit(name).alias("table"), "order_id", item.cast("int").alias("item"),
                unreadable.alias("unreadable"), reasons.alias("reasons"),
            )
        )
    return reduce(DataFrame.unionByName, found)


_SKIPPED = {
    "silver_order_payments": "bronze_order_payments",
    "gold_monthly_revenue": "silver_order_payments",
    "gold_region_revenue": "silver_order_payments",
    "gold_payment_method": "silver_order_payments",
}


def _checked(skipped: dict[str, str]) -> str:
    """Checks of a run as SQL: rows of every table that was computed, notes of the others."""
    sources = {name: name for name in _SILVER_TABLES} | {
        f"gold_{name}": f"({select})" for name, select in sql.SILVER_REPORTS.items()
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", CAST(0 AS BIGINT) AS total, false AS ok, 'skipped: {skipped[name]}' AS note"
        if name in skipped
        else f"SELECT '{name}', count(*), true, NULL FROM {source}"
        for name, source in sorted(sources.items(), key=lambda item: item[0] not in skipped)
    )


@query("run_with_missing_file", _checked(_SKIPPED), *_SILVER_TABLES)
def _(spark, sf):
    """A run that may go on without a file: what rests on it is skipped and not ok."""
    base = raw_files(spark, sf, without="order_payments")
    result = plans.run_pipeline(spark, f"{base}/raw", f"{base}/lake", database=None, strict=False)
    return result.checks.select("table", "total", "ok", "note")


@query(
    "run_with_catalog",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"table\", count(*) AS total, true AS in_catalog, true AS ok FROM {source}"
        for name, source in (
            {name: name for name in _SILVER_TABLES}
            | {f"gold_{name}": f"({select})" for name, select in sql.SILVER_REPORTS.items()}
        ).items()
    ),
    *_SILVER_TABLES,
)
def _(spark, sf):
    """A run that publishes its tables, in a database of its own that is dropped with them."""
    base = raw_files(spark, sf)
    database = "tierforge_" + base.split("-")[-1].split("/")[0]
    spark.sql(f"CREATE DATABASE {database}")
    try:
        result = plans.run_pipeline(spark, f"{base}/raw", f"{base}/lake", database=database)
        return result.checks.select("table", "total", "in_catalog", "ok")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


_DOCUMENT_TEXTS = ", ".join(
    f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in ("doc_id", "text", "lang", "source", "n_chars")
)


@query("bronze_mixed_files", f"SELECT {_DOCUMENT_TEXTS} FROM documents")
def _(spark, sf):
    """Texts with and without line breaks in separate files, whose columns stand in different order."""
    base = scratch_path(spark, "mixed")
    documents = table(spark, sf, "documents")
    broken = F.coalesce(F.col("text").contains("\n"), F.lit(False))
    write_csv(documents.where(broken), f"{base}/raw/documents_1.csv")
    write_csv(documents.where(~broken).select(*reversed(documents.columns)), f"{base}/raw/documents_2.csv")
    ingest_all(spark, [("documents_*.csv", "bronze_documents")], f"{base}/raw", f"{base}/brz", strict=True)
    return read_layer(spark, f"{base}/brz", "bronze_documents").drop(CORRUPT)


def _write_files(rows: DataFrame, folder: str, name: str) -> None:
    """``rows`` as two files ``folder/name_0.csv`` and ``folder/name_1.csv``, replacing those that are there."""
    spark = rows.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    beside = hadoop(scratch_path(spark, name))
    rows.repartition(2).write.option("header", True).csv(beside.toString())
    files = beside.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop(folder))
    parts = sorted(f.getPath().toString() for f in files.listStatus(beside) if f.getPath().getName().endswith(".csv"))
    for number, part in enumerate(parts):
        target = hadoop(f"{folder}/{name}_{number}.csv")
        files.delete(target, False)
        files.rename(hadoop(part), target)


def _landed_thrice(spark, sf):
    """Customers in files by nation are landed; some files are changed, some added, and all are landed again, twice."""
    base = scratch_path(spark, "ledger")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    share = F.col("c_nationkey") % 3
    batches = (
        {"a": customers.where(share == 0), "b": customers.where(share == 1)},
        {"b": customers.where((share == 1) & (F.col("c_custkey") % 2 == 0)), "c": customers.where(share == 2)},
        {},
    )
    runs = []
    for number, batch in enumerate(batches):
        for name, rows in batch.items():
            _write_files(rows, f"{base}/raw", name)
        runs.append(land_new(spark, f"{base}/raw/*.csv", f"{base}/brz", "bronze_customers").withColumn("run", F.lit(number)))
    return base, runs


@query(
    "ledger_status",
    """SELECT run, action, part, rows FROM (VALUES (0, 'landed', 0), (0, 'landed', 1), (1, 'unchanged', 0), (1, 'replaced', 3),
              (1, 'landed', 2), (2, 'unchanged', 0), (2, 'unchanged', 3), (2, 'unchanged', 2)) v(run, action, part)
       JOIN (SELECT c_nationkey % 3 AS part, count(*) AS rows FROM customer GROUP BY 1
             UNION ALL SELECT 3, count(*) FROM customer WHERE c_nationkey % 3 = 1 AND c_custkey % 2 = 0) USING (part)""",
)
def _(spark, sf):
    runs = reduce(DataFrame.unionByName, _landed_thrice(spark, sf)[1])
    name = F.regexp_extract("path", "/([abc])_[01].csv", 1)
    part = F.when(name == "a", 0).when(name == "c", 2).when(F.col("run") == 0, 1).otherwise(3)
    return runs.groupBy("run", "action", part.alias("part")).agg(F.sum("rows").alias("rows"))


@query(
    "ledger_rows",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer
       WHERE c_nationkey % 3 <> 1 OR c_custkey % 2 = 0""",
)
def _(spark, sf):
    base, _runs = _landed_thrice(spark, sf)
    return read_landed(spark, f"{base}/brz", "bronze_customers").drop(CORRUPT)


# Two batches of each source, in the order in which they arrive; a null belongs to the first.
_LATE = {
    "silver_orders": "order_purchase_timestamp >= '1995'",
    "silver_order_items": "order_item_id IN ('2', '4')",
    "silver_products": "product_id LIKE '%7'",
}


def _merged(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The late half of the rows first, then the rest, then the late half once more."""
    spec, base = plans.SILVER[name], scratch_path(spark, "merged")
    source, *lookups = [views.RAW[part.removeprefix("bronze_")](spark, sf) for part in (spec.source, *spec.lookups)]
    late = F.coalesce(F.expr(_LATE[name]), F.lit(False))
    for batch in (source.where(late), source.where(~late), source.where(late)):
        plans.merge_silver(batch, base, name, buckets=16)
    return plans.read_merged_silver(spark, base, name, *lookups)


for _name in _LATE:
    query(f"merged_{_name}", f"SELECT * {_DOUBLES.get(_name, '')} FROM {_name}", _name)(
        lambda spark, sf, name=_name: _merged(spark, sf, name)
    )


@query(
    "published_versions",
    """SELECT 1 AS version, o_orderstatus, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
       UNION ALL SELECT 2, o_orderstatus, count(*) FROM orders GROUP BY 2
       UNION ALL SELECT 3, o_orderstatus, count(*) FROM orders WHERE o_orderstatus <> 'O' GROUP BY 2""",
)
def _(spark, sf):
    """Three versions of a table, the last of them made from the one before it, read after all were made."""
    base, orders = scratch_path(spark, "versions"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    write_version(orders.where("o_orderstatus = 'F'"), base, "orders")
    write_version(orders, base, "orders", partition_by=["o_orderstatus"])
    write_version(read_version(spark, base, "orders").where("o_orderstatus <> 'O'"), base, "orders")
    versions = [(1, read_version(spark, base, "orders", 1)), (2, read_version(spark, base, "orders", 2))]
    versions.append((3, read_version(spark, base, "orders")))
    counted = [
        df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")).select(F.lit(number).alias("version"), "*")
        for number, df in versions
    ]
    return reduce(DataFrame.unionByName, counted)


@query(
    "bronze_quoted_splits",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, text || chr(10) || '"' || lang || '", ' || chr(10) || chr(10) || source AS text,
              CAST(n_chars AS VARCHAR) AS n_chars FROM documents""",
)
def _(spark, sf):
    """Files whose every record has line breaks, commas and quotes in a quoted field, read in several splits each."""
    base = scratch_path(spark, "splits")
    text = F.concat("text", F.lit('\n"'), "lang", F.lit('", \n\n'), "source")
    write_csv(table(spark, sf, "documents").select("doc_id", text.alias("text"), "n_chars"), f"{base}/raw/texts.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        ingest_all(spark, [("texts.csv", "bronze_texts")], f"{base}/raw", f"{base}/brz", strict=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return read_layer(spark, f"{base}/brz", "bronze_texts").drop(CORRUPT)


@query(
    "bronze_backslash",
    "SELECT " + ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in ("conv_id", "turn", "role", "text"))
    + ", '\"' || role || '\"' AS said FROM conversations",
)
def _(spark, sf):
    """Quotes inside quoted texts are marked by a backslash."""
    base = scratch_path(spark, "backslash")
    said = table(spark, sf, "conversations").withColumn("said", F.concat(F.lit('"'), "role", F.lit('"')))
    said.write.option("header", True).option("escape", "\\").csv(f"{base}/raw/said.csv")
    ingest_all(spark, [("said.csv", "bronze_said")], f"{base}/raw", f"{base}/brz", strict=True, escape="\\")
    return read_layer(spark, f"{base}/brz", "bronze_said").drop(CORRUPT)


@query(
    "bronze_wrong_fields",
    """SELECT CAST(s_suppkey AS VARCHAR) AS key, CASE WHEN s_nationkey % 3 <> 0 THEN s_name END AS name,
              s_nationkey % 3 <> 1 AS corrupt FROM supplier""",
)
def _(spark, sf):
    """Rows with too few and with too many fields are kept and flagged."""
    base = scratch_path(spark, "fields")
    key, name, left = F.col("s_suppkey").cast("string"), F.col("s_name"), F.col("s_nationkey") % 3
    line = F.when(left == 0, key).when(left == 1, F.concat_ws(",", key, name)).otherwise(F.concat_ws(",", key, name, name))
    # Every split has the header, as a file of its own has.
    parts = table(spark, sf, "supplier").select(line.alias("key,name"))
    parts.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(f"{base}/raw/supplier.csv")
    ingest_all(spark, [("supplier.csv", "bronze_supplier")], f"{base}/raw", f"{base}/brz", strict=True)
    landed_rows = read_layer(spark, f"{base}/brz", "bronze_supplier")
    return landed_rows.select("key", "name", F.col(CORRUPT).isNotNull().alias("corrupt"))


@query("partitioned_layer", "SELECT * FROM lineitem")
def _(spark, sf):
    base = scratch_path(spark, "partitioned")
    write_layer(table(spark, sf, "lineitem"), base, "lineitem", partition_by=["l_returnflag"])
    return read_layer(spark, base, "lineitem")


@query(
    "sorted_months",
    """SELECT month, row_number() OVER (ORDER BY month) AS place
       FROM (SELECT DISTINCT strftime(bought, '%Y-%m') AS month FROM typed_orders)""",
    "typed_orders",
)
def _(spark, sf):
    """The place of every row in a stored report."""
    base = scratch_path(spark, "sorted")
    report = plans.monthly_revenue(views.typed_orders(spark, sf), views.typed_payments(spark, sf))
    # One row a month: the window over all of them is as small as the report.
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    write_layer(report.withColumn("place", place.cast("bigint")), base, "months")
    return read_layer(spark, base, "months").select("month", "place")


# --- projections ---------------------------------------------------------------------


@query(
    "projection",
    """SELECT o_orderkey AS order_id, 'retail' AS channel, CAST(1 AS INTEGER) AS version, true AS is_live,
              CAST(NULL AS VARCHAR) AS note, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) * 2 AS DOUBLE) AS twice
       FROM orders WHERE o_orderstatus <> 'P' AND NOT (o_totalprice <= 1000 OR o_totalprice > 400000)""",
)
def _(spark, sf):
    price = F.col("o_totalprice")
    orders = table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") != "P") & ~((price <= 1000) | (price > 400000))
    )
    derived = orders.withColumns(
        {
            "channel": F.lit("retail"),
            "version": F.lit(1),
            "is_live": F.lit(True),
            "note": F.lit(None).cast("string"),
            "twice": price.cast("decimal(18,2)") * 2,
            "helper": price + 1,
        }
    ).drop("helper")
    return derived.select(
        F.col("o_orderkey").alias("order_id"), "channel", "version", "is_live", "note", "twice"
    )


@query("preview", "SELECT least(count(*), 5) AS total FROM lineitem")
def _(spark, sf):
    return ops.row_count(preview(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 5))


# --- casts and text ------------------------------------------------------------------


def event_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers as text, spoiled by event type."""
    number = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", F.concat(number, F.lit("x")))
        .when(kind == "view", F.lit(""))
        .when(kind == "signup", F.concat(F.lit(" "), number, F.lit(" ")))
        .when(kind == "click", F.concat(number, F.lit(".5")))
        .otherwise(number)
        .alias("number"),
        F.when(kind == "error", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "view", F.concat(F.date_format("ts", views.MOMENT), F.lit(".5")))
        .when(kind == "signup", F.concat(F.date_format("ts", views.MOMENT), F.lit("abc")))
        .when(kind == "purchase", F.date_format("ts", "yyyy-M-d H:m:s"))
        .otherwise(F.date_format("ts", views.MOMENT))
        .alias("moment"),
    )


_NUMBER = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_SECOND = "date_trunc('second', CAST(ts AS TIMESTAMP))"


@query(
    "cast_columns",
    f"""SELECT event_id, CASE WHEN event_type IN ('signup', 'purchase') THEN {_NUMBER} END AS as_int,
               CASE WHEN event_type IN ('signup', 'purchase') THEN CAST({_NUMBER} AS DOUBLE)
                    WHEN event_type = 'click' THEN {_NUMBER} + 0.5::DOUBLE END AS as_double,
               CASE WHEN event_type IN ('signup', 'purchase') THEN CAST({_NUMBER} AS DOUBLE)
                    WHEN event_type = 'click' THEN {_NUMBER} + 0.5::DOUBLE END AS as_float
        FROM events""",
)
def _(spark, sf):
    copies = event_texts(spark, sf).select(
        "event_id", *[F.col("number").alias(f"as_{kind}") for kind in ("int", "double", "float")]
    )
    return ops.cast_columns(copies, {"as_int": "int", "as_double": "double", "as_float": "float"})


@query(
    "cast_report",
    """SELECT 'number' AS "column", count(*) AS total, count(*) FILTER (WHERE event_type = 'view') AS missing,
              count(*) FILTER (WHERE event_type IN ('error', 'click')) AS malformed,
              count(*) FILTER (WHERE event_type IN ('signup', 'purchase')) AS valid FROM events
       UNION ALL
       SELECT 'moment', count(*), 0, count(*) FILTER (WHERE event_type IN ('error', 'view', 'signup') OR (event_type = 'purchase'
                  AND length(strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')) < 19)),
              count(*) FILTER (WHERE event_type = 'click' OR (event_type = 'purchase'
                  AND length(strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')) = 19)) FROM events""",
)
def _(spark, sf):
    return ops.cast_report(event_texts(spark, sf), {"number": "int", "moment": to_timestamp()})


@query(
    "parse_timestamps",
    f"""SELECT event_id,
               CASE WHEN event_type = 'click' OR (event_type = 'purchase'
                         AND length(strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')) = 19) THEN {_SECOND} END AS by_format,
               CASE event_type WHEN 'click' THEN {_SECOND} WHEN 'purchase' THEN {_SECOND}
                    WHEN 'view' THEN {_SECOND} + INTERVAL 500 MILLISECOND
                    WHEN 'error' THEN date_trunc('day', CAST(ts AS TIMESTAMP)) END AS by_default
        FROM events""",
)
def _(spark, sf):
    texts = event_texts(spark, sf).select(
        "event_id", F.col("moment").alias("by_format"), F.col("moment").alias("by_default")
    )
    return ops.parse_timestamps(ops.parse_timestamps(texts, ["by_format"]), ["by_default"], fmt=None)


@query(
    "blank_defaults",
    f"""SELECT event_id, CASE event_type WHEN 'error' THEN {_NUMBER} || 'x' WHEN 'signup' THEN ' ' || {_NUMBER} || ' '
                     WHEN 'click' THEN {_NUMBER} || '.5' WHEN 'purchase' THEN CAST({_NUMBER} AS VARCHAR) END AS text,
               CASE WHEN event_type IN ('signup', 'purchase') THEN {_NUMBER} WHEN event_type = 'view' THEN 1 END
                   AS number_or_one
        FROM events""",
)
def _(spark, sf):
    texts = event_texts(spark, sf).select(
        "event_id", F.col("number").alias("text"), F.col("number").alias("number_or_one")
    )
    return ops.default_if_blank(ops.blank_to_null(texts, ["text"]), {"number_or_one": ("int", 1)})


@query(
    "standardize_text",
    f"""SELECT c_custkey, {sql.initcap("c_mktsegment || '  of ' || n_name")} AS title,
               {sql.initcap("c_mktsegment || ' of ' || n_name")} AS title_collapsed,
               upper(c_name) AS big, lower(c_name) AS small, c_name AS plain
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    named = ops.left_lookup(table(spark, sf, "customer"), nations, "c_nationkey", ["n_name"])
    place = F.concat(F.lit(" "), "c_mktsegment", F.lit("  of "), "n_name", F.lit("  "))
    name = F.concat(F.lit("  "), "c_name", F.lit(" "))
    texts = named.select(
        "c_custkey",
        place.alias("title"),
        place.alias("title_collapsed"),
        name.alias("big"),
        name.alias("small"),
        name.alias("plain"),
    )
    texts = ops.standardize_text(texts, {"title": "title", "big": "upper", "small": "lower", "plain": "trim"})
    return ops.standardize_text(texts, {"title_collapsed": "title"}, collapse_whitespace=True)


@query(
    "codes_and_comments",
    """SELECT conv_id, turn, CASE role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE role END AS role,
              CASE WHEN turn = 0 THEN '' ELSE coalesce(trim(text, ' '), '') END AS comment,
              CASE WHEN turn = 0 OR coalesce(trim(text, ' '), '') = '' THEN 0 ELSE 1 END AS has_comment
       FROM conversations""",
)
def _(spark, sf):
    talks = table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", F.when(F.col("turn") > 0, F.col("text")).alias("comment")
    )
    talks = ops.map_values(talks, "role", {"user": "User", "assistant": "Assistant"})
    return ops.has_text(ops.fill_text(talks, ["comment"]), ["comment"], "has_comment")


@query(
    "delivery_features",
    f"""SELECT order_id, {sql.days("bought", "due")} AS delivery_days_planned,
               {sql.days("bought", "delivered")} AS delivery_days_actual,
               {sql.days("bought", "delivered")} - {sql.days("bought", "due")} AS delivery_delay_days,
               coalesce({sql.days("bought", "delivered")} > {sql.days("bought", "due")}, false) AS is_delayed,
               CASE WHEN delivered <= due THEN 'On Time' ELSE 'Late' END AS delivery_status,
               {sql.days("due", "delivered")} AS days_over, strftime(bought, '%Y-%m') AS month,
               delivered IS NULL AS is_open
        FROM typed_orders""",
    "typed_orders",
)
def _(spark, sf):
    bought, due, delivered = (
        "order_purchase_timestamp",
        "order_estimated_delivery_date",
        "order_delivered_customer_date",
    )
    df = ops.delay_features(views.typed_orders(spark, sf), bought, due, delivered)
    df = ops.on_time_label(df, delivered, due, "delivery_status")
    df = ops.days_between(df, due, delivered, "days_over")
    df = ops.month_bucket(df, bought, "month")
    df = ops.flag(df, "is_open", F.col(delivered).isNull())
    return df.drop("customer_id", bought, due, delivered)


# --- rules and keys --------------------------------------------------------------------


def line_rules() -> list[ops.Rule]:
    return [
        ops.Rule("quantity", F.col("l_quantity") <= 45),
        ops.Rule("discount", F.nullif("l_discount", F.lit(0.05)).isNotNull()),
        ops.Rule("flag", F.col("l_returnflag").rlike(r"^[AN]\z")),
    ]


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_BROKEN = """SELECT *, NOT (l_quantity <= 45) AS r1, (nullif(l_discount, 0.05) IS NULL) AS r2,
                    l_returnflag NOT IN ('A', 'N') AS r3 FROM lineitem"""


@query(
    "reject_report",
    f"""WITH broken AS ({_BROKEN})
        SELECT 'quantity' AS rule, count(*) AS rows_in, count(*) FILTER (WHERE r1) AS failed, count(*) FILTER (WHERE r1) AS dropped,
               count(*) FILTER (WHERE NOT r1 AND NOT r2 AND NOT r3) AS rows_kept FROM broken
        UNION ALL SELECT 'discount', count(*), count(*) FILTER (WHERE r2), count(*) FILTER (WHERE r2 AND NOT r1),
               count(*) FILTER (WHERE NOT r1 AND NOT r2 AND NOT r3) FROM broken
        UNION ALL SELECT 'flag', count(*), count(*) FILTER (WHERE r3), count(*) FILTER (WHERE r3 AND NOT r1 AND NOT r2),
               count(*) FILTER (WHERE NOT r1 AND NOT r2 AND NOT r3) FROM broken""",
)
def _(spark, sf):
    return ops.apply_rules(table(spark, sf, "lineitem"), line_rules()).metrics


@query(
    "reject_rows",
    f"""WITH broken AS ({_BROKEN})
        SELECT {_LINE}, concat_ws(',', CASE WHEN r1 THEN 'quantity' END, CASE WHEN r2 THEN 'discount' END,
                                  CASE WHEN r3 THEN 'flag' END) AS reasons
        FROM broken WHERE r1 OR r2 OR r3""",
)
def _(spark, sf):
    rejects = ops.apply_rules(table(spark, sf, "lineitem"), line_rules()).rejects
    return rejects.select(*_LINE.split(", "), F.array_join("reject_reasons", ",").alias("reasons"))


@query(
    "kept_rows",
    f"""WITH broken AS ({_BROKEN}) SELECT {_LINE} FROM broken WHERE NOT r1 AND NOT r2 AND NOT r3""",
)
def _(spark, sf):
    return ops.apply_rules(table(spark, sf, "lineitem"), line_rules()).kept.select(*_LINE.split(", "))


@query(
    "required_and_bounded",
    """SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment, c_acctbal FROM customer
       WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal BETWEEN 0 AND 9000""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"), "c_acctbal"
    )
    return ops.require_range(ops.require_not_null(df, ["segment"]), {"c_acctbal": (0, 9000)})


@query(
    "allowed_patterns",
    r"""SELECT event_id, text FROM (
            SELECT event_id, event_type, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN ''
                   ELSE json_extract_string(props, '$.k') END AS text FROM events)
        WHERE text IS NULL OR text = '' OR regexp_full_match(text, '[1-5][0-9]*')""",
)
def _(spark, sf):
    kind = F.col("event_type")
    text = F.when(kind == "error", F.lit("")).when(kind != "view", F.get_json_object("props", "$.k"))
    df = table(spark, sf, "events").select("event_id", text.alias("text"))
    return ops.require_pattern(df, "text", r"^[1-5][0-9]*\z")


@query(
    "null_keys",
    """SELECT 'product_id' AS "column", count(*) AS total, count(*) FILTER (WHERE product_id IS NULL) AS nulls FROM raw_order_items
       UNION ALL SELECT 'seller_id', count(*), count(*) FILTER (WHERE seller_id IS NULL) FROM raw_order_items""",
    "raw_order_items",
)
def _(spark, sf):
    return ops.null_counts(views.raw_order_items(spark, sf), ["product_id", "seller_id"])


@query(
    "fk_orphans",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return ops.fk_orphans(orders, table(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"})


@query(
    "fk_flag",
    """SELECT order_id, order_item_id, product_id, coalesce(product_id IN (
                  SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 40), false) AS fk_ok
       FROM silver_order_items""",
    "silver_order_items",
)
def _(spark, sf):
    items = silver(spark, sf, "silver_order_items").select("order_id", "order_item_id", "product_id")
    sold = table(spark, sf, "part").filter("p_size <= 40").select(F.col("p_partkey").cast("string").alias("id"))
    return ops.check_fk(items, sold, {"product_id": "id"})


@query(
    "line_dedupe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    return ops.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


# --- lookups -----------------------------------------------------------------------------


@query(
    "translate_fallback",
    """SELECT s_suppkey, n_name AS code, CASE WHEN n_regionkey < 3 THEN r_name ELSE n_name END AS region
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    labels = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).filter("n_regionkey < 3")
    labels = labels.select(F.concat(F.lit(" "), "n_name").alias("code"), F.col("r_name").alias("label"))
    codes = ops.left_lookup(
        table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"), nations, "n_nationkey", ["n_name"]
    ).select("s_suppkey", F.col("n_name").alias("code"))
    return ops.translate(codes, labels, "code", "label", "region")


@query(
    "left_lookup",
    """SELECT s_nationkey, s_suppkey, CASE WHEN n_regionkey < 3 THEN n_name END AS n_name
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def _(spark, sf):
    known = table(spark, sf, "nation").filter("n_regionkey < 3").withColumnRenamed("n_nationkey", "s_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey")
    return ops.left_lookup(suppliers, known, "s_nationkey", ["n_name"])


@query(
    "chained_lookups",
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey > 0""",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf, "region").filter("r_regionkey > 0").withColumnRenamed("r_regionkey", "n_regionkey")
    named = ops.left_lookup(table(spark, sf, "customer"), nations, "c_nationkey", ["n_name", "n_regionkey"])
    return ops.left_lookup(named, regions, "n_regionkey").select("c_custkey", "n_name", "r_name")


@query(
    "joined_totals",
    """SELECT o_orderkey AS order_id, any_value(o_custkey) AS customer_id, CAST(sum(amount) AS DOUBLE) AS paid,
              nullif(count(l_orderkey), 0) AS payments
       FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey GROUP BY 1""",
    "lines",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    return ops.join_preaggregated(
        orders,
        views.typed_payments(spark, sf),
        "order_id",
        {"paid": ops.total("payment_value"), "payments": F.count(F.lit(1))},
    )


# --- reports and profiles -------------------------------------------------------------------


@query(
    "rollup_report",
    """SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status, count(*) AS orders,
              CAST(round(sum(CAST(o_totalprice AS DECIMAL(18, 2))), 1) AS DOUBLE) AS revenue,
              round(avg(o_custkey % 10), 2) AS digit
       FROM orders GROUP BY 1, 2""",
)
def _(spark, sf):
    return ops.rollup_report(
        table(spark, sf, "orders"),
        {"priority": F.nullif("o_orderpriority", F.lit("5-LOW")), "status": F.col("o_orderstatus")},
        {
            "orders": ops.non_null_count("o_orderkey"),
            "revenue": ops.total(F.col("o_totalprice").cast("decimal(18,2)"), 1),
            "digit": ops.average(F.col("o_custkey") % 10, 2),
        },
        [F.desc("revenue"), "priority", "status"],
    )


@query(
    "top_parts",
    """SELECT l_partkey, count(*) AS sold, sum(CAST(l_quantity AS BIGINT))::BIGINT AS pieces FROM lineitem
       GROUP BY 1 ORDER BY sold DESC, l_partkey LIMIT 10""",
)
def _(spark, sf):
    measures = {"sold": F.count(F.lit(1)), "pieces": F.sum(F.col("l_quantity").cast("bigint"))}
    return ops.top_n(table(spark, sf, "lineitem"), "l_partkey", measures, "sold", 10)


@query("row_count", "SELECT count(*) AS total FROM lineitem")
def _(spark, sf):
    return ops.row_count(table(spark, sf, "lineitem"))


@query(
    "profile_numeric",
    """SELECT 'l_linenumber' AS "column", min(l_linenumber)::DOUBLE AS min_value, max(l_linenumber)::DOUBLE AS max_value,
              avg(l_linenumber) AS mean_value FROM lineitem
       UNION ALL SELECT 'l_quantity', min(l_quantity), max(l_quantity), avg(l_quantity) FROM lineitem""",
)
def _(spark, sf):
    return ops.summarize(table(spark, sf, "lineitem"), ["l_linenumber", "l_quantity"])


@query(
    "profile_distinct",
    """SELECT 'segment' AS "column", count(DISTINCT c_mktsegment) AS distinct_values,
              count(DISTINCT nullif(c_mktsegment, 'BUILDING')) AS distinct_non_null FROM customer
       UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey), count(DISTINCT c_nationkey) FROM customer
       UNION ALL SELECT 'c_name', count(DISTINCT c_name), count(DISTINCT c_name) FROM customer""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return ops.distinct_counts(df, ["segment", "c_nationkey", "c_name"])


@query(
    "profile_frequencies",
    "SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*) AS total FROM customer GROUP BY 1",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return ops.frequencies(df, "segment")


@query("score_distribution", "SELECT quality, count(*) AS total FROM labels GROUP BY 1")
def _(spark, sf):
    return ops.frequencies(table(spark, sf, "labels"), "quality").orderBy(F.desc("total"))


@query(
    "late_share",
    """SELECT count(*) AS total, count(*) FILTER (WHERE is_delayed) AS matching,
              avg(CASE WHEN is_delayed THEN 1.0 ELSE 0.0 END) * 100 AS percent FROM silver_orders""",
    "silver_orders",
)
def _(spark, sf):
    return ops.share_where(silver(spark, sf, "silver_orders"), F.col("is_delayed"))


_LINE_OF_PROFILE = 'SELECT {} AS metric, {} AS "column", {} AS item, CAST({} AS DOUBLE) AS value FROM {}'


def profile_sql(*lines: tuple[str, str, str, str, str]) -> str:
    return "\nUNION ALL\n".join(_LINE_OF_PROFILE.format(*line) for line in lines)


def _top(table_name: str, column: str, n: int | None = None) -> str:
    tail = "" if n is None else f" ORDER BY n DESC, v ASC NULLS LAST LIMIT {n}"
    return f"(SELECT {column} AS v, count(*) AS n FROM {table_name} GROUP BY 1{tail})"


def _place_profile(entity: str, cities: int) -> str:
    source = f"silver_{entity}s"
    lines = [("'rows'", "''", "''", "count(*)", source)]
    for column, n in ((f"{entity}_state", 5), (f"{entity}_city", cities)):
        lines += [
            ("'distinct'", f"'{column}'", "''", f"count(DISTINCT {column})", source),
            ("'distinct_rows'", f"'{column}'", "''", "count(*)", source),
            ("'frequency'", f"'{column}'", "v", "n", _top(source, column, n)),
        ]
    return profile_sql(*lines)


_PROFILE_SQL = {
    "silver_orders": profile_sql(
        ("'rows'", "''", "''", "count(*)", "silver_orders"),
        ("'min'", "'delivery_delay_days'", "''", "min(delivery_delay_days)", "silver_orders"),
        ("'max'", "'delivery_delay_days'", "''", "max(delivery_delay_days)", "silver_orders"),
        ("'mean'", "'delivery_delay_days'", "''", "avg(delivery_delay_days)", "silver_orders"),
        ("'matching'", "'is_delayed'", "''", "count(*) FILTER (WHERE is_delayed)", "silver_orders"),
        ("'percent'", "'is_delayed'", "''", "avg(CASE WHEN is_delayed THEN 1.0 ELSE 0.0 END) * 100", "silver_orders"),
    ),
    "silver_customers": _place_profile("customer", 5),
    "silver_sellers": _place_profile("seller", 10),
    "silver_order_payments": profile_sql(
        ("'rows'", "''", "''", "count(*)", "silver_order_payments"),
        ("'frequency'", "'payment_type'", "v", "n", _top("silver_order_payments", "payment_type")),
        (
            "'sum'",
            "'payment_value'",
            "v",
            "n",
            "(SELECT payment_type AS v, sum(payment_value) AS n FROM silver_order_payments GROUP BY 1)",
        ),
    ),
    "silver_order_reviews": profile_sql(
        ("'rows'", "''", "''", "count(*)", "silver_order_reviews"),
        ("'min'", "'review_score'", "''", "min(review_score)", "silver_order_reviews"),
        ("'max'", "'review_score'", "''", "max(review_score)", "silver_order_reviews"),
        ("'mean'", "'review_score'", "''", "avg(review_score)", "silver_order_reviews"),
        (
            "'frequency'",
            "'review_score'",
            "CAST(v AS VARCHAR)",
            "n",
            _top("silver_order_reviews", "review_score"),
        ),
    ),
    "silver_products": profile_sql(
        ("'rows'", "''", "''", "count(*)", "silver_products"),
        (
            "'distinct'",
            "'product_category_name'",
            "''",
            "count(DISTINCT product_category_name) + max(CASE WHEN product_category_name IS NULL THEN 1 ELSE 0 END)",
            "silver_products",
        ),
        ("'distinct_rows'", "'product_category_name'", "''", "count(*)", "silver_products"),
        (
            "'frequency'",
            "'product_category_name_english'",
            "v",
            "n",
            _top("silver_products", "product_category_name_english", 10),
        ),
    ),
    # Means of amounts are compared as sums of decimals over row counts.
    "silver_order_items": profile_sql(
        *[
            line
            for column in ("price", "freight_value")
            for line in (
                ("'min'", f"'{column}'", "''", f"min({column})", "silver_order_items"),
                ("'max'", f"'{column}'", "''", f"max({column})", "silver_order_items"),
                (
                    "'mean'",
                    f"'{column}'",
                    "''",
                    f"round(CAST(sum({column}) AS DOUBLE) / count({column}), 4)",
                    "silver_order_items",
                ),
            )
        ],
        ("'rows'", "''", "''", "count(*)", "silver_order_items"),
    ),
}


def _rounded_means(profile: DataFrame, amounts: Column) -> DataFrame:
    """Means of ``amounts`` to four digits, as in the SQL."""
    mean = (F.col("metric") == "mean") & amounts
    return profile.withColumn("value", F.when(mean, F.round("value", 4)).otherwise(F.col("value")))


def profiled(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return _rounded_means(plans.PROFILES[name](silver(spark, sf, name)), F.lit(name == "silver_order_items"))


@query(
    "run_profiles",
    "\nUNION ALL\n".join(f"SELECT '{name}' AS \"table\", * FROM ({twin}) t_{name}" for name, twin in _PROFILE_SQL.items()),
    *_PROFILE_SQL,
)
def _(spark, sf):
    """All that a whole run profiles, of every silver table."""
    return _rounded_means(whole_run(spark, sf)[0].profiles, F.col("table") == "silver_order_items")


for _name, _sql in _PROFILE_SQL.items():
    query(f"profile_{_name.removeprefix('silver_')}", _sql, _name)(
        lambda spark, sf, name=_name: profiled(spark, sf, name)
    )


@query(
    "output_check",
    """SELECT 'gold_region_revenue' AS "table", true AS table_exists, count(*) AS total,
              count(*) FILTER (WHERE customer_state IS NULL) AS null_keys, count(*) - count(DISTINCT customer_state) AS duplicate_keys,
              true AS ok FROM (SELECT DISTINCT CASE WHEN c_custkey IS NULL THEN NULL ELSE
                  nullif(c_mktsegment, 'BUILDING') END AS customer_state
              FROM orders LEFT JOIN customer ON o_custkey = c_custkey) WHERE customer_state IS NOT NULL
       UNION ALL
       SELECT 'lines', true, count(*), 0, count(*) - count(DISTINCT (l_orderkey, l_linenumber)), false FROM lineitem
       UNION ALL SELECT 'absent', false, 0, 0, 0, false""",
)
def _(spark, sf):
    base = scratch_path(spark, "checked")
    regions = plans.region_revenue(
        views.typed_orders(spark, sf), views.typed_customers(spark, sf), views.typed_payments(spark, sf)
    )
    paths = {
        "gold_region_revenue": (
            write_layer(regions.filter(F.col("customer_state").isNotNull()), base, "gold_region_revenue"),
            ("customer_state",),
        ),
        "lines": (
            write_layer(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), base, "lines"),
            ("l_orderkey", "l_linenumber"),
        ),
        "absent": (f"{base}/absent", ()),
    }
    return plans.output_check(spark, paths)


@query(
    "key_check",
    """SELECT 'silver_order_items' AS "table", true AS table_exists, count(*) AS total, CAST(0 AS BIGINT) AS null_keys,
              count(*) - count(DISTINCT (order_id, order_item_id)) AS duplicate_keys FROM silver_order_items""",
    "silver_order_items",
)
def _(spark, sf):
    items = silver(spark, sf, "silver_order_items")
    return key_check(items, "silver_order_items", ["order_id", "order_item_id"])


_METRICS_ITEMS = {
    ("rows_in", ""): "count(*)",
    ("failed", "amounts"): "count(*) FILTER (WHERE NOT coalesce(price >= 0 AND freight_value >= 0, false))",
    ("dropped", "amounts"): "count(*) FILTER (WHERE NOT coalesce(price >= 0 AND freight_value >= 0, false))",
    ("failed", "product_id"): "count(*) FILTER (WHERE product_id IS NULL)",
    ("dropped", "product_id"): "count(*) FILTER (WHERE product_id IS NULL AND price >= 0 AND freight_value >= 0)",
    ("failed", "seller_id"): "count(*) FILTER (WHERE seller_id IS NULL)",
    ("dropped", "seller_id"): "count(*) FILTER (WHERE seller_id IS NULL AND product_id IS NOT NULL AND price >= 0 AND freight_value >= 0)",
    ("rows_kept", ""): "count(*) FILTER (WHERE seller_id IS NOT NULL AND product_id IS NOT NULL AND price >= 0 AND freight_value >= 0)",
    ("malformed", "order_item_id"): "max(0)",
    ("malformed", "shipping_limit_date"): "count(*) FILTER (WHERE shipping_limit_date IS NULL)",
    ("malformed", "price"): "count(*) FILTER (WHERE price IS NULL)",
    ("rounded", "price"): "max(0)",
    ("malformed", "freight_value"): "max(0)",
    ("rounded", "freight_value"): "max(0)",
}


@query(
    "silver_metrics",
    "\nUNION ALL\n".join(
        f"SELECT 'silver_order_items' AS \"table\", '{metric}' AS metric, '{item}' AS item, "
        f"CAST({value} AS BIGINT) AS value FROM raw_order_items"
        for (metric, item), value in _METRICS_ITEMS.items()
    ),
    "raw_order_items",
)
def _(spark, sf):
    return plans.silver_metrics("silver_order_items", views.raw_order_items(spark, sf))
