"""The gold reports, and the whole run over small CSV files."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierforge.plans import (
    SILVER,
    delivery_performance,
    monthly_revenue,
    payment_method,
    read_rejects,
    region_revenue,
    retail_manifest,
    review_by_delivery,
    run_pipeline,
    run_silver,
    top_products,
)
from tierforge.plans.run import _Lake, _run_silver


@pytest.fixture(scope="module")
def silver(spark):
    """Random tables in which one order and one product hold a third of all rows."""
    rng = random.Random(7)
    start = datetime(2020, 1, 1)

    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    def hot(n):
        return 0 if rng.random() < 0.33 else rng.randrange(n)

    orders = [
        (maybe(f"o{i}", 0.05), maybe(f"c{hot(12)}"), maybe(start + timedelta(days=rng.randrange(90))),
         maybe(start + timedelta(days=30 + rng.randrange(90))), maybe(start + timedelta(days=60)))
        for i in range(60)
    ]
    payments = [
        (maybe(f"o{hot(80)}"), maybe(rng.choice(["Boleto", "Voucher"])), maybe(rng.randrange(9)),
         maybe(rng.randrange(1, 10**6) / 100))
        for _ in range(300)
    ]
    items = [(maybe(f"o{hot(80)}"), maybe(f"p{hot(30)}"), maybe(rng.randrange(1, 10**5) / 100)) for _ in range(300)]
    products = [(f"p{i}", maybe(f"cat{i % 14}", 0.2)) for i in range(25)]
    customers = [(f"c{i}", maybe(f"S{i % 4}", 0.2)) for i in range(10)]
    reviews = [(maybe(f"o{hot(80)}"), maybe(rng.randrange(1, 6))) for _ in range(200)]
    frame = spark.createDataFrame
    return {
        "orders": frame(
            orders,
            "order_id string, customer_id string, order_purchase_timestamp timestamp,"
            " order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
        ),
        "payments": frame(
            payments,
            "order_id string, payment_type string, payment_installments int, payment_value double",
        ).withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)")),
        "items": frame(items, "order_id string, product_id string, price double").selectExpr(
            "order_id", "product_id", "cast(price as decimal(18,2)) as price"
        ),
        "products": frame(products, "product_id string, product_category_name string"),
        "customers": frame(customers, "customer_id string, customer_state string"),
        "reviews": frame(reviews, "order_id string, review_score int"),
    }


def listed(df):
    return [tuple(row) for row in df.collect()]


def test_preaggregation_changes_no_report(silver):
    o, p, c = silver["orders"], silver["payments"], silver["customers"]
    for report, inputs in [
        (monthly_revenue, (o, p)),
        (region_revenue, (o, c, p)),
        (top_products, (silver["items"], silver["products"])),
        (review_by_delivery, (o, silver["reviews"])),
    ]:
        reduced, plain = report(*inputs), report(*inputs, pre_aggregate=False)
        assert reduced.schema == plain.schema or reduced.columns == plain.columns
        assert reduced.dtypes == plain.dtypes
        assert sorted(listed(reduced), key=str) == sorted(listed(plain), key=str)
        assert reduced.count() > 1


def test_preaggregation_survives_duplicate_dimension_rows(silver):
    twice = silver["customers"].union(silver["customers"])
    inputs = (silver["orders"], twice, silver["payments"])
    assert listed(region_revenue(*inputs)) == listed(region_revenue(*inputs, pre_aggregate=False))


def test_report_types(silver):
    assert monthly_revenue(silver["orders"], silver["payments"], distinct_orders=True).dtypes == [
        ("month", "string"),
        ("total_revenue", "double"),
        ("total_orders", "bigint"),
        ("distinct_orders", "bigint"),
    ]
    assert payment_method(silver["payments"]).dtypes == [
        ("payment_type", "string"),
        ("total_orders", "bigint"),
        ("total_revenue", "double"),
        ("avg_installments", "double"),
    ]
    assert delivery_performance(silver["orders"]).dtypes == [
        ("delivery_status", "string"),
        ("total_orders", "bigint"),
        ("avg_delivery_days", "double"),
    ]


def test_orders_with_none_one_and_three_payments(spark):
    day = datetime(2020, 5, 1)
    orders = spark.createDataFrame(
        [("o0", day), ("o1", day), ("o3", day)], "order_id string, order_purchase_timestamp timestamp"
    )
    payments = spark.createDataFrame(
        [("o1", 1.0), ("o3", 2.0), ("o3", 3.0), ("o3", None)], "order_id string, payment_value double"
    )
    report = monthly_revenue(orders, payments, distinct_orders=True)
    assert listed(report) == [("2020-05", 6.0, 5, 3)]


RAW = {
    "orders_dataset.csv": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2020-01-05 10:00:00,2020-01-05 11:00:00,2020-01-06 00:00:00,2020-01-10 12:00:00,2020-01-20 00:00:00
o1,c1,delivered,2020-01-05 10:00:00,2020-01-05 11:00:00,2020-01-06 00:00:00,2020-01-10 12:00:00,2020-01-20 00:00:00
o2,c2,delivered,2020-01-15 10:00:00,,,2020-02-20 12:00:00,2020-02-20 00:00:00
o3,c3,delivered,2020-02-01 10:00:00,bad,,2020-02-11 00:00:00,2020-02-20 00:00:00
o4,c9,delivered,2020-02-03 10:00:00,,,2020-02-10 00:00:00,
o5,c1,shipped,2020-02-03 10:00:00,,,,2020-02-20 00:00:00
""",
    "products_dataset.csv": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,beleza,40,287,1,225,16,10,14
p2,,44,276,1,,30,18,20
p3,nova,46,250,1,154,18,9,15
""",
    "customers_dataset.csv": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01310, sao paulo,sp
c2,u2,20000,"rio de
janeiro",RJ
c3,u3,01311,campinas, SP
""",
    "sellers_dataset.csv": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,13023,campinas,SP
s2,13844,mogi guacu,SP
""",
    "order_items_dataset.csv": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2020-01-08 00:00:00,50.00,5.00
o1,2,p1,s1,2020-01-08 00:00:00,50.00,5.00
o2,1,p2,s2,2020-01-18 00:00:00,20.50,1.00
o3,1,p3,s2,2020-02-08 00:00:00,-1.00,1.00
o3,2,p3,s2,2020-02-08 00:00:00,7.25,1.00
o4,1,p9,s2,2020-02-08 00:00:00,9.00,1.00
""",
    "order_payments_dataset.csv": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,100.00
o1,2,voucher,,10.00
o2,1,boleto,1,21.50
o3,1,credit_card,2,8.25
o5,1,credit_card,8,99.99
o9,1,credit_card,1,oops
""",
    "order_reviews_dataset.csv": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,,"very ""good"", again",2020-01-12 00:00:00,2020-01-13 10:00:00
r1,o1,4,,,2020-01-11 00:00:00,2020-01-13 10:00:00
r2,o2,1,late,"two
lines",2020-02-21 00:00:00,2020-02-22 10:00:00
r3,o3,x,,,2020-02-21 00:00:00,2020-02-22 10:00:00
r4,o3,4,,,2020-02-21 00:00:00,2020-02-22 10:00:00
""",
    "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\nbeleza,beauty\n",
}

GOLD = {
    "gold_monthly_revenue": [("2020-01", 131.5, 3), ("2020-02", 8.25, 2)],
    "gold_top_products": [("beleza", 2, 100.0), (None, 2, 29.5), ("nova", 1, 7.25)],
    "gold_region_revenue": [("SP", 3, 118.25), ("RJ", 1, 21.5), (None, 1, None)],
    "gold_payment_method": [("Credit Card", 3, 208.24, 4.3), ("Boleto", 1, 21.5, 1.0), ("Voucher", 1, 10.0, 1.0)],
    "gold_delivery_performance": [("Late", 2, 21.5), ("On Time", 2, 7.5)],
    "gold_review_by_delivery": [("Late", 1.0), ("On Time", 4.5)],
}


@pytest.fixture
def raw_dir(tmp_path):
    for name, text in RAW.items():
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / name).write_text(text, encoding="utf-8")
    return str(tmp_path / "raw")


@pytest.mark.parametrize("database", ["default", None])
def test_whole_run_twice(spark, tmp_path, raw_dir, rows, database):
    lake = str(tmp_path / "lake")
    for _ in range(2):
        result = run_pipeline(spark, raw_dir, lake, database=database)
        for name, expected in GOLD.items():
            table = spark.table(f"default.{name}") if database else spark.read.parquet(f"{lake}/gld/{name}")
            assert rows(table) == sorted(expected, key=str), name
        assert [r.error for r in result.ingest.collect()] == [None] * 8
        assert all(r.ok for r in result.checks.collect())
        assert result.checks.count() == 13
        counted = {(r.table, r.metric, r.item): r.value for r in result.metrics.collect()}
        assert counted["silver_orders", "dropped", "delivered"] == 1
        assert counted["silver_order_items", "dropped", "amounts"] == 1
        assert counted["silver_order_reviews", "dropped", "score"] == 1
        assert counted["silver_order_payments", "malformed", "payment_value"] == 1
        # Every rejected row is stored, with what it breaks.
        for name in SILVER:
            rejected = read_rejects(spark, lake, name)
            assert counted[name, "rows_in", ""] == rejected.count() + counted[name, "rows_kept", ""]
            firsts = sum(value for (table, metric, _), value in counted.items() if table == name and metric == "dropped")
            assert rejected.where("size(reject_reasons) > 0").count() == firsts
        assert rows(read_rejects(spark, lake, "silver_orders"), "order_id", "reject_reasons") == [("o5", ["delivered"])]
    if database:
        for name in GOLD:
            spark.sql(f"drop table default.{name}")


def test_rejects_change_no_metric(spark, tmp_path, raw_dir, rows):
    run_pipeline(spark, raw_dir, str(tmp_path / "a"), database=None)
    kept = run_silver(spark, str(tmp_path / "a"), database=None)
    assert rows(kept) == rows(run_silver(spark, str(tmp_path / "a"), database=None, keep_rejects=False))


def test_double_amounts_give_the_same_reports(spark, tmp_path, raw_dir, rows):
    lake = str(tmp_path / "lake")
    run_pipeline(spark, raw_dir, lake, database=None, money="double")
    for name, expected in GOLD.items():
        assert rows(spark.read.parquet(f"{lake}/gld/{name}")) == sorted(expected, key=str), name


def test_missing_file_stops_a_strict_run(spark, tmp_path, raw_dir):
    with pytest.raises(RuntimeError, match="x_orders_dataset.csv"):
        run_pipeline(spark, raw_dir, str(tmp_path / "lake"), manifest=retail_manifest("x_"), database=None)


def test_doubtful_observed_counts_are_replaced(spark, tmp_path, raw_dir, monkeypatch):
    lake_dir = str(tmp_path / "lake")
    run_pipeline(spark, raw_dir, lake_dir, database=None)
    from pyspark.sql import Observation

    lake = _Lake(spark, lake_dir, None)
    trusted = sorted(_run_silver(lake, "silver_order_items", "decimal(18,2)"))
    twice = property(lambda self: {"rows_in": 99, "rows_kept": 99})
    monkeypatch.setattr(Observation, "get", twice)
    assert sorted(_run_silver(lake, "silver_order_items", "decimal(18,2)")) == trusted


def test_step_by_step_from_the_command_line(spark, tmp_path, raw_dir, rows, capsys):
    from tierforge.__main__ import main

    lake = str(tmp_path / "lake")
    main(["bronze", "--raw", raw_dir, "--lake", lake])
    main(["silver", "--lake", lake, "--database", ""])
    main(["silver", "silver_orders", "--lake", lake, "--database", ""])
    main(["gold", "--lake", lake, "--database", ""])
    main(["gold", "gold_payment_method", "--lake", lake, "--database", "", "--threads", "1"])
    main(["check", "--lake", lake])
    shown = capsys.readouterr().out
    assert all(title in shown for title in ("ingest", "metrics", "profiles", "checks"))
    assert "|is_delayed" in shown
    for name, expected in GOLD.items():
        assert rows(spark.read.parquet(f"{lake}/gld/{name}")) == sorted(expected, key=str), name
    with pytest.raises(SystemExit):
        main(["run", "--lake", lake])


def test_a_lake_does_not_read_another_lakes_tables(spark, tmp_path, raw_dir, rows):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    run_pipeline(spark, raw_dir, one, database="default")
    payments = tmp_path / "raw" / "order_payments_dataset.csv"
    payments.write_text(payments.read_text().replace("o3,1,credit_card,2,8.25", "o3,1,credit_card,2,4908.25"))
    from tierforge.plans.run import run_checks, run_gold, run_silver
    from tierforge.sources import ingest_all

    ingest_all(spark, retail_manifest(), raw_dir, f"{two}/brz", True)
    run_silver(spark, two, database=None)
    run_gold(spark, two)
    card = spark.read.parquet(f"{two}/gld/gold_payment_method").where("payment_type = 'Credit Card'").first()
    assert card.total_revenue == 5108.24
    # The catalog now has the second lake's reports and the first one's silver tables.
    checks = {r.table: r for r in run_checks(spark, two, database="default").collect()}
    assert checks["gold_payment_method"].ok and checks["gold_payment_method"].in_catalog
    assert not checks["silver_orders"].ok and not checks["silver_orders"].in_catalog
    for name in checks:
        spark.sql(f"drop table if exists default.{name}")


def test_what_rests_on_a_missing_file_is_skipped(spark, tmp_path, raw_dir, rows):
    lake = str(tmp_path / "lake")
    run_pipeline(spark, raw_dir, lake, database=None)
    (tmp_path / "raw" / "order_payments_dataset.csv").unlink()
    result = run_pipeline(spark, raw_dir, lake, database=None, strict=False)
    skipped = {r.table: r.reason for r in result.skipped.collect()}
    assert skipped == {
        "silver_order_payments": "skipped: bronze_order_payments",
        "gold_monthly_revenue": "skipped: silver_order_payments",
        "gold_region_revenue": "skipped: silver_order_payments",
        "gold_payment_method": "skipped: silver_order_payments",
    }
    checks = {r.table: r for r in result.checks.collect()}
    assert {name for name, r in checks.items() if not r.ok} == set(skipped)
    assert checks["gold_payment_method"].note == "skipped: silver_order_payments"


def test_every_row_is_accounted_for_and_stored(spark, tmp_path, raw_dir):
    lake = str(tmp_path / "lake")
    reviews = tmp_path / "raw" / "order_reviews_dataset.csv"
    reviews.write_text(reviews.read_text() + "r9,o3\n")
    payments = tmp_path / "raw" / "order_payments_dataset.csv"
    payments.write_text(payments.read_text() + "".join(f"o1,1,code{i},1,1.00\n" for i in range(1200)))
    for _ in range(2):
        result = run_pipeline(spark, raw_dir, lake, database=None)
    counted = {}
    for r in result.metrics.collect():
        counted.setdefault(r.table, {})[r.metric, r.item] = r.value
    assert len(counted) == 7
    for name, values in counted.items():
        dropped = sum(v for (metric, _), v in values.items() if metric == "dropped")
        assert values["rows_in", ""] == dropped + values["duplicates", ""] + values["rows_out", ""]
        assert values["rows_out", ""] == spark.read.parquet(f"{lake}/slv/{name}").count()
    assert counted["silver_orders"]["duplicates", ""] == 1
    assert counted["silver_order_reviews"]["corrupt", ""] == 1
    stored = spark.read.parquet(f"{lake}/meta/profiles")
    codes = stored.where("`table` = 'silver_order_payments'")
    assert codes.select("run_id").distinct().count() == 2
    assert codes.where("item like 'code%'").select("item").distinct().count() == 1200


def test_long_lists_of_values_are_not_kept_as_dictionaries(spark, tmp_path):
    """Looking values up in a dictionary larger than the processor's cache takes longer than writing them out."""
    import pyarrow.parquet as pq

    from tierforge.sinks import write_layer

    df = spark.range(100_000, numPartitions=1).select(
        F.md5(F.floor(F.col("id") / 5).cast("string")).alias("key"), (F.col("id") % 7).cast("string").alias("code")
    )
    path = write_layer(df, str(tmp_path), "layer")
    assert spark.read.parquet(path).exceptAll(df).isEmpty() and spark.read.parquet(path).count() == 100_000
    (part,) = (tmp_path / "layer").glob("*.parquet")
    group = pq.ParquetFile(part).metadata.row_group(0)
    sizes = {}
    for column in map(group.column, range(group.num_columns)):
        listed = column.has_dictionary_page
        sizes[column.path_in_schema] = column.data_page_offset - column.dictionary_page_offset if listed else 0
    # 20,000 keys of 32 letters are 720 KB.
    assert 0 < sizes["code"] < 1_000 and sizes["key"] < 200_000, sizes


def test_layers_are_compressed_by_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    from tierforge.sinks import write_layer

    df = spark.range(1000, numPartitions=1).selectExpr("id", "cast(id as string) as text")
    path = write_layer(df, str(tmp_path), "layer")
    assert sorted(spark.read.parquet(path).collect()) == sorted(df.collect())
    (part,) = (tmp_path / "layer").glob("*.parquet")
    group = pq.ParquetFile(part).metadata.row_group(0)
    assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}


def test_shuffle_files_go_when_items_are_done(spark):
    """Those of the last item may still be referred to when it ends."""
    import time

    from tierforge.session import side_by_side

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = lambda: {name for name in disk.getAllBlocks().mkString(" ").split() if name.startswith("shuffle_")}
    before, made = found(), []

    def task(parts):
        spark.range(1000).repartition(parts).write.format("noop").mode("overwrite").save()
        made.append(found() - before)
        return parts

    assert side_by_side(spark, task, [3, 5, 7], 1) == [3, 5, 7] and all(made)
    until = time.time() + 30
    while (left := found() & made[0]) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_raw_files_of_a_run_are_compressed_where_lines_are_records(spark, monkeypatch):
    from pathlib import Path

    from acceptance import queries
    from tierforge.sources import CORRUPT, read_raw_csv

    rows = [(f"k{i}", None if i % 3 else f'say "{i}", so', "  x ") for i in range(200)]
    lines = [(key, f"{key}\nnext line", end) for key, _, end in rows]
    frames = {
        name: spark.createDataFrame(lines if name == "order_reviews" else rows, "a string, b string, c string")
        for name in queries.views.RAW
    }
    monkeypatch.setattr(queries.views, "RAW", {name: lambda spark, sf, df=df: df for name, df in frames.items()})
    base = queries.raw_files(spark, "unused")
    for entry in retail_manifest():
        name = entry.table.removeprefix("bronze_")
        parts = [p.name for p in Path(f"{base}/raw/{entry.file}").glob("part-*")]
        assert parts and all(p.endswith(".csv" if name == "order_reviews" else ".csv.gz") for p in parts)
        got = read_raw_csv(spark, f"{base}/raw/{entry.file}", multiline="auto").collect()
        assert all(row[CORRUPT] is None for row in got)
        assert sorted((tuple(row)[:3] for row in got), key=str) == sorted(map(tuple, frames[name].collect()), key=str)
