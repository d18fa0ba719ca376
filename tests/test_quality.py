import pytest
from pyspark.sql import functions as F

from tierforge.operators import (
    Rule,
    apply_rules,
    check_fk,
    fk_orphans,
    null_counts,
    require_not_null,
    require_pattern,
    require_range,
)
from tierforge.plans.silver import MOMENT_PATTERN, SCORE_PATTERN


def test_required_columns(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    assert rows(require_not_null(df, ["k", "v"])) == [(1, "a")]


def test_bounds(spark, rows):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (7.0,)], "p double")
    assert rows(require_range(df, {"p": (0, None)})) == [(0.0,), (7.0,)]
    assert rows(require_range(df, {"p": (0, 5)})) == [(0.0,)]


def test_score_pattern(spark, rows):
    df = spark.createDataFrame([("1",), ("5",), ("0",), ("6",), ("5\n",), (None,), ("",)], "s string")
    assert rows(require_pattern(df, "s", SCORE_PATTERN)) == [("",), ("1",), ("5",), (None,)]


def test_moment_pattern_without_null(spark, rows):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), (None,), ("text",)], "s string")
    kept = require_pattern(df, "s", MOMENT_PATTERN, allow_null=False, allow_blank=False)
    assert rows(kept) == [("2017-10-02 10:56:33",)]


def test_rejects_name_every_broken_rule_and_add_up(spark, rows):
    df = spark.createDataFrame(
        [(1, 5.0, "a"), (2, -1.0, None), (3, None, "c"), (4, 1.0, None), (5, 2.0, "e")],
        "i int, price double, key string",
    )
    rules = [Rule("price", F.col("price") >= 0), Rule("key", F.col("key").isNotNull())]
    kept, rejects, metrics = apply_rules(df, rules)
    assert rows(kept, "i") == [(1,), (5,)]
    assert rows(rejects, "i", "reject_reasons") == [(2, ["price", "key"]), (3, ["price"]), (4, ["key"])]
    assert kept.count() + rejects.count() == df.count()
    # Of the two rows without key one was already dropped for its price.
    assert rows(metrics) == [("key", 5, 2, 1, 2), ("price", 5, 2, 2, 2)]


def test_rules_over_nothing(spark, rows):
    empty = spark.createDataFrame([], "k int")
    kept, rejects, metrics = apply_rules(empty, [Rule("k", F.col("k").isNotNull())])
    assert kept.count() == rejects.count() == 0
    assert rows(metrics) == [("k", 0, 0, 0, 0)]


def test_null_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(null_counts(df, ["a", "b"])) == [("a", 3, 1), ("b", 3, 2)]


def test_foreign_keys(spark, rows):
    items = spark.createDataFrame([(1, "p1"), (2, "p9"), (3, None), (4, "p1")], "i int, product_id string")
    products = spark.createDataFrame([("p1",), ("p1",), ("p2",), (None,)], "product_id string")
    flagged = check_fk(items, products, "product_id")
    assert flagged.columns == ["i", "product_id", "fk_ok"]
    assert rows(flagged, "i", "fk_ok") == [(1, True), (2, False), (3, False), (4, True)]
    assert rows(fk_orphans(items, products, "product_id")) == [(2, "p9")]
    renamed = products.withColumnRenamed("product_id", "id")
    assert rows(fk_orphans(items, renamed, {"product_id": "id"})) == [(2, "p9")]
    assert check_fk(items, renamed, {"product_id": "id"}).count() == 4


def test_two_column_foreign_key(spark, rows):
    left = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    right = spark.createDataFrame([(1, 2), (2, 1)], "a int, b int")
    assert rows(check_fk(left, right, ["a", "b"])) == [(1, 1, False), (1, 2, True)]


def test_self_reference(spark, rows):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id int, boss int")
    assert rows(fk_orphans(staff, staff, {"boss": "id"})) == [(3, 9)]
    assert rows(check_fk(staff, staff, {"boss": "id"}), "id", "fk_ok") == [(1, False), (2, True), (3, False)]


@pytest.mark.parametrize("cut", [1, 7])
def test_metrics_do_not_depend_on_partitions(spark, rows, cut):
    df = spark.range(100).selectExpr("id", "if(id % 3 = 0, null, id) as k").repartition(cut)
    _, _, metrics = apply_rules(df, [Rule("k", F.col("k").isNotNull())])
    assert rows(metrics) == [("k", 100, 34, 34, 66)]


def test_reasons_are_built_for_rejected_rows_only(spark, rows):
    rules = [Rule("low", F.col("a") > 1), Rule("b", F.col("b").isNotNull())]
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y"), (3, None)], "a int, b string")
    found = apply_rules(df, rules).rejects
    assert rows(found) == [(1, None, ["low", "b"]), (3, None, ["b"]), (None, "y", ["low"])]
    executed = found._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in executed.splitlines() if "Filter " in line]
    assert tests and not any("array" in line for line in tests)
