import pytest
from pyspark.sql import functions as F

from tierforge.operators import (
    average,
    distinct_counts,
    frequencies,
    non_null_count,
    profile_table,
    rollup_report,
    row_count,
    share_where,
    summarize,
    total,
)
from tierforge.plans import output_check


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("a", 2.675, 1), ("a", None, 2), ("b", None, 3), (None, 1.0, 4)], "k string, v double, n int"
    )


def test_report_has_a_null_group_and_null_sums(sales):
    report = rollup_report(
        sales,
        "k",
        {"s": total("v", 2), "m": average("n", 1), "c": non_null_count("k")},
        [F.asc_nulls_last("k")],
    )
    assert [tuple(r) for r in report.collect()] == [("a", 2.68, 1.5, 1 + 1), ("b", None, 3.0, 1), (None, 1.0, 4.0, 0)]


def test_derived_key(sales, rows):
    report = rollup_report(sales, {"big": F.col("n") > 2}, {"c": F.count(F.lit(1))})
    assert rows(report) == [(False, 2), (True, 2)]


def test_counts_and_frequencies(sales, rows):
    assert rows(row_count(sales)) == [(4,)]
    assert rows(frequencies(sales, "k")) == [("a", 2), ("b", 1), (None, 1)]


def test_summary_is_typed_and_survives_no_rows(sales, rows):
    assert rows(summarize(sales, ["n", "v"])) == [("n", 1.0, 4.0, 2.5), ("v", 1.0, 2.675, 1.8375)]
    assert summarize(sales, ["n"], stats=["max"]).columns == ["column", "max_value"]
    assert rows(summarize(sales.limit(0), ["n"])) == [("n", None, None, None)]


def test_distinct_counts_null_as_a_value(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    assert rows(distinct_counts(df, ["k", "n"])) == [("k", 2, 1), ("n", 2, 2)]
    assert rows(distinct_counts(df, ["k", "n"], approx=True)) == [("k", 2, 1), ("n", 2, 2)]
    assert rows(distinct_counts(df.limit(0), ["k"])) == [("k", 0, 0)]


def test_share(spark, rows):
    df = spark.createDataFrame([(1,), (-1,), (None,), (5,)], "n int")
    assert rows(share_where(df, F.col("n") > 0)) == [(4, 2, 50.0)]
    assert rows(share_where(df.limit(0), F.col("n") > 0)) == [(0, 0, None)]


def test_profile(sales):
    lines = profile_table(
        sales,
        numeric=["n"],
        shares={"big": F.col("n") > 2},
        distinct=["k"],
        top={"k": 2},
        sums={"k": "v"},
    ).collect()
    got = {(r.metric, r.column, r.item): r.value for r in lines}
    assert len(got) == len(lines)
    assert got["rows", "", ""] == 4.0
    assert (got["min", "n", ""], got["max", "n", ""], got["mean", "n", ""]) == (1.0, 4.0, 2.5)
    assert (got["matching", "big", ""], got["percent", "big", ""]) == (2.0, 50.0)
    assert got["distinct", "k", ""] == 3.0
    assert {k[2]: v for k, v in got.items() if k[0] == "frequency"} == {"a": 2.0, "b": 1.0}
    assert got["sum", "v", "a"] == 2.675 and got["sum", "v", "b"] is None


def test_output_check(spark, tmp_path, rows):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    spark.createDataFrame([("a",), ("b",)], "k string").write.parquet(good)
    spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string").write.parquet(bad)
    report = output_check(
        spark,
        {
            "good": (good, ["k"]),
            "no_keys": (bad, []),
            "bad": (bad, ["k"]),
            "missing": (str(tmp_path / "missing"), ["k"]),
        },
    )
    assert rows(report) == [
        ("bad", True, 4, 2, 2, False),
        ("good", True, 2, 0, 0, True),
        ("missing", False, 0, 0, 0, False),
        ("no_keys", True, 4, 0, 0, True),
    ]
