from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierforge.operators import (
    check_fk,
    dedupe_latest,
    fk_orphans,
    join_preaggregated,
    left_lookup,
    top_n,
    total,
    translate,
)

EARLY, LATE = datetime(2020, 1, 1), datetime(2020, 2, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_wins_null_loses_and_ties_are_decided(spark, rows):
    df = spark.createDataFrame(
        [
            ("two dates", EARLY, "x"),
            ("two dates", LATE, "a"),
            ("tie", LATE, "a"),
            ("tie", LATE, "b"),
            ("null", None, "z"),
            ("null", EARLY, "a"),
        ],
        "k string, t timestamp, v string",
    )
    expected = [("null", EARLY, "a"), ("tie", LATE, "b"), ("two dates", LATE, "a")]
    for parts in (1, 5):
        once = dedupe_latest(df.repartition(parts), "k", "t")
        assert once.columns == df.columns
        assert rows(once) == expected
        assert rows(dedupe_latest(once, "k", "t")) == expected


def test_composite_key(spark, rows):
    df = spark.createDataFrame([("o1", 1, EARLY), ("o1", 1, LATE), ("o1", 2, EARLY)], "o string, i int, t timestamp")
    assert rows(dedupe_latest(df, ["o", "i"], "t")) == [("o1", 1, LATE), ("o1", 2, EARLY)]


def test_columns_without_order_need_a_tie_break(spark):
    df = spark.sql("select 1 as k, 2 as t, map('a', 1) as m")
    with pytest.raises(ValueError, match="m"):
        dedupe_latest(df, "k", "t")
    assert dedupe_latest(df, "k", F.col("t").asc(), tie_break=[]).count() == 1


def test_ranking_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as t")
    text = plan(dedupe_latest(df, "k", "t"))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_lookup_keeps_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    dim = spark.createDataFrame([("a", "A", 0)], "k string, label string, other int")
    joined = left_lookup(df, dim, "k", ["label"])
    assert joined.columns == ["k", "v", "label"]
    assert rows(joined) == [("a", 1, "A"), ("b", 2, None), (None, 3, None)]


def test_small_lookup_is_broadcast_by_its_size_only(spark, tmp_path):
    spark.range(100).selectExpr("id as k", "id as label").write.parquet(str(tmp_path / "dim"))
    df, dim = spark.range(1000).selectExpr("id as k"), spark.read.parquet(str(tmp_path / "dim"))
    assert "BroadcastHashJoin" in plan(left_lookup(df, dim, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "BroadcastHashJoin" not in plan(left_lookup(df, dim, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_translation(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None), (4, " a ")], "i int, code string")
    dim = spark.createDataFrame([("a ", "A"), ("a", None), ("b", "B"), ("a", "AA ")], "code string, label string")
    out = translate(df, dim, "code", "label", "english")
    assert out.columns == ["i", "code", "english"]
    assert rows(out) == [(1, "a", "AA"), (2, "zz", "zz"), (3, None, None), (4, " a ", "AA")]
    bare = translate(df, dim, "code", "label", "english", fallback=False)
    assert rows(bare, "i", "english") == [(1, "AA"), (2, None), (3, None), (4, "AA")]


def test_preaggregated_join_counts_what_a_plain_join_counts(spark):
    orders = spark.createDataFrame([("o0",), ("o1",), ("o3",), (None,)], "order_id string")
    payments = spark.createDataFrame(
        [("o1", 1), ("o3", 1), ("o3", 2), ("o3", None), ("other", 5), (None, 9)], "order_id string, v int"
    )
    reduced = join_preaggregated(orders, payments, "order_id", {"s": total("v"), "n": F.count(F.lit(1))})
    assert reduced.count() == 4
    plain = orders.join(payments, "order_id", "left").groupBy("order_id").agg(
        F.sum("v").alias("s"), F.count("order_id").alias("n")
    )
    weights = reduced.withColumn("n", F.when(F.col("order_id").isNotNull(), F.coalesce("n", F.lit(1))).otherwise(0))
    assert {tuple(r) for r in weights.collect()} == {tuple(r) for r in plain.collect()}


def test_top_n_ties_go_by_key_with_null_last(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 1), ("c", 5), ("c", 1)], "k string, v int")
    best = top_n(df, "k", {"n": F.count(F.lit(1))}, "n", 3)
    assert [tuple(r) for r in best.collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert "TakeOrderedAndProject" in plan(best)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3))
        ),
        max_size=30,
    ),
    st.integers(1, 6),
)
def test_dedupe_against_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, "k int, t int, v int").repartition(parts)
    got = sorted(tuple(r) for r in dedupe_latest(df, "k", "t").collect())
    rank = lambda x: -1 if x is None else x
    best = {}
    for row in data:
        if row[0] not in best or tuple(map(rank, row)) > tuple(map(rank, best[row[0]])):
            best[row[0]] = row
    assert [tuple(map(rank, r)) for r in got] == [tuple(map(rank, best[k])) for k in sorted(best)]


@pytest.fixture
def skewed(spark, tmp_path):
    """A table in which one key and NULL hold a third of the rows each; small skew limits."""
    limits = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {name: spark.conf.get(name) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    path = str(tmp_path / "skewed")
    rows = spark.range(0, 60000, 1, 8).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then null else concat('k', id % 1000) end as k", "uuid() as v"
    )
    rows.write.parquet(path)
    yield spark.read.parquet(path)
    for name, value in before.items():
        spark.conf.set(name, value)


def splits_skew(df):
    """Whether the executed plan, after AQE, joins split partitions."""
    result = df.agg(F.max(F.xxhash64(*df.columns)))
    result.collect()
    return "Join(skew=true)" in plan(result)


@pytest.mark.parametrize("join", ["lookup", "fk", "orphans", "translate", "totals"])
def test_hot_left_keys_are_split(spark, skewed, join):
    dim = spark.range(0, 1000, 1, 8).selectExpr("concat('k', id) as k", "cast(id as string) as label").union(
        spark.sql("select 'hot', 'x'")
    )
    joined = {
        "lookup": lambda: left_lookup(skewed, dim, "k"),
        "fk": lambda: check_fk(skewed, dim.union(dim), "k"),
        "orphans": lambda: fk_orphans(skewed, dim.filter("k <> 'hot'"), "k"),
        "translate": lambda: translate(skewed, dim.union(dim), "k", "label", "out"),
        "totals": lambda: join_preaggregated(skewed, dim, "k", {"n": F.count(F.lit(1))}),
    }[join]()
    expected = 20000 if join == "orphans" else 60000
    assert joined.count() == expected
    assert splits_skew(joined)


def test_a_side_grouped_by_the_join_keys_cannot_be_split(spark, skewed):
    dim = spark.range(0, 1000, 1, 8).selectExpr("concat('k', id) as k")
    assert not splits_skew(join_preaggregated(skewed, dim, "k", {"n": F.count(F.lit(1))}, keys_repeat=False))


def test_compressed_files_are_not_broadcast_unmeasured(spark, tmp_path):
    """Files below the threshold whose rows are above it: the plan before the run joins by shuffle."""
    assert spark.conf.get("spark.sql.sources.fileCompressionFactor") == "4.0"
    path = str(tmp_path / "dim")
    spark.range(0, 300_000, 1, 1).selectExpr("id as k", "cast(id % 7 as string) as label").write.parquet(path)
    size = sum(file.stat().st_size for file in (tmp_path / "dim").iterdir())
    facts = spark.range(0, 5_000_000).selectExpr("id as k", "id as v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * size))
        assert "BroadcastHashJoin" not in plan(left_lookup(facts, spark.read.parquet(path), "k"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(8 * size))
        assert "BroadcastHashJoin" in plan(left_lookup(facts, spark.read.parquet(path), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
