"""Versioned tables and keep-latest merges into them."""

import os
import threading
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tierforge import plans
from tierforge.operators import dedupe_latest
from tierforge.sinks import current_version, merge_latest, read_version, vacuum_versions, write_version
from tierforge.sinks.versions import _commit_name


def files_of(path):
    found = {}
    for folder, _, names in os.walk(path):
        found |= {os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns for name in names}
    return found


def test_versions(spark, tmp_path, rows):
    base = str(tmp_path)
    assert current_version(spark, base, "t") is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, base, "t")
    assert write_version(spark.range(3).toDF("a"), base, "t") == 1
    first = read_version(spark, base, "t")
    # Reads from the version before it.
    assert write_version(first.withColumn("b", F.lit("x")), base, "t", partition_by=["b"]) == 2
    assert rows(first) == [(0,), (1,), (2,)]
    assert rows(read_version(spark, base, "t")) == [(0, "x"), (1, "x"), (2, "x")]
    assert rows(read_version(spark, base, "t", 1)) == rows(first)
    write_version(spark.createDataFrame([], "a long"), base, "t")
    assert read_version(spark, base, "t").count() == 0
    assert vacuum_versions(spark, base, "t", keep=2) == 1
    with pytest.raises(FileNotFoundError):
        read_version(spark, base, "t", 1)
    assert rows(read_version(spark, base, "t", 2)) == [(0, "x"), (1, "x"), (2, "x")]


def test_unfinished_commits_and_failed_writes(spark, tmp_path, rows):
    base = str(tmp_path)
    write_version(spark.range(2).toDF("a"), base, "t")
    # A writer that died while it wrote the commit file, and one that died before.
    (tmp_path / "t" / _commit_name(2)).write_text('{"number": 2, "fold')
    with pytest.raises(Exception, match="raise_error|no"):
        write_version(spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("a")), base, "t")
    assert rows(read_version(spark, base, "t")) == [(0,), (1,)]
    assert write_version(spark.range(1).toDF("a"), base, "t") == 3
    assert rows(read_version(spark, base, "t")) == [(0,)]
    vacuum_versions(spark, base, "t")
    assert [name for name in os.listdir(tmp_path / "t") if name.startswith("data-")] == [
        os.path.basename(current_version(spark, base, "t").folders[""])
    ]


def test_second_writer_of_a_version_fails(spark, tmp_path, monkeypatch, rows):
    from tierforge.sinks import versions

    write_version(spark.range(1).toDF("a"), str(tmp_path), "t")
    write_version(spark.range(2).toDF("a"), str(tmp_path), "t")
    monkeypatch.setattr(versions, "_next_number", lambda files: 2)
    with pytest.raises(RuntimeError, match="another writer"):
        write_version(spark.range(3).toDF("a"), str(tmp_path), "t")
    assert rows(read_version(spark, str(tmp_path), "t")) == [(0,), (1,)]


def test_readers_see_whole_versions(spark, tmp_path):
    base, seen, done = str(tmp_path), [], threading.Event()
    frame = lambda number: spark.range(0, 50, 1, 4).select(F.lit(number).alias("v"))
    write_version(frame(0), base, "t")

    def read():
        while not done.is_set():
            got = read_version(spark, base, "t").groupBy("v").count().collect()
            seen.append([tuple(row) for row in got])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for number in range(1, 21):
            write_version(frame(number), base, "t")
    finally:
        done.set()
        reader.join()
    assert len(seen) > 1
    assert all(len(groups) == 1 and groups[0][1] == 50 for groups in seen)
    versions = [groups[0][0] for groups in seen]
    assert versions == sorted(versions)


LINES = [
    ("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", 5, "x"), ("b", None, "z"), (None, 1, "n"), (None, 3, "n"),
    ("c", None, "x"), ("c", None, None), ("d", 1, "x"), ("d", 1, "x"), ("", 1, "e"),
]
SCHEMA = "k string, t int, v string"


def test_any_batches_in_any_order_give_the_table_of_one(spark, tmp_path, rows):
    whole = rows(dedupe_latest(spark.createDataFrame(LINES, SCHEMA), "k", "t"))
    batches = [LINES[::3], LINES[1::3], LINES[2::3], []]
    for number, order in enumerate([*permutations(batches[:3]), (LINES, [], LINES[:4], LINES[:4])]):
        for batch in order:
            merge_latest(spark.createDataFrame(batch, SCHEMA), str(tmp_path), f"t{number}", "k", "t", buckets=5)
        assert rows(read_version(spark, str(tmp_path), f"t{number}")) == whole


def test_only_touched_buckets_are_rewritten(spark, tmp_path, rows):
    base, table = str(tmp_path), str(tmp_path / "t")
    frame = lambda n, t: spark.range(n).select(F.col("id").alias("k"), F.lit(t).alias("t"))
    assert merge_latest(frame(1000, 1), base, "t", "k", "t", buckets=16) == 1
    before, first = files_of(table), current_version(spark, base, "t")
    assert merge_latest(frame(2, 2), base, "t", "k", "t", buckets=7) == 2
    second = current_version(spark, base, "t")
    changed = [name for name in first.folders if first.folders[name] != second.folders[name]]
    assert len(first.folders) == second.buckets == 16 and 1 <= len(changed) <= 2
    after = files_of(table)
    assert {name: after[name] for name in before} == before
    assert read_version(spark, base, "t").count() == 1000
    assert rows(read_version(spark, base, "t").where("t = 2")) == [(0, 2), (1, 2)]
    # What the rewritten buckets held, and the batch's own rows, which are merged elsewhere.
    assert vacuum_versions(spark, base, "t") == len(changed) + 1
    assert read_version(spark, base, "t").count() == 1000
    kept = files_of(table)
    untouched = [f for f in before if any(second.folders[b] + "/" in f for b in first.folders if b not in changed)]
    assert untouched and all(kept[name] == before[name] for name in untouched)


def test_merge_ranks_without_a_shuffle_of_its_own(spark, tmp_path, monkeypatch):
    from tierforge.sinks import versions

    plans_seen = []
    write = versions._bucketed
    monkeypatch.setattr(
        versions, "_bucketed", lambda df, path: (plans_seen.append(df._jdf.queryExecution().toString()), write(df, path))
    )
    for _ in range(2):
        merge_latest(spark.createDataFrame(LINES, SCHEMA), str(tmp_path), "t", "k", "t", buckets=4)
    executed = plans_seen[-1].partition("== Physical Plan ==")[2]
    assert executed.count("Exchange hashpartitioning") == 1


def test_other_columns_or_keys_are_refused(spark, tmp_path):
    merge_latest(spark.createDataFrame(LINES, SCHEMA), str(tmp_path), "t", "k", "t")
    with pytest.raises(ValueError, match="the batch"):
        merge_latest(spark.createDataFrame([("a", 1)], "k string, t int"), str(tmp_path), "t", "k", "t")
    with pytest.raises(ValueError, match="kept by k"):
        merge_latest(spark.createDataFrame(LINES, SCHEMA), str(tmp_path), "t", ["k", "v"], "t")


def test_silver_by_batches(spark, tmp_path, rows):
    moments = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"]
    schema = ", ".join(f"{name} string" for name in ["order_id", "customer_id", "order_status", *moments])
    day = lambda d: f"2018-01-{d:02d} 10:00:00"
    order = lambda key, bought, to: (key, f"c{key}", "delivered", day(bought), day(bought), day(to), day(to), day(9))
    lines = [order("1", 1, 5), order("1", 2, 12), order("2", 3, 4), order("2", 3, 5), ("3", *[None] * 7), order("4", 1, 2)]
    whole = plans.build_silver_orders(spark.createDataFrame(lines, schema))
    for batch in (lines[::2], lines[1::2], lines[:1]):
        plans.merge_silver(spark.createDataFrame(batch, schema), str(tmp_path), "silver_orders", buckets=3)
    merged = plans.read_merged_silver(spark, str(tmp_path), "silver_orders")
    assert merged.dtypes == whole.dtypes and rows(merged) == rows(whole) and whole.count() == 3
    with pytest.raises(ValueError, match="no keys"):
        plans.merge_silver(spark.createDataFrame(lines, schema), str(tmp_path), "silver_order_payments")


def test_a_batch_is_dealt_by_bucket_once(spark, tmp_path, monkeypatch):
    from tierforge.sinks import versions

    written, write = [], versions._bucketed
    monkeypatch.setattr(versions, "_bucketed", lambda df, path: (written.append(path), write(df, path)))
    for _ in range(3):
        merge_latest(spark.createDataFrame(LINES, SCHEMA), str(tmp_path), "t", "k", "t", buckets=4)
    assert len(written) == 3
