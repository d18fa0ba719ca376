import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tierforge.llm.exact_dedup import exact_dedup, fresh_index, op4_exact_dedup

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture
def index(spark):
    made = fresh_index(spark, buckets=4)
    yield made
    made.drop_entry()


def digest(text):
    return hashlib.sha256(BLANKS.sub(" ", text or "").encode()).hexdigest()


def test_against_brute_force(spark, index):
    texts = ["a b", "a  b", "a\n\tb", " a b", None, "", "   ", "\x1ca", "é", "é", "long " * 100000, "a b"]
    rows = [(100 - i, t, "x") for i, t in enumerate(texts)] + [(None, "a b", "x"), (None, "only null", "x"), (7, "twice", "x"), (7, "twice", "x")]
    groups = defaultdict(list)
    for doc, text, _ in rows:
        groups[digest(text)].append(doc)
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string, keep_id string"), index).collect()
    assert len(got) == len(rows)
    kept = defaultdict(list)
    for r in got:
        ids = [d for d in groups[r.text_sha256] if d is not None]
        assert r.keep_id == (min(ids) if ids else None) and r.group_size == len(groups[r.text_sha256])
        if r.kept:
            kept[r.text_sha256].append(r.doc_id)
    assert {g: [min((d for d in ids if d is not None), default=None)] for g, ids in groups.items()} == kept


def test_new_data_against_the_index(spark, index):
    first = spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "b"), (2, "c"), (3, "c")], "doc_id long, text string")
    assert sorted((r.doc_id, r.kept) for r in exact_dedup(first, index).collect()) == [(5, True), (6, True)]
    for kept in (True, False):  # added twice, nothing changes but that nothing is new
        got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(second, index).collect())
        assert got == [(1, 6, 1, False), (2, 2, 2, kept), (3, 2, 2, False)]
    assert index.rows().count() == 3


def test_index_is_bucketed_and_not_shuffled(spark, index):
    exact_dedup(spark.createDataFrame([(5, "a")], "doc_id long, text string"), index)
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {index.name}").collect()}
    assert detail["Num Buckets"] == "4" and "digest" in detail["Sort Columns"]
    new = spark.createDataFrame([(bytes(32), 1)], "digest binary, keep_id long")
    plan = new.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "SortMergeJoin" in physical and physical.count("Exchange hashpartitioning") == 1


def test_rows_meet_their_groups_by_shuffle(spark, index):
    """Groups grow with the rows, however small their files are."""
    docs = spark.range(300).selectExpr("id as doc_id", "cast(id % 200 as string) as text")
    out = exact_dedup(docs, index)
    for _ in range(2):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert sum(r.kept for r in out.collect()) == 200


def test_empty_table(spark, index):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string"), index).count() == 0


def test_repeated_batch_keeps_its_rows(spark, index):
    first = spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "b"), (2, "c"), (3, "c"), (4, "d")], "doc_id long, text string")
    exact_dedup(first, index, batch="first").collect()
    expected = [(1, 6, 1, False), (2, 2, 2, True), (3, 2, 2, False), (4, 4, 1, True)]
    for parts in (1, 1, 2):  # the first result is lost, the batch is run again
        result = exact_dedup(second, index, batch="second", parts=parts)
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in result.collect()) == expected
    assert index.rows().count() == 4
    assert not any(r.kept for r in exact_dedup(second, index, batch="third").collect())


@pytest.mark.parametrize("parts", [2, 3])
def test_shares_meet_digests_of_earlier_ones(spark, index, monkeypatch, parts):
    rows = [(i, f"text {i % 7}") for i in range(40, 0, -1)] + [(None, "text 1"), (None, "null"), (9, "text 2"), (9, "text 2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    once = fresh_index(spark, buckets=4)
    whole = sorted(map(tuple, exact_dedup(docs, once).collect()), key=str)
    once.drop_entry()
    met = []
    add = type(index).add
    monkeypatch.setattr(
        type(index), "add", lambda self, groups, batch: (met.append(groups.join(self.rows(), "digest").count()), add(self, groups, batch))[1]
    )
    result = exact_dedup(docs, index, parts=parts)
    assert sorted(map(tuple, result.collect()), key=str) == whole
    assert "Aggregate" not in result._jdf.queryExecution().toString()  # the last join can be split
    assert len(met) == parts and met[0] == 0 and all(met[1:])


def test_index_without_batches_is_taken_over(spark, index):
    old = exact_dedup(spark.createDataFrame([(5, "a")], "doc_id long, text string"), fresh_index(spark, buckets=4))
    rows = old.select(F.unhex("text_sha256").alias("digest"), "keep_id").repartition(4, "digest")
    rows.write.bucketBy(4, "digest").sortBy("digest").option("path", index.path).saveAsTable(index.name)
    both = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in exact_dedup(both, index).collect()) == [(1, 5, False), (2, 2, True)]


def test_query_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert op4_exact_dedup(spark, str(tmp_path)).count() == 0
