import zlib

import numpy as np

from tierforge.llm import quality_rules
from tierforge.llm.quality_rules import STATISTICS, _holds, fit_rules, op9_quality_rules, statistics

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op9_quality_rules(spark, SF).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.9


def test_compiled_column_equals_model(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.6)).astype(float)
    model = fit_rules(x, y)
    assert 0 < len(model.rules) < 200
    margin = model.intercept + sum(w * _holds(rule, x) for rule, w in model.rules)
    want = 1 / (1 + np.exp(-margin))
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], ["i", *STATISTICS])
    got = {r.i: r.s for r in df.select("i", model.column().alias("s")).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want)
    assert np.mean((want > 0.5) == (y > 0)) > 0.97


def test_statistics_of_blocks(monkeypatch):
    text = ("Some words. MORE words | here!\n" * 300).encode()
    whole = statistics(text)
    monkeypatch.setattr(quality_rules, "_BLOCK", 64)
    assert np.allclose(statistics(text), whole)
    assert statistics(b"") == [0.0] * len(STATISTICS)
    assert dict(zip(STATISTICS, statistics(b"x" * 1000)))["word_length"] > 60


def test_odd_tables(spark, tmp_path):
    docs = [(1, "good text here", "a"), (None, None, "b"), (2, "", "c"), (2, "", "c")]
    spark.createDataFrame(docs, "doc_id long, text string, score string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = op9_quality_rules(spark, str(tmp_path)).collect()
    assert len(rows) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e/documents.parquet"))
    labels.write.parquet(str(tmp_path / "e/labels.parquet"))
    assert op9_quality_rules(spark, str(tmp_path / "e")).count() == 0
