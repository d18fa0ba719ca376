import zlib

import numpy as np
import pytest

from tierforge.llm import language_id
from tierforge.llm.language_id import DIMENSIONS, fit_language_model, gram_counts, language_of, op1_language_id

SF = "/root/testdata/sf0.001"


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Ünder thé Tree " * 500
    whole = gram_counts(text)
    monkeypatch.setattr(language_id, "_BLOCK", 97)
    assert (gram_counts(text) == whole).all()
    data = text.lower().encode()
    assert whole.sum() == 2 * (len(b" ".join(data.split())) + 2) - 3
    assert len(whole) == DIMENSIONS and gram_counts("").sum() == 1


def test_held_out_accuracy(spark):
    rows = op1_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_edges(spark):
    rows = [(1, "the cat sat on the mat and the dog", "en", "x"), (2, "die katze und der hund sind hier", "de", "x"),
            (3, None, "en", "x"), (4, "some text", None, "x"), (5, "", "de", "x"), (None, "the dog and the cat", "en", "x"),
            (1, "the cat sat on the mat and the dog", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = fit_language_model(docs)
    assert model.languages == ["de", "en"]
    asked = [("the dog",), (None,), ("",), ("123 !?",), ("и это другой язык",), ("der hund " * 200000,)]
    got = [r.f for r in spark.createDataFrame(asked, "text string").select(language_of(spark, model, "text").alias("f")).collect()]
    assert [g.lang for g in got[:4]] == ["en", "und", "und", "und"]
    assert [g.rejected for g in got] == [False, True, True, True, True, False] and got[5].lang == "de"


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = fit_language_model(docs)
    assert docs.select(language_of(spark, model, "text").alias("f")).first().f.lang == "und"
    with pytest.raises(Exception):
        fit_language_model(docs.drop("lang"))
