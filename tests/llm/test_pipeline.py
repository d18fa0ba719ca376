import re
import zlib

import corpus_pipeline
from tierforge.llm.decontamination import THRESHOLD, shingles, words_of
from tierforge.llm.language_id import fit_language_model
from tierforge.llm.packing import public_tokenizer
from tierforge.llm.simhash import RADIUS, fingerprint

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir):
    """What every stage returns, each run on the stored rows of the last."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def brute_keep(docs, items, model):
    """The ids that each filtering stage keeps, in plain Python."""
    kept = {d.doc_id: d.text for d in docs if not model.predict(d.text)[2]}
    steps = [set(kept)]

    seen = set()
    for doc in sorted(kept):
        text = re.sub("[\\x20\\x09-\\x0D]+", " ", kept[doc])
        if text in seen:
            del kept[doc]
        seen.add(text)
    steps.append(set(kept))

    ids = sorted(kept)
    prints = {i: fingerprint(kept[i].encode()) for i in ids}
    group = {}
    for i in ids:
        if i in group:
            continue
        front, group[i] = [i], i
        while front:
            a = front.pop()
            for b in ids:
                if b not in group and (prints[a] ^ prints[b]).bit_count() <= RADIUS:
                    group[b] = i
                    front.append(b)
    kept = {i: kept[i] for i in ids if group[i] == i}
    steps.append(set(kept))

    def leaks(text):
        words = words_of(text.encode())
        for item in items:
            own = words_of(item.encode())
            width = min(5, len(own))
            mine = shingles(own, width)
            if len(mine & shingles(words, width)) >= THRESHOLD * len(mine) - 1e-9:
                return True
        return False

    kept = {i: t for i, t in kept.items() if not leaks(t)}
    steps.append(set(kept))
    return steps, kept


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    learned = docs.where(~(corpus_pipeline.remainder("doc_id", 4) == 2))
    steps, kept = brute_keep(docs.collect(), items, fit_language_model(learned))
    found = stages(spark, docs, SF)
    for stage, want in zip(found[:-1], steps):
        assert stage.columns == list(corpus_pipeline.COLUMNS)
        rows = stage.select("doc_id").collect()
        assert {r.doc_id for r in rows} == want and len(rows) == len(want)
    assert len(steps[0]) > len(steps[-1]) > 0.5 * docs.count()
    encode = public_tokenizer().encode
    tokens = {}
    for r in found[-1].collect():
        ids = encode(kept[r.doc_id]) + bytes(4)
        assert r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)])
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {i: len(encode(t)) // 4 + 1 for i, t in kept.items()}
    total = corpus_pipeline.run(spark, SF).agg({"length": "sum"}).first()[0]
    assert total == sum(tokens.values())


def test_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and ids, columns with clashing names."""
    rows = [(1, "the dog and the cat are here", "en", "s", 5, "x"), (1, "the dog and the cat are here", "en", "s", 5, "x"),
            (None, "the dog and the cat are here", "en", None, None, "x"), (2, None, "en", "s", 0, "x"), (3, "", None, "s", 0, "x"),
            (None, "a cat was not at home then", "en", "s", 1, None), (4, "leaked words of one test stand here", "en", "s", 1, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "leaked words of one test stand"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = stages(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    listed = [sorted(((r.doc_id, r.text) for r in s.collect()), key=str) for s in found[:-1]]
    assert [len(x) for x in listed] == [5, 3, 3, 2]
    assert listed[-1] == [(1, rows[0][1]), (None, rows[5][1])]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
