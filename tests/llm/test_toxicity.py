import zlib

import numpy as np

from tierforge.llm import toxicity
from tierforge.llm.toxicity import (
    Network,
    Projections,
    Shape,
    char_grams,
    fit_network,
    op13_toxicity,
    windows_of,
    with_toxicity,
    words_of,
)

SMALL = Shape(window=5, stride=2, word=3, char=4, buckets=32, hidden=3, attention=2)


def network(seed=1):
    return Network(SMALL, {"a": 1, "bb": 2}, seed)


def test_words_and_windows():
    assert words_of(None) == words_of(" \n ") == []
    assert words_of('He said: "Idiot!" ... ÉTÉ') == ["he", "said", "idiot", "...", "été"]
    assert words_of("x" * 50) == ["x" * 24, "x" * 24, "xx"]
    for n in range(40):
        starts = windows_of(n, SMALL)
        assert set(range(n)) == {i for s in starts for i in range(s, min(n, s + 5))}
        assert all(b - a <= 2 for a, b in zip(starts, starts[1:], strict=False))


def test_grams_do_not_depend_on_neighbours():
    words = ["a", "été", "hello", "x", "日本語"]
    together, sizes = char_grams(words, 997)
    alone = [char_grams([w], 997)[0] for w in words]
    assert (together == np.concatenate(alone)).all() and sizes.tolist() == [len(a) for a in alone]
    # A word of n bytes has n + 2 - k + 1 grams of k bytes, its marks included.
    for word, own in zip(words, alone, strict=True):
        assert [(own[:, i] < 997).sum() for i in range(4)] == [max(0, len(word.encode()) + 3 - k) for k in toxicity._SIZES]


def loss(net, f, index, y):
    own = net.inputs(f)[1]
    there = index.T >= 0
    p = 1 / (1 + np.exp(-net.logits(own[np.where(there, index.T, 0)], there)))
    return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))


def test_gradients_equal_differences():
    net = network()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    f = net.features(["a", "bb", "ccc", "dd"])
    index = np.array([[0, 1, 2, 3, 0], [2, 2, 1, -1, -1], [3, -1, -1, -1, -1]])
    y = np.array([1.0, 0.0, 1.0])
    got = net.gradients(f, index, y)
    rng = np.random.default_rng(0)
    for name, value in net.weights.items():
        flat = value.reshape(-1)
        used = np.flatnonzero(got[name].reshape(-1))
        for at in rng.choice(used, min(6, len(used)), replace=False):
            before = flat[at]
            flat[at] = before + 1e-5
            up = loss(net, f, index, y)
            flat[at] = before - 1e-5
            down = loss(net, f, index, y)
            flat[at] = before
            assert abs((up - down) / 2e-5 - got[name].reshape(-1)[at]) < 2e-5, name


def test_windows_equal_one_at_a_time():
    net, rng = network(), np.random.default_rng(2)
    texts = [[str(rng.choice(["a", "bb", "ccc", "dd"])) for _ in range(n)] for n in (0, 1, 3, 4, 5, 6, 17, 40)]
    facts, start = net.windows(texts, Projections(net), block=3)
    for words, row, first in zip(texts, facts, start, strict=True):
        scores = {}
        for s in windows_of(len(words), SMALL).tolist():
            part = words[s : s + 5]
            gates = net.inputs(net.features(part))[1][:, None, :]
            scores[s] = float(net.logits(gates, None)[0])
        if not words:
            assert row[0] == -np.inf and net.probability(row[None])[0] == 0
            continue
        best = max(scores.values())
        assert np.allclose(row, [best, np.mean(list(scores.values())), np.log(len(scores))], atol=1e-5)
        assert abs(scores[int(first)] - best) < 1e-5
    # Words are forgotten and projected again.
    again = net.windows(texts, Projections(net, remembered=1))[0]
    assert np.allclose(again, facts, atol=1e-5)


def test_learns_words_and_parts_of_words():
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("aeioulmnrst"), 5)) for _ in range(300)]
    texts, y = [], []
    for n in range(1000):
        words = [str(w) for w in rng.choice(plain, rng.integers(3, 80))]
        if n % 4 == 0:
            words[rng.integers(len(words))] = "zwk" + str(rng.choice(plain))
        texts.append(words)
        y.append(float(n % 4 == 0))
    net = fit_network(texts[:800], np.array(y[:800]), Shape(window=8, stride=4), passes=4)
    found = net.probability(net.windows(texts[800:], Projections(net))[0]) >= 0.3
    assert np.mean(found == np.array(y[800:])) > 0.95


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op13_toxicity(spark, sf).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    hit = [r.predicted for r in held if label[r.doc_id]]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.96 and np.mean(hit) > 0.8
    english = [r for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if "idiot" in (r.text or "").lower().split()]
    score = {r.doc_id: r.score for r in rows}
    assert np.mean([score[r.doc_id] >= 0.3 for r in english]) > 0.95


def test_odd_tables(spark, tmp_path):
    docs = [(1, "good text here", 0.1), (None, None, 0.2), (2, "", 0.3), (2, "x " * 100_000, 0.4), (3, "y" * 100_000, 0.5)]
    spark.createDataFrame(docs, "doc_id long, text string, score double").write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = op13_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == 5 and sorted(r.score for r in rows) == [0.0, 0.0, 0.5, 0.5, 0.5]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert with_toxicity(empty, fit_network([], np.zeros(0))).count() == 0
