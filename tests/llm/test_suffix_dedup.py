import hashlib
import random
from collections import Counter

import pytest

from tierforge.llm import suffix_dedup
from tierforge.llm.induced import Store, repeated_windows
from tierforge.llm.suffix_dedup import repeated_passages, segments

SF = "/root/testdata/sf0.001"


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone, spans, end = bytearray(len(d)), 0, -1
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                spans += i > end
                gone[i : i + 200] = b"\1" * 200
                end = i + 200
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def noise(rng, n, letters="abcdefgh "):
    return "".join(rng.choices(letters, k=n))


def tricky(rng):
    """Shared passages with different surroundings, copies with edits, periods, bytes of zero, long runs."""
    passage, other = noise(rng, 900), noise(rng, 230)
    texts = [noise(rng, rng.randint(0, 400)) + passage[rng.randint(0, 300) : rng.randint(500, 900)] + noise(rng, rng.randint(0, 400)) for _ in range(25)]
    texts += [noise(rng, rng.randint(0, 90)) + other + noise(rng, 150) for _ in range(12)]
    base = noise(rng, 2500)
    for _ in range(12):
        at = rng.randrange(2500)
        texts.append(base[:at] + rng.choice(["", "X", "YY"]) + base[at + rng.randint(0, 2) :])
    texts += [base, base, None, "", "short", "ab" * 400, "a" * 777, "a" * 199, "a" * 200, "é" * 130, "\0" * 350 + noise(rng, 60), "x" + "\0" * 260]
    texts += [noise(rng, 199) + "q" + noise(rng, 199), noise(rng, 500) * 2]
    return texts


def test_segments_cover_each_window_once():
    rng = random.Random(3)
    for text in [noise(rng, 5000), "ab" * 1000, "z" * 450, noise(rng, 200)]:
        data = text.encode()
        at = 0
        for start, run, off, _, _ in segments(data):
            assert start == at and run > 0 and run - 1 <= off <= 168
            at += run
        assert at == len(data) - 199
    assert list(segments(b"a" * 199)) == []


@pytest.mark.parametrize("most_bytes", [0, 1 << 30])
def test_induced_sorting_finds_all_equal_windows(most_bytes):
    rng = random.Random(6)
    found = [(t.encode(), s) for t in tricky(rng) if t for s in segments(t.encode())]
    pieces = [d[s[0] : s[0] + s[1] + 199] for d, s in found]
    hits = repeated_windows(pieces, [s[2] for _, s in found], [s[1] for _, s in found], store=Store(most_bytes))
    seen = Counter(d[s[0] + w : s[0] + w + 200] for d, s in found for w in range(s[1]))
    for (d, s), intervals in zip(found, hits):
        got = {w for low, high in intervals for w in range(low, high)}
        assert got == {w for w in range(s[1]) if seen[d[s[0] + w : s[0] + w + 200]] > 1}


def rows_of(spark, texts, **options):
    docs = spark.createDataFrame([(i if i else None, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, start int, anchor int")
    return {r.doc_id or 0: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_passages(docs, **options).collect()}


def test_against_brute_force(spark):
    texts = tricky(random.Random(9))
    assert rows_of(spark, texts) == dict(enumerate(brute(texts)))


@pytest.mark.parametrize("most", [3, 12])
def test_hot_anchors_are_split_without_change(spark, most):
    texts = tricky(random.Random(12))
    assert rows_of(spark, texts, most_in_shard=most) == dict(enumerate(brute(texts)))


def test_blocks_change_nothing(spark, monkeypatch):
    texts = tricky(random.Random(10))[:30]
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 64)
    parts = list(segments(texts[0].encode()))
    assert all(run <= 64 for _, run, *_ in parts)
    data = [t.encode() for t in texts]
    found = [(d, s) for d in data for s in segments(d)]
    pieces = [d[s[0] : s[0] + s[1] + 199] for d, s in found]
    hits = repeated_windows(pieces, [s[2] for _, s in found], [s[1] for _, s in found])
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    for (d, s), intervals in zip(found, hits):
        assert {w for low, high in intervals for w in range(low, high)} == {w for w in range(s[1]) if seen[d[s[0] + w : s[0] + w + 200]] > 1}


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(zip(texts, brute(texts.values())))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_passages(docs).collect()}
    assert got == want and any(w[1] for w in want.values())


def test_empty_table(spark):
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
