import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer as Whole

from tierforge.llm.packing import Limits, Packer, Piece, op3_vector_packing, pack_documents, public_tokenizer

ODD = [
    "", " ", "  ", "   a", "a b", "a  b", "a   b", "a\nb", "a \nb", "a\n b", "a\n\n b", "a\n  b", " a ", "it's 's we'll", "x　y z",
    "12 345", "a\x1cb c", "a\x85 b", "é 😀 ß", "say <|endoftext|> twice <|endoftext|>", "tab\tb \t c", "end\n", "a !b ?! c.",
]


def reference_ids():
    whole = Whole.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, 0]


def test_tokenizer_equals_library():
    ids, encode = reference_ids(), public_tokenizer().encode
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "a", "Word", "é", "1", "!", "'s", "\t", "ß", "..."]
    for text in ODD + ["".join(rng.choice(parts) for _ in range(30)) for _ in range(500)]:
        assert np.frombuffer(encode(text), "<u4").tolist() == ids(text)[:-1], repr(text)


def check(rows, texts_by_id, limits=Limits()):
    ids = reference_ids()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts_by_id)
    for doc, found in pieces.items():
        want, at = np.array(ids(texts_by_id[doc]), dtype="<u4"), 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    padding = total = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(found) <= limits.segments
        assert at - len(found) <= limits.loss_tokens
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
        total += at
    return padding / total


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = op3_vector_packing(spark, "/root/testdata/sf0.001").collect()
    assert check(rows, {r.doc_id: r.text for r in docs.collect()}) == 0


def test_odd_texts_and_limits(spark):
    texts = {i: t for i, t in enumerate([None, *ODD, "long text " * 30000, *["w"] * 400])}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, start int")
    assert check(pack_documents(docs).collect(), texts) == 0
    tight = Limits(256, 5, 200)
    assert check(pack_documents(docs, limits=tight).collect(), texts, tight) == 0
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id long, text string").coalesce(1)
    assert sorted(r.length for r in pack_documents(twice).collect()) in ([1, 1, 2, 2], [2, 2, 2])


def test_dot_product_choice():
    packer = Packer(Limits(100, 10, 100))
    for n in (60, 55, 40, 30):
        packer.pool.append(Piece(n, 0, bytes(4 * n), n))
    first = packer._sequence()
    assert [p.doc for p in first] == [60, 40]
