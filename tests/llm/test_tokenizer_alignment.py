import hashlib
import random
from array import array
from bisect import bisect_left, bisect_right
from collections import defaultdict

import public_tokenizers as files
import pytest

from tierforge.llm.tokenizer_alignment import EDGE, align_tokenizers, op12_tokenizer_alignment, public_aligner

ODD = [" ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "▁", "é", "日本", "😀", "<|endoftext|>", "<s>", "<0x41>", "'s", "a", "the",
       "12", "!?", "\x00", "ñ", "Word", "é", "​", "ﬁ", "½"]


def whole(texts):
    """Tokens and their bytes by the libraries, whole texts at once."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=files.path("piece_bpe_32k.model"))
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {**{chr(c): c for c in signs}, **{chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in signs)}}

    def b_bytes(piece):
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()

    for text in texts:
        if not text:
            yield [], [], [], []
            continue
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        x = [bytes(signs[c] for c in first.id_to_token(i)) for i in a]
        y = [b_bytes(second.id_to_piece(i)) for i in b]
        same = b"".join(x) == b"".join(y) == (" " + text).encode()
        yield (a, x, b, y) if same else ([], [], [], [])


def ids(data):
    return array("I", data).tolist()


def ranges(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(texts):
    rows, holds = [], defaultdict(set)
    for number, (a, x, b, y) in enumerate(whole(texts)):
        p, q = ranges(x), ranges(y)
        stops = [s[1] for s in q]
        links = []
        for i, r in zip(a, p, strict=True):
            at = bisect_right(stops, r[0])
            while at < len(q) and q[at][0] < r[1]:
                links.append((i, b[at]))
                at += 1
        ends = sorted({r[1] for r in p} & {s[1] for s in q})
        parts = [["" for _ in ends], ["" for _ in ends]]
        for side, (tokens, at) in enumerate(((a, p), (b, q))):
            for i, r in zip(tokens, at, strict=True):
                group = bisect_left(ends, r[1])
                parts[side][group] += f",{i}" if parts[side][group] else str(i)
        groups = [f"{x}|{y}" for x, y in zip(*parts, strict=True)]
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
        for link in links:
            holds[link].add(number)
    most = defaultdict(int)
    for (i, _), held in holds.items():
        most[i] = max(most[i], len(held))
    return [
        (n_a, n_b, n_groups, len(links), sum(len(holds[k]) == most[k[0]] for k in links), sum(len(holds[k]) for k in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for n_a, n_b, n_groups, links, groups in rows
    ]


def odd_texts(number, seed=1):
    rng = random.Random(seed)
    words = ["hello", "world,", "straße", "naïve", "x1y2", "don't", "(a)", "supercalifragilistic", "ab-cd", "10.5", "Éé", "end."]
    out = []
    for _ in range(number):
        parts = [rng.choice(words) if rng.random() < 0.7 else rng.choice(ODD) for _ in range(rng.randint(1, 25))]
        out.append(rng.choice([" ", " ", ""]).join(parts))
    return out


def test_units_equal_whole_texts():
    own = public_aligner()
    texts = odd_texts(4000)
    for text, (a, _, b, _) in zip(texts, whole(texts), strict=True):
        found = own.document(text)
        assert (ids(found.a), ids(found.b)) == (a, b) if found.whole else not a, text


def test_fragments_are_a_monoid():
    own, rng = public_aligner(), random.Random(2)
    for text in odd_texts(150, 3):
        data = b" " + text.encode()
        want = own.document(text)
        cuts = sorted(rng.sample(range(len(data) + 1), min(len(data), 5)))
        parts = [own.fragment(data[a:b]) for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]
        parts = [EDGE, *parts, EDGE]
        while len(parts) > 1:  # in any order
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [own.join(parts[at], parts[at + 1])]
        got = parts[0].closed
        assert got.whole == want.whole and (not want.whole or got == want)


@pytest.mark.parametrize(("chunk_bytes", "frequent"), [(1 << 16, 1 << 16), (40, 7), (3, 0)])
def test_equals_brute_force(spark, chunk_bytes, frequent):
    texts = [None, "", " ", "x", "same text", "same text", "▁", "a ▁ b", "ab" * 400, "no cut " * 60, *odd_texts(60, 5)]
    ids = [None if n % 9 == 0 else n // 2 for n in range(len(texts))]
    rows = [(i, t, "x", 0) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string, n int")
    got = align_tokenizers(df, chunk_bytes=chunk_bytes, frequent=frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *row) for i, row in zip(ids, brute(texts), strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, *row) for r, row in zip(docs, brute([r.text for r in docs]), strict=True)}
    assert {tuple(r) for r in op12_tokenizer_alignment(spark, "/root/testdata/sf0.001").collect()} == want


def test_empty_table(spark):
    assert align_tokenizers(spark.createDataFrame([], "doc_id long, text string")).count() == 0
