import random
import re

from tierforge.llm.decontamination import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc, text in docs:
        words = words_of(text)
        for item, asked in items:
            own = words_of(asked)
            width = min(5, len(own))
            if not width:
                continue
            grams = lambda w: {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}  # noqa: E731, B023
            mine = grams(own)
            common = len(mine & grams(words))
            if common >= 0.8 * len(mine) - 1e-9:
                out.append((doc, item, len(mine), common))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcé1", k=rng.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 4, 5, 6, 12, 30, 40])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "!!!"), (3, items[3][1]), (None, items[7][1])]
    docs = [(0, None), (1, ""), (2, "?"), (None, items[10][1])]
    for i in range(80):
        inside = (rng.choice(items)[1] or "").split()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            if inside:
                inside[rng.randrange(len(inside))] = rng.choice(["X-Y", "zzz", ""])
        text = [word() for _ in range(rng.choice([0, 5, 400]))] + inside + [word() for _ in range(50)]
        docs.append((10 + i % 70, rng.choice([" ", "\n", ", "]).join(text).upper()))
    docs.append((500, "long " * 200000 + items[12][1]))
    docs_df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    items_df = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    want = brute(docs, items)
    for block in (4 << 20, 100):
        got = contamination(spark, docs_df, items_df, block_bytes=block).collect()
        assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got), key=str) == want
    assert len(want) > 40


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contamination(spark, docs, items.limit(0)).count() == 0
    assert contamination(spark, docs.limit(0), items).count() == 0
    assert contamination(spark, docs, items).count() == 1
