import random
import re

import numpy as np
import pytest
import xxhash

from tierforge.llm import simhash
from tierforge.llm.components import connected_components
from tierforge.llm.simhash import fingerprint, near_duplicates


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_components(values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


TEXTS = [None, "", " \n\t", "one", "One two", "a b c", "A  B\nC d", "é É x y z", "x\x1cy z w", "a b a b a b a b", "w " * 70000 + "end"]


def test_fingerprint():
    rng = random.Random(1)
    for text in TEXTS + [" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 60))) for _ in range(50)]:
        assert fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_components_of_a_star(spark):
    """One node with nearly all links, in the middle of the order, and a tail."""
    edges = spark.range(0, 20000).selectExpr("if(id = 5000, 20001, 5000) as a", "id as b").where("a <> b")
    edges = edges.unionByName(spark.createDataFrame([(20002, 19999), (-3, -4)], "a long, b long"))
    got = connected_components(edges)
    assert sorted(map(tuple, got.groupBy("component").count().collect())) == [(-4, 2), (0, 20002)]
    assert got.select("node").distinct().count() == got.count()


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(25)] + [(7, 7), (-5, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("spread", [2, 3, 4])
def test_linking_against_brute_force(spark, spread, monkeypatch):
    """Planted fingerprints around few centres; texts hold the number that stands for each."""
    rng = np.random.default_rng(spread)
    values = []
    for centre in rng.integers(0, 2**63, 12, dtype=np.uint64):
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, spread + 1), replace=False)
            values.append(int(centre) ^ sum(1 << int(f) for f in flips))
    values += [0, 1 << 63, (1 << 64) - 1]
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    nodes = spark.createDataFrame([(v, v) for v in {v for _, v in signed}], "fp long, label long")
    near = simhash.stored(simhash._relabel(nodes, simhash._near_links(nodes.select("fp"))), "t")
    far = simhash._relabel(near, simhash._far_links(near))
    label = {r.fp: r.label for r in far.collect()}
    want = brute_components(values)
    for i, (_, v) in enumerate(signed):
        for j, (_, w) in enumerate(signed[:i]):
            assert (label[v] == label[w]) == (want[i] == want[j])


def test_nothing_is_broadcast(spark):
    """Stored tables are small as files, their variants are not; planned and run, joins are by shuffle."""
    prints = simhash.stored(spark.range(300).selectExpr("xxhash64(id) as fp", "xxhash64(id) as label"), "t")
    edges = simhash.stored(spark.range(300).selectExpr("id + 1 as a", "id as b"), "t")
    docs = spark.range(30).selectExpr("id as doc_id", "cast(id as string) as text")
    for df in (simhash._far_links(prints), simhash._relabel(prints, edges), near_duplicates(docs)):
        for _ in range(2):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
            df.collect()


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = TEXTS + [base, base + " tail", base.replace("w7 ", "z "), base, "unrelated words stand here"]
    rows = [(i + 10, t, 5, 1.0) for i, t in enumerate(texts)] + [(None, base, 0, 0.0), (3, base, 0, 0.0), (3, base, 0, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int, label double")
    got = near_duplicates(docs, keep_key=True).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(r[1]) for r in rows]
    group = brute_components(prints)
    least = {g: min(r[0] for r, h in zip(rows, group) if h == g and r[0] is not None) for g in set(group)}
    want = sorted((r[0] or -1, f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, group))
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == len(set(group)) and all(r.doc_id == r.component_id for r in got if r.kept)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
