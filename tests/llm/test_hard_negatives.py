import numpy as np
import pytest
from pyspark.sql import functions as F

from tierforge.llm import hard_negatives
from tierforge.llm.hard_negatives import Mining, hilbert_keys, mine_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, block int"
SMALL = Mining(block_rows=8, group_rows=3)


def brute(rows, how=SMALL):
    """Anchors divisible by ten; ids must be unique."""
    rows = [(i, np.floor(how.scale * np.array(v, dtype=float)).astype(int), label) for i, v, label, *_ in rows
            if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)]
    dims = max((len(v) for _, v, _ in rows), default=0)
    rows = [(i, np.pad(v, (0, dims - len(v))), label) for i, v, label in rows]
    out = []
    for a, va, la in rows:
        if a % 10:
            continue
        scored = sorted((-int(va @ v), i, label) for i, v, label in rows if i != a)
        for minus, p, _ in [s for s in scored if s[2] == la][: how.positives]:
            low, high = how.window[0] * -minus, 100 * -minus
            inside = [(n, -s) for s, n, label in scored if label != la and low <= 100 * -s <= high]
            out += [(a, p, rank, n, -minus, s) for rank, (n, s) in enumerate(inside[: how.negatives], 1)]
    return sorted(out)


def mined(spark, rows, how=SMALL):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in mine_hard_negatives(df, F.col("vec_id") % 10 == 0, how=how).collect())


def vectors(rng, n, dims=5, centres=4, spread=0.05):
    middle = rng.normal(size=(centres, dims))
    own = rng.integers(0, centres, n)
    at = middle[own] + rng.normal(scale=spread, size=(n, dims))
    label = np.where(rng.random(n) < 0.6, own, rng.integers(0, centres, n))
    return [(i, v.tolist(), int(k), "s", 1) for i, (v, k) in enumerate(zip(at, label, strict=True))]


def test_curve_is_a_hilbert_curve():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(side**axes))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(3)
    anchors, block = rng.integers(-99, 99, (20, 6)), rng.integers(-99, 99, (30, 6))
    low, high = hard_negatives._bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = anchors @ block.T
    assert (low <= scores).all() and (scores <= high).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = vectors(rng, 160) + [(i + 1000, [0.5, 0.5, 0.0, 0.25, 0.0], i % 2, "t", 2) for i in range(60)]
    rows += [(2000, [1.0] * 5, None, "n", 0), (2010, None, 1, "n", 0), (2020, [1.0, None, 0.0, 0.0, 0.0], 1, "n", 0),
             (2030, [float("nan")] * 5, 1, "n", 0), (2040, [float("inf")] * 5, 1, "n", 0), (None, [1.0] * 5, 1, "n", 0),
             (2050, [0.0] * 5, 1, "n", 0), (2060, [-0.3] * 5, 2, "n", 0), (2070, [0.7, 0.1], 1, "n", 0), (2080, [], 1, "n", 0),
             (2090, [0.9] * 5, 77, "alone", 0)]
    want = brute(rows)
    assert len(want) > 200 and mined(spark, rows) == want


def test_zone_maps_leave_blocks_out(spark, monkeypatch):
    counted = []
    chosen = hard_negatives._wanted

    def wanted(groups, zones, dims, how, windows):
        out = chosen(groups, zones, dims, how, windows)
        counted.append((out.count(), groups.count() * sum(len(z.blocks) // 8 for z in zones.collect())))
        return out

    monkeypatch.setattr(hard_negatives, "_wanted", wanted)
    rows = vectors(np.random.default_rng(5), 600, dims=3, centres=12, spread=0.02)
    assert mined(spark, rows) == brute(rows)
    for read, of in counted:
        assert read < of / 2


def test_odd_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1, "", 0)]) == []  # no anchor
    assert mined(spark, [(0, [], 1, "", 0), (1, [], 1, "", 0), (2, [], 2, "", 0)]) == [(0, 1, 1, 2, 0, 0)]
    # Repeated rows: each copy of the anchor is an anchor, and a positive of the other.
    rows = [(0, [1.0], 1, "", 0)] * 2 + [(5, [0.9], 2, "", 0)]
    assert mined(spark, rows) == [(0, 0, 1, 5, 65536, 58880)] * 2
    with pytest.raises(ValueError, match="not exact"):
        mined(spark, [(0, [1e12], 1, "", 0), (1, [1.0], 1, "", 0)])
