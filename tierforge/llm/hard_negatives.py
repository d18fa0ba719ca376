"""Hard negatives from Hilbert-ordered blocks of vectors with zone maps.

Vectors are stored in blocks along a Hilbert curve through the dimensions of greatest spread. Each block
has a zone: the least and greatest value of every dimension, and its labels. Interval arithmetic
over a zone bounds the score of an anchor with every row of the block, from below and above, so that

* for its positives an anchor reads the blocks that hold its label and whose upper bound reaches the
  score of its last positive within its own block,
* for its negatives it reads the blocks whose bounds meet the window of one of its positives.

Anchors are taken in groups, so one block is multiplied with many anchors at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.llm.common import require, stored, table

AXES, BITS = 8, 7
# Sums of products below this are exact as doubles.
_EXACT = 1 << 53

_BLOCK = "block bigint, n int, ids binary, labels binary, marks binary, vectors binary, low binary, high binary"
_GROUP = "grp bigint, n int, keys binary, ids binary, labels binary, vectors binary, floors binary"
_ZONES = "zones bigint, blocks binary, low binary, high binary, seen array<binary>, salt int"


class Mining(NamedTuple):
    """``window``: a negative's score times the second number lies from the first to the second times the positive's."""

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    window: tuple[int, int] = (80, 100)
    block_rows: int = 1024
    group_rows: int = 128


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of ``cells`` (unsigned, ``bits`` bits a column) on the Hilbert curve, by Gray-code rotations."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for shift in range(bits - 1, 0, -1):
        low = (1 << shift) - 1
        for axis in range(axes):
            swap = (x[axis] >> shift & 1) == 0
            moved = np.where(swap, (x[0] ^ x[axis]) & low, 0)
            x[0] ^= np.where(swap, moved, low)
            x[axis] ^= moved
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    for shift in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> shift & 1, (1 << shift) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.int64)
    for shift in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = key << 1 | (x[axis] >> shift & 1)
    return key


def _wide(column: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of a matrix; missing last components are zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _ints(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(data, dtype=kind)


def _matrix(data: bytes, rows: int, dims: int) -> np.ndarray:
    """Stored vectors as doubles, for exact products of whole numbers."""
    return _ints(data, np.int32).reshape(rows, dims).astype(float)


def _bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible product of each anchor with a vector of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class _Space(NamedTuple):
    dims: int
    rows: int
    anchors: int
    axes: list[int]
    start: list[float]
    step: list[float]


def _space(rows: DataFrame) -> _Space | None:
    """Number of dimensions, and the grid of the curve; ``None`` without rows. One row a dimension reaches the driver."""
    facts = rows.select(F.max(F.size("v")), F.count(F.lit(1)), F.count_if("marked"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if not facts[0]:
        return _Space(0, facts[1], facts[2], [], [], []) if facts[1] else None
    if (facts[3] or 0) >= 1 << 31 or (facts[3] or 0) ** 2 * facts[0] >= _EXACT:
        raise ValueError(f"components up to {facts[3]} in {facts[0]} dimensions: products are not exact")
    spread = (
        rows.select(F.posexplode("v").alias("axis", "x"))
        .groupBy("axis")
        .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread"))
        .orderBy(F.desc("spread"), "axis")
        .limit(AXES)
        .collect()
    )
    cells = 1 << BITS
    step = [max(6 * r.spread / cells, 1e-9) for r in spread]
    start = [r.mean - 3 * r.spread for r in spread]
    return _Space(facts[0], facts[1], facts[2], [r.axis for r in spread], start, step)


def _blocks(rows: DataFrame, space: _Space, block_rows: int) -> DataFrame:
    """The stored blocks: ``block_rows`` neighbours on the curve each, with their zone."""
    dims = space.dims

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _wide(batch.column("v"), dims)[:, space.axes]
            cells = np.clip((at - np.array(space.start)) / np.array(space.step), 0, (1 << BITS) - 1)
            key = hilbert_keys(cells.astype(np.int64)) if space.axes else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "curve"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[pa.RecordBatch] = []

        def block(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            part = part.combine_chunks()
            column = lambda name: part.column(name).combine_chunks()
            vectors = _wide(column("v"), dims).astype(np.int32)
            row = [
                number,
                part.num_rows,
                column("id").to_numpy().astype(np.int64).tobytes(),
                column("label").to_numpy().astype(np.int64).tobytes(),
                column("marked").to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                vectors.tobytes(),
                vectors.min(axis=0).tobytes() if dims else b"",
                vectors.max(axis=0).tobytes() if dims else b"",
            ]
            number += 1
            return _batch(_BLOCK, [row])

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= block_rows:
                whole = pa.Table.from_batches(waiting)
                full = whole.num_rows // block_rows * block_rows
                for at in range(0, full, block_rows):
                    yield block(whole.slice(at, block_rows))
                waiting = whole.slice(full).to_batches()
        if sum(b.num_rows for b in waiting):
            yield block(pa.Table.from_batches(waiting))

    placed = rows.mapInArrow(place, "id bigint, label bigint, marked boolean, v array<bigint>, curve bigint")
    parts = math.ceil(space.rows / (4 * block_rows))
    ordered = placed.repartitionByRange(parts, "curve", "id").sortWithinPartitions("curve", "id", "label", "v", "marked")
    return stored(ordered.drop("curve").mapInArrow(pack, _BLOCK), "blocks")


def _batch(schema: str, rows: list[list]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    names, types = zip(*[field.split() for field in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names)
    )


def _groups(blocks: DataFrame, space: _Space, how: Mining) -> DataFrame:
    """The anchors in groups of neighbours, stored. ``keys`` are block and row of each, ``floors`` the score that its last
    positive has at least, known from its own block."""
    dims = space.dims

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                marked = np.flatnonzero(_ints(row["marks"], np.uint8))
                if not len(marked):
                    continue
                ids, labels = _ints(row["ids"]), _ints(row["labels"])
                vectors = _matrix(row["vectors"], len(ids), dims)
                scores = vectors[marked] @ vectors.T
                other = labels != labels[marked, None]
                other[np.arange(len(marked)), marked] = True
                scores[other] = -np.inf
                floors = np.full(len(marked), -np.inf)
                if scores.shape[1] >= how.positives > 0:
                    floors = np.partition(scores, -how.positives, axis=1)[:, -how.positives]
                keys, raw = marked.tolist(), vectors[marked].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(keys), pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(ids[marked]),
                        pa.array(labels[marked]),
                        pa.array([v.tobytes() for v in raw], pa.binary()),
                        pa.array(floors),
                    ],
                    names=["block", "row", "id", "label", "v", "floor"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []

        def group(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            block, row, ids, labels, vectors, floors = zip(*rows, strict=True)
            number += 1
            packed = [np.array([block, row], dtype=np.int64), np.array(ids, np.int64), np.array(labels, np.int64)]
            packed = [p.tobytes() for p in packed] + [b"".join(vectors), np.array(floors, dtype=float).tobytes()]
            return _batch(_GROUP, [[number - 1, len(rows), *packed]])

        for batch in batches:
            waiting += zip(*[c.to_pylist() for c in batch.columns], strict=True)
            while len(waiting) >= how.group_rows:
                yield group(waiting[: how.group_rows])
                waiting = waiting[how.group_rows :]
        if waiting:
            yield group(waiting)

    seeds = blocks.select("block", "ids", "labels", "marks", "vectors").mapInArrow(
        seed, "block bigint, row bigint, id bigint, label bigint, v binary, floor double"
    )
    parts = max(1, math.ceil(space.anchors / (4 * how.group_rows)))
    ordered = seeds.repartitionByRange(parts, "block", "row").sortWithinPartitions("block", "row")
    return stored(ordered.mapInArrow(pack, _GROUP), "anchors")


def _zones(blocks: DataFrame, space: _Space, salts: int, per_row: int = 4096) -> DataFrame:
    """The zones of up to ``per_row`` blocks in a row, stored; the vectors themselves are not read."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []

        def row(zones: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            block, labels, low, high = zip(*zones, strict=True)
            seen = [np.stack(np.unique(_ints(x), return_counts=True)).astype(np.int64).tobytes() for x in labels]
            number += 1
            out = [number - 1, np.array(block, np.int64).tobytes(), b"".join(low), b"".join(high), seen, number % salts]
            return _batch(_ZONES, [out])

        for batch in batches:
            waiting += zip(*[c.to_pylist() for c in batch.columns], strict=True)
            while len(waiting) >= per_row:
                yield row(waiting[:per_row])
                waiting = waiting[per_row:]
        if waiting:
            yield row(waiting)

    return stored(blocks.select("block", "labels", "low", "high").mapInArrow(pack, _ZONES), "zones")


def _wanted(groups: DataFrame, zones: DataFrame, dims: int, how: Mining, windows: bool) -> DataFrame:
    """``grp``, ``block`` and ``members``, the anchors of the group that must read the block."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                blocks = _ints(row["blocks"])
                anchors = _matrix(row["vectors"], row["n"], dims)
                least, most = _bounds(anchors, _matrix(row["low"], len(blocks), dims), _matrix(row["high"], len(blocks), dims))
                labels = _ints(row["labels"])
                seen = [_ints(s).reshape(2, -1) for s in row["seen"]]
                if windows:
                    need = np.zeros(least.shape, dtype=bool)
                    for index, bottom, top in _windows(row["found"], how):
                        need[index] |= (most[index] >= bottom) & (least[index] <= top)
                    # A block all of whose rows have the anchor's label has no negative.
                    for number, (values, _) in enumerate(seen):
                        if len(values) == 1:
                            need[labels == values[0], number] = False
                else:
                    need = most >= _ints(row["floors"], float)[:, None]
                    for number, (values, _) in enumerate(seen):
                        need[:, number] &= np.isin(labels, values)
                chosen = np.flatnonzero(need.any(axis=0))
                members = [np.flatnonzero(need[:, c]).astype(np.int32).tobytes() for c in chosen]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["grp"]] * len(chosen), pa.int64()),
                        pa.array(blocks[chosen]),
                        pa.array(members, pa.binary()),
                    ],
                    names=["grp", "block", "members"],
                )

    # Every group meets every row of zones: each such row has one salt, each group all of them.
    salts = zones.agg(F.coalesce(F.max("salt") + 1, F.lit(1))).first()[0]
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = salted.join(zones.drop("zones"), "salt").drop("salt")
    return met.mapInArrow(choose, "grp bigint, block bigint, members binary")


def _windows(found: list[dict] | None, how: Mining) -> Iterator[tuple[int, int, int]]:
    """Index of the anchor, least and greatest score of a negative, for each of its positives."""
    share, whole = how.window
    for item in found or ():
        yield item["anchor"], -(-share * item["score"] // whole), item["score"]


def _by_place(found: list[dict] | None, members: np.ndarray, how: Mining) -> Iterator[tuple]:
    """For each place of a positive: the members that have one there, and the windows as columns."""
    index = {int(member): at for at, member in enumerate(members)}
    places: dict[int, list[tuple]] = {}
    for item, (anchor, least, most) in zip(found or (), _windows(found, how), strict=True):
        if anchor in index:
            places.setdefault(item["place"], []).append((index[anchor], least, most))
    for place, rows in places.items():
        at, least, most = np.array(rows, dtype=np.int64).T
        yield place, at, least[:, None], most[:, None]


_READ = "grp bigint, anchor int, place int, id bigint, score bigint, block bigint, row int"


def _best(scores: np.ndarray, allowed: np.ndarray, ranks: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``number`` allowed columns with the greatest score, ties by rank: row and column numbers."""
    count = scores.shape[1]
    width = min(number, count)
    key = np.where(allowed, scores.astype(np.int64) * count + (count - 1 - ranks), np.iinfo(np.int64).min)
    top = np.argpartition(key, count - width, axis=1)[:, count - width :] if width < count else np.tile(np.arange(count), (len(key), 1))
    rows = np.repeat(np.arange(len(key)), width)
    columns = top.ravel()
    real = allowed[rows, columns]
    return rows[real], columns[real]


def _read(wanted: DataFrame, groups: DataFrame, blocks: DataFrame, dims: int, how: Mining, windows: bool) -> DataFrame:
    """Each wanted block multiplied with the group's members; per anchor (and ``place`` of the positive) the best of the block."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                members = _ints(row["members"], np.int32)
                ids, labels = _ints(row["ids"]), _ints(row["labels"])
                own = _ints(row["own"])
                scores = _matrix(row["anchors"], len(own), dims)[members] @ _matrix(row["vectors"], len(ids), dims).T
                own = own[members]
                same = labels == own[:, None]
                ranks = np.empty(len(ids), dtype=np.int64)
                # Rows of a block lie in order of the curve; equal ids keep that order.
                ranks[np.argsort(ids, kind="stable")] = np.arange(len(ids))
                parts = []
                if windows:
                    for place, at, least, most in _by_place(row["found"], members, how):
                        part = scores[at]
                        allowed = ~same[at] & (part >= least) & (part <= most)
                        r, c = _best(part, allowed, ranks, how.negatives)
                        parts.append((members[at[r]], np.full(len(r), place), c, part[r, c]))
                else:
                    block, place = _ints(row["keys"]).reshape(2, -1)[:, members]
                    here = np.flatnonzero(block == row["block"])
                    same[here, place[here]] = False
                    floors = _ints(row["floors"], float)[members, None]
                    r, c = _best(scores, same & (scores >= floors), ranks, how.positives)
                    parts.append((members[r], np.zeros(len(r), np.int64), c, scores[r, c]))
                if not parts:
                    continue
                anchor, place, column, score = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(anchor), row["grp"], dtype=np.int64)),
                        pa.array(anchor.astype(np.int32)),
                        pa.array(place.astype(np.int32)),
                        pa.array(ids[column]),
                        pa.array(score.astype(np.int64)),
                        pa.array(np.full(len(anchor), row["block"], dtype=np.int64)),
                        pa.array(column.astype(np.int32)),
                    ],
                    names=[f.split()[0] for f in _READ.split(", ")],
                )

    own = [F.col("labels").alias("own"), F.col("vectors").alias("anchors")]
    payload = groups.select("grp", "keys", *own, "floors", *(["found"] if windows else []))
    met = wanted.join(payload, "grp").join(blocks.select("block", "ids", "labels", "vectors"), "block")
    return met.mapInArrow(multiply, _READ)


def _first(read: DataFrame, keys: list[str], number: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "block", "row")
    return read.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= number)


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine_hard_negatives(
    df: DataFrame,
    anchor: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    how: Mining = Mining(),  # noqa: B008
) -> DataFrame:
    """One row per anchor, positive and negative, ``RESULT``; ``anchor`` is true for the rows that are anchors.

    Components become whole numbers by ``how.scale``; a score is the exact inner product. Positives
    are the first other rows of the same label by score, ties by smaller id; negatives the first rows of other labels within
    the window of a positive's score. An anchor's positive without negatives has no row.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Vectors
    of different length count as filled up with zeros. Repeated rows are rows of their own, also those with an anchor's id;
    equal ids of equal score go by place on the curve. An empty table gives no row. Components so large that sums of
    their products are not exact raise a ``ValueError``.
    """
    require(df, [id_col, vector_col])
    spark = df.sparkSession
    label = F.col("label") if label is None else label
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("marked"),
        F.transform(vector_col, lambda x: x.cast("double")).alias("x"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.where(F.forall("x", finite))
    rows = rows.select("id", "label", "marked", F.transform("x", lambda x: F.floor(x * how.scale)).alias("v"))
    space = _space(rows)
    if space is None or not space.anchors:
        return spark.createDataFrame([], RESULT)

    blocks = _blocks(rows, space, how.block_rows)
    groups = _groups(blocks, space, how)
    zones = _zones(blocks, space, salts=max(1, math.ceil(space.rows / (4096 * how.block_rows))))

    wanted = _wanted(groups, zones, space.dims, how, windows=False)
    positives = _first(_read(wanted, groups, blocks, space.dims, how, False), ["grp", "anchor"], how.positives, "place")
    positives = stored(positives.select("grp", "anchor", "place", "id", "score"), "positives")
    # At most so many as a group has anchors, times their positives.
    found = positives.groupBy("grp").agg(F.collect_list(F.struct("anchor", "place", "score")).alias("found"))
    groups = stored(groups.join(found, "grp"), "windows")

    wanted = _wanted(groups, zones, space.dims, how, windows=True)
    negatives = _first(
        _read(wanted, groups, blocks, space.dims, how, True), ["grp", "anchor", "place"], how.negatives, "rank"
    ).select("grp", "anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _ints(row["ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), row["grp"])), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)],
                    names=["grp", "anchor", "anchor_id"],
                )

    named = groups.select("grp", "ids").mapInArrow(names, "grp bigint, anchor int, anchor_id bigint")
    own = positives.withColumnsRenamed({"id": "positive_id", "score": "positive_score"})
    joined = negatives.join(own, ["grp", "anchor", "place"]).join(named, ["grp", "anchor"])
    return joined.select(*[field.split()[0] for field in RESULT.split(", ")])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP11_SQL = """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM clean a JOIN clean b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
QUALIFY rank <= 5
"""
