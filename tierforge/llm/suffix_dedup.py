"""Removal of repeated 200-byte passages by distributed, external induced sorting.

Only suffixes that can share 200 bytes with another are sorted. Each window of 200 bytes has one anchor, the
least of its hashed 32-byte grams, the leftmost on ties; equal windows have equal anchors at the same place. Consecutive windows with
the same anchor are one segment.

1. Segments are counted by anchor. One that occurs alone holds no repeat.
2. Equal segments are repeats as a whole; one of them stays as a witness.
3. Where an anchor has different segments, they meet in one shard, and induced sorting with common-prefix
   values (``induced``) finds the windows that they share.
   An anchor with very many different segments, at the edge of a passage that a third of all documents
   share, is split by distance from the anchor first.
4. Intervals of repeated windows are united by document and cut out.

The three groupings combine map side or are joins that AQE can split; texts are read four times, and moved only by
the two joins that need them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import ROW_KEY, keyed, stored, table
from tierforge.llm.induced import LEAST, Store, repeated_windows

GRAM = 32
_GRAMS = LEAST - GRAM + 1  # in a window
_BLOCK = 1 << 19  # windows looked at together; a segment ends there
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ADD = np.uint64(0xD1B54A32D192ED03)
_PLACE = np.uint64((1 << 20) - 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at every place, from those of its halves."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    size = 1
    while size < GRAM:
        h = (h[:-size] ^ (h[:-size] >> np.uint64(31))) * _MIX + h[size:] * _ADD
        size *= 2
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def segments(data: bytes) -> Iterator[tuple[int, int, int, int, int]]:
    """``start``, number of windows, offset of the anchor, hashes of the anchor and of the whole segment."""
    digest = xxhash.xxh3_64_intdigest
    for at in range(0, len(data) - LEAST + 1, _BLOCK):
        part = data[at : at + _BLOCK + LEAST - 1]
        hashes = _gram_hashes(np.frombuffer(part, np.uint8))
        # Hash above, place below: the least one is the leftmost.
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while size * 2 <= _GRAMS:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < _GRAMS:
            least = np.minimum(least[: len(least) - (_GRAMS - size)], least[_GRAMS - size :])
        anchors = (least & _PLACE).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1])
        runs = np.diff(np.append(starts, len(anchors)))
        places = anchors[starts]
        keys = hashes[places]
        for s, run, p, key in zip(starts.tolist(), runs.tolist(), places.tolist(), keys.tolist(), strict=True):
            yield at + s, run, p - s, key, digest(part[s : s + run + LEAST - 1])


_SEGMENT = f"{ROW_KEY[0]} bigint, {ROW_KEY[1]} bigint, start int, run int, off int, anchor bigint, content bigint"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [batch.column(name).to_pylist() for name in ROW_KEY]
        for file, row, text in zip(*keys, batch.column("__text").cast(pa.binary()).to_pylist(), strict=True):
            if text is None or len(text) < LEAST:
                continue
            found = np.array(list(segments(text)), dtype=np.uint64).T
            count = found.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, file)), pa.array(np.full(count, row)), *[pa.array(c.astype(np.int32)) for c in found[:3]],
                 *[pa.array(c.view(np.int64)) for c in np.ascontiguousarray(found[3:])]],
                names=[*ROW_KEY, "start", "run", "off", "anchor", "content"],
            )


_WANTED = "array<struct<start:int,run:int,off:int,anchor:bigint,alone:boolean>>"
_CONTEXT = f"{ROW_KEY[0]} bigint, {ROW_KEY[1]} bigint, start int, run int, off int, anchor bigint, alone boolean, bytes binary"
_INTERVAL = f"{ROW_KEY[0]} bigint, {ROW_KEY[1]} bigint, low int, high int"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each document."""
    names = [c.split()[0] for c in _CONTEXT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
    for batch in batches:
        files, rows = (batch.column(name).to_pylist() for name in ROW_KEY)
        texts = batch.column("__text").cast(pa.binary()).to_pylist()
        for file, row, text, wanted in zip(files, rows, texts, batch.column("wanted").to_pylist(), strict=True):
            out = [
                (file, row, w["start"], w["run"], w["off"], w["anchor"], w["alone"], text[w["start"] : w["start"] + w["run"] + LEAST - 1])
                for w in wanted
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of shared windows, from contexts sorted by anchor; some anchors at a time."""
    pending: list[dict] = []
    size, together = 0, 4 << 20

    def solve() -> pa.RecordBatch:
        hits = repeated_windows([r["bytes"] for r in pending], [r["off"] for r in pending], [r["run"] for r in pending], store=Store())
        out = [
            (r[ROW_KEY[0]], r[ROW_KEY[1]], r["start"] + low, r["start"] + high)
            for r, found in zip(pending, hits, strict=True) if r["alone"] for low, high in found
        ]
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _INTERVAL.split(", ")]
        )

    for batch in batches:
        for row in batch.to_pylist():
            if size >= together and row["anchor"] != pending[-1]["anchor"]:
                yield solve()
                pending, size = [], 0
            pending.append(row)
            size += len(row["bytes"])
    if pending:
        yield solve()


def _united(windows: list[dict]) -> list[tuple[int, int]]:
    """Bytes covered by the windows that start in the intervals."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((w["low"], w["high"] + LEAST - 1) for w in windows):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _removed(kind: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column("__text").cast(pa.binary()).to_pylist()
            for text, windows in zip(texts, batch.column("windows").to_pylist(), strict=True):
                text, at, kept = text or b"", 0, []
                spans = _united(windows or [])
                for low, high in spans:
                    kept.append(text[at:low])
                    at = high
                kept = b"".join([*kept, text[at:]])
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(text), len(text) - len(kept), len(spans), digest, [{"start": a, "end": b} for a, b in spans]))
            columns = list(zip(*out, strict=True)) or [()] * 5
            spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), spans_kind]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    columns = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    return remove, f"doc_id {kind}, {columns}"


# Distances from the anchor lie in one cell of this width; halving it ends at single windows.
_WIDEST = 256


def _halves(rows: DataFrame, width: int) -> DataFrame:
    """Contexts split where the distance from the anchor passes a half of its cell.

    The new key holds the bytes that all windows of the half have in common, so equal windows keep equal keys.
    """
    half = width // 2
    high, low = F.col("off") + 1, F.col("off") - F.col("run") + 1  # distances of the windows, high exclusive
    cell = low - F.pmod(low, F.lit(width))
    sides = F.explode(F.array(cell, cell + half)).alias("side")
    parts = rows.select("*", high.alias("high"), low.alias("low"), sides)
    parts = parts.withColumns(
        {"lower": F.greatest("low", "side"), "upper": F.least("high", F.col("side") + half)}
    ).where("lower < upper")
    skipped = F.col("high") - F.col("upper")  # windows left out before
    core = F.substring("bytes", F.col("high") - F.col("side"), F.lit(LEAST - half + 1))
    taken = F.col("upper") - F.col("lower")
    return parts.select(
        *ROW_KEY,
        (F.col("start") + skipped).cast("int").alias("start"),
        taken.cast("int").alias("run"),
        (F.col("upper") - 1).cast("int").alias("off"),
        F.xxhash64("anchor", "side", core).alias("anchor"),
        "alone",
        F.substring("bytes", skipped + 1, taken + LEAST - 1).alias("bytes"),
    )


def _split_hot(contexts: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Contexts of which no more than ``most`` share an anchor, and the intervals found on the way.

    Anchors that more contexts share are split by distance, again and again; equal parts are counted map side and merged, parts
    without a partner are done. Parts of one window are equal or have no partner, so it ends.
    """
    names = [c.split()[0] for c in _CONTEXT.split(", ")]
    cold, found, width, rows = [], [], _WIDEST, contexts
    while True:
        hot = stored(rows.groupBy("anchor").count().where(F.col("count") > most).select("anchor"), "hot")
        if hot.isEmpty():
            cold.append(rows)
            break
        cold.append(rows.join(hot, "anchor", "left_anti").select(*names))
        parts = _halves(rows.join(hot, "anchor", "left_semi").select(*names), width)
        width //= 2
        parts = stored(parts.withColumn("content", F.xxhash64("off", "run", "bytes")), "parts")
        groups = parts.groupBy("anchor", "content").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct(*ROW_KEY, "start", "run", "off", "alone", "bytes")).alias("first"),
        )
        groups = stored(groups, "groups")
        equal = parts.where("alone").join(groups.where("n > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
        found.append(equal.select(*ROW_KEY, F.col("start").alias("low"), (F.col("start") + F.col("run")).alias("high")))
        mixed = groups.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor")
        left = groups.join(stored(mixed, "mixed"), "anchor", "left_semi")
        left = left.select("first.*", "anchor", (F.col("first.alone") & (F.col("n") == 1)).alias("single"))
        rows = stored(left.withColumn("alone", F.col("single")).select(*names), "rows")
    return reduce(DataFrame.unionByName, cold), found


def repeated_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_in_shard: int = 50_000
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans``.

    ``spans`` are the maximal runs of bytes (UTF-8) that lie in a 200-byte string which also starts
    anywhere else in the table, in the same document too; matches never cross documents. ``kept_sha256`` is
    of the other bytes. Null counts as empty; texts under 200 bytes lose nothing. Rows that repeat a text lose all of it, from
    200 bytes on. Ids may be null or repeat; other columns are ignored. An empty table gives no row.
    Anchors with more than ``most_in_shard`` different contexts are split first; the result is the same.
    """
    rows = keyed(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    texts = rows.select(*ROW_KEY, "__text")
    cut = texts.mapInArrow(_cut, _SEGMENT)

    per_anchor = cut.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("least"), F.max("content").alias("most")
    )
    # Written, so that the join below lies on two shuffles and a hot anchor can be split.
    several = stored(per_anchor.where("n > 1").select("anchor", (F.col("least") != F.col("most")).alias("mixed")), "anchors")
    met = stored(cut.join(several, "anchor"), "met")

    mixed = met.where("mixed")
    first = F.min(F.struct(*ROW_KEY, "start", "run", "off")).alias("first")
    kinds = stored(mixed.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), first), "kinds")
    equal = mixed.join(kinds.where("n > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
    whole = met.where("NOT mixed").unionByName(equal).select(
        *ROW_KEY, F.col("start").alias("low"), (F.col("start") + F.col("run")).alias("high")
    )

    wanted = kinds.select("first.*", "anchor", (F.col("n") == 1).alias("alone"))
    wanted = wanted.groupBy(*ROW_KEY).agg(
        F.collect_list(F.struct("start", "run", "off", "anchor", "alone")).alias("wanted")
    )
    contexts = stored(texts.join(wanted, list(ROW_KEY)).mapInArrow(_contexts, _CONTEXT), "contexts")
    cold, found = _split_hot(contexts, most_in_shard)
    shared = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_shared, _INTERVAL)

    windows = stored(reduce(DataFrame.unionByName, [whole, *found, shared]), "windows")
    by_row = windows.groupBy(*ROW_KEY).agg(F.collect_list(F.struct("low", "high")).alias("windows"))
    remove, schema = _removed(dict(rows.dtypes)["doc_id"])
    return rows.join(by_row, list(ROW_KEY), "left").select("doc_id", "__text", "windows").mapInArrow(remove, schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
