"""Near-duplicates by SimHash, found by meet-in-the-middle ball hashing.

Fingerprints link at three or fewer differing bits. Every distinct fingerprint emits its
ball of half that radius, rounded down: itself and its 64 variants with one bit flipped.

* Two fingerprints at distance one or two have a variant in common, and any two that share
  a variant are that close. So each group of equal variants (65 members at most) is linked
  to its least member, with nothing to verify.
* At distance three one half of the word differs in one bit at most. So one half of some
  variant of the one fingerprint equals that half of the other. Variants are shuffled by
  their halves, met with the fingerprints themselves, and colliding pairs are verified.

Pairs that the first step has connected already are not looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.llm.common import ROW_KEY, keyed, stored, table
from tierforge.llm.components import connected_components

RADIUS = 3
SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """Majority bits of the XXH64 of every ``width``-word shingle; zero if there is no word."""
    # For bytes, split() and lower() know ASCII only: [\x20\x09-\x0D] and A-Z.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    number = max(1, len(words) - width + 1)
    last = ends[-number:]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, number, _BLOCK):
        stop = min(number, at + _BLOCK)
        pairs = zip(starts[at:stop].tolist(), last[at:stop].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > number, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").cast(pa.binary()).to_pylist()
        prints = np.array([fingerprint(text or b"") for text in texts], dtype=np.uint64).view(np.int64)
        columns = [c for c in batch.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in columns], pa.array(prints)], names=[*columns, "fp"]
        )


def _flips(value: Column, bits: range) -> Column:
    """``value`` and its variants with one of ``bits`` flipped."""
    masks = [0, *[(1 << bit) - (1 << 64 if bit == 63 else 0) for bit in bits]]
    return F.explode(F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]), lambda m: value.bitwiseXOR(m)))


def _near_links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints at distance one or two."""
    balls = prints.select("fp", _flips(F.col("fp"), range(64)).alias("variant"))
    met = balls.select("fp", F.min("fp").over(Window.partitionBy("variant")).alias("least"))
    return met.where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))


def _far_links(labelled: DataFrame) -> DataFrame:
    """Links between labels of fingerprints (``fp``, ``label``) at distance three, or less.

    Both sides are shuffled: Spark takes the variants for as many bytes as the fingerprints that they come from, and
    would broadcast 66 rows for each.
    """
    low, high = F.lit((1 << 32) - 1).cast("bigint"), F.lit(-(1 << 32)).cast("bigint")
    halves = ((low, range(32), 0), (high, range(32, 64), 1))

    def keys(flip: bool) -> DataFrame:
        parts = []
        for mask, bits, half in halves:
            value = F.col("fp").bitwiseAND(mask)
            key = _flips(value, bits) if flip else value
            parts.append(labelled.select("fp", "label", F.lit(half).alias("half"), key.alias("key")))
        return parts[0].unionByName(parts[1])

    one, other = keys(False).alias("one"), keys(True).alias("other")
    close = F.bit_count(F.col("one.fp").bitwiseXOR(F.col("other.fp"))) <= RADIUS
    on = [F.col(f"one.{c}") == F.col(f"other.{c}") for c in ("half", "key")]
    joined = one.join(other.hint("merge"), on[0] & on[1] & (F.col("one.label") != F.col("other.label")) & close)
    return joined.select(F.col("one.label").alias("a"), F.col("other.label").alias("b"))


def _relabel(labelled: DataFrame, links: DataFrame) -> DataFrame:
    found = stored(connected_components(links), "components")
    out = labelled.join(found.hint("merge"), labelled.label == found.node, "left")
    return out.select(*[c for c in labelled.columns if c != "label"], F.coalesce("component", "label").alias("label"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_key: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id that can be reached by links, the row itself included. Null and
    blank texts have fingerprint zero and link like any other. Rows that repeat a text or
    an id are rows of their own; a null id is in a component but never names it, unless it
    has no other. Other columns are ignored. An empty table gives no row. ``keep_key`` adds ``ROW_KEY``
    and ``kept``: true for one row of each component, that of the smallest id.

    All work after the fingerprints is on distinct ones, so copies cost nothing there. All tables grow with ``docs``,
    so no join broadcasts one, whatever its estimated size.
    """
    rows = keyed(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes if name != "__text")
    prints = stored(rows.mapInArrow(_fingerprints, f"{kinds}, fp bigint"), "fingerprints")

    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *ROW_KEY)
    nodes = stored(prints.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    labelled = nodes.withColumn("label", F.col("fp"))
    labelled = stored(_relabel(labelled, _near_links(nodes.select("fp"))), "labels")
    labelled = _relabel(labelled, _far_links(labelled.select("fp", "label")))

    labelled = stored(labelled, "labels")
    least = labelled.groupBy("label").agg(F.min("first").alias("least"))
    named = stored(labelled.select("fp", "label").join(least.hint("merge"), "label").select("fp", "least"), "named")
    out = prints.join(named.hint("merge"), "fp")
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least.doc_id").alias("component_id"),
        *([*ROW_KEY, (order == F.col("least")).alias("kept")] if keep_key else []),
    )


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
