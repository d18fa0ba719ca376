"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so their Jaccard similarity says nothing; what counts is the
share of an item's shingles that a document contains. Items are partitioned by their
number of shingles, ``n``. An item's sketch is its ``n - ceil(t * n) + 1`` least shingle hashes, for
containment ``t``: a document that contains ``t`` of the item misses fewer shingles than that, so it has
at least one of the sketch, whatever its length. Documents look their shingles up in the sketches, and each hit is
verified on the shingles themselves. No item is missed by chance.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import table

WIDTH = 5
THRESHOLD = 0.8
_BLOCK = 1 << 16
# A-Z become a-z; digits, letters and everything beyond ASCII are words, the rest is space.
_WORDS = bytes(
    ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def shingles(words: list[bytes], width: int) -> set[bytes]:
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def _hashes(words: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Hashes of every run of ``width`` words, in blocks."""
    if len(words) < width:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, last = (ends - lengths)[: len(words) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh3_64_intdigest
    for at in range(0, len(last), _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), last[at : at + _BLOCK].tolist(), strict=True)
        yield np.array([digest(joined[a:b]) for a, b in spans], dtype=np.uint64)


class Item(NamedTuple):
    id: int | None
    width: int
    shingles: frozenset[bytes]


class SketchIndex:
    """Sketches of a block of items; an item of fewer words than the width is one shingle."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float):
        self.threshold = threshold
        self.items: list[Item] = []
        # By size: partitions of items with the same shingle width, and in each the sketch length follows n.
        holders: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for number, text in items:
            words = words_of((text or "").encode())
            if not words:
                continue
            width = min(WIDTH, len(words))
            item = Item(number, width, frozenset(shingles(words, width)))
            n = len(item.shingles)
            for key in sorted(map(xxhash.xxh3_64_intdigest, item.shingles))[: n - math.ceil(threshold * n - 1e-9) + 1]:
                holders[width][key].append(len(self.items))
            self.items.append(item)
        self.sketches = {
            width: (np.array(sorted(keys), dtype=np.uint64), dict(keys)) for width, keys in holders.items()
        }

    def search(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """Id, number of shingles and number found of every item that the text contains."""
        if not text:
            return []
        words = words_of(text.encode())
        candidates: set[int] = set()
        for width, (keys, holders) in self.sketches.items():
            for hashes in _hashes(words, width):
                place = np.searchsorted(keys, hashes)
                place[place == len(keys)] = 0
                for hit in np.unique(hashes[keys[place] == hashes]).tolist():
                    candidates.update(holders[hit])
        own: dict[int, set[bytes]] = {}
        found = []
        for item in (self.items[i] for i in sorted(candidates)):
            if item.width not in own:
                own[item.width] = shingles(words, item.width)
            common = len(item.shingles & own[item.width])
            if common >= self.threshold * len(item.shingles) - 1e-9:
                found.append((item.id, len(item.shingles), common))
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``most_bytes`` of text, or one item."""
    block, size = [], 0
    for row in benchmark.select(F.col(id_col), F.col(text_col)).toLocalIterator():
        length = len((row[1] or "").encode())
        if block and size + length > most_bytes:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += length
    if block:
        yield block


def _searcher(shared, kind: str):
    """Function of a text column that searches one block; each Python worker builds the index once per task."""
    built: list[SketchIndex] = []

    @F.pandas_udf(f"array<struct<item_id:{kind},n_shingles:bigint,n_found:bigint>>")
    def search(texts: pd.Series) -> pd.Series:
        if not built:
            built.append(SketchIndex(*shared.value))
        fields = ("item_id", "n_shingles", "n_found")
        return pd.Series([[dict(zip(fields, hit, strict=True)) for hit in built[0].search(t)] for t in texts], dtype=object)

    return search


def contained_items(
    spark: SparkSession,
    benchmark: DataFrame,
    text: str | Column,
    *,
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    block_bytes: int = 4 << 20,
) -> list[Column]:
    """Columns, one for each block of items: array of ``item_id``, ``n_shingles``, ``n_found`` of the items a text contains.

    Items are a query set against all rows, in blocks of ``block_bytes`` of text: that bounds what is broadcast and held,
    and with more items than fit one block each document is searched once for each. Items without
    words, and null texts, match nothing; items with the same id or text are items of their own.
    """
    kind = dict(benchmark.dtypes)[item_col]
    columns = []
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast((block, threshold))
        columns.append(_searcher(shared, kind)(text))
    return columns


def contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per contaminated document and item: ``doc_id``, ``item_id``, ``n_shingles``, ``n_found``, ``containment``.

    Words are runs of letters, digits and whatever is beyond ASCII, with A-Z lower-cased;
    shingles are sets of runs of five words. Rows of ``docs`` that repeat give rows
    that repeat; a null id stays null. Empty tables give no row. Nothing is shuffled.
    """
    columns = contained_items(spark, benchmark, text_col, **options)
    none = F.array().cast("array<struct<item_id:bigint,n_shingles:bigint,n_found:bigint>>")
    hits = F.concat(*columns) if columns else none
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(hits).alias("hit"))
    return found.select(
        "doc_id", "hit.item_id", "hit.n_shingles", "hit.n_found", (F.col("hit.n_found") / F.col("hit.n_shingles")).alias("containment")
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH words AS (
  SELECT 0 AS kind, item_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  UNION ALL
  SELECT 1, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM documents
), widths AS (SELECT DISTINCT least(5, len(w)) AS width FROM words WHERE kind = 0 AND len(w) > 0),
grams AS (
  SELECT DISTINCT kind, id, width, array_to_string(w[i:i + width - 1], ' ') AS gram
  FROM (SELECT kind, id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i FROM words, widths
        WHERE len(w) >= width AND (kind = 1 OR width = least(5, len(w))))
), sizes AS (SELECT id, count(*) AS n FROM grams WHERE kind = 0 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(s.n) AS n_shingles, count(*) AS n_found,
       count(*) / any_value(s.n) AS containment
FROM grams b JOIN grams d ON b.kind = 0 AND d.kind = 1 AND b.width = d.width AND b.gram = d.gram
JOIN sizes s ON s.id = b.id
GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(s.n) - 1e-9
"""
