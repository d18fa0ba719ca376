"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.session import scratch_path

# Row identity: hash of the file's path and the row's number in the file.
ROW_KEY = ("__file", "__row")

# Operators through which a scan's rows stay rows of the file.
_ROWWISE = {"Project", "Filter", "LogicalRelation", "SubqueryAlias", "View"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _is_scan(df: DataFrame) -> bool:
    node = df._jdf.queryExecution().analyzed()
    while True:
        if node.getClass().getSimpleName() not in _ROWWISE:
            return False
        if node.children().isEmpty():
            return "HadoopFsRelation" in node.relation().getClass().getSimpleName()
        node = node.children().head()


def keyed(df: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` of ``df`` and ``ROW_KEY``, the same in every evaluation of the plan.

    Ids may be null or repeated, so rows are told apart by their place in their file.
    What is not a plain scan of files is written first.
    """
    source = df if _is_scan(df) else stored(df, "keyed")
    return source.select(
        *columns,
        F.xxhash64("_metadata.file_path").alias(ROW_KEY[0]),
        F.col("_metadata.row_index").alias(ROW_KEY[1]),
    )


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def hashed(*columns: str) -> Column:
    """Hash from 0 to 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def hash_share(share: float | Column) -> Column:
    """Bound below which about that share of the hashes lie."""
    share = F.least(F.lit(1.0), F.lit(share) if isinstance(share, float) else share)
    return (share * F.lit(float((1 << 63) - 1024))).cast("bigint")


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")


def bind(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


_BLOCK = 512


def running(values: Column, of, combine, start: Column, kind: str = "bigint") -> Column:
    """For each of ``values``, ``start`` combined with ``of`` all values before it; ``combine`` is associative.

    Array functions can only grow an array by copying it, so long arrays go by blocks, each from the total of those
    before it: the cost is in proportion to the length up to some ten million values.
    """

    def scan(items: Column, first: Column, part) -> Column:
        def step(acc: Column, item: Column) -> Column:
            return F.struct(combine(acc.reach, part(item)).alias("reach"), F.array_append(acc.out, acc.reach).alias("out"))

        state = F.struct(first.alias("reach"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(items, state, step, lambda acc: acc.out)

    # The last block is empty if the others hold all.
    begins = F.sequence(F.lit(0), F.size(values), F.lit(_BLOCK))
    blocks = F.transform(begins, lambda at: F.slice(values, at + 1, F.lit(_BLOCK)))
    totals = F.transform(blocks, lambda block: F.aggregate(block, start, lambda acc, item: combine(acc, of(item))))
    by_block = F.zip_with(blocks, scan(totals, start, lambda total: total), lambda block, first: scan(block, first, of))
    return F.when(F.size(values) <= _BLOCK, scan(values, start, of)).otherwise(F.flatten(by_block))


def located(text: Column, regex: Column, measure) -> Column:
    """Leftmost non-overlapping matches: array of ``start``, ``end``, ``text``.

    ``measure`` gives a text's length in the unit wanted. A match starts after all gaps and
    matches before it. Matches must not be empty.
    """
    gaps = F.call_function("split", text, regex)
    found = F.call_function("regexp_extract_all", text, regex, F.lit(0))
    # One gap follows the last match.
    pairs = F.filter(F.arrays_zip(found.alias("text"), gaps.alias("before")), lambda pair: pair.text.isNotNull())
    measured = F.transform(
        pairs,
        lambda p: F.struct(measure(p.before).alias("gap"), measure(p.text).alias("long"), p.text.alias("text")),
    )

    def placed(items: Column) -> Column:
        def span(item: Column, before: Column) -> Column:
            start = before + item.gap
            return F.struct(start.alias("start"), (start + item.long).alias("end"), item.text.alias("text"))

        before = running(items, lambda item: item.gap + item.long, lambda a, b: a + b, F.lit(0).cast("bigint"))
        return F.zip_with(items, before, span)

    return bind(measured, placed)
