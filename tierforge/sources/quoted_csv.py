"""CSV files with line breaks in quoted fields, read in splits.

Whether a physical line begins inside a quoted field is the parity of the quotes before it. Each split
is measured by itself, whatever its start state; a prefix pass over the splits of a file, one row each, gives the
start states, and only then are lines joined to records. Lines that are a record of their own stay where they
are; only the lines of longer records are shuffled.

Parity tells the state as long as quotes stand only around whole fields, and doubled inside them. Every line is tested
for that in its true state; a file with any other line is left to Spark's own reader, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

_QUOTED = "\u0001"

def _in_block() -> WindowSpec:
    return Window.partitionBy("file", "block").orderBy("id")


def _earlier_blocks() -> WindowSpec:
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _physical(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    value = F.col("value")
    first = (F.col("block") == 0) & value.startswith("﻿")
    return (
        spark.read.text(list(paths), lineSep="\n")
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        )
        .withColumn("value", F.when(first, F.substr(value, F.lit(2))).otherwise(value))
        .withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    )


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file``, ``block``, ``place`` in it, ``value``, ``before`` and ``after``: inside quotes (1) or not (0).

    ``returns`` tells whether lines of the file end with a carriage return and a line break, ``open`` whether the file leaves a quote open.
    """
    physical = _physical(spark, paths)
    blocks = physical.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("parity"), F.min_by(F.col("value").endswith("\r"), "id").alias("returns")
    )
    # The first line break of a file, quoted or not, tells whether a return before a line break belongs to it.
    returns = F.first("returns").over(Window.partitionBy("file").orderBy("block"))
    earlier = F.coalesce(F.sum("parity").over(_earlier_blocks()), F.lit(0)) % 2
    open_ = F.sum("parity").over(Window.partitionBy("file")) % 2 == 1
    blocks = blocks.select("file", "block", returns.alias("returns"), earlier.alias("opens"), open_.alias("open"))
    placed = physical.join(blocks, ["file", "block"])
    sum_before = F.sum("quotes").over(_in_block().rowsBetween(Window.unboundedPreceding, -1))
    before = (F.col("opens") + F.coalesce(sum_before, F.lit(0))) % 2
    lines = placed.withColumns({"place": F.row_number().over(_in_block()), "before": before})
    lines = lines.withColumn("after", (F.col("before") + F.col("quotes")) % 2)
    return lines.drop("quotes", "opens")


def _regular(value: Column, before: Column, after: Column) -> Column:
    """Whether quotes stand only around whole fields, given the state; a line that begins inside has its opening quote put back."""
    body = F.when(before == 1, F.concat(F.lit('"'), value)).otherwise(value)
    # Pairs of quotes become one sign; two in a row are a doubled quote. What is left is a field still open.
    collapsed = F.regexp_replace(body, '"[^"]*"', _QUOTED)
    head = F.regexp_extract(collapsed, '^[^"]*', 0)
    well = ~head.rlike(f"[^,{_QUOTED}]{_QUOTED}|{_QUOTED}[^,{_QUOTED}]") & ~value.contains(_QUOTED)
    return well & ((after == 0) | (head == "") | head.endswith(",") | head.endswith(_QUOTED))


def _without_return(text: Column) -> Column:
    return F.when(F.col("returns"), F.regexp_replace(text, r"\r\z", "")).otherwise(text)


def regular_files(spark: SparkSession, paths: Sequence[str]) -> dict[str, bool]:
    """The files at ``paths`` that are not empty, and whether they can be read in splits; one row a file reaches the driver.

    Not regular are files with a line that is not regular, with a quote left open at the end, or whose first line is
    blank or has a carriage return elsewhere than at its end.
    """
    if not paths:
        return {}
    lines = _lines(spark, paths)
    value = _without_return(F.col("value"))
    first = (F.col("block") == 0) & (F.col("place") == 1)
    facts = lines.groupBy("file").agg(
        F.bool_or(~_regular(value, F.col("before"), F.col("after"))).alias("odd"),
        F.bool_or(first & ((F.trim(value) == "") | value.contains("\r"))).alias("odd_header"),
        F.bool_or("open").alias("open"),
    )
    judged = facts.selectExpr("file", "NOT (odd OR odd_header OR open) AS regular")
    return {unquote(row.file): row.regular for row in judged.orderBy("file").collect()}


def read_quoted_splits(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    corrupt_column: str | None,
    file_column: str | None = None,
) -> DataFrame:
    """The records of regular files with a header, all columns text; as with Spark's ``multiLine``, but split.

    A record that goes over several lines, or several splits, is put together by the place of its first line.
    """
    lines = _lines(spark, paths)
    single = lines.where("before = 0 AND after = 0").where("NOT (block = 0 AND place = 1)").select("file", "value", "returns")

    pieces = lines.where("before = 1 OR after = 1")
    so_far = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.max(F.when(F.col("before") == 0, F.col("place"))).over(so_far)
    # What a split begins with belongs to the last record that was begun in the splits before it.
    # Of every split, as each has a line; those where no longer record begins carry what came before them.
    last = lines.groupBy("file", "block").agg(F.max(F.when(F.expr("before = 0 AND after = 1"), F.col("place"))).alias("last"))
    carried = F.max(F.when(F.col("last").isNotNull(), F.struct("block", "last"))).over(_earlier_blocks())
    carried = last.select("file", "block", carried.alias("carried"))
    pieces = pieces.withColumn("own", own).join(carried, ["file", "block"])
    began = F.when(F.col("own").isNotNull(), F.struct("block", F.col("own").alias("last"))).otherwise(F.col("carried"))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = pieces.groupBy("file", "returns", began.alias("began"))
    joined = joined.agg(F.array_join(F.transform(parts, lambda p: p.value), "\n").alias("value"))
    joined = joined.where("NOT (began.block = 0 AND began.last = 1)").select("file", "value", "returns")

    records = single.unionAll(joined).withColumn("value", _without_return(F.col("value"))).where("value <> ''")
    # Spark's reader takes the line break of the file for a line feed within quotes, too.
    text = F.when(F.col("returns"), F.replace("value", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))
    options = {"multiLine": "true", "lineSep": "\n", "escape": '"'}
    wanted = [*names] if corrupt_column is None else [*names, corrupt_column]
    if corrupt_column is not None:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    quoted = [f"`{name.replace('`', '``')}`" for name in wanted]
    parsed = records.select("file", "value", F.from_csv(text, ", ".join(f"{name} string" for name in quoted), options).alias("record"))
    columns = [F.col(f"record.{name}") for name in quoted]
    if corrupt_column is not None:
        columns[-1] = F.when(columns[-1].isNotNull(), F.col("value")).alias(corrupt_column)
    return parsed.select(*columns, *([] if file_column is None else [F.col("file").alias(file_column)]))
