"""CSV landing: every column text, nothing repaired, nothing lost silently."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierforge.sources.quoted_csv import regular_files, read_quoted_splits

CORRUPT = "_corrupt_record"

_QUOTED = "\u0001"


def _simple_line(line: Column, escape: str) -> Column:
    """True where a physical line is certainly one complete record.

    Each field must be free of quotes or be quoted as a whole. A quoted text that is
    still open at the line's end, a quote inside a bare field, a lone carriage return
    or a line of blanks only (which line mode would skip) makes the line doubtful.
    """
    body = F.regexp_replace(line, r"\r\z", "")
    plain = ~body.contains('"') & ~body.contains("\r")
    if escape == '"':
        collapsed = F.regexp_replace(body, '"[^"\\r]*"', _QUOTED)
        whole_fields = ~collapsed.rlike(f"[\"\\r]|[^,{_QUOTED}]{_QUOTED}|{_QUOTED}[^,{_QUOTED}]")
        plain = plain | (~body.contains(_QUOTED) & whole_fields)
    only_blanks = (F.length(body) > 0) & (F.length(F.trim(body)) == 0)
    # Most lines have none of these signs and need no pattern; the rest is evaluated for the others only.
    bare = ~line.contains('"') & ~line.contains("\r") & ~line.startswith(" ")
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    simple = F.when(bare, True)
    if escape == '"':
        # Texts that are empty, not missing, stand as two quotes; two rounds find those that stand side by side, too.
        fields = F.concat(F.lit(","), line, F.lit(","))
        for _ in range(2):
            fields = F.replace(fields, F.lit(',"",'), F.lit(",,"))
        simple = simple.when(~fields.contains('"') & ~line.contains("\r") & ~line.startswith(" "), True)
    return simple.when(odd, False).otherwise(plain & ~only_blanks)


def has_record_per_line(spark: SparkSession, path: str | Sequence[str], escape: str = '"') -> bool:
    """Whether splitting the files at line breaks cannot change what is read.

    One pass over the text in parallel splits, which ends at the first doubtful line.
    """
    lines = spark.read.text(path, lineSep="\n")
    return lines.filter(~_simple_line(F.col("value"), escape)).isEmpty()


class _File(NamedTuple):
    path: str
    header: str
    doubtful: bool


def _files(spark: SparkSession, path: str | Sequence[str], escape: str) -> list[_File]:
    """First line of every file, and whether it holds a line that may not be one record; one pass over the text.

    Files mostly have one header. Where it stands in them is a number, as all that the pass finds out: numbers are
    aggregated by hash, texts would be line by line. Files with other headers are read once more.
    One row a file reaches the driver, which lists the files anyway.
    """

    def numbered(paths: str | Sequence[str]) -> DataFrame:
        return spark.read.text(paths, lineSep="\n").select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("place"),
        )

    # The first line of some file: should that be another one's header, the files concerned are only read twice.
    some = next(iter(spark.read.text(path, lineSep="\n").limit(1).toLocalIterator()), None)
    usual = "" if some is None else some.value
    doubtful = (~_simple_line(F.col("value"), escape)).alias("doubtful")
    at = F.when(F.col("value") == usual, F.col("place"))
    sides = numbered(path).groupBy("file", doubtful).agg(F.min("place").alias("first"), F.min(at).alias("found"))
    # Two rows a file at most go on to the set.
    facts = sides.groupBy("file").agg(
        F.min("first").alias("first"),
        F.min("found").alias("found"),
        F.array_contains(F.collect_set("doubtful"), True).alias("doubtful"),
    ).collect()
    headers = {f.file: usual for f in facts if f.found == f.first}
    others = [unquote(f.file) for f in facts if f.file not in headers]
    if others:
        # A set takes part, so that Spark aggregates by hash: for the text alone it would sort all lines by their file.
        by_hash = F.collect_set(F.when(F.col("place") < 0, True)).alias("none")
        found = numbered(others).groupBy("file").agg(F.min_by("value", "place").alias("header"), by_hash)
        headers |= {f.file: f.header for f in found.collect()}
    return sorted(_File(unquote(f.file), headers[f.file].removeprefix("\ufeff").rstrip("\r"), f.doubtful) for f in facts)


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    multiline: bool | str = True,
    encoding: str = "UTF-8",
    escape: str = '"',
    corrupt_column: str | None = CORRUPT,
    file_column: str | None = None,
) -> DataFrame:
    """Headered CSV as all-string columns.

    Rows with too few or too many fields keep their text in ``corrupt_column``
    (``None`` leaves it out). ``columns`` replaces the names found in the header.

    ``file_column`` adds the path of the file that each row stands in.

    Several files may have their columns in different order: each is read by its own header. Files
    whose headers name different columns raise. (With an encoding other than UTF-8 all headers must be equal.)

    Spark cannot split a file that is read with ``multiline=True``: one file is one
    task. ``multiline="auto"`` gives the same rows and reads files in splits: line by line those in which
    ``has_record_per_line`` proves every line to be a record, by ``read_quoted_splits`` those with line breaks in quoted
    fields that are larger than one split. Left as one task each are files whose quotes are not regular (see ``regular_files``), or, with line
    breaks in quotes, escaped otherwise than by doubled quotes.
    """
    utf8 = encoding.upper() == "UTF-8"

    def reader(whole: bool) -> DataFrameReader:
        return (
            spark.read.option("header", True)
            .option("multiLine", whole)
            .option("encoding", encoding)
            .option("escape", escape)
        )

    def read(paths: str | Sequence[str], whole: bool, names: Sequence[str] | None) -> DataFrame:
        checked = reader(whole)
        if names is None:
            names = checked.csv(paths).columns
            checked = checked.option("enforceSchema", False)
        fields = [StructField(name, StringType()) for name in names]
        if corrupt_column is not None:
            checked = checked.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
            fields.append(StructField(corrupt_column, StringType()))
        rows = checked.schema(StructType(fields)).csv(paths)
        return rows if file_column is None else rows.select("*", F.col("_metadata.file_path").alias(file_column))

    def read_whole(paths: list[str], names: Sequence[str] | None) -> list[DataFrame]:
        """Files that hold line breaks: in splits where their lines can be told apart, else one task each."""
        # What is one split anyway is read as a whole; one row a file reaches the driver.
        sizes = spark.read.format("binaryFile").load(paths).select("path", "length").collect()
        one_split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        odd = sorted(unquote(file.path) for file in sizes if file.length <= one_split)
        regular = regular_files(spark, sorted(unquote(file.path) for file in sizes if file.length > one_split))
        split = [file for file, good in regular.items() if good]
        odd += [file for file, good in regular.items() if not good]
        names = names if names is not None else reader(True).csv((split or odd)[0]).columns
        parts = [read_quoted_splits(spark, split, names, corrupt_column, file_column)] if split else []
        return [*parts, read(odd, True, names)] if odd else parts

    auto = multiline == "auto"
    listed = spark.read.text(path).inputFiles()
    if not utf8 or len(listed) < 2:
        whole = (not utf8 or not has_record_per_line(spark, path, escape)) if auto else multiline
        if utf8 and columns is None:
            columns = reader(whole).csv(path).columns
        if auto and whole and utf8 and escape == '"':
            return reduce(DataFrame.unionByName, read_whole([path] if isinstance(path, str) else list(path), columns))
        return read(path, whole, columns)

    groups: dict[tuple, list[str]] = {}
    for file in _files(spark, path, escape):
        # A header that goes on in the next line is like no other.
        own = None if columns is not None else (file.header, file.path if file.header.count('"') % 2 else "")
        groups.setdefault((own, file.doubtful if auto else multiline), []).append(file.path)
    parts = []
    for (_, whole), paths in groups.items():
        names = columns if columns is not None else reader(whole).csv(paths[0]).columns
        if parts and set(names) != set(parts[0].columns) - {corrupt_column, file_column}:
            raise ValueError(f"{paths[0]} has columns {', '.join(names)}; others have {', '.join(parts[0].columns)}")
        parts += read_whole(paths, names) if auto and whole and escape == '"' else [read(paths, whole, names)]
    return reduce(DataFrame.unionByName, parts)
