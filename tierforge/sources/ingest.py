"""Landing of a manifest of CSV files as bronze tables."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.session import side_by_side
from tierforge.sinks.layers import write_layer
from tierforge.sources.raw_csv import CORRUPT, read_raw_csv
from tierforge.sources.tables import layer_path, read_layer

STATUS_SCHEMA = "file string, table string, rows bigint, cols int, corrupt bigint, error string"


class IngestEntry(NamedTuple):
    file: str
    table: str
    multiline: bool | str = "auto"


def _ingest_one(
    spark: SparkSession, entry: IngestEntry, raw_dir: str, bronze_dir: str, options: dict
) -> tuple[int, int, int]:
    source = read_raw_csv(
        spark, layer_path(raw_dir, entry.file), multiline=entry.multiline, **options
    )
    write_layer(source, bronze_dir, entry.table)
    # Counted in the written table: exact after lost executors, and a scan of one column.
    landed = read_layer(spark, bronze_dir, entry.table)
    flag = options.get("corrupt_column", CORRUPT)
    marked = F.lit(None) if flag is None else F.col(flag)
    rows, corrupt = landed.agg(F.count(F.lit(1)), F.count(marked)).first()
    return rows, len([name for name in source.columns if name != flag]), corrupt


def ingest_all(
    spark: SparkSession,
    manifest: Iterable[tuple],
    raw_dir: str,
    bronze_dir: str,
    strict: bool = False,
    threads: int = 4,
    **options,
) -> DataFrame:
    """Lands every ``(file, table[, multiline])`` of the manifest; a failing file stops no other.

    Returns one status row per file: ``rows``, ``cols``, ``corrupt`` (rows with a wrong
    number of fields) or ``error``. With ``strict`` any error raises, after all files
    were tried. ``threads`` files are landed at a time; ``options`` go to ``read_raw_csv``.
    """

    def attempt(entry: IngestEntry) -> tuple:
        try:
            counts = _ingest_one(spark, entry, raw_dir, bronze_dir, options)
            return (entry.file, entry.table, *counts, None)
        except Exception as error:
            return (entry.file, entry.table, None, None, None, str(error))

    status = side_by_side(spark, attempt, [IngestEntry(*item) for item in manifest], threads)
    failed = [f"{file}: {error}" for file, *_, error in status if error is not None]
    if strict and failed:
        raise RuntimeError("files not ingested: " + "; ".join(failed))
    return spark.createDataFrame(status, STATUS_SCHEMA)
