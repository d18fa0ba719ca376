"""Silver tables that grow by batches of bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierforge.functions.casts import MONEY
from tierforge.plans.silver import SILVER, SilverTable, passing, prepare
from tierforge.sinks.versions import merge_latest, read_version


def _keyed(name: str) -> SilverTable:
    table = SILVER[name]
    if not table.keys:
        raise ValueError(f"{name} has no keys: every row is kept, there is nothing to merge")
    return table


def merge_silver(bronze: DataFrame, base: str, name: str, *, money: str = MONEY, buckets: int = 64) -> int:
    """Merges a batch of bronze rows into the silver table ``name`` below ``base``; returns the version's number.

    The batch is typed, cleaned and judged as in a whole build, then merged by the table's keys, so that after any
    number of batches ``read_merged_silver`` gives the table built from all their rows. Only buckets of keys that
    the batch has are rewritten. Tables without keys raise a ``ValueError``.
    """
    table = _keyed(name)
    rows = passing(table, prepare(table, bronze, money))
    return merge_latest(rows, base, name, table.keys, table.latest_by, buckets=buckets)


def read_merged_silver(spark: SparkSession, base: str, name: str, *lookups: DataFrame) -> DataFrame:
    """The merged table with the steps that follow de-duplication, by the ``lookups`` as they are now."""
    return _keyed(name).finish(read_version(spark, base, name), *lookups)
