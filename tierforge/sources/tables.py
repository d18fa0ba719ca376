"""Parquet layers and catalog tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def layer_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def read_layer(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(layer_path(base, table))


def quoted(name: str) -> str:
    """A table name for use in SQL, each part in back quotes."""
    return name if "`" in name else ".".join(f"`{part}`" for part in name.split("."))


def _qualified(spark: SparkSession, path: str) -> str:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return hadoop.makeQualified(files.getUri(), files.getWorkingDirectory()).toString().rstrip("/")


def is_published(spark: SparkSession, table: str, path: str) -> bool:
    """Whether the catalog holds ``table`` and its files are those at ``path``."""
    try:
        if not spark.catalog.tableExists(table):
            return False
        detail = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE FORMATTED {quoted(table)}").collect()}
    except AnalysisException:
        return False
    location = detail.get("Location")
    return location is not None and _qualified(spark, location) == _qualified(spark, path)


def read_published(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The catalog table where its files are those at ``path``; else the files themselves.

    A table of that name with its files elsewhere belongs to another lake and is not read.
    """
    return spark.table(quoted(table)) if is_published(spark, table, path) else spark.read.parquet(path)


def read_table_or_path(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The catalog table, or the Parquet files at ``path`` where it cannot be resolved."""
    try:
        if spark.catalog.tableExists(table):
            return spark.table(quoted(table))
    except AnalysisException:
        pass
    return spark.read.parquet(path)
