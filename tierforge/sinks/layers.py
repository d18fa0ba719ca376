"""Parquet writers and catalog publication."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tierforge.sources.tables import layer_path, quoted

# Bytes of a column's dictionary in a row group, beyond which its values are written plain. In the default of 1 MB, keys and
# other long lists of values leave the processor's cache, and take longer to look up, and to read, than to write out.
DICTIONARY_BYTES = 128 << 10

# A lake holds every row in bronze and in silver; against Spark's default, snappy, this takes a third off.
COMPRESSION = "zstd"


def _write_parquet(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Writes beside ``path`` and moves the finished table there.

    A write that fails leaves the old table as it was, and ``df`` may read from ``path``. The
    change takes two renames. Should the driver die between them, the old table
    is the folder beside it whose name ends in ``.old-`` and a number.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    folder, _, name = path.rstrip("/").rpartition("/")
    beside = f"{folder}/.{name}" if folder else f".{name}"
    new, old = f"{beside}.new-{run}", f"{beside}.old-{run}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    writer = df.write.option("parquet.dictionary.page.size", DICTIONARY_BYTES).option("compression", COMPRESSION)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    try:
        writer.parquet(new)
    except BaseException:
        files.delete(hadoop(new), True)
        raise
    replaces = files.exists(hadoop(path))
    if replaces and not files.rename(hadoop(path), hadoop(old)):
        raise OSError(f"{path} cannot be moved; the new table is at {new}")
    if not files.rename(hadoop(new), hadoop(path)):
        if replaces:
            files.rename(hadoop(old), hadoop(path))
        raise OSError(f"{new} cannot be moved to {path}")
    if replaces:
        files.delete(hadoop(old), True)
    spark.catalog.refreshByPath(path)


def write_layer(
    df: DataFrame, base: str, table: str, partition_by: Sequence[str] = ()
) -> str:
    """Replaces the Parquet table ``base/table``, once all is written, and returns its path."""
    path = layer_path(base, table)
    _write_parquet(df, path, partition_by)
    return path


def _is_external_parquet(spark: SparkSession, name: str) -> bool:
    detail = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE FORMATTED {quoted(name)}").collect()}
    return detail.get("Type") == "EXTERNAL" and detail.get("Provider", "").lower() == "parquet"


def _register(
    spark: SparkSession, df: DataFrame, name: str, path: str, partition_by: Sequence[str]
) -> None:
    if spark.catalog.tableExists(name):
        columns = [(field.name, field.dataType) for field in df.schema]
        kept = [(field.name, field.dataType) for field in spark.table(name).schema]
        if kept == columns and not partition_by and _is_external_parquet(spark, name):
            location = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{location}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {quoted(name)}")
    if partition_by:
        # Partitioned tables take schema and partitions from the directory.
        spark.catalog.createTable(name, path=path, source="parquet")
        spark.catalog.recoverPartitions(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)


def publish_table(
    df: DataFrame,
    name: str,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    strict: bool = False,
) -> bool:
    """Writes ``df`` to ``path`` and makes it the external catalog table ``name``.

    The files come first: while a long write runs, readers find the old table by name and by path. A table
    that keeps its columns is pointed at the files, others are dropped and created anew. Failing to register only warns (returning False) unless ``strict``;
    failing to write always raises.
    """
    _write_parquet(df, path, partition_by)
    try:
        _register(df.sparkSession, df, name, path, partition_by)
    except PySparkException as error:
        if strict:
            raise
        warnings.warn(f"{name} not registered, its data are at {path}: {error}", stacklevel=2)
        return False
    return True


def preview(df: DataFrame, cols: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """Some ``n`` rows of the chosen columns; which ones is not defined."""
    return (df.select(*cols) if cols else df).limit(n)
