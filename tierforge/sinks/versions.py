"""Tables in versions: a commit file names the folders of a table, and readers follow the last complete one.

Data are written to folders of their own, then the commit file makes them the table: nothing is renamed or
overwritten, so a reader always finds one whole version, and a run that dies in between leaves the table as it was.
Commits are numbered, and a file is created only where none of that number is: of two writers that started from the
same version one fails. That holds where the file system creates files exclusively (HDFS, local disks); on stores that do
not, let one writer work at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierforge.operators.dedupe import dedupe_latest
from tierforge.sources.tables import layer_path

_COMMITS = "_commits"
_BUCKET = "__bucket"
# Fixed value: partitions to a bucket where rows are dealt by bucket.
_SPREAD = 4


class Version(NamedTuple):
    number: int
    # Folders below the table's, by bucket; a table without keys has the one bucket "".
    folders: dict[str, str]
    schema: StructType
    keys: list[str]
    buckets: int


class _Files:
    """A table's folder, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path
        self.system = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self._at(folder)):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(self._at(folder)))

    def read(self, name: str) -> str:
        stream = self.system.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        stream = self.system.create(self._at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.system.delete(self._at(name), True)


def _commit_name(number: int) -> str:
    return f"{_COMMITS}/{number:012d}"


def _numbers(files: _Files) -> list[int]:
    return [int(name) for name in files.names(_COMMITS) if name.isdigit()]


def _load(files: _Files, number: int) -> Version | None:
    """The version, or None where its file is still being written, or its writer has died."""
    try:
        held = json.loads(files.read(_commit_name(number)))
    except json.JSONDecodeError:
        return None
    schema = StructType.fromJson(held["schema"])
    return Version(number, held["folders"], schema, held["keys"], held["buckets"])


def current_version(spark: SparkSession, base: str, table: str) -> Version | None:
    """The last complete version; None where the table has none."""
    return _current(_Files(spark, layer_path(base, table)))


def _current(files: _Files) -> Version | None:
    for number in reversed(_numbers(files)):
        version = _load(files, number)
        if version is not None:
            return version
    return None


def _next_number(files: _Files) -> int:
    return max(_numbers(files), default=0) + 1


def _commit(files: _Files, version: Version) -> int:
    held = {**version._asdict(), "schema": version.schema.jsonValue()}
    try:
        files.create(_commit_name(version.number), json.dumps(held))
    except Exception as error:
        if version.number in _numbers(files):
            raise RuntimeError(f"another writer has made version {version.number} of {files.path}") from error
        raise
    return version.number


def write_version(df: DataFrame, base: str, table: str, partition_by: Sequence[str] = ()) -> int:
    """Makes ``df`` the next version of ``base/table`` and returns its number. ``df`` may read from an earlier one."""
    files = _Files(df.sparkSession, layer_path(base, table))
    number, folder = _next_number(files), f"data-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{files.path}/{folder}")
    return _commit(files, Version(number, {"": folder}, df.schema, [], 0))


def _rows(spark: SparkSession, files: _Files, schema: StructType, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{files.path}/{folder}" for folder in folders])


def read_version(spark: SparkSession, base: str, table: str, number: int | None = None) -> DataFrame:
    """The table as it was committed last, or by commit ``number``, as long as that is not vacuumed."""
    files = _Files(spark, layer_path(base, table))
    if number is None:
        version = _current(files)
    else:
        version = _load(files, number) if number in _numbers(files) else None
    if version is None:
        raise FileNotFoundError(f"{files.path} has no version" + ("" if number is None else f" {number}"))
    return _rows(spark, files, version.schema, sorted(version.folders.values()))


def _bucketed(df: DataFrame, path: str) -> None:
    df.write.partitionBy(_BUCKET).parquet(path)


def _written(files: _Files, folder: str) -> dict[str, str]:
    names = [name for name in files.names(folder) if name.startswith(f"{_BUCKET}=")]
    return {name.partition("=")[2]: f"{folder}/{name}" for name in names}


def merge_latest(
    batch: DataFrame,
    base: str,
    table: str,
    keys: str | Sequence[str],
    order_by: str | Column | Sequence[str | Column],
    *,
    buckets: int = 64,
    tie_break: Sequence[str | Column] | None = None,
) -> int:
    """Merges ``batch`` into the standing table, keeping one row per key as ``dedupe_latest`` does; returns the version.

    Rows lie in ``buckets`` by a hash of their keys (fixed by the first batch; choose it for some hundred MB each). Only
    buckets for which the batch has rows are read and written; the files of all others stay part of the table as
    they are. Any split of rows into batches, in any order and with batches repeated, gives the table of one batch. Null keys count as
    equal. A batch without rows makes a version equal to the last. Other columns, types or keys than the table's raise a ``ValueError``.

    A key may hold any share of the batch: the batch is reduced to one row per key, before its shuffle too. What is shuffled then
    has at most two rows per key.
    """
    spark, keys = batch.sparkSession, [keys] if isinstance(keys, str) else list(keys)
    files = _Files(spark, layer_path(base, table))
    standing, number = _current(files), _next_number(files)
    if standing is not None:
        buckets = standing.buckets
        _require_same(standing, batch, keys, files.path)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    latest = dedupe_latest(batch, keys, order_by, tie_break).withColumn(_BUCKET, bucket)

    folder = f"data-{uuid.uuid4().hex}"
    # More partitions than buckets: dealt by hash, few of them then hold several buckets.
    dealt = lambda df, n: df.repartition(_SPREAD * n, _BUCKET)
    if standing is None:
        _bucketed(dealt(latest, buckets), f"{files.path}/{folder}")
    else:
        # The reduced batch waits in files that are not dealt by bucket, which no version names: rows are dealt once, when they are merged.
        staged = f"{folder}-staged"
        latest.write.parquet(f"{files.path}/{staged}")
        new = _rows(spark, files, latest.schema, [staged])
        # At most as many rows as there are buckets.
        touched = sorted(str(row[0]) for row in new.select(_BUCKET).distinct().collect())
        if touched:
            old = _rows(spark, files, batch.schema, [standing.folders[name] for name in touched if name in standing.folders])
            both = dealt(old.withColumn(_BUCKET, bucket).union(new), len(touched))
            # Dealt by bucket already: ranking needs no shuffle of its own.
            _bucketed(dedupe_latest(both, [_BUCKET, *keys], order_by, tie_break), f"{files.path}/{folder}")
    folders = _written(files, folder)
    kept = standing.folders if standing is not None else {}
    return _commit(files, Version(number, {**kept, **folders}, batch.schema, keys, buckets))


def _require_same(standing: Version, batch: DataFrame, keys: list[str], path: str) -> None:
    if standing.keys != keys:
        raise ValueError(f"{path} is kept by {', '.join(standing.keys) or 'no key'}, not by {', '.join(keys)}")
    columns = lambda schema: [(field.name, field.dataType) for field in schema]
    if columns(standing.schema) != columns(batch.schema):
        raise ValueError(f"{path} has {standing.schema.simpleString()}, the batch {batch.schema.simpleString()}")


def vacuum_versions(spark: SparkSession, base: str, table: str, keep: int = 1) -> int:
    """Deletes what the last ``keep`` complete versions do not name; returns the number of folders deleted.

    Not for times when a run is writing, or when a reader may still use an older version.
    """
    files, kept = _Files(spark, layer_path(base, table)), []
    for number in reversed(_numbers(files)):
        version = _load(files, number)
        if version is not None and len(kept) < max(1, keep):
            kept.append(version)
        elif kept:
            files.delete(_commit_name(number))
    if not kept:
        return 0
    named, deleted = {folder for version in kept for folder in version.folders.values()}, 0
    for data in files.names(""):
        if data.startswith("data-") and data not in named:
            inside = _written(files, data).values()
            old = [folder for folder in inside if folder not in named]
            # All of a folder goes at once.
            for folder in old if len(old) < len(inside) else [data]:
                files.delete(folder)
                deleted += 1
    return deleted
