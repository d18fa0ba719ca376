"""Session settings and the shared scratch location."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# What the semantics of the library rest on; the cluster keeps its own sizing.
SESSION_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join by hash, without sorting, where AQE has measured every partition to be small. The measure is of
    # compressed shuffle data, which may take ten times as much in memory, and a hash table cannot spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    # Before a run sides of a join are measured by their compressed files, which take several times as much in memory.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the library's settings; ``settings`` use ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in SESSION_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder of ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is configured *and* the
    master is local, that is, when driver and executors share one machine. The folder is
    deleted when the driver's JVM ends; until then whatever was read from it can be read again.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.gettempdir()
    folder = f"{base.rstrip('/')}/tierforge-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return f"{folder}/{name}"


def release_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of queries that nothing refers to any more.

    Spark deletes them when the driver's garbage is collected, which a driver with memory to spare puts off: the
    shuffles of a whole run would lie on the executors' disks together.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def side_by_side(
    spark: SparkSession, task: Callable[[Any], Any], items: Iterable[Any], threads: int
) -> list:
    """Results of ``task`` for independent ``items``, whose Spark jobs may overlap.

    A table's last tasks then share the cluster with the next table's first ones. What an item shuffled is
    released when it, or the next one, is done.
    """

    def released(item: Any) -> Any:
        try:
            return task(item)
        finally:
            release_shuffles(spark)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(released), items))
