"""Landing of only what is new: a ledger of landed files beside each table.

Every version of a file (its path, length and time) has a folder of its own for its rows. A run compares the
files that are there with the ledger, reads only new and changed ones, writes their folders and then appends to
the ledger. Readers take the folders that the ledger's last entries name, so that append is what publishes
a run: before it nothing of the run is seen, after it all. A run that died in between can simply be repeated.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.operators.dedupe import dedupe_latest
from tierforge.sources.raw_csv import CORRUPT, read_raw_csv
from tierforge.sources.tables import layer_path

# Names the folder of a file version.
VERSION = "file_version"
_FILE = "__file"

LEDGER = (
    f"path string, length bigint, modified timestamp, {VERSION} string, rows bigint, corrupt bigint, checksum string, "
    "landed timestamp"
)


def ledger_path(bronze_dir: str, table: str) -> str:
    return layer_path(bronze_dir, f"{table}__ledger")


def read_ledger(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    """The last entry of every landed file; no row where nothing has landed."""
    try:
        entries = spark.read.schema(LEDGER).parquet(ledger_path(bronze_dir, table))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    return dedupe_latest(entries, "path", "landed")


def read_landed(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    """The rows of the last version of every landed file."""
    rows = spark.read.parquet(layer_path(bronze_dir, table))
    valid = read_ledger(spark, bronze_dir, table).where("rows > 0").select(VERSION)
    return rows.join(valid, VERSION, "left_semi").drop(VERSION)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``length`` and ``modified`` of the files that are there; nothing of them is read."""
    files = spark.read.format("binaryFile").load(path)
    listed = files.select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))
    # Spark lists files without a byte, but makes no row of them.
    names = [(name.replace("file:///", "file:/"),) for name in files.inputFiles()]
    every = spark.createDataFrame(names, "path string")
    return every.join(listed, "path", "left").withColumn("length", F.coalesce("length", F.lit(0)))


def land_new(
    spark: SparkSession, path: str, bronze_dir: str, table: str, *, multiline: bool | str = "auto", **options
) -> DataFrame:
    """Lands the files at ``path`` that the ledger does not have as they are now; returns a row for each file that is there.

    ``action`` is ``landed``, ``replaced`` (another length or time than in the ledger: the rows of this file, and no
    others, are replaced) or ``unchanged``; with ``rows``, ``corrupt`` (wrong number of fields) and ``checksum``, the sum of
    the hashes of the rows. Files that are gone keep their rows. A file without a byte has none. Files whose columns are not the table's
    raise a ``ValueError``, and nothing is landed. One row for each file reaches the driver, which lists the files
    anyway. ``options`` go to ``read_raw_csv``.
    """
    there = _listed(spark, path)
    named = F.concat_ws("|", "path", "length", F.unix_micros("modified"))
    there = there.withColumn(VERSION, F.substr(F.sha2(named, 256), F.lit(1), F.lit(32)))
    known = read_ledger(spark, bronze_dir, table).select("path", F.col(VERSION).alias("__known"))
    action = F.when(F.col("__known").isNull(), "landed").when(F.col("__known") == F.col(VERSION), "unchanged").otherwise("replaced")
    judged = there.join(known, "path", "left").select("path", "length", "modified", VERSION, action.alias("action"))
    # Fixed here: from now on the files may change again.
    changed = judged.where("action <> 'unchanged'").orderBy("path").collect()
    if changed:
        entries = spark.createDataFrame(changed, judged.schema).drop("action")
        _land(spark, entries, [unquote(row.path) for row in changed if row.length], bronze_dir, table, multiline, options)
    acted = spark.createDataFrame([(row.path, row.action) for row in changed], "path string, __action string")
    now = read_ledger(spark, bronze_dir, table).join(there.select("path"), "path", "left_semi").join(acted, "path", "left")
    now = now.select("path", F.coalesce("__action", F.lit("unchanged")).alias("action"), "rows", "corrupt", "checksum")
    # As it is now, whatever lands later: two scans of one path count as the same scan to Spark, when a plan holds both.
    return spark.createDataFrame(now.collect(), now.schema)


def _land(
    spark: SparkSession, entries: DataFrame, paths: list[str], bronze_dir: str, table: str, multiline, options: dict
) -> None:
    target, flag = layer_path(bronze_dir, table), options.get("corrupt_column", CORRUPT)
    facts = spark.createDataFrame([], f"{VERSION} string, rows bigint, corrupt bigint, checksum string")
    if paths:
        rows = read_raw_csv(spark, paths, multiline=multiline, file_column=_FILE, **options)
        names = [name for name in rows.columns if name not in (flag, _FILE)]
        _require_columns(spark, target, names, flag)
        versions = entries.select(F.col("path").alias(_FILE), VERSION)
        # A repeated run overwrites what a run that died has left in these folders.
        writer = rows.join(versions, _FILE).drop(_FILE).write.mode("overwrite").partitionBy(VERSION)
        writer.option("partitionOverwriteMode", "dynamic").parquet(target)
        spark.catalog.refreshByPath(target)
        # Counted in the written table: exact after lost executors.
        marked = F.lit(None) if flag is None else F.col(flag)
        landed = spark.read.parquet(target).join(entries.select(VERSION), VERSION, "left_semi")
        facts = landed.groupBy(VERSION).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(marked).alias("corrupt"),
            F.sum(F.xxhash64(*names).cast("decimal(38,0)")).cast("string").alias("checksum"),
        )
    entries = entries.join(facts, VERSION, "left").withColumns(
        {"rows": F.coalesce("rows", F.lit(0)), "corrupt": F.coalesce("corrupt", F.lit(0)), "landed": F.current_timestamp()}
    )
    schema = spark.createDataFrame([], LEDGER).schema
    entries = entries.select(*[F.col(field.name).cast(field.dataType) for field in schema])
    entries.coalesce(1).write.mode("append").parquet(ledger_path(bronze_dir, table))
    spark.catalog.refreshByPath(ledger_path(bronze_dir, table))


def _require_columns(spark: SparkSession, target: str, names: list[str], flag: str | None) -> None:
    try:
        standing = set(spark.read.parquet(target).columns) - {VERSION, flag}
    except AnalysisException:
        return
    if standing != set(names):
        raise ValueError(f"new files have columns {', '.join(names)}; {target} has {', '.join(sorted(standing))}")


def vacuum_landed(spark: SparkSession, bronze_dir: str, table: str) -> int:
    """Deletes the folders that no last entry names: older versions, and what died runs have left. Returns their number.

    Not for times when a run is landing files, or a reader still reads from before the last run.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = hadoop(layer_path(bronze_dir, table))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    valid = {row[0] for row in read_ledger(spark, bronze_dir, table).select(VERSION).collect()}
    old = [f.getPath() for f in files.listStatus(target) if f.getPath().getName().startswith(f"{VERSION}=")]
    old = [path for path in old if path.getName().partition("=")[2] not in valid]
    for path in old:
        files.delete(path, True)
    spark.catalog.refreshByPath(target.toString())
    return len(old)
