"""The whole run, in dependency order: land, clean, report, check."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierforge.functions.casts import MONEY
from tierforge.operators.quality import judge, reject_counters
from tierforge.plans import gold
from tierforge.plans.bronze import retail_manifest
from tierforge.plans.checks import TABLE_KEYS, output_check
from tierforge.plans.profiles import PROFILES
from tierforge.plans.silver import (
    METRICS_SCHEMA,
    SILVER,
    cast_counters,
    complete,
    counters,
    prepare,
    rejects,
    row_counters,
)
from tierforge.session import side_by_side
from tierforge.sinks.layers import publish_table, write_layer
from tierforge.sources.ingest import ingest_all
from tierforge.sources.tables import is_published, layer_path, quoted, read_published

# Directory of each layer below the lake.
LAYERS = {"bronze": "brz", "silver": "slv", "gold": "gld"}

# Directory of the rows that silver rules reject, one table for each silver table.
REJECTS = "rej"

# What a run reports about itself, below the lake: appended tables with a ``run_id``.
META = "meta"

# Report and the silver tables it reads.
REPORTS = {
    "gold_monthly_revenue": (gold.monthly_revenue, ("silver_orders", "silver_order_payments")),
    "gold_top_products": (gold.top_products, ("silver_order_items", "silver_products")),
    "gold_region_revenue": (
        gold.region_revenue,
        ("silver_orders", "silver_customers", "silver_order_payments"),
    ),
    "gold_payment_method": (gold.payment_method, ("silver_order_payments",)),
    "gold_delivery_performance": (gold.delivery_performance, ("silver_orders",)),
    "gold_review_by_delivery": (gold.review_by_delivery, ("silver_orders", "silver_order_reviews")),
}

SKIPPED_SCHEMA = "table string, reason string"


class PipelineResult(NamedTuple):
    ingest: DataFrame
    metrics: DataFrame
    profiles: DataFrame
    checks: DataFrame
    skipped: DataFrame


class _Lake:
    """Paths of the layers, and table names where a catalog database is used."""

    def __init__(self, spark: SparkSession, lake_dir: str, database: str | None, strict: bool = False):
        self.spark = spark
        self.base = lake_dir
        self.dirs = {layer: layer_path(lake_dir, name) for layer, name in LAYERS.items()}
        self.database = database
        self.strict = strict

    def path(self, table: str) -> str:
        return layer_path(self.dirs[table.partition("_")[0]], table)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def write(self, df: DataFrame, table: str) -> None:
        """With ``strict``, a table that cannot be registered raises; else the checks report it."""
        if self.database is None:
            write_layer(df, self.dirs[table.partition("_")[0]], table)
        else:
            publish_table(df, self.name(table), self.path(table), strict=self.strict)

    def read(self, table: str) -> DataFrame:
        """This lake's table: a catalog table of that name counts only if its files are here."""
        if self.database is None:
            return self.spark.read.parquet(self.path(table))
        return read_published(self.spark, self.name(table), self.path(table))

    def report(self, df: DataFrame, name: str, run_id: str) -> DataFrame:
        """Appends ``df`` to the lake's own account of its runs, and returns the run's rows of it."""
        path = layer_path(layer_path(self.base, META), name)
        df.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)
        return self.spark.read.parquet(path).where(F.col("run_id") == run_id).select(*df.columns)


def _run_silver(lake: _Lake, name: str, money: str, keep_rejects: bool = True) -> list[tuple[str, str, str, int]]:
    """Writes one silver table and returns its metrics.

    What casts did is counted while the table is written. Observed counters can run too high when lost executors make Spark repeat map
    tasks. A repeat also adds to ``rows_in``, so that number, compared with the rows
    of the bronze files, tells whether to trust them; if not, they are counted anew. ``rows_out`` is
    counted in the written files; what the rules kept and is not there is ``duplicates``, so
    rows_in = all dropped + duplicates + rows_out.

    With ``keep_rejects`` the rejected rows are written by a second scan of the bronze table (one that wrote both would
    store the kept rows twice), and the account of the rules is taken from them: few rows, counted exactly.
    """
    table = SILVER[name]
    bronze = lake.spark.read.parquet(lake.path(table.source))
    lookups = [lake.spark.read.parquet(lake.path(lookup)) for lookup in table.lookups]
    observation = Observation(name)
    prepared = judge(prepare(table, bronze, money), table.rules())
    if keep_rejects:
        wanted = [F.count(F.lit(1)).alias("rows_in"), *cast_counters(table, money), *row_counters(table)]
    else:
        wanted = [*counters(table, money, judged=True), *row_counters(table)]
    lake.write(complete(table, prepared.observe(observation, *wanted), *lookups, judged=True), name)
    counted = dict(observation.get)
    if counted.get("rows_in") != bronze.count():
        counted = prepared.agg(*wanted).first().asDict()
    if keep_rejects:
        path = write_layer(rejects(table, prepared), layer_path(lake.base, REJECTS), name)
        account = [F.count(F.lit(1)).alias("rejected"), *reject_counters(table.rules())]
        found = lake.spark.read.parquet(path).agg(*account).first().asDict()
        counted |= {"rows_kept": counted["rows_in"] - found.pop("rejected"), **found}
    counted["rows_out"] = lake.spark.read.parquet(lake.path(name)).count()
    counted["duplicates"] = counted["rows_kept"] - counted["rows_out"]
    return [
        (name, counter.partition(":")[0], counter.partition(":")[2], value)
        for counter, value in counted.items()
    ]


def _run_gold(lake: _Lake, name: str) -> None:
    report, inputs = REPORTS[name]
    lake.write(report(*[lake.read(table) for table in inputs]), name)


def run_silver(
    spark: SparkSession,
    lake_dir: str,
    *,
    tables: Iterable[str] = tuple(SILVER),
    database: str | None = "default",
    money: str = MONEY,
    strict: bool = False,
    threads: int = 4,
    keep_rejects: bool = True,
) -> DataFrame:
    """Bronze to silver; returns the metrics ``table``, ``metric``, ``item``, ``value``.

    With ``keep_rejects`` the rows that break a rule are written to ``read_rejects``' tables, with the rules they break.
    """
    lake = _Lake(spark, lake_dir, database, strict)
    counted = side_by_side(spark, lambda name: _run_silver(lake, name, money, keep_rejects), tables, threads)
    return spark.createDataFrame(sum(counted, []), METRICS_SCHEMA)


def read_rejects(spark: SparkSession, lake_dir: str, table: str) -> DataFrame:
    """The rows that the last run's rules kept out of the silver ``table``, see ``silver.rejects``."""
    return spark.read.parquet(layer_path(layer_path(lake_dir, REJECTS), table))


def run_gold(
    spark: SparkSession,
    lake_dir: str,
    *,
    reports: Iterable[str] = tuple(REPORTS),
    database: str | None = "default",
    strict: bool = False,
    threads: int = 4,
) -> None:
    """Silver to gold."""
    lake = _Lake(spark, lake_dir, database, strict)
    side_by_side(spark, lambda name: _run_gold(lake, name), reports, threads)


def run_checks(
    spark: SparkSession, lake_dir: str, *, database: str | None = None, skipped: dict[str, str] | None = None
) -> DataFrame:
    """One row per silver and gold table with what ``output_check`` finds, ``in_catalog`` and ``note``.

    ``in_catalog`` tells whether the catalog's table has its files in this lake and as many rows as they have; it
    is null where no ``database`` is used. Tables that are not there, and ``skipped`` ones, are not ok.
    """
    lake, skipped = _Lake(spark, lake_dir, database), skipped or {}
    report = output_check(
        spark,
        {name: (lake.path(name), keys) for name, keys in TABLE_KEYS.items()},
        nullable_keys=tuple(REPORTS),
    )
    listed: dict[str, int | None] = {}
    for name in TABLE_KEYS if database is not None else ():
        published = is_published(spark, lake.name(name), lake.path(name))
        listed[name] = spark.table(quoted(lake.name(name))).count() if published else None
    facts = spark.createDataFrame(
        [(name, listed.get(name), skipped.get(name)) for name in TABLE_KEYS],
        "table string, __listed bigint, note string",
    )
    in_catalog = F.coalesce(F.col("__listed") == F.col("total"), F.lit(False))
    return (
        report.join(facts, "table")
        .withColumn("in_catalog", in_catalog if database is not None else F.lit(None).cast("boolean"))
        .withColumn("ok", F.col("ok") & F.coalesce("in_catalog", F.lit(True)) & F.col("note").isNull())
        .drop("__listed")
    )


def run_profiles(
    spark: SparkSession, lake_dir: str, *, tables: Iterable[str] = tuple(SILVER), database: str | None = "default"
) -> DataFrame:
    """Profiles of silver tables: ``table`` and the columns of ``profile_table``."""
    lake = _Lake(spark, lake_dir, database)
    profiles = [PROFILES[name](lake.read(name)).select(F.lit(name).alias("table"), "*") for name in tables]
    return reduce(DataFrame.unionByName, profiles)


def skipped_tables(failed: Iterable[str]) -> dict[str, str]:
    """The silver and gold tables that rest on ``failed`` bronze tables, and why each is left out."""
    missing = {name: f"not landed: {name}" for name in failed}
    reasons: dict[str, str] = {}
    needs = {name: (table.source, *table.lookups) for name, table in SILVER.items()}
    needs |= {name: inputs for name, (_, inputs) in REPORTS.items()}
    for name, inputs in needs.items():
        for source in inputs:
            if source in missing:
                reasons[name] = missing[name] = f"skipped: {source}"
                break
    return reasons


def run_pipeline(
    spark: SparkSession,
    raw_dir: str,
    lake_dir: str,
    *,
    manifest: Iterable[tuple] | None = None,
    database: str | None = "default",
    money: str = MONEY,
    strict: bool = True,
    threads: int = 4,
    keep_rejects: bool = True,
) -> PipelineResult:
    """Raw CSV files to checked gold tables. Every run replaces all tables it computes.

    ``database`` names the catalog database to publish silver and gold tables in;
    ``None`` leaves the catalog alone. ``money`` is ``decimal(18,2)`` or, for amounts
    as approximate numbers, ``double`` or ``float``. Tables of one layer do not depend
    on each other; ``threads`` of them are computed at a time. ``keep_rejects`` stores the rejected rows, see ``run_silver``.

    With ``strict`` a file that does not land, or a table that cannot be registered, raises. Without, what
    rests on a file that did not land is skipped, listed in ``skipped`` and not ok in ``checks``: tables of an
    earlier run stay, but none is computed from them. The five results are
    also appended to the tables below ``lake_dir/meta``, with a ``run_id``.
    """
    manifest = list(retail_manifest() if manifest is None else manifest)
    bronze_dir = layer_path(lake_dir, LAYERS["bronze"])
    status = ingest_all(spark, manifest, raw_dir, bronze_dir, strict, threads)
    # As many rows as the manifest has.
    skipped = skipped_tables(row["table"] for row in status.where("error IS NOT NULL").collect())
    tables = [name for name in SILVER if name not in skipped]
    reports = [name for name in REPORTS if name not in skipped]
    options = {"database": database, "threads": threads, "strict": strict}
    metrics = run_silver(spark, lake_dir, tables=tables, money=money, keep_rejects=keep_rejects, **options)
    run_gold(spark, lake_dir, reports=reports, **options)

    lake, run_id = _Lake(spark, lake_dir, database), uuid.uuid4().hex
    kept = lambda name, df: lake.report(df, name, run_id)
    profiles = run_profiles(spark, lake_dir, tables=tables, database=database) if tables else None
    return PipelineResult(
        kept("ingest", status),
        kept("metrics", metrics),
        kept("profiles", profiles) if profiles is not None else spark.createDataFrame([], "table string"),
        kept("checks", run_checks(spark, lake_dir, database=database, skipped=skipped)),
        kept("skipped", spark.createDataFrame(list(skipped.items()), SKIPPED_SCHEMA)),
    )
