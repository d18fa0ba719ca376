"""``spark-submit`` entry point: one layer, one table or the whole run.

    python -m tierforge run    --raw RAW --lake LAKE [--prefix P]
    python -m tierforge bronze --raw RAW --lake LAKE [--prefix P]
    python -m tierforge silver --lake LAKE [TABLE ...]
    python -m tierforge gold   --lake LAKE [REPORT ...]
    python -m tierforge check  --lake LAKE
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession

from tierforge.functions.casts import MONEY
from tierforge.plans.bronze import retail_manifest
from tierforge.plans.run import (
    LAYERS,
    REPORTS,
    _Lake,
    run_checks,
    run_gold,
    run_pipeline,
    run_profiles,
    run_silver,
)
from tierforge.plans.silver import SILVER
from tierforge.session import build_session
from tierforge.sources.ingest import ingest_all
from tierforge.sources.tables import layer_path


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tierforge")
    parser.add_argument("step", choices=["run", "bronze", "silver", "gold", "check"])
    parser.add_argument("tables", nargs="*", help="silver tables or gold reports, default all")
    parser.add_argument("--lake", required=True, help="directory of the three layers")
    parser.add_argument("--raw", help="directory of the CSV files")
    parser.add_argument("--prefix", default="", help="what the names of the CSV files start with")
    parser.add_argument("--database", default="default", help="catalog database, empty for none")
    parser.add_argument("--money", default=MONEY, help="type of amounts")
    parser.add_argument("--lenient", action="store_true", help="go on without files that do not land")
    parser.add_argument("--threads", type=int, default=4, help="tables computed at a time")
    chosen = parser.parse_args(argv)
    if chosen.step in ("run", "bronze") and not chosen.raw:
        parser.error(f"{chosen.step} needs --raw")
    return chosen


def _show(title: str, df: DataFrame, lines: int = 100) -> None:
    """Prints some rows and says how many there are; a whole run also stores them all, below ``meta``."""
    total = df.count()
    print(f"\n{title}: {total} rows" + (f", the first {lines}" if total > lines else ""))
    df.show(lines, truncate=False)


def _stored(spark: SparkSession, lake_dir: str, name: str, df: DataFrame) -> DataFrame:
    return _Lake(spark, lake_dir, None).report(df, name, uuid.uuid4().hex)


def main(argv: list[str] | None = None) -> None:
    chosen = _arguments(argv)
    spark = build_session(f"tierforge {chosen.step}")
    where = {"database": chosen.database or None}
    manifest = retail_manifest(chosen.prefix)
    if chosen.step == "run":
        result = run_pipeline(
            spark,
            chosen.raw,
            chosen.lake,
            manifest=manifest,
            money=chosen.money,
            threads=chosen.threads,
            strict=not chosen.lenient,
            **where,
        )
        for title, df in result._asdict().items():
            _show(title, df)
    elif chosen.step == "bronze":
        bronze_dir = layer_path(chosen.lake, LAYERS["bronze"])
        status = ingest_all(spark, manifest, chosen.raw, bronze_dir, not chosen.lenient, chosen.threads)
        _show("ingest", _stored(spark, chosen.lake, "ingest", status))
    elif chosen.step == "silver":
        tables = chosen.tables or tuple(SILVER)
        options = {"money": chosen.money, "threads": chosen.threads, **where}
        _show("metrics", _stored(spark, chosen.lake, "metrics", run_silver(spark, chosen.lake, tables=tables, **options)))
        _show("profiles", _stored(spark, chosen.lake, "profiles", run_profiles(spark, chosen.lake, tables=tables, **where)))
    elif chosen.step == "gold":
        reports = chosen.tables or tuple(REPORTS)
        run_gold(spark, chosen.lake, reports=reports, threads=chosen.threads, **where)
    else:
        checks = run_checks(spark, chosen.lake, database=chosen.database or None)
        _show("checks", _stored(spark, chosen.lake, "checks", checks))


if __name__ == "__main__":
    main()
