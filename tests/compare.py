"""Compares every registered query with its SQL twin: python tests/compare.py SF [name ...]"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def compare(spark, con, sf_dir, name):
    """None when schema and rows agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = df.collect()
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    expected_kinds = {d[0]: str(d[1]) for d in cursor.description}
    for column, kind in df.dtypes:
        if kinds.get(kind, kind) != expected_kinds[column]:
            return f"type of {column}: {kind} against {expected_kinds[column]}"
    want = sorted(tuple(norm(dict(zip(columns, row))[c]) for c in sorted(columns)) for row in cursor.fetchall())
    have = sorted(tuple(norm(row[c]) for c in sorted(columns)) for row in got)
    if have != want:
        extra, missing = [r for r in have if r not in set(want)][:3], [r for r in want if r not in set(have)][:3]
        return f"{len(have)} rows against {len(want)}; only Spark {extra}; only SQL {missing}"
    return None if have else "no rows"


if __name__ == "__main__":
    from tierforge.session import build_session

    sf = f"/root/testdata/sf{sys.argv[1]}"
    session = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    twin = connect(sf)
    bad = 0
    for query in sys.argv[2:] or entry.oracle_sql():
        start = time.time()
        try:
            problem = compare(session, twin, sf, query)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {query} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
