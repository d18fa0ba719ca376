"""Landing of only what is new."""

import os
import time

import pytest

from tierforge.sources import land_new, ledger, read_landed, read_ledger, vacuum_landed


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw").mkdir()

    def write(name, text):
        path = tmp_path / "raw" / name
        path.write_bytes(text.encode())
        # Another time, whatever the clock's resolution.
        write.clock += 10
        os.utime(path, (write.clock, write.clock))
        return path

    write.clock = int(time.time()) - 10_000
    return write


def land(spark, tmp_path, **options):
    status = land_new(spark, str(tmp_path / "raw/*.csv"), str(tmp_path / "brz"), "t", **options)
    return {row.path.rpartition("/")[2]: (row.action, row.rows, row.corrupt) for row in status.collect()}


def table(spark, tmp_path):
    return sorted((r.a, r.b) for r in read_landed(spark, str(tmp_path / "brz"), "t").collect())


def parts(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "brz/t").rglob("*.parquet")}


def test_only_new_and_changed_files_are_landed(spark, tmp_path, raw):
    raw("one.csv", "a,b\n1,x\n2,y\n")
    raw("two files+%.csv", 'b,a\n"p\nq",3\n')
    assert land(spark, tmp_path) == {"one.csv": ("landed", 2, 0), "two%20files+%25.csv": ("landed", 1, 0)}
    assert table(spark, tmp_path) == [("1", "x"), ("2", "y"), ("3", "p\nq")]

    before = parts(tmp_path)
    assert {action for action, *_ in land(spark, tmp_path).values()} == {"unchanged"}
    assert parts(tmp_path) == before

    raw("one.csv", "a,b\n1,z\n9\n")
    raw("three.csv", "a,b\n7,w\n")
    again = land(spark, tmp_path)
    assert again["one.csv"] == ("replaced", 2, 1) and again["three.csv"] == ("landed", 1, 0)
    assert again["two%20files+%25.csv"] == ("unchanged", 1, 0)
    assert table(spark, tmp_path) == [("1", "z"), ("3", "p\nq"), ("7", "w"), ("9", None)]
    # Nothing that was there is touched; the old version goes when it is asked for.
    assert before.items() <= parts(tmp_path).items()
    assert vacuum_landed(spark, str(tmp_path / "brz"), "t") == 1
    assert table(spark, tmp_path) == [("1", "z"), ("3", "p\nq"), ("7", "w"), ("9", None)]


def test_files_without_rows_and_files_that_are_gone(spark, tmp_path, raw):
    raw("one.csv", "a,b\n1,x\n")
    raw("empty.csv", "")
    raw("header.csv", "a,b\n")
    assert land(spark, tmp_path) == {"one.csv": ("landed", 1, 0), "empty.csv": ("landed", 0, 0), "header.csv": ("landed", 0, 0)}
    raw("one.csv", "a,b\n")
    path = raw("header.csv", "a,b\n5,n\n")
    assert land(spark, tmp_path)["one.csv"] == ("replaced", 0, 0)
    assert table(spark, tmp_path) == [("5", "n")]
    path.unlink()
    assert "header.csv" not in land(spark, tmp_path)
    assert table(spark, tmp_path) == [("5", "n")]


def test_a_run_that_died_is_repeated(spark, tmp_path, raw, monkeypatch):
    raw("one.csv", "a,b\n1,x\n")
    land(spark, tmp_path)
    raw("one.csv", "a,b\n1,y\n2,z\n")
    raw("two.csv", "a,b\n3,w\n")

    def dies(*args):
        raise OSError("lost")

    # The rows are written, the entry in the ledger is not.
    monkeypatch.setattr(ledger, "ledger_path", lambda *args, real=ledger.ledger_path, calls=[]: calls.append(1) or (dies() if len(calls) > 1 else real(*args)))  # noqa: B006
    with pytest.raises(OSError, match="lost"):
        land(spark, tmp_path)
    monkeypatch.undo()
    assert table(spark, tmp_path) == [("1", "x")]
    assert {k: v[:2] for k, v in land(spark, tmp_path).items()} == {"one.csv": ("replaced", 2), "two.csv": ("landed", 1)}
    assert table(spark, tmp_path) == [("1", "y"), ("2", "z"), ("3", "w")]


def test_other_columns_land_nothing(spark, tmp_path, raw):
    raw("one.csv", "a,b\n1,x\n")
    land(spark, tmp_path)
    raw("two.csv", "a,c\n1,x\n")
    with pytest.raises(ValueError, match="columns"):
        land(spark, tmp_path)
    assert table(spark, tmp_path) == [("1", "x")] and read_ledger(spark, str(tmp_path / "brz"), "t").count() == 1


def test_unknown_path(spark, tmp_path):
    assert read_ledger(spark, str(tmp_path), "nothing").count() == 0
