import pytest

from tierforge.sources import CORRUPT, ingest_all, read_layer, read_raw_csv, read_table_or_path
from tierforge.sources.raw_csv import has_record_per_line
from tierforge.sinks import preview, publish_table, write_layer


@pytest.fixture
def csv(tmp_path):
    def write(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    return write


def test_byte_order_mark_is_dropped_and_types_stay_text(spark, csv):
    df = read_raw_csv(spark, csv("a.csv", "code,n\nx,007\n", "utf-8-sig"))
    assert df.columns == ["code", "n", CORRUPT]
    assert df.dtypes[1] == ("n", "string")
    assert df.first().n == "007"


@pytest.mark.parametrize("multiline", [True, "auto"])
def test_quoted_line_breaks_and_doubled_quotes(spark, csv, multiline):
    text = 'id,text\n1,"x\ny"\n2,"he said ""hi"", ok"\n3,\n4,""\n'
    df = read_raw_csv(spark, csv("a.csv", text), multiline=multiline)
    assert [tuple(r)[:2] for r in df.orderBy("id").collect()] == [
        ("1", "x\ny"),
        ("2", 'he said "hi", ok'),
        ("3", None),
        ("4", None),
    ]


def test_backslash_escape_is_an_option(spark, csv):
    df = read_raw_csv(spark, csv("a.csv", 'id,text\n1,"a \\"b\\", c"\n'), escape="\\")
    assert df.first().text == 'a "b", c'


@pytest.mark.parametrize("multiline", [True, False])
def test_short_and_long_rows_are_flagged(spark, csv, multiline):
    df = read_raw_csv(spark, csv("a.csv", "a,b\n1\n1,2\n1,2,3\n"), multiline=multiline).cache()
    got = sorted(((r.a, r.b, r[CORRUPT] is not None) for r in df.collect()), key=str)
    assert got == [("1", "2", False), ("1", "2", True), ("1", None, True)]


def test_given_columns_and_no_corrupt_column(spark, csv):
    df = read_raw_csv(spark, csv("a.csv", "a,b\n1,2\n"), columns=["x", "y"], corrupt_column=None)
    assert df.columns == ["x", "y"] and tuple(df.first()) == ("1", "2")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a,b\n1,2\n", True),
        ('a,b\n"1,5","say ""hi"""\n', True),
        ('a,b\r\n"1",""\r\n', True),
        ('a,b\n"""",x\n', True),
        ('a,b\n1,"x\ny"\n', False),
        ('a,b\n5" pipe,"x\ny"\n', False),
        ('a,b\n1, "x"\n', False),
        ('a,b\n1,x\ry\n', False),
        ("a,b\n1,2\n  \n", False),
        ('a,b\n"x"y,2\n', False),
    ],
)
def test_when_lines_are_records(spark, csv, text, expected):
    assert has_record_per_line(spark, csv("a.csv", text)) is expected


AWKWARD = [
    'a,b\n"1,5","say ""hi"""\n"",x\n,\n',
    'a,b\r\n1,"q"\r\n2,w\r\n',
    'a,b\n5" pipe,"x\ny"\n7,8\n',
    "a,b\n1,2\n  \n3,4\n\n5,6\n",
    'a,b\n"x"y,2\n1,2\n',
    'a,b\n"open,2\n1,2\n',
]


@pytest.mark.parametrize("text", AWKWARD)
def test_auto_reads_what_multiline_reads(spark, csv, rows, text):
    path = csv("a.csv", text)
    auto = read_raw_csv(spark, path, multiline="auto")
    whole = read_raw_csv(spark, path, multiline=True)
    assert auto.columns == whole.columns
    assert rows(auto, "a", "b") == rows(whole, "a", "b")


def test_ingest_isolates_failures_and_strict_raises(spark, csv, tmp_path):
    csv("one.csv", "a,b\n1,2\n3\n")
    csv("two.csv", 'a\n"x\ny"\n')
    manifest = [("one.csv", "t1"), ("missing.csv", "t2"), ("two.csv", "t3")]
    lake = str(tmp_path / "brz")
    status = {r.file: r for r in ingest_all(spark, manifest, str(tmp_path), lake).collect()}
    assert (status["one.csv"].rows, status["one.csv"].cols, status["one.csv"].corrupt) == (2, 2, 1)
    assert status["two.csv"].rows == 1 and status["two.csv"].error is None
    assert status["missing.csv"].rows is None and status["missing.csv"].error
    with pytest.raises(RuntimeError, match="missing.csv"):
        ingest_all(spark, manifest, str(tmp_path), lake, strict=True)
    assert read_layer(spark, lake, "t3").first().a == "x\ny"


def test_write_layer_replaces_everything_under_dynamic_mode(spark, tmp_path, rows):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
        write_layer(first, str(tmp_path), "t", partition_by=["p"])
        write_layer(first.filter("p = 'b'"), str(tmp_path), "t", partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_layer(spark, str(tmp_path), "t")) == [(2, "b")]


def test_publish_twice_keeps_only_the_second_content(spark, tmp_path, rows):
    path = str(tmp_path / "pub")
    name = "default.published_twice"
    assert publish_table(spark.createDataFrame([(1,)], "a int"), name, path)
    assert rows(spark.table(name)) == [(1,)]
    assert publish_table(spark.createDataFrame([(2,)], "a int"), name, path)
    assert rows(spark.table(name)) == [(2,)]
    assert publish_table(spark.createDataFrame([("x", 3)], "b string, a int"), name, path)
    assert spark.table(name).columns == ["b", "a"]
    assert rows(spark.table(name)) == [("x", 3)]
    moved = str(tmp_path / "else'where")
    assert publish_table(spark.createDataFrame([("y", 4)], "b string, a int"), name, moved)
    assert rows(spark.table(name)) == [("y", 4)]
    detail = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {name}").collect()}
    assert detail["Type"] == "EXTERNAL"
    spark.sql(f"drop table {name}")
    spark.createDataFrame([("managed", 0)], "b string, a int").write.saveAsTable(name)
    assert publish_table(spark.createDataFrame([("z", 5)], "b string, a int"), name, path, strict=True)
    assert rows(spark.table(name)) == [("z", 5)] == rows(spark.read.parquet(path))
    spark.sql(f"drop table {name}")
    assert rows(spark.read.parquet(moved)) == [("y", 4)]


def test_publish_partitioned(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    path = str(tmp_path / "part")
    for _ in range(2):
        assert publish_table(df, "default.published_parts", path, partition_by=["p"], strict=True)
    assert rows(spark.table("default.published_parts")) == [(1, "a"), (2, "b")]
    spark.sql("drop table default.published_parts")


def test_failed_registration_warns_and_keeps_the_data(spark, tmp_path, rows):
    df = spark.createDataFrame([(1,)], "a int")
    path = str(tmp_path / "pub")
    with pytest.warns(UserWarning, match="not registered"):
        assert not publish_table(df, "no_such_database.t", path)
    assert rows(spark.read.parquet(path)) == [(1,)]
    with pytest.raises(Exception):
        publish_table(df, "no_such_database.t", path, strict=True)


def test_table_first_then_path(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    spark.createDataFrame([("file",)], "a string").write.parquet(path)
    assert rows(read_table_or_path(spark, "default.not_there", path)) == [("file",)]
    assert rows(read_table_or_path(spark, "no_such_database.not_there", path)) == [("file",)]
    other = spark.createDataFrame([("table",)], "a string")
    publish_table(other, "default.is_there", str(tmp_path / "t"))
    assert rows(read_table_or_path(spark, "default.is_there", path)) == [("table",)]
    spark.sql("drop table default.is_there")


def test_preview(spark):
    df = spark.range(20).selectExpr("id", "id * 2 as twice")
    assert preview(df, ["twice"], 3).columns == ["twice"]
    assert preview(df).count() == 5


def test_files_with_swapped_columns_are_read_by_name(spark, csv, tmp_path, rows):
    (tmp_path / "many").mkdir()
    csv("many/a.csv", "id,price\n1,2.5\n")
    csv("many/b c.csv", '﻿price,id\r\n7.25,2\r\n"8\n9",3\r\n')
    for multiline in ("auto", True):
        df = read_raw_csv(spark, str(tmp_path / "many"), multiline=multiline)
        assert rows(df, "id", "price") == [("1", "2.5"), ("2", "7.25"), ("3", "8\n9")]
    status = ingest_all(spark, [("many", "t")], str(tmp_path), str(tmp_path / "brz")).first()
    assert (status["rows"], status.cols, status.corrupt, status.error) == (3, 2, 0, None)


def test_files_with_other_columns_are_an_error(spark, csv, tmp_path):
    (tmp_path / "many").mkdir()
    csv("many/a.csv", "id,price\n1,2.5\n")
    csv("many/b.csv", "id,cost\n2,7\n")
    with pytest.raises(ValueError, match="cost"):
        read_raw_csv(spark, str(tmp_path / "many"), multiline="auto")
    assert "cost" in ingest_all(spark, [("many", "t")], str(tmp_path), str(tmp_path / "brz")).first().error


def test_one_doubtful_file_leaves_the_others_split(spark, csv, tmp_path):
    (tmp_path / "many").mkdir()
    for i in range(8):
        csv(f"many/{i}.csv", "a,b\n" + "".join(f"{j},text\n" for j in range(2000)) + ('9,"x\ny"\n' if i == 3 else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_raw_csv(spark, str(tmp_path / "many"), multiline="auto")
        assert df.rdd.getNumPartitions() >= 7 * 4 + 1
        assert df.count() == 8 * 2000 + 1
        assert df.where("b = 'x\\ny'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_failed_write_leaves_the_old_table(spark, tmp_path, rows):
    path, name = str(tmp_path / "pub"), "default.published_safe"
    publish_table(spark.createDataFrame([(1,)], "a int"), name, path, strict=True)
    broken = spark.createDataFrame([(2,), (3,)], "a int").selectExpr("if(a = 3, raise_error('midway'), a) as a")
    with pytest.raises(Exception, match="midway"):
        publish_table(broken, name, path, strict=True)
    assert rows(spark.table(name)) == [(1,)] == rows(spark.read.parquet(path))
    publish_table(spark.read.parquet(path).selectExpr("a + 1 as a"), name, path, strict=True)
    assert rows(spark.table(name)) == [(2,)] == rows(spark.read.parquet(path))
    assert [p.name for p in tmp_path.iterdir()] == ["pub"]
    spark.sql(f"drop table {name}")


def test_headers_and_doubts_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    from tierforge.sources import raw_csv

    (tmp_path / "a.csv").write_text('x,y\n1,2\n3,4\n')
    (tmp_path / "b.csv").write_text('y,x\n"1\n2",3\n')
    plans_seen, collect = [], type(spark.range(0)).collect
    monkeypatch.setattr(
        type(spark.range(0)), "collect", lambda df: (plans_seen.append(df._jdf.queryExecution().toString()), collect(df))[1]
    )
    found = raw_csv._files(spark, str(tmp_path), '"')
    assert [(f.header, f.doubtful) for f in found] == [("x,y", False), ("y,x", True)]
    assert "ObjectHashAggregate" in plans_seen[0] and "SortAggregate" not in plans_seen[0]


def test_lines_without_quotes_are_judged_as_before(spark):
    from pyspark.sql import functions as F

    from tierforge.sources.raw_csv import _simple_line

    lines = ["", " ", "  ", " a", "a,b", "a ,", '"a",b', 'a"b', '"a', "a\r", "a\rb", " \r", '"a""b"', "\t"]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = {r.value: r.simple for r in df.select("value", _simple_line(F.col("value"), '"').alias("simple")).collect()}
    assert [line for line in lines if not got[line]] == [" ", "  ", 'a"b', '"a', "a\rb", " \r"]


def test_files_with_one_header_are_judged_by_numbers(spark, tmp_path, monkeypatch):
    """One aggregation by hash over all lines, without their text; the rest sees two rows a file."""
    from tierforge.sources import raw_csv

    for name, lines in {"a": "x,y\n1,2\n", "b": 'x,y\n"",3\n', "c": 'x,y\n"1\n2",3\n'}.items():
        (tmp_path / f"{name}.csv").write_text(lines)
    seen, collect = [], type(spark.range(0)).collect
    monkeypatch.setattr(
        type(spark.range(0)), "collect", lambda df: (seen.append(df._jdf.queryExecution().toString()), collect(df))[1]
    )
    found = raw_csv._files(spark, str(tmp_path), '"')
    assert [(f.path[-5:], f.header, f.doubtful) for f in found] == [
        ("a.csv", "x,y", False),
        ("b.csv", "x,y", False),
        ("c.csv", "x,y", True),
    ]
    assert len(seen) == 1 and "min_by" not in seen[0]


def test_the_usual_header_may_also_be_a_row(spark, tmp_path):
    """Only where it is the first line of a file is it the file's header; files without lines have none."""
    from tierforge.sources import raw_csv

    texts = ["x,y\n1,2\n", "y,x\nx,y\n3,4\n", "", "\ufeffx,y\r\n5,6\r\n", "\n\nx,y\n", "y,x\n"]
    for number, text in enumerate(texts):
        (tmp_path / f"{number}.csv").write_text(text, newline="")
    found = raw_csv._files(spark, str(tmp_path), '"')
    assert [(f.path[-5], f.header) for f in found] == [
        ("0", "x,y"), ("1", "y,x"), ("3", "x,y"), ("4", ""), ("5", "y,x"),
    ]
    assert not any(f.doubtful for f in found)


def test_lines_with_empty_quoted_fields_are_simple_without_patterns(spark):
    from pyspark.sql import functions as F

    from tierforge.sources.raw_csv import _simple_line

    good = ['""', '"",""', 'a,"",b', '"","","","",x', ',"",', '"",', ',""', 'a,"b","",c', '"a""b",""', '"",a\r', '""\r']
    bad = ['"', '"""', 'a""', '""a', 'a,""b', '"",a"b', '"", "", "x', 'a"",""b', '" ",""x', '"",a\rb', '""\r""']
    df = spark.createDataFrame([(line,) for line in good + bad], "value string")
    for escape in ('"', "\\"):
        simple = df.select("value", _simple_line(F.col("value"), escape).alias("simple"))
        assert {row.value for row in simple.collect() if row.simple} == (set(good) if escape == '"' else set())


def test_the_patterns_own_mark_beside_empty_quoted_fields(spark, tmp_path, rows):
    from tierforge.sources.raw_csv import read_raw_csv

    for name, text in {"a": 'x,y\n\x01,""\n"",b\x01\n', "b": 'x,y\n"c\n\x01",""\nd,\x01\n'}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = rows(read_raw_csv(spark, str(tmp_path), multiline="auto"))
    assert found == rows(read_raw_csv(spark, str(tmp_path), multiline=True))
    assert {row[:2] for row in found} == {("\x01", None), (None, "b\x01"), ("c\n\x01", None), ("d", "\x01")}
