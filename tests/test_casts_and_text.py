from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierforge.functions import to_timestamp, was_rounded
from tierforge.operators import (
    blank_to_null,
    cast_columns,
    cast_report,
    days_between,
    default_if_blank,
    delay_features,
    fill_text,
    flag,
    has_text,
    map_values,
    month_bucket,
    on_time_label,
    parse_timestamps,
    standardize_text,
)

MOMENT = datetime(2017, 10, 2, 10, 56, 33)


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, name="t"):
    return [row[name] for row in df.orderBy("i").collect()]


def test_timestamps_must_match_the_whole_format(spark):
    df = texts(
        spark,
        "2017-10-02 10:56:33",
        "2017-10-02",
        "2017-10-02 10:56:33.5",
        "2017-10-02 10:56:33abc",
        "2017-1-2 3:4:5",
        "2017-13-45 10:00:00",
        "",
        None,
    )
    assert column(parse_timestamps(df, ["t"])) == [MOMENT] + [None] * 7
    report = cast_report(df, {"t": to_timestamp()}).first()
    assert tuple(report) == ("t", 8, 2, 5, 1)


def test_default_timestamp_parsing_takes_dates_and_fractions(spark):
    df = texts(spark, "2017-10-02 10:56:33", "2017-10-02", "2017-10-02 10:56:33.5", "x", None)
    assert column(parse_timestamps(df, ["t"], fmt=None)) == [
        MOMENT,
        datetime(2017, 10, 2),
        datetime(2017, 10, 2, 10, 56, 33, 500000),
        None,
        None,
    ]


def test_integers(spark):
    df = texts(spark, "5", " 5 ", "5.0", "abc", "")
    assert column(cast_columns(df, {"t": "int"})) == [5, 5, None, None, None]
    assert tuple(cast_report(df, {"t": "int"}).first()) == ("t", 5, 1, 2, 2)


def test_doubles_and_floats(spark):
    df = texts(spark, "1.5", "1e3", "x")
    assert column(cast_columns(df, {"t": "double"})) == [1.5, 1000.0, None]
    assert column(cast_columns(texts(spark, "1.1"), {"t": "float"})) == [pytest.approx(1.1)]


def test_rounded_amounts_are_seen(spark):
    df = texts(spark, "10.99", "10.999", "1e3", "x", None, "10.990", "1e-3")
    assert column(df.withColumn("t", was_rounded(F.col("t"), F.col("t").try_cast("decimal(18,2)")))) == [
        False,
        True,
        False,
        False,
        False,
        False,
        True,
    ]


def test_blank_to_null_then_int(spark):
    df = cast_columns(blank_to_null(texts(spark, "", None, "40"), ["t"]), {"t": "int"})
    assert column(df) == [None, None, 40]


def test_default_only_for_blanks(spark):
    df = texts(spark, "", None, "12.5", "junk")
    assert column(default_if_blank(df, {"t": ("double", 0.0)})) == [0.0, 0.0, 12.5, None]
    assert default_if_blank(df, {"t": ("double", 0.0)}).schema["t"].dataType.simpleString() == "double"


def test_standard_text(spark):
    df = texts(spark, "  sao paulo ", "SAO  PAULO", "d'oeste", "mogi-guacu", None)
    assert column(standardize_text(df, {"t": "title"})) == [
        "Sao Paulo",
        "Sao  Paulo",
        "D'oeste",
        "Mogi-guacu",
        None,
    ]
    assert column(standardize_text(df, {"t": "title"}, collapse_whitespace=True))[1] == "Sao Paulo"
    assert column(standardize_text(texts(spark, " sp "), {"t": "upper"})) == ["SP"]
    assert column(standardize_text(texts(spark, " SP "), {"t": "lower"})) == ["sp"]
    assert column(standardize_text(texts(spark, " 01 "), {"t": "trim"})) == ["01"]
    with pytest.raises(ValueError):
        standardize_text(df, {"t": "camel"})


def test_codes(spark):
    labels = {"credit_card": "Credit Card", "boleto": "Boleto"}
    df = standardize_text(texts(spark, "credit_card", " BOLETO ", "not_defined", None), {"t": "lower"})
    assert column(map_values(df, "t", labels)) == ["Credit Card", "Boleto", "not_defined", None]
    assert column(map_values(df, "t", labels, default="?")) == ["Credit Card", "Boleto", "?", "?"]
    assert column(map_values(df, "t", {})) == column(df)


def test_any_text(spark):
    df = spark.createDataFrame(
        [(0, "", ""), (1, "t", ""), (2, "", "m"), (3, "  ", "  "), (4, None, None), (5, None, "m")],
        "i int, a string, b string",
    )
    assert column(has_text(fill_text(df, ["a", "b"]), ["a", "b"], "t")) == [0, 1, 1, 0, 0, 1]
    assert column(has_text(df, ["a", "b"], "t"))[4:] == [0, 1]


def test_flag_of_unknown_is_false(spark):
    df = spark.createDataFrame([(0, 1), (1, 0), (2, -3), (3, None)], "i int, d int")
    assert column(flag(df, "t", F.col("d") > 0)) == [True, False, False, False]


def test_on_time_label_compares_moments(spark):
    due = datetime(2020, 1, 2, 10)
    df = spark.createDataFrame(
        [(0, datetime(2020, 1, 1), due), (1, due, due), (2, datetime(2020, 1, 2, 11), due), (3, due, None)],
        "i int, a timestamp, b timestamp",
    )
    assert column(on_time_label(df, "a", "b", "t")) == ["On Time", "On Time", "Late", "Late"]


def test_calendar_days_and_month(spark):
    df = spark.createDataFrame(
        [(0, datetime(2017, 10, 2, 23, 59), datetime(2017, 10, 3, 0, 1))], "i int, a timestamp, b timestamp"
    )
    assert column(days_between(df, "a", "b", "t")) == [1]
    assert column(month_bucket(df, "a", "t")) == ["2017-10"]


def test_delay_features(spark):
    start, due = datetime(2020, 1, 1, 12), datetime(2020, 1, 10)
    df = spark.createDataFrame(
        [(0, start, due, datetime(2020, 1, 10, 8)), (1, start, due, datetime(2020, 1, 12)), (2, start, None, due)],
        "i int, s timestamp, d timestamp, a timestamp",
    )
    got = delay_features(df, "s", "d", "a").orderBy("i").collect()
    assert [tuple(r)[4:] for r in got] == [(9, 9, 0, False), (9, 11, 2, True), (None, 9, None, False)]


AWKWARD = [
    "5", " 5 ", "\t5\n", "+5", "-5", "--5", "5.0", "5.", ".5", "1e3", "", " ", "abc", "5 5", "٣", "\u00005",
    " 5", "99999999999", "2147483647", "-2147483648", "007", "0x1F", "NaN", None, "5\u007f", "1_000",
]


def test_guarded_integers_are_what_a_plain_cast_reads(spark):
    df = texts(spark, *AWKWARD)
    for kind in ("int", "bigint"):
        plain = df.withColumn("t", F.col("t").try_cast(kind))
        assert column(cast_columns(df, {"t": kind})) == column(plain)


def test_guarded_timestamps_are_what_the_format_reads(spark):
    df = texts(
        spark, "2017-10-02 10:56:33", "2017-02-29 00:00:00", "2016-02-29 00:00:00", "2017-10-02 24:00:00",
        "2017-10-02 23:59:60", "2017-10-02T10:56:33", " 2017-10-02 10:56:33", "2017-10-02 10:56:33 ",
        "2017-10-02 10:56:33Z", "2017-10-02 10:56", "9999-12-31 23:59:59", "1000-01-01 00:00:00",
        "2017-10-02  0:56:33", "2017-00-02 10:56:33", "+2017-10-02 10:56:33", "12017-10-02 10:56:33", None, "",
    )
    by_format = df.withColumn("t", F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss")))
    assert column(parse_timestamps(df, ["t"])) == column(by_format)
    day = texts(spark, "02/10/2017", "2017-10-02")
    assert column(parse_timestamps(day, ["t"], fmt="dd/MM/yyyy")) == [datetime(2017, 10, 2), None]


def test_rounding_is_seen_to_the_last_digit(spark):
    texts = {
        "1.00": False, "1.5000": False, "1.005": True, "2": False, "1.0000000000000000000001": True, " 7.250 ": False,
        "-3.999": True, "1e-20": True, "1.5e1": False, "1.0051e1": True, None: False, "oops": False, "0.120000000000000000000000": False,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    amount = F.col("t").try_cast("decimal(18,2)")
    got = {r.t: r.rounded for r in df.select("t", was_rounded(F.col("t"), amount).alias("rounded")).collect()}
    assert got == texts
