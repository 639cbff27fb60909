import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenderloom.functions import calendar, casts, text
from tenderloom.schemas import MONEY, RATE

DAY = dt.datetime(2026, 1, 5)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def read(df, parsed):
    return [r[0] for r in casts.select_typed(df, [parsed]).collect()]


@pytest.mark.parametrize(
    "zone, expected",
    [
        ("A, B, C", ("A", "B", "C")),
        ("A,B", ("A", "B", None)),
        ("", (None, None, None)),
        (" , ,C", (None, None, "C")),
        (None, (None, None, None)),
        ("A, B, C, D", ("A", "B", "C")),
    ],
)
def test_geography(spark, zone, expected):
    row = texts(spark, zone).select(*text.geography(F.col("t"))).first()
    assert (row.distrito, row.canton, row.provincia) == expected


def test_composite_key_keeps_separator_and_skips_null(spark):
    df = spark.createDataFrame([("S1", "1"), ("S1", None), (None, "1"), (None, None)], "a string, b string")
    keys = [r[0] for r in df.select(text.composite_key(F.col("a"), F.col("b"))).collect()]
    assert keys == ["S1_1", "S1_", "_1", "_"]


@pytest.mark.parametrize(
    "code, cut, valid",
    [
        ("1234567890123456", "1234567890123456", True),
        ("  1234567890123456 ", "1234567890123456", True),
        ("12345678901234567890", "1234567890123456", True),
        ("123456789012345", "123456789012345", False),
        ("X234567890123456", "X234567890123456", False),
        ("1234567890123456\n", "1234567890123456", True),
        ("", "", False),
    ],
)
def test_product_code(spark, code, cut, valid):
    got = text.product_code(F.col("t"))
    row = texts(spark, code).select(got.alias("c"), text.is_product_code(got).alias("v")).first()
    assert (row.c, row.v) == (cut, valid)


def test_hierarchy_honours_leading_zeros(spark):
    row = texts(spark, "0112345678901234").select(*text.hierarchy(F.col("t"))).first()
    assert tuple(row) == (1, 112, 11234, 1123456)


def test_blank_to_null_leaves_spaces(spark):
    got = texts(spark, "", " ", None, "x").select(text.blank_to_null(F.col("t"))).collect()
    assert [r[0] for r in got] == [None, " ", None, "x"]


def test_numbers(spark):
    df = texts(spark, "", None, "1.00005", "-1.00005", "12")
    got = read(df, casts.number("n", F.col("t"), MONEY))
    assert [None if v is None else str(v) for v in got] == [None, None, "1.0001", "-1.0001", "12.0000"]
    assert [str(v) for v in read(texts(spark, "512.123456"), casts.number("n", F.col("t"), RATE))] == ["512.123456"]
    assert read(texts(spark, "01", " 7 "), casts.number("n", F.col("t"), "int")) == [1, 7]


@pytest.mark.parametrize(
    "value, type_",
    [
        (" ", MONEY),
        ("abc", MONEY),
        ("123456789012345", MONEY),
        ("1.0", "int"),
        ("3000000000", "int"),
        ("12345678901234567890", "bigint"),
    ],
)
def test_unreadable_number_stops_or_is_flagged(spark, value, type_):
    df = texts(spark, value, "1")
    parsed = casts.number("n", F.col("t"), type_)
    with pytest.raises(Exception, match="n: cannot read"):
        read(df, parsed)
    flagged = casts.select_typed(df, [F.col("t"), parsed], on_error="flag")
    clean, rejected = casts.split_rejected(flagged)
    assert [r.t for r in clean.collect()] == ["1"]
    assert [(r.t, r.n, r.rejected_columns) for r in rejected.collect()] == [(value, None, ["n"])]


def test_strict_reading_does_not_depend_on_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot read"):
            read(texts(spark, "abc"), casts.number("n", F.col("t"), "int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2026-01-05 13:14:15.678", DAY),
        ("2026-01-05 13:14:15 (hora local)", DAY),
        ("2026-01-05", DAY),
        ("2026-1-5 3:04:05", DAY),
        ("", None),
        (None, None),
    ],
)
def test_day_of_timestamp(spark, value, expected):
    assert read(texts(spark, value), casts.day_of_timestamp("d", F.col("t"))) == [expected]


@pytest.mark.parametrize("value", ["2026-01-05 25:00:00", "05/01/2026", " ", "2026-02-30 00:00:00"])
def test_bad_timestamp_stops(spark, value):
    with pytest.raises(Exception, match="d: cannot read"):
        read(texts(spark, value), casts.day_of_timestamp("d", F.col("t")))


@pytest.mark.parametrize(
    "value, expected",
    [
        ("05/01/2026", DAY.date()),
        ("5/1/2026", DAY.date()),
        ("05/01/2026 00:00", DAY.date()),
        ("", None),
        (None, None),
    ],
)
def test_day_first_date(spark, value, expected):
    assert read(texts(spark, value), casts.day_first_date("d", F.col("t"))) == [expected]


@pytest.mark.parametrize("value", ["2026-01-05", "31/02/2026", " "])
def test_bad_day_first_date_stops(spark, value):
    with pytest.raises(Exception, match="d: cannot read"):
        read(texts(spark, value), casts.day_first_date("d", F.col("t")))


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        casts.select_typed(texts(spark, "1"), [casts.number("n", F.col("t"), "int")], on_error="ignore")


def test_month_edges(spark):
    stamps = ["2025-12-31 23:59:59.999999", "2026-01-01 00:00:00", "2026-01-31 23:59:59.999999", "2026-02-01 00:00:00"]
    df = texts(spark, *stamps).select(F.col("t").cast("timestamp_ntz").alias("ts"))
    inside = [r[0] for r in df.select(calendar.in_month(F.col("ts"), 2026, 1)).collect()]
    assert inside == [False, True, True, False]
    december = [r[0] for r in df.select(calendar.in_month(F.col("ts"), 2025, 12)).collect()]
    assert december == [True, False, False, False]


def test_last_periods_cross_the_year(spark):
    df = texts(spark, "202507", "202508", "202602", "202603")
    got = df.where(calendar.in_last_periods(F.col("t"), dt.date(2026, 2, 10))).collect()
    assert [r.t for r in got] == ["202508", "202602"]
    one = df.where(calendar.in_last_periods(F.col("t"), dt.date(2026, 2, 10), months=1)).collect()
    assert [r.t for r in one] == ["202602"]
