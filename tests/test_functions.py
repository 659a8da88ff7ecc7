"""Column functions: postal codes, locale numbers, missing markers, dates, store casts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions import (format_timestamp, na_to_null, parse_locale_number,
                                  parse_timestamp, postal_normalize, sentinel, to_store_decimal)


def one_col(spark, values, type_):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def test_postal_normalize_edges(spark):
    df = one_col(spark, [None, 2101.0, 90210.0, 123456.0, 90210.9, 0.0, 7.0, -5.0], "double")
    got = [r[0] for r in df.select(postal_normalize("x")).collect()]
    assert got == ["00000", "02101", "90210", "123456", "90210", "00000", "00007", "-0005"]


def test_postal_text_strict_raises_lenient_stays(spark):
    df = one_col(spark, ["V5K 0A1", "02101-1234", "2101", None], "string")
    assert [r[0] for r in df.select(postal_normalize("x", lenient=True)).collect()] == \
        ["V5K 0A1", "02101-1234", "02101", "00000"]
    with pytest.raises(PySparkException):
        df.select(postal_normalize("x")).collect()


def test_locale_numbers(spark):
    df = one_col(spark, ["1 234,56", "7", "NA", "", "1 000,5", "abc", None], "string")
    got = [r[0] for r in df.select(parse_locale_number(na_to_null("x"))).collect()]
    assert got == [1234.56, 7.0, None, None, 1000.5, None, None]


def test_locale_numbers_strict_raises(spark):
    df = one_col(spark, ["abc"], "string")
    with pytest.raises(PySparkException):
        df.select(parse_locale_number("x", strict=True)).collect()


def test_na_markers(spark):
    df = one_col(spark, ["NA", "N/A", "null", "nan", "", "None", "x", " NA"], "string")
    got = [r[0] for r in df.select(na_to_null("x")).collect()]
    assert got == [None, None, None, None, None, None, "x", " NA"]


def test_store_decimal_rounds_half_up_and_overflow_raises(spark):
    df = one_col(spark, [1.00005, -1.00005, 1.00001, 1.00002], "double")
    got = [r[0] for r in df.select(to_store_decimal("x", "decimal(12,4)")).collect()]
    assert got == [Decimal("1.0001"), Decimal("-1.0001"), Decimal("1.0000"), Decimal("1.0000")]
    big = one_col(spark, [123456789.5], "double")
    with pytest.raises(PySparkException):
        big.select(to_store_decimal("x", "decimal(12,4)")).collect()


def test_dates_parse_and_format(spark):
    df = one_col(spark, ["2020-01-02 03:04:05", None], "string")
    parsed = df.select(parse_timestamp("x", "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert [r[0] for r in parsed.collect()] == [dt.datetime(2020, 1, 2, 3, 4, 5), None]
    back = parsed.select(format_timestamp("t"))
    assert [r[0] for r in back.collect()] == ["2020-01-02 03:04:05", None]
    bad = one_col(spark, ["not a date"], "string")
    assert bad.select(parse_timestamp("x", "yyyy-MM-dd HH:mm:ss", lenient=True)).first()[0] is None


def test_sentinel(spark):
    df = one_col(spark, [None, 5], "bigint")
    assert [r[0] for r in df.select(sentinel("x")).collect()] == ["-", "5"]
    assert df.select(sentinel(F.col("x"), "n/a")).first()[0] == "n/a"


def test_dates_in_several_formats(spark):
    df = one_col(spark, ["11/8/2016", "2016-11-08 00:00:00", "2016-11-08", "1/2/2017", None, "junk"],
                 "string")
    fmts = ("M/d/yyyy", "yyyy-MM-dd HH:mm:ss")
    got = [r[0] for r in df.select(parse_timestamp("x", fmts, lenient=True)).collect()]
    d = dt.datetime(2016, 11, 8)
    assert got == [d, d, d, dt.datetime(2017, 1, 2), None, None]
    assert [r[0] for r in df.filter("x IS NULL OR x != 'junk'").select(parse_timestamp("x", fmts)).collect()] \
        == [d, d, d, dt.datetime(2017, 1, 2), None]
    with pytest.raises(PySparkException):
        df.select(parse_timestamp("x", fmts)).collect()
