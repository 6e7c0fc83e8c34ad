"""Bulk casts: to string (Spark's rendering) and date parsing modes."""

import datetime as dt
import decimal

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from tidemark.functions.casts import cast_to_date, cast_to_string


def test_cast_to_string_renders_types(spark):
    df = spark.sql("""select true as b, cast(2.0 as double) as d, cast(1.50 as decimal(10,2)) as dec,
        date'2024-01-02' as dt, timestamp_ntz'2024-01-02 03:04:05.1' as ts,
        array(1, null) as arr, map('k', 1) as m, named_struct('a', 1, 'b', 2.0D) as st,
        cast('hi' as binary) as bin, 1e7D as big, 1e-4D as small, cast(null as int) as n""")
    out = cast_to_string(df, df.columns)
    assert all(t == "string" for _, t in out.dtypes)
    assert tuple(out.first()) == ("true", "2.0", "1.50", "2024-01-02", "2024-01-02 03:04:05.1",
                                  "[1, null]", "{k -> 1}", "{1, 2.0}", "hi", "1.0E7", "1.0E-4", None)


TEXTS = ["01-15-2024", "13-45-2024", "02-30-2024", "2024-01-15", " 01-15-2024", "1-5-2024",
         "", "01-15-2024 extra", None]


def test_cast_to_date_null_mode(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string")
    got = [r.s for r in cast_to_date(df, ["s"], "MM-dd-yyyy").collect()]
    assert got == [dt.date(2024, 1, 15)] + [None] * 8


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cast_to_date_null_mode_ignores_ansi(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("13-45-2024",)], "s string")
        assert cast_to_date(df, "s", "MM-dd-yyyy").first().s is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cast_to_date_raise_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ok = spark.createDataFrame([("01-15-2024",), (None,)], "s string")
        assert [r.s for r in cast_to_date(ok, "s", "MM-dd-yyyy", on_error="raise").collect()] == \
            [dt.date(2024, 1, 15), None]
        bad = spark.createDataFrame([("13-45-2024",)], "s string")
        with pytest.raises((PySparkException, Py4JJavaError), match="cannot parse"):
            cast_to_date(bad, "s", "MM-dd-yyyy", on_error="raise").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_cast_to_date_rejects_unknown_mode(spark):
    df = spark.createDataFrame([("x",)], "s string")
    with pytest.raises(ValueError):
        cast_to_date(df, "s", "MM-dd-yyyy", on_error="ignore")
