"""Golden rows for string and column-name normal forms."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.cleaning import (normalize_column_name, normalize_column_names,
                                         normalize_strings)


def test_normalize_strings_golden(spark):
    rows = [("foo_bar",), ("_",), ("  ",), ("",), (None,), ("__a__b_",), ("iPHONE_x",), ("a\tb_c",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.s for r in normalize_strings(df, ["s"]).collect()]
    assert got == ["Foo Bar", None, None, None, None, "A  B", "Iphone X", "A\tb C"]


def test_normalize_strings_casts_non_string(spark):
    df = spark.createDataFrame([(1, "x_y")], "n int, s string")
    out = normalize_strings(df, "n, s")
    assert dict(out.dtypes)["n"] == "string"
    assert out.first().asDict() == {"n": "1", "s": "X Y"}


def test_normalize_strings_single_projection(spark):
    df = spark.createDataFrame([("a_b", "c_d")], "x string, y string")
    plan = normalize_strings(df, ["x", "y"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 2


@pytest.mark.parametrize("name,want", [
    (" firstName ", "first_name"), ("userID", "user_id"), ("HTTPServer", "httpserver"),
    ("col1Name", "col1name"), ("total (USD)", "total_usd"), ("_private", "_private"),
    ("a.b", "a_b"), ("aBcD", "a_bc_d"), ("MKT_Segment__", "mkt_segment"),
    ("acctBal (USD)", "acct_bal_usd"), ("nation-Key", "nation_key"),
])
def test_normalize_column_name(name, want):
    assert normalize_column_name(name) == want


def test_normalize_column_names_keeps_order_and_values(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `Weird Name` int, `x``y` int")
    out = normalize_column_names(df)
    assert out.columns == ["a_b", "weird_name", "x_y"]
    assert tuple(out.first()) == (1, 2, 3)


def test_normalize_column_names_raises_on_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="both normalise"):
        normalize_column_names(df)


def test_normalize_column_names_raises_on_empty(spark):
    df = spark.createDataFrame([(1,)], "`___` int")
    with pytest.raises(ValueError, match="empty"):
        normalize_column_names(df)
