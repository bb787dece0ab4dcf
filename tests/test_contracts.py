"""Scalar rules at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import contracts as c


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_canonical_number(spark):
    got = values(spark, c.canonical_number, ["1.50", "001.5", "+1.5", "-0", "-0.0", "1.", ".5", "1E5", "", None, "1" * 60 + ".10"])
    assert got == ["1.5", "1.5", "1.5", "0", "0", "1", "0.5", None, None, None, "1" * 60 + ".1"]


def test_exact_difference(spark):
    df = spark.createDataFrame([("1.10", "0.1"), ("99999999999999999999999999.9", "0.1"), ("9" * 40, "1"), ("x", "1")], "a string, b string")
    assert [r[0] for r in df.select(c.exact_difference(F.col("a"), F.col("b"))).collect()] == ["1", "99999999999999999999999999.8", None, None]


def test_scalar_equal(spark):
    df = spark.createDataFrame([("1.0", "1"), ("a", "a"), ("a", "b"), (None, None), (None, "1"), ("1", "a")], "a string, b string")
    assert [r[0] for r in df.select(c.scalar_equal(F.col("a"), F.col("b"))).collect()] == [True, True, False, True, False, False]


def test_market_number(spark):
    df = spark.createDataFrame([("1E2",), (" 12 ",), ("",), ("NaN",), (None,)], "a string")
    value, reason = c.market_number(F.col("a"))
    rows = [(None if r[0] is None else float(r[0]), r[1]) for r in df.select(value, reason).collect()]
    assert rows == [(100.0, None), (12.0, None), (None, None), (None, "invalid_market_number"), (None, None)]


def test_precision_bound(spark):
    got = values(spark, lambda x: F.date_format(c.precision_bound(x), "yyyy-MM-dd HH:mm"), ["2024-01-01", "2024-01-01 10:00", "2024-01-01 10:00:30", "2024/01/01", None])
    assert got == ["2024-01-01 15:00", "2024-01-01 01:01", "2024-01-01 01:00", None, None]


def test_first_reason_keeps_order(spark):
    df = spark.range(3).select(c.first_reason((F.col("id") > 1, "late"), (F.col("id") > 0, "early"), (F.lit(None).cast("boolean"), "never")).alias("r"))
    assert [r[0] for r in df.collect()] == [None, "early", "late"]


def test_guard_raises(spark):
    df = c.guard(spark.range(3), F.col("id") == 2, "broken")
    with pytest.raises(Exception, match="broken"):
        df.collect()


def test_content_id_counts_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    ids = [r[0] for r in df.select(c.content_id({"y": F.col("y"), "x": F.col("x")})).collect()]
    assert len(set(ids)) == 2


def test_formula_guard(spark):
    assert values(spark, c.formula_guard, ["=1", "-5", "-a", "@x", "+1.5", "text", None]) == ["'=1", "-5", "'-a", "'@x", "+1.5", "text", None]


def test_squeezed(spark):
    assert values(spark, c.squeezed, ["a　b \n c"]) == ["abc"]


def test_standard_error(spark):
    df = spark.createDataFrame([(4.0,), (-1.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    root, reason = c.checked_standard_error(F.col("v"))
    assert [tuple(r) for r in df.select(root, reason).collect()] == [(2.0, None)] + [(None, "invalid_variance")] * 4


def test_locator(spark):
    h = "a" * 64
    rows = [("a/b", 1, h, h, 1, True), ("/a", 1, h, h, 1, False), ("a/../b", 1, h, h, 1, False), ("c:a", 1, h, h, 1, False), ("a", 0, h, h, 1, False), ("a", 1, "x", h, 1, False), ("a", 1, h, h, 0, False), (None, 1, h, h, 1, False)]
    df = spark.createDataFrame(rows, "p string, s bigint, h string, r string, i bigint, want boolean")
    assert all(r[0] == r[1] for r in df.select(c.locator_valid(*[F.col(x) for x in "pshri"]), "want").collect())


def test_availability_bound(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None), (dt.date(2024, 1, 1), "10:30")], "d date, t string")
    got = [r[0] for r in df.select(F.date_format(c.availability_bound(F.col("d"), F.col("t"), F.expr("interval 5 minutes")), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2024-01-01 15:05", "2024-01-01 01:35"]


def test_numbers_keep_every_digit(spark):
    rows = [("1e3", "1000", True), ("NaN", "NaN", False), ("-0", "0", True), ("0.12345678912", "0.123456789", False), ("1E400", "10e399", True), ("Infinity", "Infinity", False), ("x", "x", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert [r[0] for r in df.select(c.scalar_equal(F.col("a"), F.col("b")) == F.col("want")).collect()] == [True] * len(rows)
    value, reason = c.market_number(F.col("a"))
    got = df.select(value.cast("string"), reason).collect()
    assert got[3] == (None, "market_number_not_exact") and got[1][1] == "invalid_market_number" and float(got[0][0]) == 1000


def test_negative_latency_fails(spark):
    import pytest

    df = spark.sql("select date'2024-01-01' as d, '10:00' as t")
    with pytest.raises(Exception, match="Negative latency"):
        df.select(c.availability_bound(F.col("d"), F.col("t"), F.expr("interval -5 minutes"))).collect()
