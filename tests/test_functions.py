import pytest
from pyspark.sql import functions as F

from pulselake.functions.lenient import (
    clock_hour, clock_text, millisecond_text, narrow_to_int, number_or_null, text_or_null,
)
from pulselake.functions.stats import mean_squared_error, severity, z_score
from pulselake.functions.wellness import accepts, dominant_label, goal_reached, null_as_zero_sum
from tests.rows import one


def value(spark, column):
    return one(spark.range(1).select(column.alias("v")))["v"]


@pytest.mark.parametrize("text, number", [
    ("134.0", 134.0), (" 7 ", 7.0), ("-1e3", -1000.0), (".5", 0.5), ("5.", 5.0), ("", None), (None, None),
    ("nan", None), ("NaN", None), ("inf", None), ("-Infinity", None), ("1e999", None), ("1.5f", None),
    ("1.5d", None), ("0x1p3", None), ("abc", None), ("1.2.3", None), ("--1", None),
])
def test_number_or_null(spark, text, number):
    assert value(spark, number_or_null(F.lit(text).cast("string"))) == number


def test_text_or_null(spark):
    assert value(spark, text_or_null(F.lit(""))) is None
    assert value(spark, text_or_null(F.lit("x"))) == "x"


@pytest.mark.parametrize("text, stamp", [
    ("7.0", "2021-05-24T07:00:00"), ("23.9", "2021-05-24T23:00:00"), ("x", "2021-05-24T00:00:00"),
    ("nan", "2021-05-24T00:00:00"), (None, "2021-05-24T00:00:00"), ("24", "2021-05-24T24:00:00"),
    ("3e10", "2021-05-24T30000000000:00:00"), ("-1", "2021-05-24T-1:00:00"),
])
def test_clock(spark, text, stamp):
    hour = clock_hour(number_or_null(F.lit(text).cast("string")))
    assert value(spark, clock_text(F.lit("2021-05-24"), hour)) == stamp


@pytest.mark.parametrize("text, number", [("1 2", None), ("- 1", None), ("1e 5", None), ("  ", None), ("  -1e3  ", -1000.0),
                                          ("\t7", None), ("7\n", None)])
def test_number_takes_outer_spaces_only(spark, text, number):
    assert value(spark, number_or_null(F.lit(text))) == number


def test_cells_and_clock_are_read_once(spark):
    """Every document pays for these: no trimmed copy of a cell, no formatter that reads its pattern per row."""
    rows = spark.range(1).select(F.col("id").cast("string").alias("cell"))
    hour = clock_hour(number_or_null(F.col("cell")))
    plan = rows.select(clock_text(F.col("cell"), hour))._jdf.queryExecution().optimizedPlan().toString()
    assert "format_string" not in plan and "trim(" not in plan


@pytest.mark.parametrize("number, whole", [
    (134.9, 134), (-0.5, 0), (30000.9, 30000), (3e10, 2147483647), (-3e10, -2147483648),
    (float("nan"), 0), (None, None), (float("inf"), 2147483647),
])
def test_narrow_to_int(spark, number, whole):
    assert value(spark, narrow_to_int(F.lit(number).cast("float"))) == whole


def test_millisecond_text(spark):
    stamp = F.lit("2026-01-01 00:00:00.123987").cast("timestamp")
    assert value(spark, millisecond_text(stamp)) == "2026-01-01T00:00:00.123"


@pytest.mark.parametrize("number, kept", [(30.0, True), (220.0, True), (29.99, False), (220.01, False), (None, True),
                                          (float("nan"), False)])
def test_accepts_closed_range(spark, number, kept):
    assert value(spark, accepts(F.lit(number).cast("float"), 30, 220)) is kept


def test_accepts_open_range_takes_nan(spark):
    assert value(spark, accepts(F.lit(float("nan")).cast("float"), 0, None)) is True
    assert value(spark, accepts(F.lit(-1).cast("float"), 0, None)) is False


@pytest.mark.parametrize("counts, label", [
    ((2, 2, 0), "a"), ((0, 2, 2), "b"), ((0, 0, 0), None), ((None, None, None), None), ((None, 1, 0), "b"),
])
def test_dominant_label(spark, counts, label):
    pairs = [(n, F.lit(c).cast("long")) for n, c in zip("abc", counts)]
    assert value(spark, dominant_label(pairs)) == label


@pytest.mark.parametrize("total, goal, met", [(10, 10.0, True), (9, 10.0, False), (None, 10.0, None), (9, None, None)])
def test_goal_reached(spark, total, goal, met):
    assert value(spark, goal_reached(F.lit(total).cast("int"), F.lit(goal).cast("float"))) is met


def test_null_as_zero_sum(spark):
    assert value(spark, null_as_zero_sum([F.lit(None).cast("int"), F.lit(4), F.lit(5)])) == 9


@pytest.mark.parametrize("z, name", [(1.03, "normal"), (1.04, "green"), (1.289, "green"), (1.29, "yellow"),
                                     (1.65, "red"), (-3.0, "normal"), (float("nan"), "normal"), (None, "normal")])
def test_severity(spark, z, name):
    assert value(spark, severity(F.lit(z).cast("double"))) == name


def test_z_score_without_spread(spark):
    assert value(spark, z_score(F.lit(2.0), 2.0, 0.0)) == 0.0


def test_mean_squared_error(spark):
    actual = F.array(F.lit(1.0).cast("float"), F.lit(2.0).cast("float"))
    assert value(spark, mean_squared_error(actual, F.array(F.lit(0.0), F.lit(0.0)))) == 2.5
