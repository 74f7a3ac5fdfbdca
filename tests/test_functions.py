from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankmart import functions as B
from tests.frames import one, rows, text


@pytest.mark.parametrize("value, expected", [
    ("12", 12), ("12.00", 12), ("12.5", None), ("", None), ("abc", None), (None, None), ("-3", -3),
])
def test_whole_numbers(spark, value, expected):
    assert one(spark, value, B.as_whole) == expected


@pytest.mark.parametrize("value, loose, strict", [
    ("1e3", Decimal("1000.0000"), None), ("1000", Decimal("1000.0000"), Decimal("1000.0000")),
    ("N/A", None, None), ("", None, None), ("-0.5", Decimal("-0.5000"), Decimal("-0.5000")),
])
def test_decimals_loose_and_strict(spark, value, loose, strict):
    assert one(spark, value, B.as_decimal) == loose
    assert one(spark, value, lambda v: B.as_decimal(v, strict=True)) == strict


def test_empty_and_impossible_dates_are_null(spark):
    assert one(spark, "", B.as_day) is None
    assert one(spark, "31/31/2024", B.as_day) is None
    assert one(spark, "2024-02-29", B.as_day) == date(2024, 2, 29)


def test_month_gap_counts_boundaries(spark):
    df = text(spark, "a b", ("2024-01-31", "2024-02-29"), ("2023-12-01", "2024-01-31"))
    gaps = df.select(B.month_gap(F.col("a").cast("date"), F.col("b").cast("date")))
    assert rows(gaps) == [(1,), (1,)]


def test_ratio_of_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (1.0, None)], "a double, b double")
    assert rows(df.select(B.ratio("a", "b"), B.ratio("a", "b", 0.0))) == [
        (None, 0.0), (0.25, 0.25), (None, 0.0)]


@pytest.mark.parametrize("value, label", [
    ("AGRICULTURA", "Agricultura"), ("agro-export", "Agricultura"), ("comercio ", "Comercio"),
    ("Salud", "No Definido"), (None, "No Definido"), ("Industria textil", "Industria"),
])
def test_sector_is_case_insensitive_and_first_rule_wins(spark, value, label):
    assert one(spark, value, B.normalize_sector) == label


def test_sector_rules_can_be_extended(spark):
    rules = [("salud", "Salud")]
    assert one(spark, "SALUD", lambda v: B.normalize_sector(v, rules)) == "Salud"


@pytest.mark.parametrize("days, label", [
    (0, "Normal"), (1, "Potencial"), (15, "Potencial"), (16, "Deficiente"), (45, "Deficiente"),
    (46, "Dudoso"), (90, "Dudoso"), (91, "Pérdida"), (-4, "Potencial"), (None, None),
])
def test_rating_from_days(spark, days, label):
    assert one(spark, days, B.rating_from_days, "int") == label


@pytest.mark.parametrize("own, source, expected", [
    ("1.00", "1.01", "1.00"), ("1.00", "1.02", "1.02"), ("1.00", None, "1.00"), (None, "5.00", None),
])
def test_replace_if_differs(spark, own, source, expected):
    df = text(spark, "a b", (own, source)).select(B.as_money("a").alias("a"), B.as_money("b").alias("b"))
    got = df.select(B.replace_if_differs("a", "b")).first()[0]
    assert got == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize("days, paid, delay", [(-5, 0, 180), (-5, 10, 0), (7, 0, 7), (-5, None, 0)])
def test_instalment_delay(spark, days, paid, delay):
    df = spark.createDataFrame([(days, paid)], "d int, p int")
    assert df.select(B.instalment_delay("d", "p")).first()[0] == delay


@pytest.mark.parametrize("value, label", [
    (13.99, "low"), (14.0, "alert"), (22.99, "alert"), (23.0, "optimal"), (35.0, "optimal"), (35.01, "high"),
])
def test_status_band(spark, value, label):
    assert one(spark, value, B.status_band, "double") == label


def test_direction_polarity(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,), (None,)], "d double")
    up, good = B.direction("d")
    _, inverse = B.direction("d", higher_is_better=False)
    assert rows(df.select(up, good, inverse)) == [
        ("up", True, False), ("down", False, True), ("down", False, False), ("down", False, False)]
