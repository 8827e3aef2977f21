"""Column functions against hand-computed values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cairn.functions import dates, numbers, rules, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    ("raw", "day", "flag"),
    [("19870615", date(1987, 6, 15), False), ("19870600", date(1987, 6, 1), True), ("19870000", date(1987, 1, 1), True), ("00000000", None, True), ("19870231", None, False), ("abcdefgh", None, False), ("1987", None, False), (None, None, None)],
)
def test_approx_date(spark, raw, day, flag):
    assert one(spark, raw, dates.approx_date("x")) == day
    assert one(spark, raw, dates.approx_flag("x")) == flag


@pytest.mark.parametrize(("raw", "parts"), [("DUPONT*JEAN PIERRE", ("DUPONT", "JEAN PIERRE")), ("DUPONT", ("DUPONT", "")), ("A*B*C", ("A", "B*C")), (None, (None, None))])
def test_split_first(spark, raw, parts):
    assert tuple(spark.createDataFrame([(raw,)], "x string").select(*text.split_first("x")).first()) == parts


@pytest.mark.parametrize(("raw", "out"), [("1001", "01001"), ("2A004", "2A004"), ("974111", "97411"), ("", None), (None, None)])
def test_zfill(spark, raw, out):
    assert one(spark, raw, text.zfill("x")) == out


def test_text(spark):
    assert one(spark, " ab ", text.clean_text("x")) == "AB"
    assert one(spark, "", text.blank_to_null("x")) is None
    assert one(spark, "X /", text.strip_trailing("x")) == "X "
    assert one(spark, "/", text.strip_trailing("x")) == ""
    assert one(spark, "9", text.map_codes("x", {"1": "M", "2": "F"})) is None
    assert one(spark, "97411", text.region_prefix("x")) == "974"
    assert one(spark, "01001", text.region_prefix("x")) == "01"
    assert one(spark, "x1", text.to_number("x")) is None


def test_numbers(spark):
    assert one(spark, 3, numbers.ratio("x", F.lit(0)), "int") is None
    assert one(spark, 3, numbers.ratio("x", F.lit(0), default=0), "int") == 0.0
    assert one(spark, 1, numbers.ratio("x", F.lit(3), 100, 2), "int") == 33.33
    assert one(spark, 40.0, numbers.rate_per(F.lit(2), "x", 1000, 4, 50), "double") is None
    assert one(spark, 72, numbers.band_label("x"), "int") == "70-79"
    assert one(spark, -2.6, numbers.severity("x"), "double") == "ÉLEVÉ"


def test_rules(spark):
    assert [len(rules.AGE_BANDS[k]) for k in rules.AGE_BANDS] == [7, 21, 11, 5]
    assert one(spark, 100, rules.rules_case("x", rules.AGE_BANDS["tranche_age_10_ans"]), "int") == "100 ans et +"
    assert one(spark, 200, rules.rules_case("x", rules.AGE_BANDS["tranche_age"]), "int") == "Inconnue"
    assert one(spark, 1945, rules.rules_case("x", rules.GENERATIONS), "int") == "Silent Generation"


def test_age(spark):
    df = spark.createDataFrame([(date(1900, 1, 1), date(2000, 1, 1)), (date(2000, 1, 2), date(2000, 1, 1)), (None, date(2000, 1, 1)), (date(1800, 1, 1), date(2000, 1, 1))], "b date, d date")
    assert [r[0] for r in df.select(dates.age_years("b", "d")).collect()] == [99, None, None, None]
