"""Parsing, rounding and NULL rules of the column expressions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text


def one(spark, column, **values):
    """The value of an expression over one row of named texts."""
    schema = ", ".join(f"{name} STRING" for name in values) or "x STRING"
    rows = [tuple(values.values()) or (None,)]
    return spark.createDataFrame(rows, schema).select(column).first()[0]


@pytest.mark.parametrize(
    "cell, whole",
    [("2.5", 3), ("-2.5", -3), ("2.4", 2), ("17.0", 17), ("1.1156E+4", 11156), (" 7 ", 7), (None, None)],
)
def test_whole_numbers_round_half_away_from_zero(spark, cell, whole):
    assert one(spark, numbers.to_whole("x"), x=cell) == whole


def test_strict_casts_fail_and_lenient_ones_give_null(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, numbers.to_whole("x"), x="ten")
    assert one(spark, numbers.to_whole("x", strict=False), x="ten") is None
    assert one(spark, dates.parse_dmy("x", strict=False), x="yesterday") is None
    assert one(spark, dates.parse_iso("x", strict=False), x="2020-13-01") is None


def test_decimals_round(spark):
    assert one(spark, numbers.to_decimal("x", 5, 2), x="2.675") == Decimal("2.68")
    assert one(spark, numbers.half_up_double(F.lit(1.005), 2)) == Decimal("1.01")
    assert one(spark, numbers.half_up(F.lit(Decimal("-0.125")), 2)) == Decimal("-0.13")


@pytest.mark.parametrize(
    "name, title",
    [
        ("BLACK-TOWN", "Black-Town"),
        ("O'CONNELL", "O'Connell"),
        ("ST. IVES  2nd", "St. Ives  2nd"),
        ("ÉLAN VITAL", "Élan Vital"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, name, title):
    assert one(spark, text.title_case("x"), x=name) == title


def test_dates(spark):
    assert one(spark, dates.parse_dmy("x"), x="3/7/2014") == dt.date(2014, 7, 3)
    assert one(spark, dates.parse_dmy("x"), x="03/07/2014") == dt.date(2014, 7, 3)
    assert one(spark, dates.period_of("x"), x="07_2020.csv") == dt.date(2020, 7, 1)
    march = F.lit("2020-03-31").cast("date")
    assert one(spark, dates.month_floor(march)) == dt.date(2020, 3, 1)
    assert one(spark, dates.previous_month(dates.month_floor(march))) == dt.date(2020, 2, 1)
    assert one(spark, dates.year_month(march)) == "2020-03"


def test_flags_keep_null(spark):
    assert one(spark, text.is_true("x"), x="t") is True
    assert one(spark, text.is_true("x"), x="f") is False
    assert one(spark, text.is_true("x"), x=None) is None


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 7.0)], "x INT, y DOUBLE")
    row = df.agg(
        numbers.pearson("x", "y").alias("flat"),
        numbers.ratio_of_sums("y", F.col("x") == 2).alias("none"),
        numbers.percent(F.count("*"), F.count_if(F.col("x") == 2), 1).alias("share"),
    ).first()
    assert (row.flat, row.none, row.share) == (None, None, None)


def test_thousands(spark):
    assert one(spark, numbers.thousands(F.lit(Decimal("1234567.5")))) == "1,234,568"
    assert one(spark, numbers.thousands(F.lit(Decimal("2.5")))) == "3"


def test_missing_value_texts(spark):
    for cell in ("", "NA", "N/A", "null", "NaN", "None", "n/a"):
        assert one(spark, text.null_tokens("x"), x=cell) is None
    assert one(spark, text.null_tokens("x"), x="Nancy") == "Nancy"
