from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.functions import (
    as_date, clean_text, in_year, money, outside_dates, outside_range, rag_rating, z_score,
)


def values(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_text_loses_spaces_but_keeps_tabs(spark):
    df = spark.createDataFrame([("  a b ",), ("\tx",), (None,)], "t string")
    assert values(df, clean_text("t")) == ["a b", "\tx", None]
    assert values(df, clean_text("t", upper=True)) == ["A B", "\tX", None]


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.344,), (None,)], "x double")
    assert values(df, money("x")) == [Decimal("1.01"), Decimal("-1.01"), Decimal("2.34"), None]
    assert values(df, money("x", default=0))[-1] == Decimal("0.00")


@pytest.mark.parametrize("amount", [float("nan"), float("inf"), 1e20])
def test_money_refuses_what_it_cannot_hold(spark, amount):
    df = spark.createDataFrame([(amount,)], "x double")
    with pytest.raises(Exception, match="no money|out of range|cannot be represented"):
        df.select(money("x", default=0)).collect()


def test_text_that_is_no_date_becomes_null(spark):
    df = spark.createDataFrame([("1998-02-03",), ("1998-02-30",), ("soon",), (None,)], "d string")
    assert values(df, as_date(df, "d")) == [date(1998, 2, 3), None, None, None]


DAYS = ["1997-12-31", "1998-01-01", "1998-12-31", "1999-01-01", "1999-01-03", "1999-01-04", "junk", None]


def test_year_is_half_open(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d string")
    kept = df.filter(in_year(df, "d", 1998)).collect()
    assert [r["d"] for r in kept] == ["1998-01-01", "1998-12-31"]
    graced = df.filter(in_year(df, "d", 1998, grace_days=3)).collect()
    assert [r["d"] for r in graced] == DAYS[1:5]


SPELLINGS = [
    "1998-02-03", " 1998-02-03", "\t1998-02-03", "\n 1998-02-03 ", "+1998-02-03", "01998-02-03", "001998-2-3",
    "\x7f1998-02-03", "1998", "1998-02", "1998-2-3", "1998-02-03 10:11:12", "1998-02-03T10:11:12", "1999-01-02",
    " 1999-1-2", "1997-12-31", "2999-01-01", "998-02-03", "", " ", "soon", "\x001998-02-03",
]


@pytest.mark.parametrize("year, grace", [(1998, 0), (1998, 40), (9999, 0), (9998, 10), (2999, 365)])
def test_the_pushed_range_loses_no_readable_date(spark, year, grace):
    df = spark.createDataFrame([(d,) for d in SPELLINGS], "d string")
    end = date(year + 1, 1, 1) + timedelta(days=grace) if year < 9999 else None
    if end is None:
        with pytest.raises(ValueError):
            in_year(df, "d", year, grace)
        return
    readable = {r["d"]: r["day"] for r in df.select("d", as_date(df, "d").alias("day")).collect()}
    want = {d for d, day in readable.items() if day is not None and date(year, 1, 1) <= day < end}
    assert {r["d"] for r in df.filter(in_year(df, "d", year, grace)).collect()} == want
    assert year != 1998 or len(want) >= 11


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_year_of_typed_columns(spark, kind):
    df = spark.createDataFrame([(d,) for d in DAYS[:6]], "d string")
    typed = df.select(F.col("d").cast(kind).alias("d"))
    assert typed.filter(in_year(typed, "d", 1998)).count() == 2
    late = spark.createDataFrame([("1998-12-31 23:59:59",)], "d string")
    late = late.select(F.col("d").cast(kind).alias("d"))
    assert late.filter(in_year(late, "d", 1998)).count() == 1


def test_range_without_bounds_flags_nothing(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (5.0,), (None,), (float("nan"),)], "x double")

    def flagged(low=None, high=None):
        return [repr(r["x"]) for r in df.filter(outside_range("x", low, high)).collect()]

    assert flagged() == []
    assert flagged(low=0) == ["-1.0"]
    assert flagged(high=4.0) == ["5.0", "nan"]  # NaN counts as greater than any number
    assert flagged(low=0, high=4) == ["-1.0", "5.0", "nan"]


def test_dates_compare_as_days(spark):
    moments = [(datetime(1998, 1, 1),), (datetime(1998, 1, 31, 15),), (datetime(1998, 2, 1),), (None,)]
    df = spark.createDataFrame(moments, "d timestamp_ntz")
    out = df.filter(outside_dates(df, "d", "1998-01-01", "1998-01-31")).collect()
    assert [r["d"] for r in out] == [datetime(1998, 2, 1)]
    raw = df.filter(outside_dates(df, "d", "1998-01-01", "1998-01-31", raw=True)).collect()
    assert [r["d"] for r in raw] == [datetime(1998, 1, 31, 15), datetime(1998, 2, 1)]


def test_text_dates_compare_as_days_unless_raw(spark):
    df = spark.createDataFrame([("1998-1-5",), ("1998-03-01",), ("none",)], "d string")
    out = df.filter(outside_dates(df, "d", "1998-01-01", "1998-01-31")).collect()
    assert [r["d"] for r in out] == ["1998-03-01"]
    raw = df.filter(outside_dates(df, "d", "1998-01-01", "1998-01-31", raw=True)).collect()
    assert [r["d"] for r in raw] == ["1998-1-5", "1998-03-01", "none"]


def test_rating_edges(spark):
    df = spark.createDataFrame([(99.0,), (98.99,), (95.0,), (94.99,), (None,)], "rate double")
    assert values(df, rag_rating(F.col("rate"))) == ["GREEN", "AMBER", "AMBER", "RED", "RED"]


def test_zero_deviation_counts_as_one(spark):
    df = spark.createDataFrame(
        [(5.0, 3.0, 0.0), (5.0, 3.0, None), (5.0, 3.0, 4.0)], "x double, m double, s double"
    )
    assert values(df, z_score(F.col("x"), F.col("m"), F.col("s"))) == [2.0, None, 0.5]
