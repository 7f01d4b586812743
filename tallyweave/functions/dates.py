"""Dates, kept as half-open ranges on the stored column wherever its type allows a pushed filter."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col

TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def _stored_as(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _moment(day: date, stored: T.DataType) -> Column:
    """Midnight of ``day`` as a literal of the stored timestamp type."""
    return F.lit(datetime(day.year, day.month, day.day).isoformat(" ")).cast(stored)


def as_date(df: DataFrame, name: str) -> Column:
    """The column as a date; text that is no date becomes NULL."""
    if isinstance(_stored_as(df, name), T.StringType):
        return F.try_to_date(col(name))
    return col(name).cast("date")


def month_of(name: str) -> Column:
    """``yyyy-MM`` of a date column."""
    return F.date_format(col(name), "yyyy-MM")


def _may_lie_in(name: str, first: int, last: int) -> Column:
    """True of every text that reads as a date in the years ``first`` to ``last``, of four digits each.

    Such a text begins with the year, or with something that sorts before "1" (blanks, tabs, signs, zeros)
    or after "9" (a DEL). A comparison of the raw text can be pushed to the Parquet scan.
    """
    text = col(name)
    begins = (text >= str(first)) & (text < str(last + 1))
    return (text < "1") | begins | (text >= "\x7f")


def in_year(df: DataFrame, name: str, year: int, grace_days: int = 0) -> Column:
    """True from 1 January of ``year`` up to its end, or ``grace_days`` past it.

    Date and timestamp columns are compared as stored, so the range reaches the Parquet scan. Text is
    parsed, which cannot be pushed; a range on the raw text that loses no readable date goes along with it
    and can.
    """
    start, end = date(year, 1, 1), date(year + 1, 1, 1) + timedelta(days=grace_days)
    stored = _stored_as(df, name)
    if isinstance(stored, TIMESTAMPS):
        return (col(name) >= _moment(start, stored)) & (col(name) < _moment(end, stored))
    day = as_date(df, name)
    inside = (day >= F.lit(start)) & (day < F.lit(end))
    last = (end - timedelta(days=1)).year
    if isinstance(stored, T.StringType) and 1000 <= year and last < 9999:
        inside = _may_lie_in(name, year, last) & inside
    return inside


def outside_dates(df: DataFrame, name: str, start: str, end: str, raw: bool = False) -> Column:
    """True before ``start`` or after ``end``, both days being inside. NULL is never outside.

    By default whole days are compared, so any time on the end day is inside. ``raw`` compares the stored
    values with the bounds as given: text as text, a timestamp with midnight of the end day.
    """
    if raw:
        return (col(name) < F.lit(start)) | (col(name) > F.lit(end))
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    stored = _stored_as(df, name)
    if isinstance(stored, TIMESTAMPS):
        after = last + timedelta(days=1)
        return (col(name) < _moment(first, stored)) | (col(name) >= _moment(after, stored))
    day = as_date(df, name)
    return (day < F.lit(first)) | (day > F.lit(last))
