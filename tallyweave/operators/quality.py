"""Checks on the data that goes in: nulls, duplicates, ranges, statistics, and a gate.

Reports are small tidy DataFrames. Counting passes read only the columns they check and shuffle nothing
but partial counts; distinct keys are counted by a separate pass over the key columns alone, grouped, so
that a hot key or a group of copies is folded together before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MONEY
from ..functions import col, outside_dates, outside_range
from ..sources.staging import stage

SCORECARD_COLUMNS = ["table_name", "column_name", "check", "rows", "pct"]
REPORT_COLUMNS = ["table_name", "section", "column_name", "metric", "value"]


class QualityError(ValueError):
    """Input that must not be processed."""


def _percent(part: Column, total: Column) -> Column:
    share = F.try_divide(F.lit(100.0) * part, total.cast("double"))
    return F.round(F.coalesce(share, F.lit(0.0)), 2)


def _missing(df: DataFrame, name: str, blank_is_null: bool) -> Column:
    missing = col(name).isNull()
    if blank_is_null and isinstance(df.schema[name].dataType, T.StringType):
        missing = missing | (F.trim(col(name)) == "")
    return missing


def _tidy(one_row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """The aggregates of a one-row frame as rows, one per struct in ``entries``."""
    return one_row.select(F.inline(F.array(*entries)))


def null_report(df: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """NULLs and their percentage per column, all columns in one pass."""
    names = df.columns
    nulls = [
        F.count_if(_missing(df, name, blank_is_null)).alias(f"n{i}") for i, name in enumerate(names)
    ]
    return _tidy(
        df.agg(F.count(F.lit(1)).alias("total"), *nulls),
        [
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"n{i}").alias("null_count"),
                _percent(F.col(f"n{i}"), F.col("total")).alias("null_pct"),
            )
            for i, name in enumerate(names)
        ],
    )


def _key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as ``k0, k1, ..., n``; NULL is a key like any other."""
    aliases = [col(key).alias(f"k{i}") for i, key in enumerate(keys)]
    return df.select(*aliases).groupBy(*(f"k{i}" for i in range(len(keys)))).agg(
        F.count(F.lit(1)).alias("n")
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows, distinct keys, and the rows beyond the first of each key, in one row."""
    total, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return _key_counts(df, keys).agg(
        total.cast("bigint").alias("total_rows"),
        distinct.alias("distinct_keys"),
        (total - distinct).cast("bigint").alias("duplicate_row_count"),
    )


def duplicate_report(df: DataFrame, keys: Sequence[str], count_name: str = "count") -> DataFrame:
    """Keys that occur more than once, most frequent first, equally frequent ones by key."""
    if count_name in keys:
        raise ValueError(f"a key is named {count_name!r} too; choose another count_name")
    numbered = [f"k{i}" for i in range(len(keys))]
    return (
        _key_counts(df, keys)
        .filter(F.col("n") > 1)
        .orderBy(F.desc("n"), *numbered)
        .select(*(F.col(k).alias(key) for k, key in zip(numbered, keys)), F.col("n").alias(count_name))
    )


def value_range_check(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """The rows whose value is below ``low`` or above ``high``."""
    return df.filter(outside_range(column, low, high))


def date_range_check(
    df: DataFrame, column: str, start: str, end: str, raw: bool = False
) -> DataFrame:
    """The rows whose date is before ``start`` or after ``end``; see ``outside_dates`` for ``raw``."""
    return df.filter(outside_dates(df, column, start, end, raw))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


#: Bits of a part of a number, and parts: sums of whole numbers do not depend on their order.
PART_BITS, PARTS = 30, 3


def _bounds(names: Sequence[str]) -> list[Column]:
    """Smallest and largest finite value, and counts of those that are none."""

    def of(i: int, name: str) -> tuple[Column, ...]:
        value = col(name).cast("double")
        endless = F.abs(value) == float("inf")
        finite = F.when(~F.isnan(value) & ~endless, value)
        return (
            F.min(finite).alias(f"b{i}_low"),
            F.max(finite).alias(f"b{i}_high"),
            F.count_if(F.isnan(value)).alias(f"b{i}_nan"),
            F.count_if(value == float("inf")).alias(f"b{i}_plus"),
            F.count_if(value == float("-inf")).alias(f"b{i}_minus"),
        )

    return [measure for i, name in enumerate(names) for measure in of(i, name)]


def _part_sums(value: Column, label: str) -> list[Column]:
    """Sums of the whole parts of ``value`` times 2^30, 2^60 and 2^90; every step on a value is exact."""
    out, rest = [], value
    for k in range(PARTS):
        scaled = rest * float(1 << PART_BITS)
        whole = F.floor(scaled)
        out.append(F.sum(whole.cast("decimal(12,0)")).alias(f"{label}{k}"))
        rest = scaled - whole.cast("double")
    return out


def _total(label: str) -> Column:
    return reduce(add, (F.col(f"{label}{k}").cast("double") * 2.0 ** (-PART_BITS * (k + 1)) for k in range(PARTS)))


def _grid(row: Row, i: int) -> tuple[int, float, int]:
    """The exponent that brings a column's finite values within one of zero, their middle there, and the exponent of the rest."""
    low, high = row[f"b{i}_low"], row[f"b{i}_high"]
    if low is None:
        return 0, 0.0, 0
    exponent = max(-1000, math.frexp(max(abs(low), abs(high)))[1])
    low, high = math.ldexp(low, -exponent), math.ldexp(high, -exponent)
    middle = (low + high) / 2
    return exponent, middle, math.frexp(max(high - middle, middle - low))[1]


def _scaled(value: Column, exponent: int) -> Column:
    """``value`` times two to the power of ``exponent``, in two steps, as the power alone may exceed a double."""
    half = exponent // 2
    return value * math.ldexp(1.0, half) * math.ldexp(1.0, exponent - half)


def _profile_aggregates(names: Sequence[str], bounds: Row | None) -> list[Column]:
    """Measures of which ``_profile_columns`` makes the profile."""
    out = []
    for i, name in enumerate(names):
        value = col(name).cast("double")
        exponent, middle, spread = _grid(bounds, i)
        finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), _scaled(value, -exponent))
        off = _scaled(finite - F.lit(middle), -spread)
        out += [
            F.count(col(name)).alias(f"p{i}_count"),
            # Adding zero makes 0.0 of -0.0, which compare equal and would come out at random.
            (F.min(col(name)).cast("double") + F.lit(0.0)).alias(f"p{i}_min"),
            (F.max(col(name)).cast("double") + F.lit(0.0)).alias(f"p{i}_max"),
            *_part_sums(finite, f"s{i}_"),
            *_part_sums(off, f"o{i}_"),
            *_part_sums(off * off, f"q{i}_"),
        ]
    return out


def _profile_columns(names: Sequence[str], bounds: Row | None) -> list[Column]:
    out = []
    for i in range(len(names)):
        exponent, _, spread = _grid(bounds, i)
        n, off = F.col(f"p{i}_count").cast("double"), _total(f"o{i}_")
        squares = F.greatest(_total(f"q{i}_") - F.try_divide(off * off, n), F.lit(0.0))
        mean = _scaled(F.try_divide(_total(f"s{i}_"), n), exponent)
        deviation = F.when(n > 1, _scaled(F.sqrt(squares / (n - 1)), exponent + spread))
        strange = [bounds[f"b{i}_{kind}"] for kind in ("nan", "plus", "minus")]
        if any(strange):
            endless = float("inf") if strange[1] else float("-inf")
            mean = F.lit(float("nan") if strange[0] or (strange[1] and strange[2]) else endless)
            deviation = F.when(n > 1, F.lit(float("nan")))
        out += [
            F.col(f"p{i}_count"), mean.alias(f"p{i}_mean"), deviation.alias(f"p{i}_stddev"), F.col(f"p{i}_min"), F.col(f"p{i}_max"),
        ]
    return out


PROFILE_METRICS = ("count", "mean", "stddev", "min", "max")
PROFILE_SCHEMA = "column_name string, count bigint, mean double, stddev double, min double, max double"


def numeric_profile(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every numeric column.

    Means and deviations come from sums of whole numbers, so they are the same to the last bit whatever the order of
    rows. That takes two passes: the first, for the range of each column, is made at once. Values below 2^-89 of a
    column's largest count as zero in its sums. A column with NaN has the mean NaN, one with infinite values of one
    sign that infinity; neither has a deviation other than NaN. A frame without numeric columns gives no rows.
    """
    names = _numeric(df)
    if not names:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    bounds = df.agg(*_bounds(names)).first()
    return _tidy(
        df.agg(*_profile_aggregates(names, bounds)).select(*_profile_columns(names, bounds)),
        [
            F.struct(
                F.lit(name).alias("column_name"),
                *(F.col(f"p{i}_{metric}").alias(metric) for metric in PROFILE_METRICS),
            )
            for i, name in enumerate(names)
        ],
    )


def _unparsable(df: DataFrame, name: str, kind: str) -> Column | None:
    """Values that the cleansing cannot read as the given kind ("date" or "money")."""
    stored = df.schema[name].dataType
    if kind == "date" and isinstance(stored, T.StringType):
        return col(name).isNotNull() & F.try_to_date(col(name)).isNull()
    if kind == "money" and isinstance(stored, (T.DoubleType, T.FloatType)):
        # The same numbers as those the cast refuses, without the cost of the cast.
        return F.isnan(col(name)) | (F.abs(col(name)) >= F.lit(1e16))
    if kind == "money":
        return col(name).isNotNull() & col(name).try_cast(MONEY).isNull()
    return None


def quality_scorecard(
    df: DataFrame,
    name: str,
    columns: Sequence[str],
    dates: Sequence[str] = (),
    amounts: Sequence[str] = (),
    blank_is_null: bool = False,
    used: Column | None = None,
) -> DataFrame:
    """One row per table, column and check.

    Checks: the rows of the table; NULLs of each of ``columns``; duplicates on the first of them; and for
    the ``dates`` and ``amounts`` given, values that are no date or do not fit into money. With ``used``, a
    condition on the rows that will be converted, such amounts in those rows are counted once more, as
    "unconvertible". One pass: rows are counted per key, partly before the shuffle, and then added up.
    """
    checks = [(c, "nulls", _missing(df, c, blank_is_null)) for c in columns]
    for kind, listed in (("date", dates), ("money", amounts)):
        for c in listed:
            test = _unparsable(df, c, kind)
            if test is not None:
                checks.append((c, "unparsable", test))
                if used is not None and kind == "money":
                    checks.append((c, "unconvertible", test & used))

    per_key = df.groupBy(col(columns[0]).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(checks)),
    )

    def added(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(column)

    counted = per_key.agg(
        added("n"), F.count(F.lit(1)).alias("keys"), *(added(f"n{i}") for i in range(len(checks)))
    )
    no_pct = F.lit(None).cast("double")

    def entry(column: str, check: str, rows: Column, pct: Column) -> Column:
        values = (F.lit(name), F.lit(column), F.lit(check), rows, pct)
        return F.struct(*(v.alias(n) for n, v in zip(SCORECARD_COLUMNS, values)))

    return _tidy(
        counted,
        [entry("*", "rows", F.col("n"), no_pct)]
        + [
            entry(c, check, F.col(f"n{i}"), _percent(F.col(f"n{i}"), F.col("n")))
            for i, (c, check, _) in enumerate(checks)
        ]
        + [entry(columns[0], "duplicates", F.col("n") - F.col("keys"), no_pct)],
    )


def quality_gate(
    df: DataFrame,
    name: str,
    columns: Sequence[str],
    gated: int = 2,
    dates: Sequence[str] = (),
    amounts: Sequence[str] = (),
    blank_is_null: bool = False,
) -> DataFrame:
    """The scorecard, computed; raises if one of the first ``gated`` columns has NULLs.

    The error names the first such column in the order listed. NULLs of later columns are only reported.
    """
    card = stage(quality_scorecard(df, name, columns, dates, amounts, blank_is_null), "scorecard")
    return enforce(card, {name: columns[:gated]})


def enforce(card: DataFrame, gated: Mapping[str, Sequence[str]]) -> DataFrame:
    """Pass on a computed scorecard, or raise if it holds what would stop the job or falsify it.

    That is NULLs in a gated column, in the order listed, or amounts that cannot be converted in rows that
    will be.
    """
    # At most one row per checked column comes to the driver.
    wanted = {(table, column) for table, columns in gated.items() for column in columns}
    faults = card.filter((F.col("check") == "nulls") & (F.col("rows") > 0)).collect()
    found = {(row["table_name"], row["column_name"]): row["rows"] for row in faults}
    for table, columns in gated.items():
        _raise_first(table, columns, {c: found[t, c] for t, c in wanted & found.keys() if t == table})
    stopping = (F.col("check") == "unconvertible") & (F.col("rows") > 0)
    for row in card.filter(stopping).orderBy("table_name", "column_name").collect():
        raise QualityError(
            f"{row['column_name']!r} of {row['table_name']} holds {row['rows']} amounts that are no money in "
            "rows to be converted; nothing was processed"
        )
    return card


def assert_no_nulls(df: DataFrame, columns: Sequence[str], name: str = "table") -> DataFrame:
    """The null report of ``columns``, computed; raises if any of them has NULLs."""
    report = stage(null_report(df.select(*map(col, columns))), "nulls")
    faults = report.filter(F.col("null_count") > 0).collect()
    _raise_first(name, columns, {row["column_name"]: row["null_count"] for row in faults})
    return report


def _raise_first(name: str, columns: Sequence[str], nulls: dict[str, int]) -> None:
    for column in columns:
        if nulls.get(column):
            raise QualityError(
                f"critical column {column!r} of {name} has {nulls[column]} nulls; nothing was processed"
            )


def full_report(df: DataFrame, name: str, keys: Sequence[str] | None = None) -> DataFrame:
    """All checks on a table as rows of (table_name, section, column_name, metric, value).

    Sections: "table" (rows, columns), "nulls", "duplicates" on ``keys`` (the first column if none are
    given) and "numeric", which is that of ``numeric_profile``. Three passes: the range of numeric columns, at once, then
    all columns and the keys. ``full_check`` returns the
    offending keys as well.
    """
    keys = list(keys or df.columns[:1])
    numeric = _numeric(df)
    nulls = [F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]

    def entry(section: str, column: str, metric: str, value: Column) -> Column:
        values = (F.lit(name), F.lit(section), F.lit(column), F.lit(metric), value.cast("double"))
        return F.struct(*(v.alias(n) for n, v in zip(REPORT_COLUMNS, values)))

    entries = [
        entry("table", "*", "total_rows", F.col("total")),
        entry("table", "*", "column_count", F.lit(len(df.columns))),
    ]
    for i, c in enumerate(df.columns):
        entries.append(entry("nulls", c, "null_count", F.col(f"n{i}")))
        entries.append(entry("nulls", c, "null_pct", _percent(F.col(f"n{i}"), F.col("total"))))
    for i, c in enumerate(numeric):
        entries.extend(entry("numeric", c, m, F.col(f"p{i}_{m}")) for m in PROFILE_METRICS)
    bounds = df.agg(*_bounds(numeric)).first() if numeric else None
    counted = [F.col("total"), *(F.col(f"n{i}") for i in range(len(nulls)))]
    whole = df.agg(F.count(F.lit(1)).alias("total"), *nulls, *_profile_aggregates(numeric, bounds))
    whole = whole.select(*counted, *_profile_columns(numeric, bounds))

    key_names = ",".join(keys)
    by_key = _tidy(
        duplicate_summary(df, keys),
        [
            entry("duplicates", key_names, metric, F.col(metric))
            for metric in ("total_rows", "distinct_keys", "duplicate_row_count")
        ],
    )
    return _tidy(whole, entries).unionByName(by_key)


class FullCheck(NamedTuple):
    """A full report, and the keys that occur more than once."""

    report: DataFrame
    duplicates: DataFrame


def full_check(df: DataFrame, name: str, keys: Sequence[str] | None = None) -> FullCheck:
    """The full report together with the offending keys, most frequent first."""
    keys = list(keys or df.columns[:1])
    return FullCheck(full_report(df, name, keys), duplicate_report(df, keys))
