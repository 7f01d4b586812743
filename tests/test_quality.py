import math
import random
from datetime import date
from decimal import Decimal
from fractions import Fraction

import pytest

from tallyweave.operators import (
    QualityError, assert_no_nulls, date_range_check, duplicate_report, duplicate_summary, full_report,
    full_check, null_report, numeric_profile, quality_gate, quality_scorecard, value_range_check,
)

SCHEMA = "transaction_id string, customer_id string, transaction_date string, net_revenue double"


@pytest.fixture(scope="module")
def example(spark):
    """Five rows: one exact copy, one without customer, one negative amount."""
    rows = [
        ("S1", "K1", "2023-03-01", 40.0),
        ("S2", "K2", "2023-03-02", 15.5),
        ("S2", "K2", "2023-03-02", 15.5),
        ("S3", None, "2023-03-09", 40.0),
        ("S4", "K1", "2023-03-12", -3.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_report(example):
    assert rows(null_report(example)) == [
        ("transaction_id", 0, 0.0), ("customer_id", 1, 20.0), ("transaction_date", 0, 0.0),
        ("net_revenue", 0, 0.0),
    ]


def test_reports_on_an_empty_frame(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert {r[1:] for r in rows(null_report(empty))} == {(0, 0.0)}
    assert rows(duplicate_summary(empty, ["transaction_id"])) == [(0, 0, 0)]
    assert rows(numeric_profile(empty)) == [("net_revenue", 0, None, None, None, None)]
    assert rows(duplicate_report(empty, ["transaction_id"])) == []


def test_percentages_round_half_up(spark):
    df = spark.createDataFrame([(None,)] + [(1,)] * 799, "x int")
    assert rows(null_report(df)) == [("x", 1, 0.13)]


def test_nan_is_no_null_but_blank_text_can_be(spark):
    df = spark.createDataFrame([(float("nan"), "  "), (1.0, "x")], "x double, t string")
    assert rows(null_report(df)) == [("x", 0, 0.0), ("t", 0, 0.0)]
    assert rows(null_report(df, blank_is_null=True)) == [("x", 0, 0.0), ("t", 1, 50.0)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "`a.b` int, `c``d` int")
    assert rows(null_report(df)) == [("a.b", 0, 0.0), ("c`d", 1, 50.0)]
    assert rows(duplicate_report(df, ["a.b"])) == [(1, 2)]
    assert [r[0] for r in rows(numeric_profile(df))] == ["a.b", "c`d"]
    assert value_range_check(df, "a.b", low=2).count() == 2
    assert quality_scorecard(df, "t", ["a.b", "c`d"]).count() == 4


def test_duplicates(example):
    assert rows(duplicate_summary(example, ["transaction_id"])) == [(5, 4, 1)]
    report = duplicate_report(example, ["transaction_id", "customer_id"])
    assert report.columns == ["transaction_id", "customer_id", "count"]
    assert rows(report) == [("S2", "K2", 2)]


def test_null_is_one_key(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert rows(duplicate_summary(df, ["k"])) == [(3, 2, 1)]
    assert rows(duplicate_report(df, ["k"])) == [(None, 2)]


def test_duplicates_are_ordered_by_count_then_key(spark):
    keys = [3] * 2 + [1] * 2 + [2] * 5 + [9]
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(5)
    assert rows(duplicate_report(df, ["k"])) == [(2, 5), (1, 2), (3, 2)]


def test_key_named_count(spark):
    df = spark.createDataFrame([(1,), (1,)], "count int")
    with pytest.raises(ValueError, match="count_name"):
        duplicate_report(df, ["count"])
    assert rows(duplicate_report(df, ["count"], count_name="times")) == [(1, 2)]


def test_ranges(example):
    assert [r["transaction_id"] for r in value_range_check(example, "net_revenue", low=0).collect()] == ["S4"]
    assert value_range_check(example, "net_revenue").count() == 0
    late = date_range_check(example, "transaction_date", "2023-03-01", "2023-03-09")
    assert [r["transaction_id"] for r in late.collect()] == ["S4"]


def test_profile(example):
    assert rows(numeric_profile(example)) == [
        ("net_revenue", 5, pytest.approx(21.6), pytest.approx(18.416704), -3.0, 40.0)
    ]


def test_profile_does_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(8)
    columns = {
        "plain": [rng.uniform(-1e6, 1e6) for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(3000)],
        "huge": [rng.uniform(1e300, 1.7e308) for _ in range(3000)],
        "tiny": [rng.uniform(0, 1e-300) for _ in range(3000)],
        "far": [1e9 + rng.random() for _ in range(3000)],
        "whole": [float(rng.randrange(10**6)) for _ in range(3000)],
        "same": [0.1] * 3000,
    }
    table = list(zip(*columns.values()))
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(table)
        df = spark.createDataFrame(table, ", ".join(f"{c} double" for c in columns)).repartition(seed * 3 + 1)
        found.add((tuple(rows(numeric_profile(df))), tuple(rows(full_report(df, "t", ["whole"])))))
    assert len(found) == 1
    profile = {r[0]: r for r in next(iter(found))[0]}
    for name, values in columns.items():
        exact = [Fraction(v) for v in values]
        mean = sum(exact) / len(exact)
        variance = sum((v - mean) ** 2 for v in exact) / (len(exact) - 1)
        assert profile[name][2] == pytest.approx(float(mean), rel=1e-14, abs=0), name
        scale = Fraction(10) ** 200 if name == "tiny" else Fraction(1, 10**200) if name == "huge" else Fraction(1)
        deviation = Fraction(math.sqrt(variance * scale * scale)) / scale
        assert profile[name][3] == pytest.approx(float(deviation), rel=1e-9, abs=1e-15 if name == "same" else 0), name
        assert profile[name][4:] == (min(values), max(values))


def test_profile_of_values_that_are_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    table = [(1.0, nan, inf, inf, -inf, None, 7, Decimal("1.50")), (2.0, 1.0, 1.0, -inf, 3.0, None, 9, Decimal("2.50"))]
    df = spark.createDataFrame(table, "a double, b double, c double, d double, e float, f double, g int, h decimal(10,2)")
    got = {r[0]: r[1:4] for r in rows(numeric_profile(df))}
    assert got["a"][:2] == (2, 1.5) and got["g"][:2] == (2, 8.0) and got["h"][:2] == (2, 2.0)
    assert [str(got[c][1]) for c in "bcde"] == ["nan", "inf", "nan", "-inf"]
    assert all(str(got[c][2]) == "nan" for c in "bcde")
    assert got["f"] == (0, None, None)


def test_scorecard(spark, example):
    card = quality_scorecard(
        example, "Sales", ["transaction_id", "customer_id"], dates=["transaction_date"],
        amounts=["net_revenue"],
    )
    assert rows(card) == [
        ("Sales", "*", "rows", 5, None),
        ("Sales", "transaction_id", "nulls", 0, 0.0),
        ("Sales", "customer_id", "nulls", 1, 20.0),
        ("Sales", "transaction_date", "unparsable", 0, 0.0),
        ("Sales", "net_revenue", "unparsable", 0, 0.0),
        ("Sales", "transaction_id", "duplicates", 1, None),
    ]
    odd = spark.createDataFrame([("1", "x", "31/12", float("nan")), ("1", "x", None, 1e20)], SCHEMA)
    counts = {(r[1], r[2]): r[3] for r in rows(quality_scorecard(
        odd, "odd", ["transaction_id"], dates=["transaction_date"], amounts=["net_revenue"]
    ))}
    assert counts["transaction_date", "unparsable"] == 1
    assert counts["net_revenue", "unparsable"] == 2


def test_gate_stops_on_the_first_two_columns_only(spark, example):
    with pytest.raises(QualityError, match="'customer_id' of Sales has 1 nulls"):
        quality_gate(example, "Sales", ["transaction_id", "customer_id"])
    passed = quality_gate(example, "Sales", ["transaction_id", "net_revenue", "customer_id"])
    assert passed.count() == 5
    both = spark.createDataFrame([(None, None)], "a int, b int")
    with pytest.raises(ValueError, match="'b'"):
        quality_gate(both, "t", ["b", "a"])


def test_blank_keys_pass_unless_asked(spark):
    df = spark.createDataFrame([(" ",)], "k string")
    quality_gate(df, "t", ["k"])
    with pytest.raises(QualityError):
        quality_gate(df, "t", ["k"], blank_is_null=True)


def test_null_gate(example):
    assert rows(assert_no_nulls(example, ["transaction_id"])) == [("transaction_id", 0, 0.0)]
    with pytest.raises(QualityError, match="customer_id"):
        assert_no_nulls(example, ["transaction_id", "customer_id"])


def test_full_report(example):
    report = {r[1:4]: r[4] for r in rows(full_report(example, "example", ["transaction_id"]))}
    assert report["table", "*", "total_rows"] == 5 and report["table", "*", "column_count"] == 4
    assert report["nulls", "customer_id", "null_pct"] == 20.0
    assert report["duplicates", "transaction_id", "duplicate_row_count"] == 1
    assert report["duplicates", "transaction_id", "distinct_keys"] == 4
    assert report["numeric", "net_revenue", "min"] == -3.0
    by_default = {r[1:4]: r[4] for r in rows(full_report(example.select("customer_id"), "x"))}
    assert by_default["duplicates", "customer_id", "distinct_keys"] == 3


def test_typed_dates_need_no_parsing(spark):
    df = spark.createDataFrame([(date(1998, 1, 1),)], "d date")
    assert quality_scorecard(df, "t", ["d"], dates=["d"]).count() == 3


@pytest.mark.parametrize("kind", ["double", "string", "decimal(20,2)"])
def test_amounts_that_do_not_fit(spark, kind):
    df = spark.createDataFrame(
        [("9999999999999998",), ("-9999999999999998",), ("10000000000000000",), ("-1e16",), ("0",), (None,)],
        "t string",
    ).selectExpr(f"cast(cast(t as double) as {kind}) as x")
    card = quality_scorecard(df, "t", ["x"], amounts=["x"])
    assert card.filter("check = 'unparsable'").collect()[0]["rows"] == 2


def test_profile_of_a_frame_without_numbers_is_empty(spark):
    none = numeric_profile(spark.createDataFrame([("a",)], "t string"))
    assert none.columns == ["column_name", "count", "mean", "stddev", "min", "max"] and none.count() == 0


def test_full_check_returns_the_offending_keys(spark, example):
    check = full_check(example, "t", ["transaction_id"])
    assert check.report.count() == full_report(example, "t", ["transaction_id"]).count()
    assert rows(check.duplicates) == rows(duplicate_report(example, ["transaction_id"])) != []


def test_a_scorecard_reads_its_table_once(spark, tables):
    sales = spark.read.parquet(f"{tables()}/orders.parquet")
    plan = quality_scorecard(sales, "t", ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
