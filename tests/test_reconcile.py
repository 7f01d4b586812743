import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import (
    category_stats, detect_anomalies, monthly_summary, three_way_reconciliation, with_anomaly_flags,
    with_z_score,
)

SALES = (
    "transaction_id string, customer_id string, transaction_date date, product_category string, "
    "net_revenue decimal(18,2), gross_revenue decimal(18,2)"
)
GL = "source_reference string, posting_date date, gl_net_amount decimal(28,2), gl_gross_amount decimal(28,2)"
BANK = "reference_id string, settlement_date date, bank_settled_amount decimal(28,2)"


def money(text):
    return None if text is None else Decimal(text)


def reconcile(spark, sales, gl, bank, **options):
    """Ledgers given as (id, net), (id, day in March, net) and (id, day in March, settled)."""
    s = [(i, "C", date(1998, 3, 1), "BOOKS", money(net), money(net)) for i, net in sales]
    g = [(i, date(1998, 3, d), money(net), money(net)) for i, d, net in gl]
    b = [(i, date(1998, 3, d), money(amount)) for i, d, amount in bank]
    return three_way_reconciliation(
        spark.createDataFrame(s, SALES), spark.createDataFrame(g, GL), spark.createDataFrame(b, BANK),
        **options,
    )


CASES = {
    "matched": ("10.00", [(1, "10.00")], [(2, "10.00")], "MATCHED"),
    "within tolerance": ("10.00", [(1, "10.01")], [(2, "10.02")], "MATCHED"),
    "no gl": ("10.00", [], [(2, "10.00")], "MISSING_IN_GL"),
    "neither": ("10.00", [], [], "MISSING_IN_GL"),
    "gl without amount": ("10.00", [(1, None)], [(2, "10.00")], "MISSING_IN_GL"),
    "no bank": ("10.00", [(1, "99.00")], [], "MISSING_IN_BANK"),
    "both off": ("10.00", [(1, "11.00")], [(2, "12.00")], "MULTI_SYSTEM_VARIANCE"),
    "gl off": ("10.00", [(1, "10.02")], [(2, "10.02")], "GL_VARIANCE"),
    "bank off": ("10.00", [(1, "10.00")], [(2, "9.98")], "BANK_VARIANCE"),
    "five days": ("10.00", [(6, "10.00")], [(6, "10.00")], "MATCHED"),
    "six days": ("10.00", [(7, "10.00")], [(7, "10.00")], "TIMING_DIFFERENCE"),
    "six days and off": ("10.00", [(7, "10.00")], [(7, "9.00")], "BANK_VARIANCE"),
}


@pytest.mark.parametrize("name", CASES)
def test_status(spark, name):
    net, gl, bank, status = CASES[name]
    row = reconcile(
        spark, [("T1", net)], [("T1", *g) for g in gl], [("T1", *b) for b in bank]
    ).collect()[0]
    assert row["reconciliation_status"] == status


def test_columns_variances_and_lags(spark):
    df = reconcile(spark, [("T1", "10.00")], [("T1", 4, "8.00")], [("T1", 2, "7.50")])
    assert df.columns == [
        "transaction_id", "customer_id", "transaction_date", "product_category", "source_net",
        "source_gross", "gl_net_amount", "gl_gross_amount", "posting_date", "bank_settled_amount",
        "settlement_date", "source_vs_gl_variance", "gl_vs_bank_variance", "days_to_post",
        "days_to_settle", "reconciliation_status",
    ]
    row = df.collect()[0]
    assert (row["source_vs_gl_variance"], row["gl_vs_bank_variance"]) == (Decimal("2.00"), Decimal("0.50"))
    assert (row["days_to_post"], row["days_to_settle"]) == (3, -2)


def test_bank_matches_without_gl(spark):
    row = reconcile(spark, [("T1", "10.00")], [], [("T1", 2, "7.50")]).collect()[0]
    assert row["bank_settled_amount"] == Decimal("7.50")
    assert row["gl_vs_bank_variance"] == Decimal("-7.50") and row["days_to_settle"] is None


def test_fan_out_is_posting_dates_times_settlement_dates(spark):
    df = reconcile(
        spark,
        [("T1", "10.00"), ("T2", "1.00")],
        [("T1", 1, "4.00"), ("T1", 2, "6.00")],
        [("T1", d, "1.00") for d in (3, 4, 5)],
    )
    counts = {r["transaction_id"]: r["count"] for r in df.groupBy("transaction_id").count().collect()}
    assert counts == {"T1": 6, "T2": 1}


def test_tolerance_and_lateness_are_settings(spark):
    one = ([("T1", "10.00")], [("T1", 4, "10.50")], [("T1", 4, "10.50")])
    assert reconcile(spark, *one, tolerance=Decimal("0.50")).collect()[0][-1] == "MATCHED"
    late = reconcile(spark, *one, tolerance=Decimal("0.50"), late_after_days=2).collect()[0]
    assert late[-1] == "TIMING_DIFFERENCE"


SCORING = "id int, product_category string, source_net decimal(18,2)"


def scoring_rows():
    rows = [(i, "A", Decimal("10.00")) for i in range(40)] + [(100, "A", Decimal("500.00"))]
    rows += [(200, "SINGLE", Decimal("7.00"))]
    rows += [(300 + i, "FLAT", Decimal("0.10")) for i in range(5)]
    rows += [(400 + i, None, Decimal(i * i)) for i in range(4)]
    return rows


@pytest.mark.parametrize("max_broadcast_bytes", [10_000, 0])
def test_scores(spark, max_broadcast_bytes):
    df = spark.createDataFrame(scoring_rows(), SCORING).repartition(4)
    scored = with_anomaly_flags(with_z_score(df, max_broadcast_bytes=max_broadcast_bytes))
    assert scored.columns[0] == "product_category"
    rows = {r["id"]: r for r in scored.collect()}
    assert not [i for i in rows if i >= 400]  # rows without a category are left out
    assert (rows[100]["anomaly_flag"], rows[100]["anomaly_priority"]) == ("ANOMALY", "HIGH")
    assert (rows[0]["anomaly_flag"], rows[0]["anomaly_priority"]) == ("NORMAL", "NONE")
    assert rows[200]["std_val"] is None and rows[200]["z_score"] is None
    assert rows[200]["anomaly_flag"] == "NORMAL"
    assert rows[300]["std_val"] == 0.0 and rows[300]["z_score"] == 0.0


@pytest.mark.parametrize("max_broadcast_bytes", [10_000, 0])
def test_rows_without_category_can_be_kept(spark, max_broadcast_bytes):
    df = spark.createDataFrame(scoring_rows(), SCORING)
    kept = with_z_score(df, null_category="keep", max_broadcast_bytes=max_broadcast_bytes)
    scores = {r["id"]: r["z_score"] for r in kept.collect()}
    assert len(scores) == len(scoring_rows())
    assert scores[403] == 1.361  # of 0, 1, 4, 9: mean 3.5, deviation 4.0415


def test_flag_edges(spark):
    df = spark.createDataFrame(
        [(2.0,), (-2.0,), (2.001,), (-4.0,), (4.001,), (-4.001,), (None,)], "z_score double"
    )
    assert [tuple(r) for r in with_anomaly_flags(df).collect()] == [
        (2.0, "NORMAL", "NONE"), (-2.0, "NORMAL", "NONE"), (2.001, "ANOMALY", "MEDIUM"),
        (-4.0, "ANOMALY", "MEDIUM"), (4.001, "ANOMALY", "HIGH"), (-4.001, "ANOMALY", "HIGH"),
        (None, "NORMAL", "NONE"),
    ]


SCORED = (
    "transaction_date date, source_net decimal(18,2), source_vs_gl_variance decimal(29,2), "
    "reconciliation_status string, anomaly_flag string"
)


def test_monthly_summary(spark):
    rows = [
        (date(1998, 2, 3), Decimal("99.00"), Decimal("0.00"), "MATCHED", "NORMAL"),
        (date(1998, 2, 4), Decimal("1.00"), Decimal("-3.00"), "GL_VARIANCE", "ANOMALY"),
        (date(1998, 1, 4), Decimal("95.00"), Decimal("0.01"), "MATCHED", "NORMAL"),
        (date(1998, 1, 5), Decimal("5.00"), Decimal("0.00"), "BANK_VARIANCE", "NORMAL"),
        (date(1998, 3, 5), Decimal("0.00"), Decimal("0.00"), "MATCHED", "NORMAL"),
    ]
    out = monthly_summary(spark.createDataFrame(rows, SCORED))
    assert out.columns == [
        "period", "total_transactions", "total_source_revenue", "matched_revenue", "total_unreconciled",
        "anomalies_detected", "reconciliation_rate_pct", "rag_status",
    ]
    assert [tuple(r) for r in out.collect()] == [
        ("1998-01", 2, Decimal("100.00"), Decimal("95.00"), Decimal("0.00"), 0, 95.0, "AMBER"),
        ("1998-02", 2, Decimal("100.00"), Decimal("99.00"), Decimal("3.00"), 1, 99.0, "GREEN"),
        ("1998-03", 1, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), 0, None, "RED"),
    ]


def test_row_order_does_not_matter(spark):
    rows = scoring_rows()
    seen = []
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCORING).repartition(1 + 4 * seed)
        scored = detect_anomalies(df).select("id", "mean_val", "z_score", "anomaly_priority")
        seen.append(sorted(map(tuple, scored.collect())))
    assert seen[0] == seen[1]


def test_mean_does_not_depend_on_row_order(spark):
    rows = [(i, "A", Decimal(i) / 100 + (Decimal(10) ** (i % 15))) for i in range(500)]
    means = {
        category_stats(spark.createDataFrame(part, SCORING).repartition(n)).collect()[0]["mean_val"]
        for part, n in ((rows, 1), (rows[::-1], 3), (rows, 7))
    }
    assert len(means) == 1


def test_deviation_does_not_depend_on_the_order_of_rows(spark):
    rows = spark.range(20_000).selectExpr(
        "concat('c', id % 3) product_category",
        "cast((hash(id) % 100000000) / 100.0 as decimal(18,2)) source_net",
    )
    results = []
    for seed, parts in ((1, 3), (2, 8)):
        shuffled = rows.orderBy(F.rand(seed)).repartition(parts)
        results.append(sorted(map(tuple, category_stats(shuffled).collect())))
    assert results[0] == results[1]
    usual = dict(rows.groupBy("product_category").agg(F.stddev_samp(F.col("source_net").cast("double"))).collect())
    for category, _, deviation in results[0]:
        assert abs(deviation - usual[category]) < 1e-6 * usual[category]


def test_deviation_of_the_largest_amounts(spark):
    big = "9999999999999999.99"
    rows = spark.sql(f"select 'c' product_category, explode(array({big}BD, -{big}BD)) source_net")
    row = category_stats(rows).collect()[0]
    assert row["mean_val"] == 0.0 and abs(row["std_val"] / (1e16 * 2**0.5) - 1) < 1e-12
