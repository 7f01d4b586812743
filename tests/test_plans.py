"""What the physical plans must look like."""

import contextlib
import io
import re

import pytest

from tallyweave.operators import (
    cleanse_bank, cleanse_gl, cleanse_sales, date_range_check, status_counts, value_range_check, with_z_score,
)
from tallyweave.plans import cleanse_all, reconcile
from tallyweave.plans.catalog import CONFIG, QUERIES
from tallyweave.sources import stage
from tallyweave.plans.derived import ledgers, order_base


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return re.sub(r"#\d+", "", text.getvalue())


@pytest.fixture(scope="module")
def raw(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    frames = []
    for name, df in zip(("sales", "gl", "bank"), ledgers(order_base(spark, tables()))):
        df.write.parquet(str(root / name))
        frames.append(spark.read.parquet(str(root / name)))
    return tuple(frames)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(text):
    """The names of the columns that each scan reads."""
    return [
        set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>\n", text)
    ]


def test_account_filter_reaches_the_scan(raw):
    text = plan(cleanse_gl(raw[1], 1998))
    assert "EqualTo(account_type,REVENUE)" in text


def test_text_date_ranges_reach_the_scan(raw):
    frames = (
        (cleanse_sales(raw[0], 1998), "transaction_date"),
        (cleanse_gl(raw[1], 1998), "posting_date"),
        (cleanse_bank(raw[2], 1998), "settlement_date"),
    )
    for df, name in frames:
        year = f"And(GreaterThanOrEqual({name},1998),LessThan({name},1999))"
        assert f"Or(Or(LessThan({name},1),{year}),GreaterThanOrEqual({name},\x7f))" in plan(df)


def test_ranges_reach_the_scan(spark, tables):
    customers = spark.read.parquet(f"{tables()}/customer.parquet")
    text = plan(value_range_check(customers, "c_acctbal", 0, 9000))
    assert "Or(LessThan(c_acctbal,0.0),GreaterThan(c_acctbal,9000.0))" in text
    lines = spark.read.parquet(f"{tables()}/lineitem.parquet")
    text = plan(date_range_check(lines, "l_shipdate", "1996-01-01", "1996-12-31"))
    assert "Or(LessThan(l_shipdate,1996-01-01" in text


def test_versions_are_limited_before_the_shuffle(raw):
    text = plan(cleanse_sales(raw[0], 1998))
    assert text.count("WindowGroupLimit") >= 2


def test_only_the_columns_in_use_are_read(raw):
    sales, _, _ = scans(plan(reconcile(raw, CONFIG)))
    assert sales == {
        "transaction_id", "customer_id", "product_category", "transaction_date", "gross_revenue",
        "net_revenue", "last_modified_date",
    }
    # For the counts of each status only the net amounts are read of GL and bank.
    _, gl, bank = scans(plan(status_counts(reconcile(raw, CONFIG))))
    assert gl == {"source_reference", "account_type", "posting_date", "net_amount"}
    assert bank == {"reference_id", "settlement_date", "settled_amount"}


def test_sales_are_shuffled_once(raw, no_broadcast):
    text = plan(reconcile(raw, CONFIG))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 5  # sales once; GL and bank by reference and date, then by reference
    assert "CartesianProduct" not in tree and "BroadcastNestedLoopJoin" not in tree


def test_statistics_are_broadcast_and_rows_stay_in_place(spark, raw, no_broadcast):
    scored = with_z_score(stage(reconcile(raw, CONFIG), "plan"))
    tree = plan(scored).split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
    # The only exchange is the broadcast of the statistics.
    assert re.findall(r"\b(\w*Exchange)\b", tree) == ["BroadcastExchange"]


def test_many_categories_are_joined_by_a_shuffle(spark, raw, no_broadcast):
    scored = with_z_score(stage(reconcile(raw, CONFIG), "plan"), max_broadcast_bytes=0)
    assert "SortMergeJoin" in plan(scored)


def test_no_query_uses_a_cross_join(spark, tables):
    for name in ("pipeline_summary", "full_quality_report", "quality_scorecard", "null_report"):
        text = plan(QUERIES[name](spark, tables()))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_cleansed_frames_are_lazy(spark, raw):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    cleanse_all(raw, CONFIG)
    reconcile(raw, CONFIG)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
