"""The registered queries: every operator, run over the driver's tables.

The ledger queries work on three ledgers that Spark derives from ``orders``; the quality queries work on the
tables themselves. Money is computed in exact decimals and turned into doubles only in the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MONEY, JobConfig
from ..functions import as_date, clean_text, col, in_year, money, month_of
from ..operators import (
    assert_no_nulls,
    category_stats,
    cleanse_bank,
    cleanse_gl,
    cleanse_sales,
    date_range_check,
    detect_anomalies,
    duplicate_report,
    duplicate_summary,
    full_report,
    join_gl,
    join_ledgers,
    latest_version,
    monthly_summary,
    null_report,
    number_versions,
    numeric_profile,
    quality_scorecard,
    status_counts,
    tidy_sales,
    value_range_check,
    with_anomaly_flags,
    with_lags,
    with_variances,
    with_z_score,
)
from ..operators.cleanse import bank_rollup, gl_rollup, sales_order
from ..operators.summary import (
    SUMMARISED,
    anomalies_detected,
    by_month,
    matched_revenue,
    total_unreconciled,
)
from ..sources import ingest_audit, scan_parquet, scratch_path, stage, write_csv, write_table
from .derived import bank_ledger, gl_ledger, ledgers, order_base, sales_ledger
from .reconciliation import JobResult, cleanse_all, process, reconcile, run

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1998
# The derived sales hold NULL amounts on purpose, so only the keys are gated here.
CONFIG = JobConfig("", "", "", "", year=YEAR, gated_columns=1)


def published(df: DataFrame) -> DataFrame:
    """The result as plain types: decimals as double, dates as ISO text, whole numbers as bigint."""
    plain = []
    for f in df.schema.fields:
        value = col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            value = value.cast("string")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        plain.append(value.alias(f.name))
    return df.select(*plain)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def _round(df: DataFrame, **places: int) -> DataFrame:
    """Statistics to a fixed number of places, as their last digits depend on the order of rows."""
    return df.withColumns({name: F.round(col(name), n) for name, n in places.items()})


# ---- scans and scalar functions


def scan(spark, sf_dir):
    return _table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def scan_projection(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def audit(spark, sf_dir):
    sales, gl, bank = ledgers(order_base(spark, sf_dir))
    return ingest_audit({"sales": sales, "gl": gl, "bank": bank})


def period_filter(spark, sf_dir):
    sales = sales_ledger(order_base(spark, sf_dir))
    kept = sales.filter(in_year(sales, "transaction_date", YEAR))
    return kept.select("transaction_id", "transaction_date", "source_system")


def period_filter_spellings(spark, sf_dir):
    """Order dates as text with stray blanks and short months and days, read from a Parquet table."""
    day = F.col("o_orderdate").cast("date")
    short = F.concat_ws("-", F.year(day), F.month(day), F.day(day))
    spelled = F.when(F.col("o_orderkey") % 3 == 0, short).otherwise(day.cast("string"))
    spelled = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit(" "), spelled)).otherwise(spelled)
    text = stage(_table(spark, sf_dir, "orders").select("o_orderkey", spelled.alias("day")), "spelled")
    return text.filter(in_year(text, "day", YEAR))


def account_filter(spark, sf_dir):
    gl = gl_ledger(order_base(spark, sf_dir)).filter(F.col("account_type") == CONFIG.account_type)
    return gl.select("posting_id", "source_reference", "account_type", "net_amount")


def scalar_string_clean(spark, sf_dir):
    return sales_ledger(order_base(spark, sf_dir)).select(
        clean_text("transaction_id").alias("transaction_id"),
        clean_text("customer_id", upper=True).alias("customer_id"),
        clean_text("product_category", upper=True).alias("product_category"),
        "source_system",
    )


def scalar_dates(spark, sf_dir):
    sales = sales_ledger(order_base(spark, sf_dir))
    dated = sales.select(
        "transaction_id",
        "source_system",
        as_date(sales, "transaction_date").alias("transaction_date"),
        as_date(sales, "service_end_date").alias("service_end_date"),
    )
    return dated.withColumns(
        {
            "period": month_of("transaction_date"),
            "sale_year": F.year("transaction_date"),
            "service_days": F.datediff("service_end_date", "transaction_date"),
        }
    )


def scalar_money(spark, sf_dir):
    return sales_ledger(order_base(spark, sf_dir)).select(
        "transaction_id",
        "source_system",
        money("net_revenue", default=0).alias("net_revenue"),
        money("gross_revenue", default=0).alias("gross_revenue"),
        F.abs(money("net_revenue", default=0) - money("gross_revenue", default=0)).alias("markup"),
    )


# ---- versions, roll-ups, cleansing


def _numbered(spark, sf_dir, **limit):
    tidy = tidy_sales(sales_ledger(order_base(spark, sf_dir)))
    in_period = tidy.filter(in_year(tidy, "transaction_date", YEAR))
    narrow = in_period.select("transaction_id", "last_modified_date", "net_revenue", "source_system")
    return number_versions(narrow, ["transaction_id"], sales_order(narrow), **limit)


def row_number_rank(spark, sf_dir):
    return _numbered(spark, sf_dir)


def row_number_large_groups(spark, sf_dir):
    """The same with every key of more than one row taken for a large one."""
    return _numbered(spark, sf_dir, max_group_rows=1)


def dedup_latest(spark, sf_dir):
    tidy = tidy_sales(sales_ledger(order_base(spark, sf_dir)))
    kept = latest_version(tidy, ["transaction_id"], sales_order(tidy))
    return kept.select("transaction_id", "last_modified_date", "net_revenue", "source_system")


def distinct_rows(spark, sf_dir):
    sales = sales_ledger(order_base(spark, sf_dir))
    return sales.select(
        "transaction_id", "net_revenue", "gross_revenue", "tax_amount", "transaction_date"
    ).distinct()


def sales_clean(spark, sf_dir):
    return cleanse_sales(sales_ledger(order_base(spark, sf_dir)), YEAR)


def gl_clean(spark, sf_dir):
    return cleanse_gl(gl_ledger(order_base(spark, sf_dir)), YEAR)


def bank_clean(spark, sf_dir):
    return cleanse_bank(bank_ledger(order_base(spark, sf_dir)), YEAR)


def gl_rolled(spark, sf_dir):
    return gl_rollup(gl_ledger(order_base(spark, sf_dir)))


def bank_rolled(spark, sf_dir):
    return bank_rollup(bank_ledger(order_base(spark, sf_dir)))


# ---- reconciliation


def left_join_gl(spark, sf_dir):
    sales, gl, _ = cleanse_all(ledgers(order_base(spark, sf_dir)), CONFIG)
    joined = join_gl(sales, gl)
    return joined.select(
        "transaction_id", "transaction_date", "net_revenue", "posting_date", "gl_net_amount",
        "gl_gross_amount", "gl_tax_amount", "journal_count",
    )


def _joined(spark, sf_dir):
    return join_ledgers(*cleanse_all(ledgers(order_base(spark, sf_dir)), CONFIG))


ROW_KEY = ["transaction_id", "posting_date", "settlement_date"]


def recon_variance(spark, sf_dir):
    return with_variances(_joined(spark, sf_dir)).select(
        *ROW_KEY, "source_vs_gl_variance", "gl_vs_bank_variance"
    )


def recon_lags(spark, sf_dir):
    return with_lags(_joined(spark, sf_dir)).select(*ROW_KEY, "days_to_post", "days_to_settle")


def _reconciled(spark, sf_dir):
    return reconcile(ledgers(order_base(spark, sf_dir)), CONFIG)


def recon_status(spark, sf_dir):
    return _reconciled(spark, sf_dir).select(*ROW_KEY, "reconciliation_status")


def counts_by_status(spark, sf_dir):
    return status_counts(_reconciled(spark, sf_dir))


# ---- scoring and summary


def stats(spark, sf_dir):
    reconciled = _reconciled(spark, sf_dir)
    return _round(category_stats(reconciled), mean_val=3, std_val=3)


def _z(spark, sf_dir, columns: Sequence[str]):
    """The reconciled rows with z-scores, staged with only the columns that the query reports."""
    reconciled = stage(_reconciled(spark, sf_dir).select(*columns), "reconciled")
    return with_z_score(reconciled)


SCORED = [*ROW_KEY, "product_category", "source_net"]


def zscore(spark, sf_dir):
    return _round(_z(spark, sf_dir, SCORED), mean_val=3, std_val=3)


def anomaly_flag(spark, sf_dir):
    flagged = with_anomaly_flags(_z(spark, sf_dir, SCORED))
    return flagged.select(*ROW_KEY, "z_score", "anomaly_flag")


def anomaly_priority(spark, sf_dir):
    flagged = with_anomaly_flags(_z(spark, sf_dir, SCORED))
    return flagged.select(*ROW_KEY, "z_score", "anomaly_priority")


def _scored(spark, sf_dir):
    return detect_anomalies(stage(_reconciled(spark, sf_dir), "reconciled"))


def anomalies(spark, sf_dir):
    return _round(_scored(spark, sf_dir), mean_val=3, std_val=3)


def conditional_sum(spark, sf_dir):
    return by_month(
        _reconciled(spark, sf_dir),
        matched_revenue().alias("matched_revenue"),
        total_unreconciled().alias("total_unreconciled"),
    )


def conditional_count(spark, sf_dir):
    scored = with_anomaly_flags(_z(spark, sf_dir, ["transaction_date", "product_category", "source_net"]))
    return by_month(scored, anomalies_detected().alias("anomalies_detected"))


def summary(spark, sf_dir):
    return monthly_summary(with_anomaly_flags(_z(spark, sf_dir, SUMMARISED)))


def ratings(spark, sf_dir):
    return summary(spark, sf_dir).select("period", "reconciliation_rate_pct", "rag_status")


def pipeline_reconciled(spark, sf_dir):
    _, scored = process(ledgers(order_base(spark, sf_dir)), CONFIG)
    return _round(scored, mean_val=3, std_val=3)


def pipeline_summary(spark, sf_dir):
    _, scored = process(ledgers(order_base(spark, sf_dir)), CONFIG)
    return monthly_summary(scored)


def _with_option(**option) -> Query:
    def query(spark, sf_dir):
        _, scored = process(ledgers(order_base(spark, sf_dir)), replace(CONFIG, **option))
        return _round(scored, mean_val=3, std_val=3)

    return query


def _job(spark, sf_dir) -> JobResult:
    """The whole job with the default gate, from ledgers without NULL amounts in folders of their own."""
    root = scratch_path(spark, "job")
    sales, gl, bank = ledgers(order_base(spark, sf_dir))
    complete = sales.withColumn("net_revenue", F.coalesce("net_revenue", F.lit(0).cast(MONEY)))
    for df, name in ((complete, "sales"), (gl, "gl"), (bank, "bank")):
        write_table(df, f"{root}/in/{name}")
    return run(spark, JobConfig(f"{root}/in/sales", f"{root}/in/gl", f"{root}/in/bank", f"{root}/out", year=YEAR))


def job_transactions(spark, sf_dir):
    return _round(_job(spark, sf_dir).transactions, mean_val=3, std_val=3)


def job_summary(spark, sf_dir):
    return _job(spark, sf_dir).summary


def job_audit(spark, sf_dir):
    return _job(spark, sf_dir).audit


# ---- data quality


def nulls(spark, sf_dir):
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    # Only whether a text is there takes part in the join, so that no text is shuffled.
    present = documents.withColumn("text", F.when(col("text").isNotNull(), F.lit(True)))
    return null_report(present.join(labels, "doc_id", "left"))


def blank_nulls(spark, sf_dir):
    """Blank text counted as missing."""
    remainder = F.col("o_orderkey") % 4
    note = F.when(remainder == 0, F.lit("  ")).when(remainder > 1, F.col("o_orderpriority"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note"))
    return null_report(orders, blank_is_null=True)


LINE_KEY = ["l_orderkey", "l_linenumber"]


def repeated_lines(spark, sf_dir):
    return duplicate_report(_table(spark, sf_dir, "lineitem"), LINE_KEY, "row_count")


def line_duplicates(spark, sf_dir):
    return duplicate_summary(_table(spark, sf_dir, "lineitem"), LINE_KEY)


def _balance_outside(low=None, high=None) -> Query:
    def query(spark, sf_dir):
        return value_range_check(_table(spark, sf_dir, "customer"), "c_acctbal", low, high)

    return query


def ship_dates(spark, sf_dir):
    late = date_range_check(
        _table(spark, sf_dir, "lineitem"), "l_shipdate", "1996-01-01", "2000-12-31"
    )
    return late.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def profile(spark, sf_dir):
    return _round(numeric_profile(_table(spark, sf_dir, "lineitem")), mean=3, stddev=3)


def scorecard(spark, sf_dir):
    sales = sales_ledger(order_base(spark, sf_dir))
    return quality_scorecard(
        sales,
        "Sales",
        ["transaction_id", "net_revenue", "transaction_date"],
        dates=["transaction_date"],
        amounts=["net_revenue"],
    )


def gate(spark, sf_dir):
    return assert_no_nulls(_table(spark, sf_dir, "lineitem"), LINE_KEY, "lineitem")


def quality_report(spark, sf_dir):
    return _round(full_report(_table(spark, sf_dir, "lineitem"), "lineitem", LINE_KEY), value=3)


# ---- sinks


def parquet_roundtrip(spark, sf_dir):
    written = write_table(_scored(spark, sf_dir), scratch_path(spark, "transaction_level"))
    return _round(written, mean_val=3, std_val=3)


def csv_roundtrip(spark, sf_dir):
    months = write_table(summary(spark, sf_dir), scratch_path(spark, "summary"))
    path = scratch_path(spark, "summary_csv")
    write_csv(months, path)
    return spark.read.schema(months.schema).option("header", "true").csv(path)


QUERIES: dict[str, Query] = {
    "scan_parquet": scan,
    "scan_projection": scan_projection,
    "ingest_audit": audit,
    "period_filter": period_filter,
    "period_filter_spellings": period_filter_spellings,
    "account_filter": account_filter,
    "scalar_string_clean": scalar_string_clean,
    "scalar_dates": scalar_dates,
    "scalar_money": scalar_money,
    "row_number_rank": row_number_rank,
    "row_number_large_groups": row_number_large_groups,
    "dedup_latest": dedup_latest,
    "distinct_rows": distinct_rows,
    "cleanse_sales": sales_clean,
    "gl_rollup": gl_rolled,
    "cleanse_gl": gl_clean,
    "bank_rollup": bank_rolled,
    "cleanse_bank": bank_clean,
    "left_join_gl": left_join_gl,
    "three_way_join": _joined,
    "recon_variance": recon_variance,
    "recon_lags": recon_lags,
    "recon_status": recon_status,
    "three_way_reconciliation": _reconciled,
    "status_counts": counts_by_status,
    "category_stats": stats,
    "zscore": zscore,
    "anomaly_flag": anomaly_flag,
    "anomaly_priority": anomaly_priority,
    "detect_anomalies": anomalies,
    "conditional_sum": conditional_sum,
    "conditional_count": conditional_count,
    "rag_rating": ratings,
    "monthly_summary": summary,
    "pipeline_reconciled": pipeline_reconciled,
    "pipeline_summary": pipeline_summary,
    "pipeline_reference_grain": _with_option(grain="reference"),
    "pipeline_null_category": _with_option(null_category="keep"),
    "pipeline_grace_days": _with_option(grace_days=31),
    "job_transactions": job_transactions,
    "job_summary": job_summary,
    "job_audit": job_audit,
    "null_report": nulls,
    "null_report_blanks": blank_nulls,
    "duplicate_report": repeated_lines,
    "duplicate_summary": line_duplicates,
    "value_range_min": _balance_outside(low=0),
    "value_range_max": _balance_outside(high=9000),
    "value_range_both": _balance_outside(low=0, high=9000),
    "value_range_none": _balance_outside(),
    "date_range_check": ship_dates,
    "numeric_profile": profile,
    "quality_scorecard": scorecard,
    "null_gate": gate,
    "full_quality_report": quality_report,
    "sink_roundtrip_parquet": parquet_roundtrip,
    "sink_roundtrip_csv": csv_roundtrip,
}


def catalog() -> dict[str, Query]:
    """All queries by name, each with its result in plain types."""

    def plain(query: Query) -> Query:
        return lambda spark, sf_dir: published(query(spark, sf_dir))

    return {name: plain(query) for name, query in QUERIES.items()}
