"""The monthly summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MONEY
from ..functions import month_of, rag_rating
from ..functions.rules import ANOMALY, MATCHED

# The columns of reconciled rows that the summary reads, the scores aside.
SUMMARISED = (
    "transaction_date", "product_category", "source_net", "source_vs_gl_variance", "reconciliation_status",
)
GREEN_FROM = 99.0
AMBER_FROM = 95.0


def matched_revenue() -> Column:
    """Net revenue of matched rows."""
    return _sum_where(F.col("reconciliation_status") == MATCHED, F.col("source_net"))


def total_unreconciled() -> Column:
    """Size of the sales-to-GL gap over all rows that are not matched."""
    return _sum_where(
        F.col("reconciliation_status") != MATCHED, F.abs("source_vs_gl_variance")
    )


def anomalies_detected() -> Column:
    return F.count_if(F.col("anomaly_flag") == ANOMALY)


def _sum_where(condition: Column, amount: Column) -> Column:
    return F.sum(F.when(condition, amount).otherwise(F.lit(0).cast(MONEY)))


def by_month(df: DataFrame, *aggregates: Column, date: str = "transaction_date") -> DataFrame:
    return df.groupBy(month_of(date).alias("period")).agg(*aggregates)


def with_rating(
    summary: DataFrame, green_from: float = GREEN_FROM, amber_from: float = AMBER_FROM
) -> DataFrame:
    """Matched revenue as a percentage of all revenue, and its traffic light. No revenue is RED."""
    share = F.try_divide(
        F.lit(100.0) * F.col("matched_revenue").cast("double"),
        F.col("total_source_revenue").cast("double"),
    )
    return summary.withColumn("reconciliation_rate_pct", F.round(share, 2)).withColumn(
        "rag_status", rag_rating(F.col("reconciliation_rate_pct"), green_from, amber_from)
    )


def monthly_summary(
    scored: DataFrame, green_from: float = GREEN_FROM, amber_from: float = AMBER_FROM
) -> DataFrame:
    """One row per month in order of month."""
    months = by_month(
        scored,
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("source_net").alias("total_source_revenue"),
        matched_revenue().alias("matched_revenue"),
        total_unreconciled().alias("total_unreconciled"),
        anomalies_detected().alias("anomalies_detected"),
    )
    return with_rating(months, green_from, amber_from).orderBy("period")
