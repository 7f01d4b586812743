"""Three-way reconciliation of sales, general ledger and bank."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BankColumns, GlColumns, SalesColumns
from ..functions import gap, reconciliation_status

TOLERANCE = Decimal("0.01")
LATE_AFTER_DAYS = 5


def join_gl(
    sales: DataFrame,
    gl: DataFrame,
    sales_columns: SalesColumns = SalesColumns(),
    gl_columns: GlColumns = GlColumns(),
) -> DataFrame:
    """Every sale (as ``s``) with its GL roll-up rows (as ``g``), or with NULLs if it has none."""
    same = _of("s", sales_columns.key) == _of("g", gl_columns.reference)
    return sales.alias("s").join(gl.alias("g"), same, "left")


def _of(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name}`")


def join_ledgers(
    sales: DataFrame,
    gl: DataFrame,
    bank: DataFrame,
    sales_columns: SalesColumns = SalesColumns(),
    gl_columns: GlColumns = GlColumns(),
    bank_columns: BankColumns = BankColumns(),
) -> DataFrame:
    """Every sale with its GL and bank rows; the bank is matched on the sale, with or without a GL row.

    A sale with m posting dates and n settlement dates gives m x n rows. Both numbers are at most the days
    of the period, as roll-ups have one row per reference and date, so no sale can flood a task. The sales
    keep the partitioning by key of the version step, and both joins use it.
    """
    s, g, b = sales_columns, gl_columns, bank_columns
    same = _of("s", s.key) == _of("b", b.reference)
    joined = join_gl(sales, gl, s, g).join(bank.alias("b"), same, "left")
    return joined.select(
        _of("s", s.key).alias("transaction_id"),
        _of("s", s.customer).alias("customer_id"),
        _of("s", s.date).alias("transaction_date"),
        _of("s", s.category).alias("product_category"),
        _of("s", s.net).alias("source_net"),
        _of("s", s.gross).alias("source_gross"),
        "g.gl_net_amount",
        "g.gl_gross_amount",
        _of("g", g.date).alias("posting_date"),
        "b.bank_settled_amount",
        _of("b", b.date).alias("settlement_date"),
    )


def with_variances(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            "source_vs_gl_variance": gap("source_net", "gl_net_amount"),
            "gl_vs_bank_variance": gap("gl_net_amount", "bank_settled_amount"),
        }
    )


def with_lags(joined: DataFrame) -> DataFrame:
    """Days from sale to posting and from posting to settlement; NULL if either is missing."""
    return joined.withColumns(
        {
            "days_to_post": F.datediff("posting_date", "transaction_date"),
            "days_to_settle": F.datediff("settlement_date", "posting_date"),
        }
    )


def with_status(
    df: DataFrame, tolerance: Decimal = TOLERANCE, late_after_days: int = LATE_AFTER_DAYS
) -> DataFrame:
    return df.withColumn(
        "reconciliation_status",
        reconciliation_status(
            in_gl=F.col("gl_net_amount").isNotNull(),
            in_bank=F.col("bank_settled_amount").isNotNull(),
            gl_gap=F.col("source_vs_gl_variance"),
            bank_gap=F.col("gl_vs_bank_variance"),
            days_to_post=F.col("days_to_post"),
            tolerance=tolerance,
            late_after_days=late_after_days,
        ),
    )


def three_way_reconciliation(
    sales: DataFrame,
    gl: DataFrame,
    bank: DataFrame,
    tolerance: Decimal = TOLERANCE,
    late_after_days: int = LATE_AFTER_DAYS,
    sales_columns: SalesColumns = SalesColumns(),
    gl_columns: GlColumns = GlColumns(),
    bank_columns: BankColumns = BankColumns(),
) -> DataFrame:
    """Cleansed ledgers joined, with variances, lags and a status per row."""
    joined = join_ledgers(sales, gl, bank, sales_columns, gl_columns, bank_columns)
    return with_status(with_lags(with_variances(joined)), tolerance, late_after_days)


def status_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("row_count"))
