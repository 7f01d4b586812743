"""Settings of the reconciliation job. Every operator also takes them as plain arguments."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


@dataclass(frozen=True)
class SalesColumns:
    """Column names of a sales ledger."""

    key: str = "transaction_id"
    customer: str = "customer_id"
    category: str = "product_category"
    date: str = "transaction_date"
    net: str = "net_revenue"
    gross: str = "gross_revenue"
    tax: str = "tax_amount"
    modified: str = "last_modified_date"


@dataclass(frozen=True)
class GlColumns:
    """Column names of a general ledger."""

    reference: str = "source_reference"
    date: str = "posting_date"
    account: str = "account_type"
    net: str = "net_amount"
    gross: str = "debit_amount"
    tax: str = "tax_posted"
    journal: str = "journal_id"


@dataclass(frozen=True)
class BankColumns:
    """Column names of a bank statement ledger."""

    reference: str = "reference_id"
    date: str = "settlement_date"
    settled: str = "settled_amount"
    fee: str = "fee_deducted"


# The schemas of the three source ledgers. Dates and times are kept as ISO text.
SALES_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_code", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("transaction_date", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("gross_revenue", T.DoubleType()),
        T.StructField("net_revenue", T.DoubleType()),
        T.StructField("tax_amount", T.DoubleType()),
        T.StructField("service_start_date", T.StringType()),
        T.StructField("service_end_date", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("last_modified_date", T.StringType()),
    ]
)
GL_SCHEMA = T.StructType(
    [
        T.StructField("posting_id", T.StringType()),
        T.StructField("journal_id", T.StringType()),
        T.StructField("source_reference", T.StringType()),
        T.StructField("account_type", T.StringType()),
        T.StructField("posting_date", T.StringType()),
        T.StructField("debit_amount", T.DoubleType()),
        T.StructField("net_amount", T.DoubleType()),
        T.StructField("tax_posted", T.DoubleType()),
        T.StructField("posted_by", T.StringType()),
    ]
)
BANK_SCHEMA = T.StructType(
    [
        T.StructField("settlement_id", T.StringType()),
        T.StructField("reference_id", T.StringType()),
        T.StructField("settlement_date", T.StringType()),
        T.StructField("settled_amount", T.DoubleType()),
        T.StructField("fee_deducted", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
    ]
)


@dataclass(frozen=True)
class JobConfig:
    """One run of the job.

    The rules above the blank line have the usual values. The options below it change how data is read:

    grain           "date" keeps one row per sale, posting date and settlement date;
                    "reference" first brings GL and bank down to one row per reference.
    null_category   "drop" leaves sales without a category out of the scored rows; "keep" scores them
                    as a category of their own.
    grace_days      days after the year's end in which GL and bank rows still count.
    blank_is_null   the quality gate counts blank text as missing.
    staging_path    folder for intermediate tables, which the job removes; by default below the output.
    """

    sales_path: str
    gl_path: str
    bank_path: str
    output_path: str
    year: int
    variance_tolerance: Decimal = Decimal("0.01")
    z_threshold: float = 2.0
    high_multiple: float = 2.0
    late_after_days: int = 5
    green_from: float = 99.0
    amber_from: float = 95.0
    account_type: str = "REVENUE"
    gated_columns: int = 2

    grain: str = "date"
    null_category: str = "drop"
    grace_days: int = 0
    blank_is_null: bool = False
    output_format: str = "parquet"
    staging_path: str | None = None

    sales: SalesColumns = field(default_factory=SalesColumns)
    gl: GlColumns = field(default_factory=GlColumns)
    bank: BankColumns = field(default_factory=BankColumns)

    @property
    def staging_folder(self) -> str | None:
        """Where intermediate tables go; None, the session's shared folder, for a job without output."""
        return self.staging_path or (f"{self.output_path.rstrip('/')}/_staging" if self.output_path else None)

    @property
    def source_paths(self) -> tuple[str, str, str]:
        return self.sales_path, self.gl_path, self.bank_path
