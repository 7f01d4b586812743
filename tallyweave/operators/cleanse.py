"""Cleansing, the period filter and the roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BankColumns, GlColumns, SalesColumns
from ..functions import as_date, clean_text, col, in_year, money
from .versions import latest_version, newest_first


def tidy_sales(df: DataFrame, columns: SalesColumns = SalesColumns()) -> DataFrame:
    """Sales with trimmed keys, upper-case customer and category, real dates and complete amounts."""
    c = columns
    cleaned = {
        c.key: clean_text(c.key),
        c.customer: clean_text(c.customer, upper=True),
        c.category: clean_text(c.category, upper=True),
        c.date: as_date(df, c.date),
        c.gross: money(c.gross, default=0),
        c.net: money(c.net, default=0),
    }
    if c.tax in df.columns:
        cleaned[c.tax] = money(c.tax, default=0)
    return df.withColumns(cleaned)


def reconciled_columns(columns: SalesColumns = SalesColumns()) -> list[str]:
    """The sales columns that reconciliation reads. Reading no others halves the scan and the shuffle."""
    c = columns
    return [c.key, c.modified, c.net, c.gross, c.customer, c.category, c.date]


def sales_order(df: DataFrame, columns: SalesColumns = SalesColumns()) -> list[Column]:
    """Newest version first; among equally new ones the largest net, then the remaining columns.

    The columns that reconciliation reads come first, so that it picks the same version from a frame of
    those columns alone.
    """
    _, modified, *first = reconciled_columns(columns)
    ties = [name for name in first if name in df.columns]
    others = [name for name in df.columns if name not in (columns.key, modified, *ties)]
    return newest_first(modified, (*ties, *others))


def cleanse_sales(
    df: DataFrame, year: int, columns: SalesColumns = SalesColumns()
) -> DataFrame:
    """Tidy sales of one year, one row per key: the version modified last within that year.

    The year is filtered before the versions are compared, so a later version dated in another year does
    not replace one of this year.
    """
    period = df.filter(in_year(df, columns.date, year))
    tidy = tidy_sales(period, columns)
    return latest_version(tidy, [columns.key], sales_order(tidy, columns))


def roll_up(
    df: DataFrame,
    by: Sequence[str],
    sums: Mapping[str, str],
    counts: Mapping[str, str | None],
) -> DataFrame:
    """Group by ``by``; ``sums`` and ``counts`` map result names to columns.

    A count of a column skips its NULLs, a count of None counts rows. Sums of money are exact decimals,
    so they do not depend on the order of rows. Spark adds up within each input partition before the
    shuffle, so a hot key arrives as one row per partition.
    """
    aggregates = [F.sum(col(source)).alias(name) for name, source in sums.items()]
    for name, source in counts.items():
        counted = F.lit(1) if source is None else col(source)
        aggregates.append(F.count(counted).alias(name))
    return df.groupBy(*map(col, by)).agg(*aggregates)


def cleanse_gl(
    df: DataFrame,
    year: int,
    account_type: str = "REVENUE",
    grace_days: int = 0,
    columns: GlColumns = GlColumns(),
) -> DataFrame:
    """Postings to one type of account in one year, added up per reference and posting date."""
    c = columns
    period = df.filter(
        (col(c.account) == account_type) & in_year(df, c.date, year, grace_days)
    )
    tidy = period.withColumns(
        {
            c.reference: clean_text(c.reference),
            c.date: as_date(period, c.date),
            c.net: money(c.net),
            c.gross: money(c.gross),
            c.tax: money(c.tax),
        }
    )
    return gl_rollup(tidy, c)


def gl_rollup(tidy: DataFrame, columns: GlColumns = GlColumns()) -> DataFrame:
    c = columns
    return roll_up(
        tidy,
        [c.reference, c.date],
        {"gl_net_amount": c.net, "gl_gross_amount": c.gross, "gl_tax_amount": c.tax},
        {"journal_count": c.journal},
    )


def cleanse_bank(
    df: DataFrame,
    year: int,
    grace_days: int = 0,
    columns: BankColumns = BankColumns(),
) -> DataFrame:
    """Settlements of one year, added up per reference and settlement date."""
    c = columns
    period = df.filter(in_year(df, c.date, year, grace_days))
    tidy = period.withColumns(
        {
            c.reference: clean_text(c.reference),
            c.date: as_date(period, c.date),
            c.settled: money(c.settled),
            c.fee: money(c.fee),
        }
    )
    return bank_rollup(tidy, c)


def bank_rollup(tidy: DataFrame, columns: BankColumns = BankColumns()) -> DataFrame:
    c = columns
    return roll_up(
        tidy,
        [c.reference, c.date],
        {"bank_settled_amount": c.settled, "bank_fees": c.fee},
        {"settlement_count": None},
    )


def per_reference(rolled: DataFrame, reference: str, date: str) -> DataFrame:
    """A roll-up brought down to one row per reference: earliest date, all amounts and counts added up.

    Joining this instead of the per-date roll-up keeps one row per sale.
    """
    totals = [
        F.sum(col(name)).alias(name) for name in rolled.columns if name not in (reference, date)
    ]
    return rolled.groupBy(col(reference)).agg(F.min(col(date)).alias(date), *totals)
