"""Three ledgers derived from an ``orders`` table, to exercise the operators at any size.

Each ledger is a projection of one scan of ``orders``: an order is repeated once per entry that it has in
the ledger, and the columns are computed from the order and the number of the entry. No shuffle, no random
numbers, and columns that a query does not read are not computed. The remainders below are fixed values;
each plants one kind of fault (stray spaces, missing postings, late or wrong amounts, second postings).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MONEY
from ..sources import scan_parquet


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledgers need of each order: key, customer, day, category and net amount."""
    order_key = F.col("o_orderkey")
    factor = F.when(order_key % 97 == 0, 20).otherwise(1)
    return scan_parquet(spark, f"{sf_dir}/orders.parquet").select(
        order_key.alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderdate").cast("date").alias("d"),
        F.lower(F.substring("o_orderpriority", 3, 100)).alias("cat"),
        (F.col("o_totalprice").cast(MONEY) * factor).cast(MONEY).alias("net"),
    )


def _entries(base: DataFrame, *conditions: Column) -> DataFrame:
    """Repeat each order for every condition that holds; ``entry`` is the number of the condition."""
    numbers = [F.when(condition, F.lit(i)) for i, condition in enumerate(conditions)]
    return base.select("*", F.explode(F.array_compact(F.array(*numbers))).alias("entry"))


def _by_entry(*values: Column) -> Column:
    """The value for the number of the entry; the last one serves all further entries."""
    chosen = values[-1]
    for i in reversed(range(len(values) - 1)):
        chosen = F.when(F.col("entry") == i, values[i]).otherwise(chosen)
    return chosen


def _left(divisor: int, remainder: int) -> Column:
    return F.col("k") % divisor == remainder


def _padded(number: Column, width: int) -> Column:
    """Zero-padded to ``width`` digits; longer numbers keep all of theirs."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _day(offset: Column | int = 0) -> Column:
    shift = F.lit(offset) if isinstance(offset, int) else offset.cast("int")
    return F.date_add("d", shift).cast("string")


def _money(amount: Column | str) -> Column:
    """An expression, or a constant given as text, as money."""
    return (F.lit(amount) if isinstance(amount, str) else amount).cast(MONEY)


def _times(amount: str, factor: str) -> Column:
    """A money column times an exact factor, to two places."""
    return _money(F.col(amount) * F.lit(factor).cast("decimal(4,2)"))


def sales_ledger(base: DataFrame) -> DataFrame:
    k, net = F.col("k"), F.col("net")
    absent = F.lit(None)
    txn = F.concat(F.lit("TXN-"), _padded(k, 7))
    spaced = F.when(_left(11, 0), F.concat(F.lit("  "), txn, F.lit(" "))).otherwise(txn)
    category = F.when(_left(53, 17), absent).otherwise(F.concat(F.lit(" "), F.col("cat")))
    amount = F.when(_left(59, 19), absent).otherwise(net)
    subscription = _left(4, 1) & (F.col("entry") == 0)
    modified = _by_entry(_day(k % 28), _day(-1))
    # Entry 0 is the current version of a sale, entry 1 an older one with another amount.
    return _entries(base, F.lit(True), _left(50, 0)).select(
        _by_entry(spaced, txn).alias("transaction_id"),
        F.concat(F.lit(" c"), _padded(F.col("ck"), 6)).alias("customer_id"),
        F.concat(F.lit("P"), _padded(F.col("ck") % 50 + 1, 3)).alias("product_code"),
        _by_entry(category, F.col("cat")).alias("product_category"),
        _day().alias("transaction_date"),
        (k % 10 + 1).cast("int").alias("quantity"),
        _money(net / (k % 10 + 1)).alias("unit_price"),
        _times("net", "1.20").alias("gross_revenue"),
        _by_entry(amount, _money(net - _money("1.00"))).alias("net_revenue"),
        _money(_times("net", "1.20") - net).alias("tax_amount"),
        F.when(subscription, _day()).alias("service_start_date"),
        F.when(subscription, _day(365)).alias("service_end_date"),
        _by_entry(F.lit("SYSTEM_A"), F.lit("SYSTEM_B")).alias("source_system"),
        F.concat(modified, F.lit(" 09:00:00")).alias("last_modified_date"),
    )


def gl_ledger(base: DataFrame) -> DataFrame:
    k = F.col("k")
    number = _padded(k, 7)
    wrong = F.when(_left(50, 3), _times("net", "1.03")).otherwise(F.col("net"))
    late = F.when(_left(41, 5), 9).otherwise(k % 4)
    # Entries: the sale itself, its VAT, one more cent the same day, and a second posting date.
    postings = _entries(base, ~_left(33, 7), _left(9, 2), _left(7, 1), _left(61, 10)).select(
        F.concat(_by_entry(*map(F.lit, ("JNL-", "JNV-", "JN2-", "JN3-"))), number).alias("journal_id"),
        F.concat(F.lit("TXN-"), number).alias("source_reference"),
        _by_entry(F.lit("REVENUE"), F.lit("VAT"), F.lit("REVENUE")).alias("account_type"),
        _day(_by_entry(late, F.lit(0), k % 4, F.lit(4))).alias("posting_date"),
        _by_entry(wrong, _times("net", "0.20"), _money("0.01"), _money("5.00")).alias("net_amount"),
        F.when(_left(10, 0), "manual").otherwise("auto_post").alias("posted_by"),
    )
    gross = _times("net_amount", "1.20")
    return postings.select(
        F.concat(F.lit("GL-"), F.substring("journal_id", 3, 100)).alias("posting_id"),
        "journal_id",
        "source_reference",
        "account_type",
        "posting_date",
        gross.alias("debit_amount"),
        "net_amount",
        _money(gross - F.col("net_amount")).alias("tax_posted"),
        "posted_by",
    )


def bank_ledger(base: DataFrame) -> DataFrame:
    k, net = F.col("k"), F.col("net")
    number = _padded(k, 7)
    short = (
        F.when(_left(53, 4), _money("1.25"))
        .when(_left(50, 3) & _left(4, 1), _money("0"))
        .when(_left(50, 3), -_times("net", "0.03"))
        .otherwise(_money("0"))
    )
    method = F.when(_left(3, 0), "CARD").when(_left(3, 1), "BACS").otherwise("CHAPS")
    # Entries: the settlement of the sale, and a second one on a later day.
    return _entries(base, ~_left(45, 8), _left(71, 12)).select(
        F.concat(_by_entry(F.lit("BNK-"), F.lit("BN2-")), number).alias("settlement_id"),
        F.concat(F.lit("TXN-"), number).alias("reference_id"),
        _day(_by_entry(k % 5 + 1, F.lit(6))).alias("settlement_date"),
        _by_entry(_money(net - short), _money("2.50")).alias("settled_amount"),
        _by_entry(_times("net", "0.01"), _money("0.03")).alias("fee_deducted"),
        _by_entry(method, F.lit("BACS")).alias("payment_method"),
    )


def ledgers(base: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return sales_ledger(base), gl_ledger(base), bank_ledger(base)
