from datetime import date
from decimal import Decimal

from tallyweave.config import BANK_SCHEMA, GL_SCHEMA, SALES_SCHEMA, SalesColumns
from tallyweave.operators import cleanse_bank, cleanse_gl, cleanse_sales, per_reference
from tallyweave.operators.cleanse import reconciled_columns

SALE = {
    "transaction_id": "T1", "customer_id": "c1", "product_code": "P1", "product_category": "books",
    "transaction_date": "1998-03-01", "quantity": 1, "unit_price": 1.0, "gross_revenue": 12.0,
    "net_revenue": 10.0, "tax_amount": 2.0, "service_start_date": None, "service_end_date": None,
    "source_system": "A", "last_modified_date": "1998-03-01 09:00:00",
}


def sales(spark, *changes):
    return spark.createDataFrame([SALE | c for c in changes], SALES_SCHEMA)


def test_sales_are_tidied(spark):
    row = cleanse_sales(
        sales(spark, dict(transaction_id="  t1 ", customer_id=" c9", product_category=" toys ",
                          net_revenue=None, gross_revenue=1.005)),
        1998,
    ).collect()[0]
    assert (row["transaction_id"], row["customer_id"], row["product_category"]) == ("t1", "C9", "TOYS")
    assert row["net_revenue"] == Decimal("0.00") and row["gross_revenue"] == Decimal("1.01")
    assert row["transaction_date"] == date(1998, 3, 1)
    assert list(row.asDict()) == SALES_SCHEMA.fieldNames()


def test_later_version_in_another_year_does_not_count(spark):
    df = sales(
        spark,
        dict(net_revenue=1.0),
        dict(net_revenue=2.0, transaction_date="1999-01-02", last_modified_date="1999-01-02 09:00:00"),
        dict(transaction_id=" T1", net_revenue=3.0, last_modified_date="1998-01-01 09:00:00"),
    )
    assert [r["net_revenue"] for r in cleanse_sales(df, 1998).collect()] == [Decimal("1.00")]


def test_unreadable_dates_leave_the_year(spark):
    df = sales(spark, dict(transaction_date="n/a"), dict(transaction_date=None))
    assert cleanse_sales(df, 1998).count() == 0


def test_narrow_sales_pick_the_same_version(spark):
    # Equal in version and net; product_code and customer disagree on which is the larger.
    df = sales(
        spark,
        dict(product_code="P9", customer_id="a", product_category="x"),
        dict(product_code="P1", customer_id="b", product_category="x"),
    )
    names = reconciled_columns()
    full = cleanse_sales(df, 1998).select(*names).collect()
    assert full == cleanse_sales(df.select(*names), 1998).select(*names).collect()


def test_columns_may_have_other_names(spark):
    df = sales(spark, {}).withColumnRenamed("transaction_id", "sale.id")
    out = cleanse_sales(df, 1998, columns=SalesColumns(key="sale.id"))
    assert out.collect()[0]["sale.id"] == "T1"


def gl(spark, *rows):
    full = [
        (f"G{i}", journal, reference, account, day, gross, net, tax, "auto")
        for i, (reference, account, day, net, gross, tax, journal) in enumerate(rows)
    ]
    return spark.createDataFrame(full, GL_SCHEMA)


def test_gl_rolls_up_per_reference_and_date(spark):
    df = gl(
        spark,
        ("T1", "REVENUE", "1998-03-01", 1.005, 2.0, 0.1, "J1"),
        (" T1 ", "REVENUE", "1998-03-01", 1.0, 2.0, 0.2, None),
        ("T1", "REVENUE", "1998-03-02", 5.0, 6.0, 1.0, "J3"),
        ("T1", "VAT", "1998-03-01", 9.0, 9.0, 9.0, "J4"),
        ("T1", "REVENUE", "1999-01-01", 9.0, 9.0, 9.0, "J5"),
        ("T2", "REVENUE", "1998-05-01", None, None, None, "J6"),
    )
    rows = {(r[0], r[1]): tuple(r[2:]) for r in cleanse_gl(df, 1998).collect()}
    assert rows == {
        ("T1", date(1998, 3, 1)): (Decimal("2.01"), Decimal("4.00"), Decimal("0.30"), 1),
        ("T1", date(1998, 3, 2)): (Decimal("5.00"), Decimal("6.00"), Decimal("1.00"), 1),
        ("T2", date(1998, 5, 1)): (None, None, None, 1),
    }
    assert cleanse_gl(df, 1998, grace_days=1).count() == 4
    assert cleanse_gl(df, 1998, account_type="VAT").count() == 1


def test_per_reference_keeps_one_row(spark):
    df = gl(
        spark,
        ("T1", "REVENUE", "1998-03-02", 1.0, 2.0, 0.1, "J1"),
        ("T1", "REVENUE", "1998-03-01", 4.0, 5.0, 0.1, "J2"),
    )
    one = per_reference(cleanse_gl(df, 1998), "source_reference", "posting_date")
    assert [tuple(r) for r in one.collect()] == [
        ("T1", date(1998, 3, 1), Decimal("5.00"), Decimal("7.00"), Decimal("0.20"), 2)
    ]


def test_bank_rolls_up(spark):
    rows = [
        ("B1", "T1", "1998-03-01", 1.0, 0.1, "CARD"),
        ("B2", "T1 ", "1998-03-01", 2.004, 0.2, "CARD"),
        ("B3", "T1", "1998-03-03", None, 0.3, "CARD"),
        ("B4", "T1", "1997-12-31", 5.0, 0.3, "CARD"),
    ]
    out = cleanse_bank(spark.createDataFrame(rows, BANK_SCHEMA), 1998).collect()
    assert {r[1]: tuple(r[2:]) for r in out} == {
        date(1998, 3, 1): (Decimal("3.00"), Decimal("0.30"), 2),
        date(1998, 3, 3): (None, Decimal("0.30"), 1),
    }
