"""Every registered query against its SQL, and the measured counts of the ledgers."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from tallyweave.plans.catalog import catalog
from tallyweave.plans.oracle import ORACLE

QUERIES = catalog()


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables())


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, tables, duck):
    assert differences(QUERIES[name](spark, tables()), duck, ORACLE[name]) == []


def test_entry_gives_twelve_months(spark, tables):
    tables()
    assert [row["period"] for row in contract.entry(spark).collect()] == [
        f"1998-{month:02d}" for month in range(1, 13)
    ]


# Measured independently, in plain SQL, for the year 1998.
STATUSES = {
    "0.001": {
        "MISSING_IN_GL": 3, "MISSING_IN_BANK": 2, "MULTI_SYSTEM_VARIANCE": 9, "GL_VARIANCE": 13,
        "BANK_VARIANCE": 3, "TIMING_DIFFERENCE": 4, "MATCHED": 219,
    },
    "0.01": {
        "MISSING_IN_GL": 60, "MISSING_IN_BANK": 74, "MULTI_SYSTEM_VARIANCE": 75, "GL_VARIANCE": 49,
        "BANK_VARIANCE": 68, "TIMING_DIFFERENCE": 40, "MATCHED": 1929,
    },
}


@pytest.mark.parametrize("sf", STATUSES)
def test_status_counts(sf, spark, tables):
    rows = QUERIES["status_counts"](spark, tables(sf)).collect()
    assert {row["reconciliation_status"]: row["row_count"] for row in rows} == STATUSES[sf]


def test_priorities(spark, tables):
    counts = QUERIES["anomaly_priority"](spark, tables("0.01")).groupBy("anomaly_priority").count()
    assert {r["anomaly_priority"]: r["count"] for r in counts.collect()} == {
        "HIGH": 17, "MEDIUM": 1, "NONE": 2234,
    }
