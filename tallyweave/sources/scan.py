"""Parquet in."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    BANK_SCHEMA,
    GL_SCHEMA,
    SALES_SCHEMA,
    BankColumns,
    GlColumns,
    JobConfig,
    SalesColumns,
)


def scan_parquet(
    spark: SparkSession, path: str, expect: T.StructType | None = None
) -> DataFrame:
    """A Parquet folder as a DataFrame; reads footers only.

    With ``expect`` a missing column, or text where a number belongs (or the reverse), is an error here
    and not halfway through the job. Number widths may differ, and extra columns are let through.
    """
    df = spark.read.parquet(path)
    if expect is not None:
        _check_schema(df, path, expect)
    return df


def _check_schema(df: DataFrame, path: str, expect: T.StructType) -> None:
    found = {f.name: f.dataType for f in df.schema.fields}
    faults = []
    for f in expect.fields:
        if f.name not in found:
            faults.append(f"{f.name} is missing")
        elif not _alike(found[f.name], f.dataType):
            faults.append(f"{f.name} is {found[f.name].simpleString()}, not {f.dataType.simpleString()}")
    if faults:
        raise ValueError(f"{path}: " + "; ".join(faults))


def _alike(found: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.NumericType):
        return isinstance(found, T.NumericType)
    # Dates arrive as ISO text or as real dates and timestamps; the operators take all three.
    return isinstance(found, (type(wanted), T.DateType, T.TimestampType, T.TimestampNTZType))


def load_ledgers(spark: SparkSession, config: JobConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sales, GL and bank ledgers from the configured folders, schemas checked.

    A job that names its own columns is taken at its word: only the default layout is checked.
    """

    def scan(path: str, standard: bool, schema: T.StructType) -> DataFrame:
        return scan_parquet(spark, path, schema if standard else None)

    return (
        scan(config.sales_path, config.sales == SalesColumns(), SALES_SCHEMA),
        scan(config.gl_path, config.gl == GlColumns(), GL_SCHEMA),
        scan(config.bank_path, config.bank == BankColumns(), BANK_SCHEMA),
    )


def ingest_audit(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source: its name, row count and column count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, counts)
