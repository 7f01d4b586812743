"""Outliers within a category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MONEY
from ..functions import col, z_score
from ..functions.rules import ANOMALY, HIGH, MEDIUM, NONE, NORMAL
from ..sources.staging import BROADCAST_BYTES, broadcast_if_small, stage

Z_THRESHOLD = 2.0
HIGH_MULTIPLE = 2.0


# Distances are split into thousands of millions of cents and the rest, so that sums of products stay exact.
SPLIT = 1_000_000_000


def category_stats(
    df: DataFrame,
    category: str = "product_category",
    value: str = "source_net",
    folder: str | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Mean and sample deviation of a money column per category.

    Both come from exact sums, so they do not depend on the order of rows: the mean from the sum of the
    amounts, the deviation from a second pass that adds up squared distances, in cents, from the mean rounded
    to a cent. A category of one row has no deviation. ``df`` is read twice.
    """
    cents = (col(value).cast(MONEY) * 100).cast("decimal(20,0)")
    sums = df.groupBy(col(category).alias("__in")).agg(
        F.sum(cents).alias("__sum"), F.count(col(value)).alias("__n")
    )
    middle = F.round(F.try_divide(F.col("__sum"), F.col("__n").cast("decimal(20,0)")), 0)
    settled = stage(sums.withColumn("__middle", middle.cast("decimal(20,0)")), "sums", folder)
    centred = df.select(col(category).alias("__of"), cents.alias("__cents")).join(
        broadcast_if_small(settled, max_broadcast_bytes), F.col("__of").eqNullSafe(F.col("__in"))
    )
    centred = centred.withColumn("__d", (F.col("__cents") - F.col("__middle")).cast("bigint"))
    high = F.expr(f"cast(__d div {SPLIT} as decimal(20,0))")
    low = F.expr(f"cast(__d % {SPLIT} as decimal(20,0))")
    wide = "decimal(38,0)"
    squares = centred.groupBy("__of").agg(
        F.first("__sum").alias("__sum"),
        F.first("__n").alias("__n"),
        F.sum((high * high).cast(wide)).alias("__hh"),
        F.sum((high * low).cast(wide)).alias("__hl"),
        F.sum((low * low).cast(wide)).alias("__ll"),
        F.sum(F.col("__d").cast(wide)).alias("__off"),
    )
    n = F.col("__n").cast("double")
    total = (
        F.col("__hh").cast("double") * float(SPLIT) * float(SPLIT)
        + F.col("__hl").cast("double") * (2.0 * SPLIT)
        + F.col("__ll").cast("double")
    )
    rest = total - F.try_divide(F.col("__off").cast("double") * F.col("__off").cast("double"), n)
    deviation = F.sqrt(F.greatest(rest, F.lit(0.0)) / (n - 1)) / 100
    return squares.select(
        F.col("__of").alias(category),
        F.try_divide(F.col("__sum").cast("double") / 100, n).alias("mean_val"),
        F.when(F.col("__n") > 1, deviation).alias("std_val"),
    )


def with_z_score(
    df: DataFrame,
    category: str = "product_category",
    value: str = "source_net",
    null_category: str = "drop",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """Each row with the statistics of its category and its z-score, the category column first.

    The statistics are computed once, measured, and broadcast if they are small; then the rows are not
    shuffled at all. ``df`` is read three times, so pass a staged table if it is costly to compute.
    ``null_category`` "drop" leaves out rows without a category, "keep" scores them as one category.
    """
    if null_category not in ("drop", "keep"):
        raise ValueError(f"null_category must be 'drop' or 'keep', not {null_category!r}")
    kept = df if null_category == "keep" else df.filter(col(category).isNotNull())
    found = category_stats(kept, category, value, folder, max_broadcast_bytes)
    stats = broadcast_if_small(stage(found, "statistics", folder), max_broadcast_bytes)
    stats = stats.withColumnRenamed(category, "__category")
    same = col(category).eqNullSafe(F.col("__category"))
    if null_category == "drop":
        same = col(category) == F.col("__category")
    others = [col(name) for name in df.columns if name != category]
    return kept.join(stats, same).select(
        col(category),
        *others,
        "mean_val",
        "std_val",
        z_score(col(value), F.col("mean_val"), F.col("std_val")).alias("z_score"),
    )


def with_anomaly_flags(
    df: DataFrame, threshold: float = Z_THRESHOLD, high_multiple: float = HIGH_MULTIPLE
) -> DataFrame:
    """Flag and priority by the size of the rounded z-score; no z-score is normal."""
    size = F.abs("z_score")
    beyond = size > threshold
    return df.withColumns(
        {
            "anomaly_flag": F.when(beyond, F.lit(ANOMALY)).otherwise(F.lit(NORMAL)),
            "anomaly_priority": F.when(size > threshold * high_multiple, F.lit(HIGH))
            .when(beyond, F.lit(MEDIUM))
            .otherwise(F.lit(NONE)),
        }
    )


def detect_anomalies(
    df: DataFrame,
    threshold: float = Z_THRESHOLD,
    high_multiple: float = HIGH_MULTIPLE,
    category: str = "product_category",
    value: str = "source_net",
    null_category: str = "drop",
    folder: str | None = None,
) -> DataFrame:
    """z-score, flag and priority for every row, over the same rows the statistics come from."""
    scored = with_z_score(df, category, value, null_category, folder=folder)
    return with_anomaly_flags(scored, threshold, high_multiple)
