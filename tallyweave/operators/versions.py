"""Versions of a record: the latest one, or all of them numbered."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import col
from ..sources.staging import broadcast_if_small, stage

# Names of helper columns; none of them is in a result.
_ENTRY, _SLICE, _HOT, _COUNT, _BEFORE, _RANK = (
    "__entry", "__slice", "__hot", "__count", "__before", "__rank"
)
# Slices that follow the limit alone, and rows that make a further slice worth a task.
FEW_SLICES, SLICE_ROWS = 64, 100_000


def newest_first(version: str, tiebreak: Sequence[str] = ()) -> list[Column]:
    """Latest version first, missing ones last; equal versions by the tie-break columns, largest first."""
    return [col(name).desc_nulls_last() for name in (version, *tiebreak)]


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``. NULL is a key like any other.

    Spark limits each key to one row before the shuffle (WindowGroupLimit), so a key with a large share
    of all rows sends one row per input partition. ``order`` should be total, or the choice is arbitrary.
    """
    rank = F.row_number().over(Window.partitionBy(*map(col, keys)).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def _sortable(kind: T.DataType) -> bool:
    """False for maps, and whatever holds one."""
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, T.MapType)


def _total(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """``order`` and then all columns; those that hold maps, which cannot be sorted, by their JSON text."""
    rest = [
        col(f.name) if _sortable(f.dataType) else F.to_json(F.struct(col(f.name)))
        for f in df.schema.fields
    ]
    return [*order, *rest]


def number_versions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "rn",
    max_group_rows: int = 5_000_000,
    folder: str | None = None,
) -> DataFrame:
    """All rows, numbered from 1 within their key in ``order``, ties by all columns.

    The input is computed once, staged. Keys of up to ``max_group_rows`` rows are numbered by a plain window. A
    larger key would keep one task busy with all its rows, so such keys go another way: their rows are
    range-partitioned by key and order, numbered within each slice, and moved up by the rows of the same
    key in earlier slices. That holds for groups of identical rows too. Both ways sort alike, so the numbers
    do not depend on the limit. The number of large keys is at most the row count divided by the limit. Slices beyond
    ``FEW_SLICES`` take ``SLICE_ROWS`` rows or more, as tasks of a few rows cost more than their rows.
    """
    df = stage(df, "unnumbered", folder)
    total = _total(df, order)
    rank = F.row_number().over(Window.partitionBy(*map(col, keys)).orderBy(*total)).cast("bigint")
    sizes = df.groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias(_COUNT))
    hot = stage(sizes.filter(F.col(_COUNT) > max_group_rows), "large", folder)
    hot_rows = hot.agg(F.sum(_COUNT).alias(_COUNT)).collect()[0][_COUNT]
    if hot_rows is None:
        return df.withColumn(name, rank)
    hot = hot.drop(_COUNT).withColumn(_HOT, F.lit(True))

    marked = _lookup(df, broadcast_if_small(hot), keys)
    small = marked.filter(F.col(_HOT).isNull()).drop(_HOT)
    large = marked.filter(F.col(_HOT)).drop(_HOT)
    slices = min(
        ceil(hot_rows / max(max_group_rows, 1)), max(FEW_SLICES, ceil(hot_rows / SLICE_ROWS))
    )
    return small.withColumn(name, rank).unionByName(
        _number_in_slices(large, keys, total, name, slices, folder)
    )


def _lookup(df: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys where NULL equals NULL, without the right side's key columns."""
    renamed = right.select(
        *(right[_quoted(k)].alias(_tag(k)) for k in keys),
        *(right[_quoted(c)] for c in right.columns if c not in keys),
    )
    same = reduce(and_, (df[_quoted(k)].eqNullSafe(renamed[_quoted(_tag(k))]) for k in keys))
    return df.join(renamed, same, "left").drop(*map(_tag, keys))


def _tag(key: str) -> str:
    return f"__key_{key}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _number_in_slices(
    df: DataFrame,
    keys: Sequence[str],
    total: Sequence[Column],
    name: str,
    least_slices: int,
    folder: str | None,
) -> DataFrame:
    slices = max(least_slices, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # All columns take part in the order, so entry numbers tell apart nothing but identical rows. A task
    # that is run again may number those differently without any row being lost or doubled.
    total = [*total, F.col(_ENTRY)]
    # Staged, because both readers below must see the same slices.
    sliced = stage(
        df.withColumn(_ENTRY, F.monotonically_increasing_id())
        .repartitionByRange(slices, *map(col, keys), *total)
        .withColumn(_SLICE, F.spark_partition_id()),
        "versions",
        folder,
    )
    within = Window.partitionBy(_SLICE, *map(col, keys)).orderBy(*total)
    earlier = (
        Window.partitionBy(*map(col, keys))
        .orderBy(_SLICE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per key and slice: a key has no more of them than there are slices.
    runs = stage(
        sliced.groupBy(_SLICE, *map(col, keys))
        .agg(F.count(F.lit(1)).alias(_COUNT))
        .withColumn(_BEFORE, F.sum(_COUNT).over(earlier) - F.col(_COUNT))
        .drop(_COUNT),
        "runs",
        folder,
    )
    numbered = sliced.withColumn(name, F.row_number().over(within))
    moved = _lookup(numbered, broadcast_if_small(runs), [_SLICE, *keys])
    return moved.withColumn(name, F.col(name) + F.col(_BEFORE)).drop(
        _ENTRY, _SLICE, _BEFORE
    )
