"""Intermediate results in a folder that every executor can reach.

Results that more than one later step reads are written out once, as Parquet. They lie in the folder that the
caller names, or under the one that the session names in ``spark.checkpoint.dir``, or else under its
warehouse; so they outlive any executor. Whoever names a folder removes it.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col

SHARED_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
BROADCAST_BYTES = 64 * 1024 * 1024
# Types whose values fit the 16 bytes counted for every column.
FIXED_WIDTH = (
    T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType
)


def _parts(path: str) -> list[str]:
    """Scheme and components of a path; a path without scheme counts as a local one."""
    scheme, mark, rest = path.partition("://")
    if not mark:
        scheme, rest = "file", path.removeprefix("file:")
    return [scheme, *(part for part in rest.split("/") if part not in ("", "."))]


def lies_in(path: str, folder: str) -> bool:
    """True if ``path`` is ``folder`` or below it, compared by whole components."""
    outer = _parts(folder)
    return _parts(path)[: len(outer)] == outer


def _shared_folder(spark: SparkSession) -> str:
    """The application's own checkpoint folder if it lies where the session says, else that place."""
    named, current = spark.conf.get(SHARED_DIR, None), spark.sparkContext.getCheckpointDir()
    if current is not None and (named is None or lies_in(current, named)):
        return current
    return named or f"{spark.conf.get(WAREHOUSE_DIR)}/.scratch"


def scratch_path(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A path that nothing has used yet, in ``folder`` or else in the shared folder."""
    return f"{(folder or _shared_folder(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Compute a frame once, as a Parquet table; later reads pick only the columns they need."""
    path = scratch_path(df.sparkSession, label, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that it lies in; nothing happens if it is not there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _value_bytes(name: str, kind: T.DataType) -> Column | None:
    """The bytes of a value beyond its slot, or None if no bound is known."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col(name)), F.lit(0))
    if isinstance(kind, FIXED_WIDTH):
        return F.lit(0)
    return None


def broadcast_if_small(staged: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged frame for broadcast if its values take at most ``max_bytes``.

    Beyond that, or with columns of a type whose size is not measured (arrays, maps, structures), it is
    returned as it is, and the join shuffles both sides, hot keys being split by Spark's skew-join handling.
    """
    values = [_value_bytes(f.name, f.dataType) for f in staged.schema.fields]
    if any(value is None for value in values):
        return staged
    row_bytes = reduce(add, values, F.lit(16 * len(values)))
    total = staged.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).collect()[0]["bytes"]
    return F.broadcast(staged) if total <= max_bytes else staged
