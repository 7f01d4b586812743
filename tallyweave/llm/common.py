"""What the operators share: reading tables, staging in the shared folder, disjoint sets inside one task."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package wherever the driver was started.

    On a cluster the package is installed or shipped with the job, as for any PySpark job; the entry does no harm there.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Shuffle files go when the query that made them has ended, and not only when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A folder of its own below the one that the session names in spark.checkpoint.dir.

    Where the session names none, as in tests, it lies below the warehouse. Tables written here are what later steps
    read, so a lost executor costs its tasks only. Whoever makes a Scratch may `remove` it once nothing reads from it.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/.scratch"
        self.spark = spark
        self.path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """`df` as a table that has been written once."""
        path = f"{self.path}/{name}"
        before = self.spark.conf.get(DROP_SHUFFLES, "false")
        self.spark.conf.set(DROP_SHUFFLES, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(DROP_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, name: str | None = None) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def quoted(df: DataFrame, name: str) -> Column:
    """A column of `df` whatever characters its name holds."""
    return df["`" + name.replace("`", "``") + "`"]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def with_row_keys(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """`docs` with a column that numbers its rows, and that column's name. Every pass over the result gives a row the same number.

    Rows that come straight from files are numbered by the file splits that they lie in, which all passes share; any
    other table is written once.
    """
    name = free_name(docs, "row_key")
    try:
        docs.select("_metadata.row_index")
        plain = True
    except AnalysisException:
        plain = False
    number = F.monotonically_increasing_id().alias(name)
    if plain:
        return docs.select("*", number), name
    return scratch.write(docs.select("*", number), "rows"), name


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """Whole texts of a batch as UTF-8, null as empty, without making Python strings of them."""
    col = batch.column(batch.schema.get_field_index(column))
    for value in col.cast(pa.large_binary()) if pa.types.is_string(col.type) else col:
        yield value.as_py() or b""


class Sets:
    """Disjoint sets of the positions 0..n-1; the smallest position of a set is its root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """False if they were together already."""
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], dtype=np.int64)


def join_all(sets: Sets, left: np.ndarray, right: np.ndarray) -> None:
    for i, j in zip(left.tolist(), right.tolist()):
        sets.join(i, j)


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set in hashes[starts[k]:starts[k + 1]], the last to the end; no stretch is empty.

    Eight bits are added at a time, as the bytes of one machine word, over stretches too short for a byte to overflow.
    """
    ends = np.append(starts[1:], len(hashes))
    parts = -(-(ends - starts) // 255)
    first = np.cumsum(parts) - parts
    cuts = np.repeat(starts - first * 255, parts) + np.arange(parts.sum()) * 255
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    short = np.add.reduceat(bits.view(np.uint64), cuts, axis=0).view(np.uint8)
    if len(cuts) == len(starts):
        return short.astype(np.int64)
    return np.add.reduceat(short.astype(np.int64), first, axis=0)
