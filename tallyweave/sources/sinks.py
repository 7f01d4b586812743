"""Tables out."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def _folder(path: str) -> str:
    """The path without scheme, doubled slashes and trailing slash, for comparison."""
    bare = path[len("file:"):] if path.startswith("file:") else path
    scheme, mark, rest = bare.partition("://")
    if not mark:
        scheme, rest = "", bare
    parts = [part for part in rest.split("/") if part not in ("", ".")]
    return scheme + "/" + "/".join(parts) + "/"


def refuse_overlap(target: str, sources: Iterable[str]) -> None:
    """Stop if overwriting ``target`` would delete a source, or a folder that holds or lies in one."""
    out = _folder(target)
    for source in sources:
        read = _folder(source)
        if out.startswith(read) or read.startswith(out):
            raise ValueError(f"refusing to overwrite {target}: it overlaps the source {source}")


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    sources: Iterable[str] = (),
) -> DataFrame:
    """Write ``df`` and return the written table, so what follows reads it instead of recomputing.

    ``sources`` names the folders the frame is read from; a target that overlaps one is refused. The file
    format is any that the session knows.
    """
    refuse_overlap(path, sources)
    df.write.format(format).mode(mode).save(path)
    return df.sparkSession.read.format(format).load(path)


def write_csv(df: DataFrame, path: str, sources: Iterable[str] = (), files: int | None = 1) -> None:
    """Write a report as CSV with a header, in at most ``files`` files.

    One file is for reports of a few rows, as one task writes it; None leaves the frame's partitions as
    they are. Give it a table that is already computed: a lazy frame would run its last stage in those few
    tasks too.
    """
    refuse_overlap(path, sources)
    parts = df if files is None else df.coalesce(files)
    parts.write.mode("overwrite").option("header", "true").csv(path)


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes paths of it."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _move(spark: SparkSession, source: str, target: str) -> None:
    files, path = _file_system(spark, source)
    if not files.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")


def next_to(target: str) -> str:
    """A folder beside ``target``, in the same file system, that nothing has used yet."""
    return f"{target.rstrip('/')}.next-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, staged: str, target: str, names: Iterable[str]) -> None:
    """Replace the tables ``names`` in ``target`` by those in ``staged``, all of them or none.

    Everything is written before, so what happens here is renames only: the tables in place are set aside, the new ones
    moved in, and the old ones deleted last. If a move fails, the tables that were there are put back. Other files in
    ``target`` stay. A driver that dies between two renames leaves the old tables in a folder ``<target>.last-...``.
    Stores without an atomic rename copy instead; there a reader may see the moment between.
    """
    target, names = target.rstrip("/"), list(names)
    files, path = _file_system(spark, target)
    aside = f"{target}.last-{uuid.uuid4().hex[:12]}"
    files.mkdirs(path(target))
    files.mkdirs(path(aside))
    old: list[str] = []
    new: list[str] = []
    try:
        for name in names:
            if files.exists(path(f"{target}/{name}")):
                _move(spark, f"{target}/{name}", f"{aside}/{name}")
                old.append(name)
        for name in names:
            _move(spark, f"{staged}/{name}", f"{target}/{name}")
            new.append(name)
    except BaseException:
        for name in new:
            files.delete(path(f"{target}/{name}"), True)
        for name in old:
            _move(spark, f"{aside}/{name}", f"{target}/{name}")
        files.delete(path(aside), True)
        raise
    files.delete(path(aside), True)
