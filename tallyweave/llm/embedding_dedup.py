"""Embedding near-duplicates by a pivot-permutation index.

1. Vectors of equal content become one. Pivots are drawn from a bounded sample, about the square root of
   the number of vectors for each dimension, and thinned, so that no two are close: else a group that holds many rows
   would hold as many pivots, and the order of those would be noise.
2. Each vector is described by its nearest pivots in order and filed under each of them in an inverted list.
3. Pairs in a list that share enough pivots are candidates; their cosine is computed in double precision. A pair
   that shares several pivots counts only in the list of its smallest shared pivot.
4. Lists longer than a tile are cut into chunks and every pair of chunks is a task of its own. Each returns, per
   vector, how many others it links to, and a forest of the links, not all pairs. Components follow from the forests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch, Sets, join_all
from tallyweave.llm.components import components


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    #: Nearest pivots that describe a vector, and how many a candidate pair shares at least.
    nearest: int = 8
    shared: int = 2
    #: Pivots of a dimension, at most (the driver holds them); below that the square root of the number of vectors.
    pivots_most: int = 8192
    #: Vectors of a list that one task compares with each other or with as many others.
    tile: int = 2048


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector as doubles) of the vectors that can link."""
    v = F.col("vector")
    rows = vectors.select(vectors[id_column].alias("id"), vectors[vector_column].cast("array<double>").alias("vector"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def stacked(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def thinned(sample: np.ndarray, cosine: float) -> np.ndarray:
    """Unit vectors without those that are twice as near to an earlier one as a linked pair may be apart, or nearer."""
    most, kept = 1 - 4 * (1 - cosine), np.zeros(len(sample), bool)
    gone = np.zeros(len(sample), bool)
    for k in range(len(sample)):
        if not gone[k]:
            kept[k] = True
            gone[k + 1 :] |= sample[k + 1 :] @ sample[k] >= most
    return sample[kept]


def _pivots(points: DataFrame, settings: Settings) -> dict[int, np.ndarray]:
    """Pivots by dimension: the vectors whose hash is smallest, thinned."""
    sizes = points.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(64).collect()
    out = {}
    for row in sizes:
        wanted = min(settings.pivots_most, max(1, math.isqrt(row["n"])))
        sample = points.where(F.size("vector") == row["dim"]).select("vector").orderBy(F.xxhash64("vector"), "vector").limit(wanted).collect()
        out[row["dim"]] = thinned(unit(np.array([r[0] for r in sample], np.float64)), settings.cosine)
    return out


def _described(points: DataFrame, pivots: dict[int, np.ndarray], settings: Settings) -> DataFrame:
    """(id, times, vector of unit length, dim, pivots: the nearest in order). A dimension without pivots has one list."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                rows = np.nonzero(dims == dim)[0]
                part = batch.take(pa.array(rows))
                x = unit(stacked(part.column(2)))
                pivot = pivots.get(dim)
                if pivot is None:
                    order = np.zeros((len(x), 1), np.int32)
                else:
                    order = np.argsort(-(x @ pivot.T), axis=1, kind="stable")[:, : settings.nearest].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(x), pa.list_(pa.float64())), pa.array(np.full(len(x), dim, np.int32)), pa.array(list(order), pa.list_(pa.int32()))],
                    names=["id", "times", "vector", "dim", "pivots"],
                )

    kind = points.schema["id"].dataType.simpleString()
    return points.select("id", "times", "vector").mapInArrow(describe, f"id {kind}, times long, vector array<double>, dim int, pivots array<int>")


def compare(x: np.ndarray, pivots: np.ndarray, pivot: int, left: np.ndarray, right: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (position, position) of rows in `left` with rows in `right`, block by block."""
    names = np.unique(pivots)
    held = np.zeros((len(x), len(names)), np.float32)
    held[np.arange(len(x))[:, None], np.searchsorted(names, pivots)] = 1
    least = min(settings.shared, pivots.shape[1])
    smaller = held[:, : np.searchsorted(names, pivot)]
    step = max(1, 1_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        # The list of the smallest shared pivot counts the pair.
        candidates = (held[rows] @ held[right].T >= least) & (smaller[rows] @ smaller[right].T == 0)
        # All cosines of a block at once are cheaper than gathering the candidates' vectors; those that may do are verified.
        i, j = np.nonzero(candidates & (x[rows] @ x[right].T >= settings.cosine - 1e-9))
        i, j = rows[i], right[j]
        for b in range(0, len(i), 200_000):
            p, q = i[b : b + 200_000], j[b : b + 200_000]
            p, q = p[p < q], q[p < q]
            close = np.einsum("ij,ij->i", x[p], x[q]) >= settings.cosine
            yield p[close], q[close]


def _links(key: tuple, table: pa.Table, settings: Settings) -> pa.Table:
    """(id, links, root) for each row of a tile that links."""
    table = table.sort_by("id")
    pivot, i, j = (key[k].as_py() for k in (1, 2, 3))
    x, pivots = stacked(table.column("vector")), stacked(table.column("pivots"))
    times, side = table.column("times").to_numpy(), table.column("side").to_numpy()
    links, sets = np.zeros(len(x), np.int64), Sets(len(x))
    rows = np.arange(len(x))
    left, right = (rows, rows) if i == j else (rows[side == i], rows[side == j])
    for p, q in [*compare(x, pivots, pivot, left, right, settings)] + ([] if i == j else [*compare(x, pivots, pivot, right, left, settings)]):
        np.add.at(links, p, times[q])
        np.add.at(links, q, times[p])
        root = sets.roots()
        apart = root[p] != root[q]
        join_all(sets, p[apart], q[apart])
    found = np.nonzero(links)[0]
    ids = table.column("id").combine_chunks()
    return pa.table({"id": ids.take(pa.array(found)), "links": links[found], "root": ids.take(pa.array(sets.roots()[found]))})


def embedding_groups(vectors: DataFrame, scratch: Scratch, settings: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per row: id, n_links (other vectors linked directly), component_id (smallest id reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and neither do vectors of
    different dimension. Rows of equal content link with each other, repeated ids included; other
    columns are ignored, whatever their names; an empty table gives an empty one.
    """
    rows = usable(vectors, id_column, vector_column)
    points = scratch.write(rows.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("times")), "points")
    described = scratch.write(_described(points, _pivots(points, settings), settings), "described")
    filed = described.select("id", "times", "vector", "dim", "pivots", F.explode("pivots").alias("pivot"))
    lists = described.select("dim", F.explode("pivots").alias("pivot")).groupBy("dim", "pivot").agg(F.count("*").alias("size"))
    spread = filed.join(lists, ["dim", "pivot"]).withColumn("chunks", F.expr(f"cast((size + {settings.tile - 1}) div {settings.tile} as int)"))
    spread = spread.withColumn("side", F.pmod(F.xxhash64("id", "pivot"), "chunks").cast("int"))
    tiles = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiles = tiles.select("dim", "pivot", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "times", "vector", "pivots")
    kind = points.schema["id"].dataType.simpleString()
    linked = tiles.groupBy("dim", "pivot", "i", "j").applyInArrow(lambda key, table: _links(key, table, settings), f"id {kind}, links long, root {kind}")
    linked = scratch.write(linked, "linked")
    groups = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch, "groups")
    counted = linked.groupBy("id").agg(F.sum("links").alias("links"))
    merged = points.select("vector", "id", "times").join(counted, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    merged = merged.select("vector", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    own = vectors.select(vectors[id_column].alias("own"), vectors[vector_column].cast("array<double>").alias("vector"))
    component = F.coalesce("component", "own")
    return own.join(merged, "vector", "left").select(
        F.col("own").alias(id_column), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("own").eqNullSafe(component).alias("kept")
    )


def brute_force(x: np.ndarray, cosine: float) -> set[tuple[int, int]]:
    """All linked pairs (position, position) of usable vectors, for measuring recall."""
    u = unit(np.asarray(x, np.float64))
    i, j = np.nonzero(u @ u.T >= cosine)
    return {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a < b}


