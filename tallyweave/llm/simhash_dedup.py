"""SimHash near-duplicates: every pair of fingerprints within a Hamming distance, found by vantage-point trees.

1. Each text gets a 64-bit fingerprint of its word shingles. Equal fingerprints become one point.
2. A vantage-point tree over a bounded sample of the points cuts the space into shards: each inner node holds a
   vantage point and a radius, points within the radius go left, the others right. Every point has one home.
3. A point may have a partner in another shard only if it lies within d of the boundary between them (triangle bound).
   Of two such points one has to visit the other: the one inside the radius visits the far side, and a visitor goes
   on to every branch that its bound allows; other branches are pruned. Each shard gets its own points and its
   visitors, packed by the task that sends them.
4. A shard compares visitors with its own points and returns the links as a forest, not as all pairs.
5. Components of the forests' links over all shards give each document its group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch, Sets, bit_counts, join_all, texts
from tallyweave.llm.components import components

#: Points that a shard holds as its own, about. Only the amount of work depends on it.
SHARD_POINTS = 4096
#: Points the tree is built from: so many for each shard, and at most so many in all (8 bytes each, on the driver).
SAMPLE_PER_SHARD, SAMPLE_MOST = 64, 262_144
#: Pairs of points that are compared at once.
TILE = 2_000_000


def fingerprint(text: bytes, words: int) -> int:
    """Bit i is 1 if it is set in more than half of the shingles' XXH64 with seed 42. No words: 0.

    Words are what stands between blanks (space and \\t to \\r), A-Z in lower case; fewer words than a
    shingle has make one shingle.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    last = min(words, len(parts)) - 1
    digest = xxhash.xxh64_intdigest
    ones, step = np.zeros(64, np.int64), 50_000
    for at in range(0, n, step):
        spans = zip(starts[at : min(n, at + step)].tolist(), ends[at + last : min(n, at + step) + last].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        ones += bit_counts(hashes, np.zeros(1, np.int64))[0]
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint as a signed long) for every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text, words) for text in texts(batch, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=[id_column, "point"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(docs[id_column].alias(id_column), docs[text_column].alias("text")).mapInArrow(hashed, f"`{id_column}` {kind}, point long")


class VantageTree:
    """Inner nodes as arrays; a child below 0 is shard -child-1."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.point, self.radius, self.near, self.far, self.shards = [], [], [], [], 0
        rng = np.random.default_rng(7)
        self.top = self._grow(sample, max(1, shards), rng)

    def _grow(self, sample: np.ndarray, shards: int, rng: np.random.Generator) -> int:
        if shards > 1 and len(sample) > 1:
            # The vantage point whose distances spread most has the fewest points near its boundary.
            tried = rng.choice(sample, min(16, len(sample)), replace=False)
            distance = np.bitwise_count(tried[:, None] ^ sample[None, :])
            best = int(distance.var(axis=1).argmax())
            radius = int(np.median(distance[best]))
            inside = distance[best] <= radius
            if inside.any() and not inside.all():
                node = len(self.point)
                self.point.append(tried[best])
                self.radius.append(radius)
                self.near.append(0)
                self.far.append(0)
                self.near[node] = self._grow(sample[inside], shards // 2, rng)
                self.far[node] = self._grow(sample[~inside], shards - shards // 2, rng)
                return node
        self.shards += 1
        return -self.shards

    def visits(self, points: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(shard, its own points or its visitors, whether they are its own)."""
        stack = [(self.top, points, True)]
        while stack:
            node, rows, own = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -node - 1, rows, own
                continue
            d, radius = np.bitwise_count(rows ^ self.point[node]).astype(np.int64), self.radius[node]
            if own:
                stack.append((self.near[node], rows[d <= radius], True))
                stack.append((self.far[node], rows[d > radius], True))
                stack.append((self.far[node], rows[(d <= radius) & (d > radius - distance)], False))
            else:
                stack.append((self.near[node], rows[d <= radius + distance], False))
                stack.append((self.far[node], rows[d > radius - distance], False))


def near(own: np.ndarray, visitors: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (visitor, own) of pairs within the distance, block by block."""
    step = max(1, TILE // max(1, len(own)))
    for at in range(0, len(visitors), step):
        i, j = np.nonzero(np.bitwise_count(visitors[at : at + step, None] ^ own[None, :]) <= distance)
        yield i + at, j


def point_links(points: DataFrame, distance: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (a, b) between distinct points (column `point`) whose components are those of all pairs within `distance`."""
    shards = max(1, -(-points.count() // shard_points))
    wanted = min(SAMPLE_MOST, SAMPLE_PER_SHARD * shards)
    sample = points.orderBy(F.xxhash64("point"), "point").limit(wanted).collect() if shards > 1 else []
    tree = VantageTree(np.array([row[0] for row in sample], np.int64).view(np.uint64), shards)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = [(shard, own, part.tobytes()) for shard, part, own in tree.visits(values, distance)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.binary())], names=["shard", "own", "packed"]
            )

    def linked(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(p, np.uint64) for p in table.column("packed").to_pylist()]
        mine = table.column("own").to_pylist()
        none = [np.zeros(0, np.uint64)]
        own = np.unique(np.concatenate(none + [p for p, m in zip(parts, mine) if m]))
        points = np.concatenate([own, np.unique(np.concatenate(none + [p for p, m in zip(parts, mine) if not m]))])
        sets = Sets(len(points))
        for i, j in near(own, points, distance):
            join_all(sets, i, j)
        root = sets.roots()
        moved = np.nonzero(root != np.arange(len(root)))[0]
        signed = points.view(np.int64)
        return pa.table({"a": signed[moved], "b": signed[root[moved]]})

    visits = points.select("point").mapInArrow(routed, "shard int, own boolean, packed binary")
    return visits.groupBy("shard").applyInArrow(linked, "a long, b long")


def simhash_groups(docs: DataFrame, words: int, distance: int, scratch: Scratch, shard_points: int = SHARD_POINTS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, point (fingerprint as a signed long), component_id (smallest id reachable, the row's own included).

    Null and empty texts have fingerprint 0 and link like any other; repeated rows link as equal fingerprints;
    other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    prints = scratch.write(fingerprints(docs, words, id_column, text_column), "fingerprints")
    points = scratch.write(prints.groupBy("point").agg(F.min(id_column).alias("least")), "points")
    links = components(point_links(points, distance, shard_points), scratch, "links")
    # Only points that have a partner go through the grouping.
    grouped = points.join(links.withColumnRenamed("node", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))
    # Written, so that the join has an exchange of its own and Spark can split a large group.
    least = scratch.write(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    group_of = grouped.join(least, "component").select("point", "component_id")
    return prints.join(group_of, "point").select(id_column, "point", "component_id")


def hex_digits(point: str) -> Column:
    """A signed long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(point), 16, "0"))
