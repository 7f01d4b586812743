"""Approximate nearest neighbours by a hash-prefix forest, for the largest inner product.

1. Vectors are dealt evenly into parts and queries into blocks, whatever their values; each pair of a part and a block is a
   task of its own. A vector takes part once per block of queries, so neither grows with the other in memory.
2. A task builds the forest of its part: per tree a sorted array of 64-bit hash strings. Bit j of a string is the
   side of a random hyperplane j on which the vector lies, after a coordinate that gives all vectors the same
   length, so that near in angle means large in inner product.
3. A query descends in each tree to the longest prefix that it shares with any string, by binary search. Then all trees
   are ascended together, one bit at a time from the longest match of all, until the strings that share the
   prefix of that length are enough. All vectors behind them are candidates, none is left out; the inner product decides.
4. How many strings are enough is fitted beforehand: for a bounded sample of queries, the neighbours are found by
   brute force in every part, with the number of strings at which the forest would give them. The share that
   reaches the wanted part of these neighbours holds for all queries.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch
from tallyweave.llm.embedding_dedup import stacked, usable

BITS = 64


@dataclass(frozen=True)
class Settings:
    trees: int = 24
    #: Vectors of a part at least and at most; in between it grows with the root of their number, as do the parts.
    part_least: int = 4096
    part_most: int = 65_536
    #: Queries of a block, about.
    block: int = 16_384
    #: Queries that are answered by brute force to fit the forest, at most, and the share of their neighbours it has to give.
    sample: int = 256
    recall: float = 0.96
    seed: int = 11


def planes(settings: Settings, dim: int) -> np.ndarray:
    """Hyperplanes of all trees over a dimension and the one more that evens the lengths."""
    return np.random.default_rng([settings.seed, dim]).standard_normal((dim + 1, settings.trees * BITS))


def lengthened(x: np.ndarray) -> np.ndarray:
    """Rows scaled to a length of one at most, and the coordinate that makes it one."""
    most = np.abs(x).max(initial=0) or 1.0
    x = x / most
    square = (x * x).sum(axis=1)
    longest = square.max(initial=0) or 1.0
    return np.column_stack([x, np.sqrt(np.maximum(longest - square, 0))]) / np.sqrt(longest)


def strings(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Hash strings, (trees, rows), the first bit of a string the highest."""
    out = np.empty((planes.shape[1] // BITS, len(x)), np.uint64)
    for at in range(0, len(x), 2048):
        bits = np.packbits(x[at : at + 2048] @ planes > 0, axis=1)
        out[:, at : at + 2048] = bits.view(">u8").T
    return out


class Forest:
    def __init__(self, x: np.ndarray, settings: Settings):
        self.x, self.planes = x, planes(settings, x.shape[1])
        found = strings(lengthened(x), self.planes)
        self.rows = np.argsort(found, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(found, self.rows, axis=1)

    def strings_of(self, queries: np.ndarray) -> np.ndarray:
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
        return strings(np.column_stack([scaled, np.zeros(len(queries))]), self.planes)

    def ranges(self, asked: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query, the places of the strings that share a prefix of that length."""
        low = (np.uint64(BITS) - depth).astype(np.uint64)
        rest = np.where(low >= BITS, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(low, np.uint64(BITS - 1))) - np.uint64(1))
        begin = [np.searchsorted(s, a & ~rest, "left") for s, a in zip(self.sorted, asked)]
        end = [np.searchsorted(s, a | rest, "right") for s, a in zip(self.sorted, asked)]
        return np.array(begin), np.array(end)

    def longest(self, asked: np.ndarray) -> np.ndarray:
        """Per query, the longest prefix that it shares with a string of any tree."""
        best = np.zeros(asked.shape[1], np.int64)
        for s, a in zip(self.sorted, asked):
            at = np.searchsorted(s, a)
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(s) - 1)):
                best = np.maximum(best, _shared(s[near], a))
        return best

    def descend_and_ascend(self, asked: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of all trees at the longest prefix at which they hold enough strings together."""
        depth = self.longest(asked)
        begin, end = self.ranges(asked, depth.astype(np.uint64))
        going = np.nonzero(((end - begin).sum(axis=0) < enough) & (depth > 0))[0]
        while len(going):
            depth[going] -= 1
            begin[:, going], end[:, going] = self.ranges(asked[:, going], depth[going].astype(np.uint64))
            going = going[((end - begin)[:, going].sum(axis=0) < enough) & (depth[going] > 0)]
        return begin, end

    def candidates(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A row per query, true for the vectors of its ranges."""
        out = np.zeros((begin.shape[1], len(self.x)), bool)
        for rows, a, b in zip(self.rows, begin.tolist(), end.tolist()):
            for q, (p, r) in enumerate(zip(a, b)):
                out[q, rows[p:r]] = True
        return out

    def needed(self, asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """For one query (its string in each tree): how many strings the forest holds when it first gives each of these rows."""
        place = np.argsort(self.rows, axis=1, kind="stable")
        depth = np.max([_shared(s[p[rows]], a) for s, p, a in zip(self.sorted, place, asked)], axis=0)
        begin, end = self.ranges(np.repeat(asked[:, None], len(rows), axis=1), depth.astype(np.uint64))
        return (end - begin).sum(axis=0)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that numbers have in common."""
    differ = a ^ b
    out = np.full(len(differ), BITS)
    for shift in (32, 16, 8, 4, 2, 1):
        high = differ >> np.uint64(shift)
        moved = high > 0
        out = np.where(moved, out - shift, out)
        differ = np.where(moved, high, differ)
    return out - (differ > 0)


def product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with one vector, added up from the first component on, so that equal rows give equal numbers."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * q[k]
    return total


def nearest(x: np.ndarray, keys: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, rough: np.ndarray, margin: float, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the `top` rows with the largest inner product, ties by id; `rough` has it to within half the margin, or -inf."""
    rows = np.nonzero(rough > -np.inf)[0]
    if len(rows) > top + 1:
        kth = np.partition(rough[rows], len(rows) - top - 1)[len(rows) - top - 1]
        rows = rows[rough[rows] >= kth - margin]
    rows = rows[keys[rows] != own]
    score = product(x[rows], q)
    order = np.lexsort((ids[rows], -score))[:top]
    return rows[order], score[order]


ANSWER = "query_key long, vec_id long, score double, needed double"


def _search(part: pa.Table, asked: pa.Table, top: int, share: float | None, settings: Settings) -> pa.Table:
    """The nearest of one part for one block of queries; without a share by brute force, with the share that it takes."""
    queries, found_ids, scores, needs = [], [], [], []
    if part.num_rows and asked.num_rows:
        x, q = stacked(part.column("vector")), stacked(asked.column("q_vector"))
        keys, ids, own = (t.column(c).to_numpy() for t, c in ((part, "key"), (part, "id"), (asked, "q_key")))
        forest = Forest(x, settings)
        strings = forest.strings_of(q)
        margin = 1e-12 * x.shape[1] * np.abs(x).max() * np.abs(q).max()
        enough = max(top + 1, int(np.ceil((share or 0) * len(x))))
        for at in range(0, len(q), 128):
            block = slice(at, at + 128)
            if share is None:
                rough = q[block] @ x.T
            else:
                begin, end = forest.descend_and_ascend(strings[:, block], enough)
                some = forest.candidates(begin, end)
                if some.sum() * 8 < some.size:
                    rough = np.full(some.shape, -np.inf)
                    for k, row in enumerate(some):
                        held = np.nonzero(row)[0]
                        rough[k, held] = x[held] @ q[at + k]
                else:
                    rough = np.where(some, q[block] @ x.T, -np.inf)
            for k, row in enumerate(rough):
                rows, score = nearest(x, keys, ids, q[at + k], own[at + k], row, margin, top)
                queries.append(np.full(len(rows), own[at + k]))
                found_ids.append(ids[rows])
                scores.append(score)
                needs.append(forest.needed(strings[:, at + k], rows) / len(x) if share is None else np.full(len(rows), np.nan))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.table({"query_key": join(queries, np.int64), "vec_id": join(found_ids, np.int64), "score": join(scores, np.float64), "needed": join(needs, np.float64)})


def _answers(points: DataFrame, queries: DataFrame, parts: int, blocks: int, top: int, share: float | None, settings: Settings) -> DataFrame:
    """The `top` nearest of each part, over all pairs of a part of the vectors and a block of the queries."""
    dealt = points.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # Names of their own: both sides come from one table.
    asked = asked.select(F.col("dim").alias("q_dim"), F.col("part").cast("long").alias("q_part"), F.col("block").alias("q_block"), F.col("key").alias("q_key"), F.col("vector").alias("q_vector"))
    return dealt.groupBy("dim", "part", "block").cogroup(asked.groupBy("q_dim", "q_part", "q_block")).applyInArrow(lambda left, right: _search(left, right, top, share, settings), ANSWER)


def _best(answers: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def fitted_share(points: DataFrame, queries: DataFrame, parts: int, top: int, settings: Settings) -> float:
    """Strings, as a share of a part's vectors, at which the forest gives the wanted part of the sample's true neighbours."""
    sample = queries.orderBy(F.xxhash64("key"), "key").limit(settings.sample)
    found = _best(_answers(points, sample, parts, 1, top, None, settings), top).select("needed").collect()  # sample times top rows at most
    if not found:
        return 0.0
    return float(np.quantile(np.array([r["needed"] for r in found]), settings.recall, method="higher"))


def nearest_vectors(vectors: DataFrame, is_query: F.Column, scratch: Scratch, top: int = 20, settings: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row where `is_query` holds for `id`, the `top` other rows of largest inner product.

    The score is the inner product of the vectors as they are, in double precision; ties rank by ascending id. Vectors
    that are null, empty, zero or hold null or non-finite components, and rows without an id, take no part; vectors of
    different dimension don't meet. Components are expected below 1e150 or so, whose products are finite. Rows that share an id, or are repeated, are vectors of their own; each is a candidate
    for the others. Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    rows = usable(vectors, id_column, vector_column).where("id is not null")
    points = scratch.write(rows.select(F.monotonically_increasing_id().alias("key"), F.col("id").cast("long").alias("id"), F.size("vector").alias("dim"), "vector"), "points")
    queries = points.where(is_query)
    held, asked = points.count(), queries.count()
    part = min(settings.part_most, max(settings.part_least, 16 * math.isqrt(held)))
    parts, blocks = max(1, -(-held // part)), max(1, -(-asked // settings.block))
    share = fitted_share(points, queries, parts, top, settings)
    best = _best(_answers(points, queries, parts, blocks, top, share, settings), top)
    named = queries.select(F.col("key").alias("query_key"), F.col("id").alias("query_id"))
    return best.join(named, "query_key").select("query_id", "rank", F.col("vec_id").alias(id_column), "score")
