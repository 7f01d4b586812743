"""Prefix trie of conversations by union-find over the links of sorted neighbours.

1. Each turn becomes a digest and a length; each conversation the sequence of its digests. Texts are not shuffled.
2. Conversations are sorted by sequence and cut into ranges. Neighbours are linked by the length of their longest common
   prefix (LCP); conversations that share a prefix are neighbours.
3. Each range joins its links in descending LCP: a component that is joined at depth d becomes a branching node of depth d
   over the nodes it had before; the depths between two such nodes are nodes with one child.
4. A range's nodes that reach over its first or last row, known from the LCP with the neighbouring ranges, stay open. Of the
   range's forest only these, the two outer spines, are handed on, each with what its own rows add; equal open nodes
   of all ranges are then added up. All other nodes are final.

Every figure of a node is a sum over its rows, once the LCP of each row with the one before and after it is known: a row that
shares fewer turns with the next than it has ends a leaf, and a row's common turns with the one before are those that it saves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch, Sets

#: Hexadecimal digits of a turn's digest.
WIDTH = 32
#: Turns in a range of sorted conversations, about.
RANGE_TURNS = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node binary, parent binary"


def common(a: str, b: str) -> int:
    """Turns that two sequences share from their beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x, y = np.frombuffer(a.encode(), np.uint8, n), np.frombuffer(b.encode(), np.uint8, n)
    return int(np.argmax(x != y)) // WIDTH


def node_names(key: str, deepest: int) -> list[bytes]:
    """A name for each prefix of 0 to `deepest` turns."""
    rolling = xxhash.xxh3_128()
    out = [rolling.digest()]
    for depth in range(deepest):
        rolling.update(key[depth * WIDTH : (depth + 1) * WIDTH])
        out.append(rolling.digest())
    return out


def ends_hash(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@dataclass
class Nodes:
    """Rows of the result under way, by column."""

    rows: list[tuple] = field(default_factory=list)

    def table(self) -> pa.Table:
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in NODE.split(", ")]
        columns = list(zip(*self.rows)) or [[]] * len(kinds)
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def trie_of_range(ids: list[int], keys: list[str], chars: list[np.ndarray], before: int, after: int) -> Nodes:
    """Nodes of sorted sequences; `before` and `after` are the LCP with the neighbouring ranges, -1 where there is none.

    A closed node has no name. An open one has a name, the sums of these rows and no hash; each conversation that ends
    in an open node follows as a row of its own, with only conv_id, depth and node.
    """
    m, out = len(ids), Nodes()
    size = [len(k) // WIDTH for k in keys]
    shared = [before] + [common(a, b) for a, b in zip(keys, keys[1:])] + [after]
    saving = [int(c[s - 1]) if s > 0 else 0 for c, s in zip(chars, shared)]
    saved_to = np.concatenate(([0], np.cumsum(saving))).tolist()
    leaves_to = np.concatenate(([0], np.cumsum([shared[r + 1] < size[r] for r in range(m)]))).tolist()
    left, right = node_names(keys[0], max(before, 0)), node_names(keys[-1], max(after, 0))
    # A component is a run of rows; its root is its first row.
    sets = Sets(m)
    last, least, depth, children = list(range(m)), list(ids), list(size), [0] * m

    def name(lo: int, hi: int, d: int) -> bytes | None:
        if lo == 0 and d <= before:
            return left[d]
        return right[d] if hi == m - 1 and d <= after else None

    def close(lo: int, hi: int, smallest: int, top: int, branches: int, above: int, parent: tuple[int | None, bytes | None]) -> None:
        """The nodes of a component with depths from above + 1 to top, the deepest first."""
        total, row = chars[lo], lo
        while row <= hi and size[row] == top:
            row += 1
        for d in range(top, above, -1):
            key = name(lo, hi, d)
            ends = ids[lo:row] if d == top else []
            kids = branches if d == top else 1
            first = 0 if lo == 0 and before >= d else 1
            n = hi + 1 - lo
            base = int(total[d - 2]) if d > 1 else 0
            saved = saved_to[hi + 1] - saved_to[lo + first] - (n - first) * base
            leaves = leaves_to[hi + 1] - leaves_to[lo]
            own = (smallest, name(lo, hi, d - 1)) if d > above + 1 else parent
            up = None if own[1] is not None else own[0]
            if key is None:
                out.rows.append((smallest, d, up, n, kids, leaves, saved, ends_hash(ends), None, own[1]))
            else:
                # A child that the range before began is counted there.
                kids -= lo == 0 and before > d
                out.rows.append((smallest, d, None, n, kids, leaves, saved, None, key, own[1]))
                out.rows += [(c, d, None, None, None, None, None, None, key, None) for c in ends]

    links = sorted(range(m - 1), key=lambda r: -shared[r + 1])
    for d, group in groupby(links, key=lambda r: shared[r + 1]):
        group = list(group)
        old = sorted({sets.root(r) for r in group} | {sets.root(r + 1) for r in group})
        state = [(lo, last[lo], least[lo], depth[lo], children[lo]) for lo in old]
        for r in group:
            sets.join(r, r + 1)
        for lo, hi, smallest, top, branches in state:
            new = sets.root(lo)
            if new != lo:
                last[new], least[new] = max(last[new], hi), min(least[new], smallest)
        for new in {sets.root(lo) for lo in old}:
            depth[new], children[new] = d, 0
        for lo, hi, smallest, top, branches in state:
            new = sets.root(lo)
            children[new] += 1 if top > d else branches
            if top > d:
                close(lo, hi, smallest, top, branches, d, (least[new], name(new, last[new], d)))
    close(0, m - 1, least[0], depth[0], children[0], -1, (None, None))
    return out


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, key, chars) of conversations given as (conv_id, turns: an array of (turn, digest, chars) in order)."""
    key = F.array_join(F.transform("turns", lambda t: t.digest), "")
    return turns.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t.chars).alias("chars"))


def collected_turns(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(conv_id, turns): per conversation its turns (turn, digest, chars) by turn, null first, equal ones by digest.

    Rows without an id are left out. Of a turn, its digest and length are kept, 60 bytes or so, in one value per conversation.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role_column, text_column))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where(conversations[id_column].isNotNull()).select(
        conversations[id_column].cast("long").alias("conv_id"), F.struct(conversations[turn_column].alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_openings(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin as the first of their hundred: h of its turns, then their own after the first h.

    h is the CRC-32 of the decimal id modulo `most`. A first conversation that is absent or short gives what it has.
    """
    own = turns.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    own = own.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % group)
    first = turns.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, most).alias("opening"))
    joined = own.join(first, "first_id", "left")
    opening = F.when(F.col("opening").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("opening", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


def prefix_trie(sequences: DataFrame, scratch: Scratch, range_turns: int = RANGE_TURNS) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, key, chars), the empty one included.

    conv_id (its smallest conversation), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens
    (over its subtree, each node's conversations but one, times the code points of its last text) and ends_sha256 (of
    the decimal ids of conversations that end there, ascending, joined by commas).

    Null texts and roles count as empty ones. Ids are distinct and not null; a conversation without turns ends in
    the root; equal conversations share all nodes. An empty table gives an empty one. A conversation's digests are one
    row's value, so very many turns cost its task their digests' size. A large group of equal conversations is cut like
    any other rows; only its hash is made by one task, which reads the ids as a stream, as SHA-256 has to.
    """
    sequences = scratch.write(sequences, "sequences")
    turns = sequences.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    ranges = int(-(-turns // range_turns)) or 1
    # The ids are part of the order, so that equal conversations may fall into several ranges.
    cut = sequences.repartitionByRange(ranges, "key", "conv_id").withColumn("part", F.spark_partition_id())
    cut = scratch.write(cut, "sorted")
    # Two keys per range; what goes to the driver is a number per range.
    outer = cut.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    neighbour = Window.orderBy("part")
    outer = outer.select("part", "first", F.lag("last").over(neighbour).alias("before"))
    begins = [(r["part"], r["shared"]) for r in outer.mapInArrow(_boundary, "part int, shared long").collect()]
    begins.sort()
    before = dict(begins)
    after = dict(zip([p for p, _ in begins], [s for _, s in begins[1:]] + [-1]))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("conv_id", "ascending")])
        chars = [np.cumsum(np.array(c, np.int64)) for c in table.column("chars").to_pylist()]
        part = key[0].as_py()
        return trie_of_range(table.column("conv_id").to_pylist(), table.column("key").to_pylist(), chars, before[part], after[part]).table()

    nodes = scratch.write(cut.groupBy("part").applyInArrow(build, NODE), "nodes")
    parts = nodes.where("node is not null and n_convs is not null")
    ending = nodes.where("node is not null and n_convs is null").select("node", "conv_id")
    hashes = ending.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_hash_ends, "node binary, hash string")
    added = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    merged = scratch.write(added.join(hashes, "node", "left").withColumn("ends_sha256", F.coalesce("hash", F.lit(NO_ENDS))).drop("hash"), "merged")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = nodes.where("node is null")
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    # The root has no parent, neither open nor closed.
    all_nodes = closed.select(*columns, "parent", "parent_conv_id").unionByName(merged.select(*columns, "parent", F.lit(None).cast("long").alias("parent_conv_id")))
    placed = all_nodes.join(names, "parent", "left")
    return placed.select("conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), *columns[2:])


def _boundary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [-1 if b is None else common(b, a) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared, pa.int64())], names=["part", "shared"])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, SHA-256 of its ids joined by commas) of rows sorted by node and id, read as a stream."""
    node, running, done = None, None, []
    for batch in batches:
        names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for name, group in groupby(zip(names, ids), key=lambda r: r[0]):
            text = ",".join(str(i) for _, i in group)
            if name == node:
                running.update(b"," + text.encode())
                continue
            if node is not None:
                done.append((node, running.hexdigest()))
            node, running = name, hashlib.sha256(text.encode())
        if len(done) > 10_000:
            yield _named(done)
            done = []
    if node is not None:
        done.append((node, running.hexdigest()))
    yield _named(done)


def _named(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    names, hashes = zip(*rows) if rows else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], names=["node", "hash"])
