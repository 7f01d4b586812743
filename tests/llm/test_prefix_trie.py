import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyweave.llm.prefix_trie import collected_turns, prefix_trie, sequences, with_shared_openings
from tallyweave.llm.queries import op13_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Conversations by id: lists of (role, text), beginning as the first of their hundred."""
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=lambda t: t[0])] for c, turns in held.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    """The result by a dictionary of prefixes."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)

    def total(node):
        leaves, saved = (0, 0) if below[node] else (1, 0)
        saved += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for child in below[node]:
            more = total(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(below[node]), *total(node), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("range_turns", [5, 40, 100_000])
def test_random_conversations(spark, scratch, range_turns):
    rng, rows = random.Random(range_turns), []
    for c in list(range(0, 130)) + [250, 251, 405]:
        for turn in range(rng.choice([0, 1, 2, 3, 4, 7, 9])):
            rows.append((c, turn, rng.choice(["user", None, ""]), rng.choice(["a", "é😀", "", None, "bb"])))
    # Many equal ones, over several ranges.
    rows += [(c, t, "user", text) for c in range(700, 760) for t, text in enumerate(["x", "y", "z", "u", "v", "w", "q", "r"][: 7 + c % 2])]
    rng.shuffle(rows)
    convs = rebuilt(rows)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = prefix_trie(sequences(with_shared_openings(collected_turns(table))), scratch, range_turns)
    assert got(found) == plain_trie(convs)


def test_odd_rows(spark, scratch):
    rows = [(3, None, None, None), (3, 1, "user", "x"), (3, None, None, None), (None, 1, "user", "x"), (-5, 1, "user", "ab"), (103, 0, "user", "only")]
    rows += [(8, t, "user", str(t % 3)) for t in range(300)]  # a long one
    table = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("node", F.lit(1)).withColumn("chars", F.lit(2))
    found = prefix_trie(sequences(collected_turns(table)), scratch, 4)
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append(((turn is not None, turn or 0), role or "", text or ""))
    assert got(found) == plain_trie({c: [t[1:] for t in sorted(turns)] for c, turns in held.items()})


def test_turnless_and_empty(spark, scratch):
    # Conversation 5 has no first of its hundred; where h exceeds its turns it is rebuilt without turns.
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "gone")]
    table = spark.createDataFrame(rows, SCHEMA)
    found = prefix_trie(sequences(with_shared_openings(collected_turns(table))), scratch)
    assert got(found) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert prefix_trie(sequences(with_shared_openings(collected_turns(table.limit(0)))), scratch.__class__(spark, "none")).count() == 0


def test_the_query_on_whole_tables(spark, tables):
    table = spark.read.parquet(f"{tables()}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_conversation_trie(spark, tables())) == plain_trie(rebuilt(rows))
