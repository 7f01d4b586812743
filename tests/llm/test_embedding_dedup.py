import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyweave.llm.common import Scratch
from tallyweave.llm.embedding_dedup import Settings, brute_force, embedding_groups, unit

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(3)


def expected(rows, cosine=0.95):
    """n_links and component of each usable vector, from all pairs."""
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], np.float32).astype(float)
    links, up = defaultdict(int), {i: i for i in range(len(ids))}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in brute_force(x, cosine):
        links[a] += 1
        links[b] += 1
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    least = defaultdict(lambda: math.inf)
    for k in range(len(ids)):
        least[root(k)] = min(least[root(k)], ids[k])
    return {ids[k]: (links[k], least[root(k)]) for k in range(len(ids))}


def clustered(seed=1, n=700, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = base[:150] + rng.normal(size=(150, dim)) * 0.2
    ball = base[0] + rng.normal(size=(200, dim)) * 0.15
    return [(k, v.astype(np.float32).tolist()) for k, v in enumerate(np.concatenate([base, near, ball, base[5:25], 3 * base[30:40]]))]


@pytest.mark.parametrize("tile", [2048, 50])
def test_recall_and_no_false_link(spark, tile):
    rows = clustered()
    work = Scratch(spark, "emb")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(table(spark, rows), work, Settings(tile=tile)).collect()}
    work.remove()
    want = expected(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values()) > 1000


def hot(n, dim=64):
    """Vectors, a third of them in one group whose pairs are a little closer than the limit."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(n - n // 3, dim))
    base[-n // 10 :] = base[: n // 10] + rng.normal(size=(n // 10, dim)) * 0.2
    group = base[0] / np.linalg.norm(base[0]) + rng.normal(size=(n // 3, dim)) * 0.21 / math.sqrt(dim)
    return np.concatenate([base, group]).astype(np.float32)


def test_recall_with_a_hot_group_and_hundreds_of_pivots(spark):
    x = hot(30_000)
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))})).repartition(8)
    work = Scratch(spark, "emb")
    got = {r.vec_id: r.n_links for r in embedding_groups(frame, work).collect()}
    work.remove()
    u = unit(x.astype(float))
    want = np.concatenate([(u[a : a + 1000] @ u.T >= 0.95).sum(axis=1) - 1 for a in range(0, len(u), 1000)])
    assert all(got[k] <= n for k, n in enumerate(want.tolist()))
    assert sum(got.values()) >= 0.99 * want.sum() > 1e7


def test_tiles_do_not_change_the_result(spark):
    rows, out = clustered(2, 300), []
    for tile in (2048, 20):
        work = Scratch(spark, "emb")
        out.append({tuple(r) for r in embedding_groups(table(spark, rows), work, Settings(tile=tile)).collect()})
        work.remove()
    assert out[0] == out[1]


def test_vectors_that_link_with_nothing(spark):
    odd = [(1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 1]), (5, [1, NAN, 1]), (6, [1, INF, 1]), (7, [1, 2, 3]), (8, [2, 4, 6]), (9, [1, 2]), (10, [1, 2, 3]), (11, [1e-30, 2e-30, 3e-30]), (12, [1e30, 2e30, 3e30]), (13, None)]
    work = Scratch(spark, "emb")
    frame = table(spark, odd).withColumnRenamed("label", "links")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_groups(frame, work).collect()}
    work.remove()
    for i in (1, 2, 3, 4, 5, 6, 9, 13):
        assert got[i] == (0, i, True)
    assert {got[i] for i in (8, 10, 11, 12)} == {(4, 7, False)} and got[7] == (4, 7, True)


def test_empty_table(spark):
    work = Scratch(spark, "emb")
    assert embedding_groups(table(spark, []), work).count() == 0
    work.remove()
