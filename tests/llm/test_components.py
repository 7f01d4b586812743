import random

from tallyweave.llm.components import _large_star, _small_star, components


def plain(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_chains_stars_and_random_links(spark, scratch):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 400)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(7, 7), (3, 4)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), scratch, "c").collect()}
    want = {n: c for n, c in plain(links).items() if any(n in link and link[0] != link[1] for link in links)}
    assert got == want


def test_no_links(spark, scratch):
    assert components(spark.createDataFrame([], "a binary, b binary"), scratch, "c").count() == 0


def test_a_step_has_one_exchange_and_drops_repeated_links(spark):
    links = spark.createDataFrame([(2, 1), (2, 1), (5, 2), (5, 3), (5, 3), (9, 5)], "a long, b long")
    for step, wanted in ((_large_star, [(5, 1), (9, 2)]), (_small_star, [(2, 1), (3, 2), (5, 2), (9, 5)])):
        out = step(links)
        assert str(out._jdf.queryExecution().executedPlan().toString()).count("Exchange hashpartitioning") == 1
        assert set(wanted) <= {(r.a, r.b) for r in out.collect()}
