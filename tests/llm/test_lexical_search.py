import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from tallyweave.llm.lexical_search import Lists, ranked
from tallyweave.llm.queries import oracle_sql, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, top):
    """(item, rank, doc, score) by scoring every document, in whole numbers of any size."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 50 + 50 * c.total() * n // total
            score = 0
            for t in set(plain_terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("part_postings,block_bytes", [(200, 300), (10**6, 10**6)])
def test_against_brute_force(spark, scratch, documents, prose, part_postings, block_bytes):
    rng = random.Random(part_postings)
    docs = [(k, prose(rng.randrange(60), rng.randrange(1, 120))) for k in range(200)]
    docs += [(300, None), (301, ""), (302, " .,-\n\x7f"), (None, docs[3][1]), (5, docs[3][1]), (5, docs[3][1]), (303, "É é ÀB b b 7x 7X"), (304, "word " * 5000)]
    items = [(k, prose(1000 + k, 20)) for k in range(12)] + [(50, None), (51, ""), (52, "É 7X word"), (None, docs[3][1]), (0, docs[9][1]), (0, docs[9][1])]
    items = [(i, t) for i, t in items]
    table = documents(docs).withColumn("query", F.lit(1)).withColumn("score", F.lit("x"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc", F.lit(1)).withColumn("item", F.lit(1))
    assert got(ranked(table, asked, scratch, 7, part_postings, block_bytes)) == brute_force(docs, items, 7)


def test_empty_tables(spark, scratch, documents):
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = documents([(1, "a b c"), (2, "x")])
    assert ranked(some.limit(0), asked, scratch).count() == 0
    assert ranked(some, asked.limit(0), scratch.__class__(spark, "none")).count() == 0


def test_ties_are_all_met():
    """Of many equal documents the first are found, whichever list they are met in."""
    doc = np.repeat(np.arange(500), 2)
    term = np.tile([0, 1], 500)
    lists = Lists(doc, term, np.full(1000, 9, np.int64), 500, 2)
    found, scores = lists.best(np.array([0, 1]), 10)
    assert found[:10].tolist() == list(range(10)) and set(scores.tolist()) == {18}


def test_reading_stops_early():
    rng = np.random.default_rng(3)
    n = 20_000
    doc, term = np.repeat(np.arange(n), 3), np.tile([0, 1, 2], n)
    impact = (rng.pareto(1.5, 3 * n) * 1000).astype(np.int64) + 1
    lists, met = Lists(doc, term, impact, n, 3), []
    found, scores = lists.best(np.array([0, 1, 2]), 20, met)
    total = impact.reshape(n, 3).sum(axis=1)
    order = np.lexsort((np.arange(n), -total))[:20]
    assert found[:20].tolist() == order.tolist() and scores[:20].tolist() == total[order].tolist()
    assert met[0] < n / 10
    # A second search finds the index as the first did.
    assert lists.best(np.array([2]), 5)[1].tolist()[:5] == sorted(impact[2::3].tolist(), reverse=True)[:5]


def test_the_query_against_sql(spark, tables):
    name = "op11_ranked_search"
    assert differences(queries()[name](spark, tables()), connect(tables()), oracle_sql()[name]) == []
