import random
from collections import defaultdict

import pytest

from tallyweave.operators import latest_version, number_versions
from tallyweave.operators.versions import newest_first

SCHEMA = "id string, modified string, net double, note string"


def test_latest_version_and_its_ties(spark):
    rows = [
        ("a", "1998-01-01", 1.0, "old"),
        ("a", "1998-02-01", 2.0, "new"),
        ("b", None, 9.0, "undated"),
        ("b", "1998-01-01", 1.0, "dated"),
        ("c", "1998-01-01", 1.0, "small"),
        ("c", "1998-01-01", 2.0, "large"),
        ("d", "1998-01-01", 1.0, "x"),
        ("d", "1998-01-01", 1.0, "y"),
        (None, "1998-01-01", 1.0, "no key"),
        (None, "1998-01-02", 1.0, "no key, later"),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        kept = latest_version(df, ["id"], newest_first("modified", ("net", "note"))).collect()
        assert {r["id"]: r["note"] for r in kept} == {
            "a": "new", "b": "dated", "c": "large", "d": "y", None: "no key, later",
        }
        assert kept[0].asDict().keys() == {"id", "modified", "net", "note"}


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows share one key, another group is all copies, and some keys are NULL."""
    rng = random.Random(5)
    rows = [("hot", f"1998-{rng.randint(1, 12):02d}", float(rng.randint(0, 9)), "n") for _ in range(400)]
    rows += [("copies", "1998-01", 1.0, "same")] * 300
    rows += [(None, f"1998-{rng.randint(1, 12):02d}", 1.0, "n") for _ in range(60)]
    rows += [(f"k{rng.randint(0, 150)}", rng.choice([None, "1998-01", "1998-02"]), 1.0, "n")
             for _ in range(440)]
    rng.shuffle(rows)
    return rows


def numbered_by_hand(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    result = []
    for group in groups.values():
        # Stable sorts from the last criterion to the first; missing versions go last.
        group.sort(key=lambda r: r[2], reverse=True)
        group.sort(key=lambda r: (r[1] is not None, r[1] or ""), reverse=True)
        result += [(*row, i + 1) for i, row in enumerate(group)]
    return sorted(result, key=repr)


@pytest.mark.parametrize("max_group_rows", [1_000_000, 50, 0])
def test_numbering_is_the_same_with_large_groups_split(spark, skewed, max_group_rows):
    df = spark.createDataFrame(skewed, SCHEMA).repartition(7)
    out = number_versions(
        df, ["id"], newest_first("modified", ("net",)), max_group_rows=max_group_rows
    )
    assert out.columns == ["id", "modified", "net", "note", "rn"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == numbered_by_hand(skewed)


def test_large_groups_are_spread_over_slices(spark, skewed):
    from tallyweave.operators import versions

    df = spark.createDataFrame(skewed, SCHEMA)
    seen = []
    original = versions.stage
    try:
        versions.stage = lambda frame, label, folder=None: seen.append((label, original(frame, label))) or seen[-1][1]
        number_versions(df, ["id"], newest_first("modified"), max_group_rows=50).collect()
    finally:
        versions.stage = original
    (sliced,) = [frame for label, frame in seen if label == "versions"]
    slices = {key: set() for key in ("hot", "copies", None)}
    for row in sliced.select("id", "__slice").distinct().collect():
        slices[row["id"]].add(row["__slice"])
    assert len(slices["hot"]) > 4 and len(slices["copies"]) > 4
    # 760 rows in groups of more than 50: at least 16 slices.
    largest = sliced.groupBy("__slice").count().agg({"count": "max"}).collect()[0][0]
    assert largest <= 100


def test_slices_follow_the_rows_and_not_a_small_limit(spark):
    from tallyweave.operators import versions

    df = spark.range(3000).selectExpr("'k' || id % 1000 id", "id modified")
    seen = []
    original = versions.stage
    try:
        versions.stage = lambda frame, label, folder=None: seen.append((label, original(frame, label))) or seen[-1][1]
        numbered = number_versions(df, ["id"], newest_first("modified"), max_group_rows=1).collect()
    finally:
        versions.stage = original
    (sliced,) = [frame for label, frame in seen if label == "versions"]
    assert 1 < sliced.select("__slice").distinct().count() <= versions.FEW_SLICES
    assert {(r["modified"], r["rn"]) for r in numbered} == {(m, 3 - m // 1000) for m in range(3000)}


@pytest.mark.parametrize("kind", ["string", "map<string,int>", "struct<m:map<string,int>>", "array<map<string,int>>"])
def test_ties_are_numbered_alike_whatever_the_limit(spark, kind):
    value = {"string": "string(n)", "map<string,int>": "map('n', n)", "struct<m:map<string,int>>": "named_struct('m', map('n', n))",
             "array<map<string,int>>": "array(map('n', n))"}[kind]
    rows = spark.range(200).selectExpr("'k' id", "'1998' modified", "cast(id % 37 as int) n", "id other")
    df = rows.selectExpr("id", "modified", "other", f"{value} v").repartition(5)
    results = []
    for limit in (0, 50, 1_000_000):
        out = number_versions(df, ["id"], newest_first("modified"), max_group_rows=limit)
        results.append({(r["other"], r["rn"]) for r in out.collect()})
    assert results[0] == results[1] == results[2] and len(results[0]) == 200


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_the_input_is_computed_once(spark, limit):
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    df = spark.range(300).selectExpr("'k' id", "id modified").mapInArrow(seen, "id string, modified bigint")
    assert number_versions(df, ["id"], newest_first("modified"), max_group_rows=limit).count() == 300
    assert count.value == 300
