import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, differences
from tallyweave.llm.queries import MAX_TOKENS, SHARDS, oracle_sql, queries

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts(tables):
    return dict(duckdb.sql(f"select doc_id, text from '{tables()}/documents.parquet'").fetchall())


def test_each_operator_is_registered():
    names = list(queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert queries().keys() | {"pipeline"} <= contract.queries().keys() and oracle_sql().keys() <= contract.oracle_sql().keys()


def test_sql(spark, tables):
    for name, sql in oracle_sql().items():
        assert differences(queries()[name](spark, tables()), connect(tables()), sql) == []


def test_shards(spark, tables, texts):
    rows = queries()["op3_interleaved_shards"](spark, tables()).collect()
    assert {r.doc_id for r in rows} == texts.keys() and len(rows) == len(texts)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(SHARDS)) and max(sizes.values()) - min(sizes[s] for s in range(SHARDS)) <= 1
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


@pytest.mark.parametrize("name", ["op3_interleaved_shards", "op4_license_scan"])
def test_native_plans(spark, tables, name):
    plan = queries()[name](spark, tables())._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_whole_tables_are_answered(spark, tables, texts):
    for name in ("op1_token_counts", "op4_license_scan", "op6_toxicity", "op8_simhash", "op10_line_dedup"):
        ids = [r.doc_id for r in queries()[name](spark, tables()).select("doc_id").collect()]
        assert sorted(ids) == sorted(texts), name


def test_packing(spark, tables, texts):
    from tokenizers import Tokenizer

    from tallyweave.llm.queries import word_tokenizer

    library = Tokenizer.from_file(word_tokenizer())
    ids = {i: e.ids + [1] for i, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False))}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in queries()["op9_retrieval_packing"](spark, tables()).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for i, held in pieces.items():
        at = 0
        for r in sorted(held, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    padded = 0
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= MAX_TOKENS
        padded += MAX_TOKENS - at
    assert padded <= 0.02 * sum(map(len, ids.values()))


def test_leaks_hold_the_exact_passages(spark, tables, texts):
    items = duckdb.sql(f"select item_id, text from '{tables()}/benchmark.parquet'").fetchall()
    exact = {(d, i) for d, t in texts.items() for i, item in items if item in t}
    found = {(r.doc_id, r.item_id) for r in queries()["op2_benchmark_leaks"](spark, tables()).select(F.col("doc_id"), F.col("item_id")).collect()}
    assert exact <= found
