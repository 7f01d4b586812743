"""The pipeline's stages against plain versions of them, each on what the stage before kept."""

import random
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from tallyweave.llm.decontaminate import normalised
from tallyweave.llm.line_dedup import Rules
from test_line_dedup import brute_force
from test_simhash import plain_fingerprint, smallest_reachable

pytest.importorskip("public_tokenizers")

RUDE = ["blarg", "snarkle", "vexquai"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    def word(k):
        rng = random.Random(k)
        return "".join(rng.choice(["ta", "ro", "min", "es", "lu", "kor", "ve", "shi", "un", "dol"]) for _ in range(rng.randint(1, 4)))

    def prose(seed, n):
        rng = random.Random(f"p{seed}")
        return " ".join(word(rng.randrange(3000)) for _ in range(n))

    rng, rows, labels = random.Random(1), [], []
    items = [(k, prose(f"item{k}", 40)) for k in range(10)]
    line = prose("line", 60)
    for k in range(400):
        text = prose(k, rng.randint(80, 300))
        toxic = k % 5 == 0
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
            text = " ".join(words)
        elif k % 5 == 1:
            text += "\n" + line
        elif k % 25 == 2:
            text += "\n" + items[k % 10][1]
        elif k % 25 == 3:
            text = rows[k - 1][1].split("\n")[0] + " end"
        rows.append((k, text, "en", "s", len(text)))
        labels.append((k, 1, int(toxic)))
    # Rows that share an id, and equal rows, with and without one.
    rows += [(7, prose("seven", 90), "en", "s", 1), (9, prose("nine", 90), "en", "s", 1)]
    rows += [(2000, prose("twice", 90), "en", "s", 1)] * 2 + [(None, prose("twice unnamed", 90), "en", "s", 1)] * 2
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (None, prose("no id", 50), "en", "s", 1), (1002, rows[7][1], "en", "s", 1), (1003, rows[7][1], "de", "t", 1)]
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows, items


def test_stages(spark, corpus):
    root, rows, items = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    held, results = [(r[0], r[1]) for r in rows], []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.Scratch(spark, "stage").write(stage(spark, docs, root), "out")
        results.append(docs)
        if name == "packing":
            break
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "toxicity":
            want = [(i, t) for i, t in held if not any(w in (t or "").split() for w in RUDE)]
        elif name == "line dedup":
            cut, _ = brute_force(held, Rules())
            want = [(i, new) for (i, t), new in zip(held, cut) if t is None or new.strip() or not t.strip()]
        elif name == "SimHash near-dedup":
            order = sorted(range(len(held)), key=lambda k: (held[k][0] is None, held[k][0] or 0, k))
            group = smallest_reachable({n: plain_fingerprint(held[k][1] or "", 3) for n, k in enumerate(order)}, 3)
            want = [held[k] for n, k in enumerate(order) if group[n] == n]
        else:
            clean = [normalised(t.encode()) for _, t in items]
            want = [(i, t) for i, t in held if not any(c in normalised((t or "").encode()) for c in clean)]
        assert Counter(got) == Counter(want), name
        assert 0 < len(got) < len(held), name
        held = got
    tokens = Counter()
    for r in results[-1].collect():
        tokens[r.doc_id] += r.length
    whole = {r.doc_id: r.doc_tokens for r in results[-1].collect()}
    assert tokens.keys() == whole.keys() == {i for i, _ in held}
    assert sum(tokens.values()) >= sum(whole.values())
    assert {(7, rows[7][1]), (9, rows[9][1])} & set(held) and sum(i == 2000 for i, _ in held) == 1


def test_run_gives_the_last_stage_and_leaves_nothing_else(spark, corpus):
    root, _, _ = corpus
    result = corpus_pipeline.run(spark, root)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(result.columns) and result.count() > 100
    assert corpus_pipeline._made.get() is None


def test_a_run_that_fails_leaves_nothing(spark, corpus, monkeypatch):
    root, _, _ = corpus

    def fails(spark, docs, sf_dir):
        corpus_pipeline._scratch(spark, "failing").write(docs, "half")
        raise RuntimeError("lost")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("leaks", corpus_pipeline.drop_leaks), ("fails", fails)])
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p for p in shared.iterdir() if p.name.startswith("pipeline")}
    with pytest.raises(RuntimeError, match="lost"):
        corpus_pipeline.run(spark, root)
    assert {p for p in shared.iterdir() if p.name.startswith("pipeline")} == before


def test_empty_documents(spark, corpus, tmp_path):
    root, _, _ = corpus
    spark.read.parquet(f"{root}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{root}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
