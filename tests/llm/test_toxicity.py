import random

import numpy as np
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch
from tallyweave.llm.toxicity import Settings, Vector, features, fit_chain, logistic, probability, score, train, without_toxic

RUDE = ["blarg", "snarkle", "vexquai", "vexquen", "vexquor"]


def categories():
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def corpus(prose, n, seed):
    rng, rows, labels = random.Random(seed), [], []
    for k in range(n):
        words, toxic = prose(seed * 100_000 + k, rng.randint(20, 200)).split(), int(rng.random() < 0.2)
        low = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        if low:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, 1 - low, toxic))
    return rows, labels


def test_held_out_rows(spark, documents, scratch, prose):
    rows, labels = corpus(prose, 1500, 1)
    known = spark.createDataFrame(labels[:1000] + [(None, 0, 1), (3, None, 1), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(rows).withColumnRenamed("lang", "toxic")
    chain = train(docs, known, categories(), scratch)
    got = {r.doc_id: r for r in score(docs, chain).collect()}
    held = labels[1000:]
    assert sum(got[i].toxic == bool(t) for i, _, t in held) >= 0.97 * len(held)
    assert sum((got[i].p_low_quality > 0.5) == (q == 0) for i, q, _ in held) >= 0.97 * len(held)
    assert not any(got[i].toxic for i, _, t in held if not t)
    kept = {r.doc_id for r in without_toxic(docs, chain).collect()}
    assert kept == {i for i, r in got.items() if not r.toxic} and without_toxic(docs, chain).columns == docs.columns


def test_bounded_sample_and_same_model_from_any_order(spark, documents, prose):
    rows, labels = corpus(prose, 400, 2)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chains = []
    for parts in (2, 5):
        work = Scratch(spark, "tox")
        chains.append(train(documents(rows, parts), known.repartition(parts), categories(), work, Settings(sample_rows=200)))
        work.remove()
    assert chains[0].chosen == chains[1].chosen
    assert all(np.allclose(a, b) for a, b in zip(chains[0].weights, chains[1].weights))


def test_odd_rows(spark, documents, scratch, prose):
    rows, labels = corpus(prose, 300, 3)
    docs = documents([*rows, (1000, None), (1001, ""), (1001, ""), (None, "blarg snarkle"), (1002, prose(5, 40_000))])
    chain = train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), categories(), scratch)
    got = [(r.doc_id, r.toxic) for r in score(docs, chain).collect()]
    assert len(got) == 305 and (1000, False) in got and got.count((1001, False)) == 2 and (None, True) in got and (1002, False) in got
    assert score(docs.limit(0), chain).count() == 0


def test_no_labels_and_one_class(spark, documents, scratch):
    docs = documents([(1, "a b"), (2, "c d"), (3, None)])
    none = train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), categories(), scratch)
    assert [r.toxic for r in score(docs, none).collect()] == [False] * 3
    other = Scratch(spark, "one")
    clean = train(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int"), categories(), other)
    assert [r.toxic for r in score(docs, clean).collect()] == [False] * 3
    other.remove()


def test_later_categories_learn_from_unseen_predictions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    first = (x[:, 0] + rng.normal(size=400) > 0).astype(float)
    y = np.column_stack([first, first])
    chain = fit_chain(["a", "b"], [], x, y, 5, 0.1)
    # The second model sees the first's probability as one more input.
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    p = chain.predict(x)
    assert np.allclose(p[:, 1], probability(np.column_stack([x, p[:, :1], np.ones(400)]), chain.weights[1]))


def test_features_and_rows_agree(prose):
    text = prose(1, 50).encode() + b" VEXQUAI!"
    chosen = sorted(features(text))
    assert Vector(chosen).row(text)[:-3].all() and not Vector([b"other", b"othe*"]).row(text)[:-3].any()
    assert logistic(np.zeros((0, 2)), np.zeros(0), 0.1).shape == (3,)


def test_an_id_of_many_documents_does_not_pass_the_bound(spark, documents, scratch, prose, monkeypatch):
    from tallyweave.llm import toxicity

    rows, labels = corpus(prose, 100, 4)
    rows += [(7, f"{prose(9, 3)} {k}") for k in range(200)] + [(7, "the same")] * 100
    seen = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda names, chosen, x, y, folds, l2: seen.append(len(x)) or fit_chain(names, chosen, x, y, folds, l2))
    train(documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), categories(), scratch, Settings(sample_rows=120))
    again = Scratch(spark, "tox")
    train(documents(rows[:100]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), categories(), again, Settings(sample_rows=120))
    again.remove()
    assert seen == [120, 100]


def test_chain_is_that_of_a_plain_loop():
    rng = np.random.default_rng(6)
    x, folds, l2 = rng.normal(size=(60, 4)), 3, 0.2
    y = (x[:, :3] + rng.normal(size=(60, 3)) > 0).astype(float)

    unseen = []  # out-of-fold probabilities, category by category
    for k in range(3):
        inputs = [[*x[i], *(unseen[j][i] for j in range(k))] for i in range(60)]
        w = logistic(np.array(inputs), y[:, k], l2)
        assert np.allclose(fit_chain(list("abc"), [], x, y, folds, l2).weights[k], w)
        column = [0.0] * 60
        for f in range(folds):
            rest = [i for i in range(60) if i % folds != f]
            part = logistic(np.array([inputs[i] for i in rest]), y[rest, k], l2)
            for i in range(f, 60, folds):
                column[i] = 1 / (1 + np.exp(-(sum(a * b for a, b in zip(inputs[i], part)) + part[-1])))
        unseen.append(column)
