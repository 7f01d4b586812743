"""Toxicity by classifier chains.

Categories are predicted one after the other by linear (logistic) models; each later model also sees the
probabilities of the earlier categories. It is trained with out-of-fold predictions of these, so that it meets
probabilities as unsure in training as in use. Models are fitted on a bounded sample of the labelled rows
(`Settings.sample_rows`); all documents are scored in one pass, whole texts, without a shuffle.

Features are words and word beginnings that are significantly more or less frequent in a category's rows, present or not, and the
shares of capitals, digits and punctuation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch, texts


@dataclass(frozen=True)
class Settings:
    #: Labelled rows the models are fitted on, at most; drawn by a hash of the id.
    sample_rows: int = 8000
    #: Features chosen for each category, at most, and the least z-score of the difference in frequency.
    features: int = 128
    least_z: float = 4.0
    folds: int = 5
    threshold: float = 0.5
    l2: float = 0.1


PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
CAPITALS, DIGITS, WORDLIKE = bytes(range(65, 91)), bytes(range(48, 58)), bytes(b for b in range(256) if PLAIN[b] != 32 or b in b" \t\n\v\f\r")
BEGINNINGS = (4, 5, 6)


def features(text: bytes) -> Iterator[bytes]:
    """Distinct words, and distinct beginnings marked with a star, of a text."""
    words = set(text.translate(PLAIN).split())
    yield from words
    for n in BEGINNINGS:
        yield from {w[:n] + b"*" for w in words if len(w) >= n}


def shares(text: bytes) -> list[float]:
    n = max(1, len(text))
    return [1 - len(text.translate(None, CAPITALS)) / n, 1 - len(text.translate(None, DIGITS)) / n, len(text.translate(None, WORDLIKE)) / n]


class Vector:
    """Finds chosen features in texts."""

    def __init__(self, chosen: list[bytes]):
        self.words = {f: k for k, f in enumerate(chosen) if not f.endswith(b"*")}
        self.starts = {n: {f[:-1]: k for k, f in enumerate(chosen) if f.endswith(b"*") and len(f) == n + 1} for n in BEGINNINGS}
        self.size = len(chosen) + 3

    def row(self, text: bytes) -> np.ndarray:
        out = np.zeros(self.size, np.float64)
        words = set(text.translate(PLAIN).split())
        found = [self.words[w] for w in words & self.words.keys()]
        for n, starts in self.starts.items():
            if starts:
                found += [starts[s] for s in {w[:n] for w in words} & starts.keys()]
        out[found] = 1
        out[-3:] = shares(text)
        return out


def logistic(x: np.ndarray, y: np.ndarray, l2: float) -> np.ndarray:
    """Weights, the last for the constant, by Newton steps; a single class gives its (smoothed) rate."""
    x = np.column_stack([x, np.ones(len(x))])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w = np.zeros(x.shape[1])
    w[-1] = np.log(rate / (1 - rate))
    if y.min(initial=1) == y.max(initial=0):
        return w
    penalty = np.full(len(w), l2)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = probability(x, w)
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-3:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))


@dataclass
class Chain:
    names: list[str]
    chosen: list[bytes]
    weights: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """A column of probabilities for each category."""
        out = np.zeros((len(x), len(self.names)))
        for k, w in enumerate(self.weights):
            out[:, k] = probability(np.column_stack([x, out[:, :k], np.ones(len(x))]), w)
        return out


def fit_chain(names: list[str], chosen: list[bytes], x: np.ndarray, y: np.ndarray, folds: int, l2: float) -> Chain:
    """x: rows of features, y: rows of 0 and 1 for each category."""
    unseen, weights = np.zeros(y.shape), []  # out-of-fold probabilities of the categories done
    fold = np.arange(len(x)) % folds
    for k in range(len(names)):
        inputs = np.column_stack([x, unseen[:, :k]])
        weights.append(logistic(inputs, y[:, k], l2))
        if k + 1 < len(names):
            for f in range(min(folds, len(x))):
                part = fold == f
                w = logistic(inputs[~part], y[~part, k], l2)
                unseen[part, k] = probability(np.column_stack([inputs[part], np.ones(part.sum())]), w)
    return Chain(names, chosen, weights)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], scratch: Scratch, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> Chain:
    """`categories`: in the chain's order, a name and a boolean of `labels` columns for each.

    Rows whose category is null, whose id is null or that have no document are not used. Several labels of a
    document, and several documents of an id, each make a row, up to sample_rows in all. Null and empty texts are
    rows without features; a long text costs time in proportion. Without usable rows all probabilities are the same
    and below a half.
    """
    names = list(categories)
    sample = labels.select(labels[id_column].alias("id"), *[c.cast("int").alias(f"y{k}") for k, c in enumerate(categories.values())]).dropna()
    sample = sample.orderBy(F.xxhash64("id"), *sample.columns).limit(settings.sample_rows)
    rows = docs.select(docs[id_column].alias("id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    label = [f"y{k}" for k in range(len(names))]
    # The sample's ids are bounded by sample_rows, the documents of an id are not: rows beyond that number go, in the order of a hash.
    mark = F.xxhash64("id", *label, "text").alias("mark")
    sample = scratch.write(rows.join(F.broadcast(sample), "id").select("*", mark, F.monotonically_increasing_id().alias("row")), "sample")
    last = sample.select("mark", "row").orderBy("mark", "row").limit(settings.sample_rows).agg(F.max(F.struct("mark", "row")).alias("m")).select("m.*").first()
    if last["mark"] is not None:
        sample = sample.where((F.col("mark") < last["mark"]) | (F.col("mark") == last["mark"]) & (F.col("row") <= last["row"]))
    sample = sample.drop("mark", "row")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(len(label) + 1)]
        for batch in batches:
            ys = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in label]
            for row, text in enumerate(texts(batch, "text")):
                found = list(features(text))
                counts[-1].update(found)
                for k, y in enumerate(ys):
                    if y[row]:
                        counts[k].update(found)
        names_ = list(counts[-1])
        columns = [pa.array(names_, pa.binary())] + [pa.array([c[f] for f in names_], pa.int64()) for c in counts]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", *label, "n"])

    whole = sample.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in label]).first()
    n = whole["n"]
    if not n:
        return Chain(names, [], [np.array([0.0, 0.0, 0.0, *[0.0] * k, -1.0]) for k in range(len(names))])
    counted = sample.mapInArrow(tally, "feature binary, " + ", ".join(f"{c} long" for c in [*label, "n"]))
    counted = scratch.write(counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in [*label, "n"]]).where("n >= 3"), "counted")
    chosen: dict[bytes, None] = {}
    for c in label:
        yes, no = whole[c], n - whole[c]
        if not yes or not no:
            continue
        share = F.col("n") / n
        z = F.abs(F.col(c) / yes - (F.col("n") - F.col(c)) / no) / F.sqrt(share * (1 - share + 1e-9) * (1 / yes + 1 / no))
        best = counted.where(z >= settings.least_z).orderBy(z.desc(), "feature").limit(settings.features).select("feature").collect()
        chosen |= {bytes(row[0]): None for row in best}
    vector = Vector(list(chosen))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [vector.row(text) for text in texts(batch, "text")]
            rest = [batch.column(batch.schema.get_field_index(c)) for c in label]
            yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float32).tobytes() for r in x], pa.binary()), batch.column(batch.schema.get_field_index("id")).cast(pa.string()), *rest], names=["x", "id", *label])

    seen = sample.mapInArrow(look, "x binary, id string, " + ", ".join(f"{c} int" for c in label)).orderBy(F.xxhash64("id"), "id", *label, "x").collect()
    x = np.array([np.frombuffer(row["x"], np.float32) for row in seen], np.float64)
    y = np.array([[row[c] for c in label] for row in seen], np.float64)
    return fit_chain(names, list(chosen), x, y, settings.folds, settings.l2)


def _rows(chain: Chain, vector: Vector, found: list[bytes]) -> np.ndarray:
    step, none = 1000, [np.zeros((0, len(chain.names)))]
    return np.concatenate(none + [chain.predict(np.array([vector.row(t) for t in found[at : at + step]])) for at in range(0, len(found), step)])


def score(docs: DataFrame, chain: Chain, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, p_<category> for each, toxic (the last category reaches the threshold).

    Null and empty texts have no features; repeated rows are scored each; other columns are ignored, whatever their
    names; an empty table gives an empty one.
    """

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vector(chain.chosen)
        for batch in batches:
            p = _rows(chain, vector, list(texts(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, k]) for k in range(p.shape[1])], pa.array(p[:, -1] >= settings.threshold)], names=[id_column, *[f"p_{n}" for n in chain.names], "toxic"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    columns = ", ".join(f"`p_{n}` double" for n in chain.names)
    return docs.select(docs[id_column].alias(id_column), docs[text_column].alias("text")).mapInArrow(rate, f"`{id_column}` {kind}, {columns}, toxic boolean")


def without_toxic(docs: DataFrame, chain: Chain, settings: Settings = Settings(), text_column: str = "text") -> DataFrame:
    """The documents below the threshold, unchanged; no shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = Vector(chain.chosen)
        for batch in batches:
            p = _rows(chain, vector, list(texts(batch, text_column)))
            yield batch.filter(pa.array(p[:, -1] < settings.threshold))

    return docs.mapInArrow(keep, docs.schema)
