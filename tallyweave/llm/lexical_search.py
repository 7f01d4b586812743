"""Ranked lexical search by the Best Position Algorithm.

1. One pass over the documents counts their terms and keeps, packed, how often each holds the terms that are asked for.
2. Corpus statistics (documents, terms, documents per term) follow from sums over that pass.
3. Documents are taken as they lie, some hundred thousand postings at a time, and indexed there: per term an impact list,
   sorted by what the term adds to a document's score, and per document its places in all lists for direct access.
4. For each item the lists of its terms are read in parallel, from the highest impact down. Each document met is looked up
   in all lists at once, which gives its score and marks its places there as seen. A list's best position is the end
   of its unbroken run of seen places; the impacts at the best positions add up to what an unmet document could have
   at most. Reading stops when that is strictly below the k-th best score, so ties are all met.
5. The k best of each part go to one ranking per item.

Items are taken in blocks of bounded size, so that the terms asked for, and their statistics, fit a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch, texts

#: Bytes of item texts in a block, and postings that are indexed at once, about.
BLOCK_BYTES = 4 << 20
PART_POSTINGS = 2_000_000
#: Places of each list that are read first; twice as many each time after that.
FIRST_READ = 16

# ASCII letters in lower case; other ASCII but digits as blanks.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text, repeats included."""
    return text.translate(PLAIN).split(b" ")


def counted(text: bytes) -> Counter:
    found = Counter(terms_of(text))
    del found[b""]
    return found


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def held_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """(doc, n, terms, times): of each document that has a term, its length and its terms of the vocabulary, packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, terms, times = [], [], [], []
            for row, text in enumerate(texts(batch, "text")):
                found = counted(text)
                n = found.total()
                if n:
                    asked = found.keys() & vocabulary.keys()
                    rows.append(row)
                    lengths.append(n)
                    terms.append(np.array([vocabulary[t] for t in asked], "<i4").tobytes())
                    times.append(np.array([found[t] for t in asked], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())], names=["doc", "n", "terms", "times"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(docs[id_column].alias("doc"), docs[text_column].alias("text")).mapInArrow(count, f"doc {kind}, n long, terms binary, times binary")


def holders(held: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of `size` terms stands."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = np.zeros(size, np.int64)
        for batch in batches:
            docs += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        term = np.nonzero(docs)[0]
        yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(docs[term])], names=["term", "docs"])

    out = np.zeros(size, np.int64)
    for row in held.select("terms").mapInArrow(add, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        out[row["term"]] = row["docs"]
    return out


class Lists:
    """Impact lists of one part of the documents, and each document's places in them."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int, size: int):
        """Postings sorted by document, with impacts above 0; documents are numbered as ties are ordered."""
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(size + 1))
        # Direct access: the postings of document d are those from first[d] to first[d + 1].
        self.first = np.searchsorted(doc, np.arange(documents + 1))
        self.term = term
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.column = np.full(size, -1)

    def best(self, terms: np.ndarray, k: int, accessed: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all that have a score of at least the k-th best, best first, ties in order."""
        terms = terms[self.begin[terms] < self.begin[terms + 1]]
        begin, size = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Each list's places lie one after the other, with an unseen one behind the last.
        offset = np.cumsum(size + 1) - size - 1
        seen = np.zeros(int((size + 1).sum()), bool)
        position = np.zeros(len(terms), np.int64)
        self.column[terms] = np.arange(len(terms))
        met = np.zeros(len(self.first) - 1, bool)
        documents, scores, read, step = [], [], np.zeros(len(terms), np.int64), FIRST_READ
        kth = 0
        while True:
            until = np.minimum(np.maximum(read, position) + step, size)
            spans = [self.doc[b + p : b + u] for b, p, u in zip(begin.tolist(), position.tolist(), until.tolist())]
            new = np.unique(np.concatenate(spans))
            new = new[~met[new]]
            read, step = until, step * 2
            if len(new):
                met[new] = True
                # All lists at once, through what each document holds.
                count = self.first[new + 1] - self.first[new]
                rows = np.repeat(self.first[new] - np.cumsum(count) + count, count) + np.arange(count.sum())
                column = self.column[self.term[rows]]
                rows, owner = rows[column >= 0], np.repeat(np.arange(len(new)), count)[column >= 0]
                column = column[column >= 0]
                place = self.place[rows]
                score = np.zeros(len(new), np.int64)
                np.add.at(score, owner, self.impact[place])
                seen[offset[column] + place - begin[column]] = True
                documents.append(new)
                scores.append(score)
            for t in range(len(terms)):
                a = offset[t] + position[t]
                position[t] += int(np.argmin(seen[a : offset[t] + size[t] + 1]))
            # Nothing unmet is left in a list that has been seen to its end; else the impact at the best position bounds it.
            at_best = np.where(position < size, self.impact[begin + np.maximum(position, 1) - 1], 0)
            threshold = int(at_best.sum())
            have = np.concatenate(scores)
            if len(have) >= k:
                kth = int(np.partition(have, len(have) - k)[len(have) - k])
            if (len(have) >= k and threshold < kth) or (position == size).all():
                break
        self.column[terms] = -1
        if accessed is not None:
            accessed.append(int(met.sum()))
        documents = np.concatenate(documents)
        chosen = np.nonzero(have >= kth)[0]
        chosen = chosen[np.lexsort((documents[chosen], -have[chosen]))]
        return documents[chosen], have[chosen]


def ranked(docs: DataFrame, items: DataFrame, scratch: Scratch, top: int = 50, part_postings: int = PART_POSTINGS, block_bytes: int = BLOCK_BYTES,
           id_column: str = "doc_id", item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item, rank, id, score): for each row of `items` the `top` rows of `docs` with the highest score above 0.

    Equal scores rank by ascending id, a null id last. Null and empty texts hold no term: such documents aren't found and
    such items find none. Rows that share an id are documents, or items, of their own. Other columns are ignored, whatever
    their names; empty tables give an empty one. A long text costs time and memory in proportion to its size.
    """
    rows = items.select(F.monotonically_increasing_id().alias("query"), items[item_column].alias("item"), items[text_column].cast("string").alias("text"))
    asked = scratch.write(rows.where(F.col("text").isNotNull()), "items")
    columns = f"query long, doc {docs.schema[id_column].dataType.simpleString()}, score long"
    found = docs.sparkSession.createDataFrame([], columns)
    for number, block in enumerate(_blocks(asked, block_bytes)):
        found = found.union(_ranked_block(docs, block, scratch, f"block-{number}", top, part_postings, id_column, text_column, columns))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    placed = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return placed.join(asked.drop("text"), "query").select(F.col("item").alias(item_column), "rank", F.col("doc").alias(id_column), "score")


def _blocks(asked: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, bytes]]]:
    """Blocks of (query, text); the driver holds one at a time."""
    block, size = [], 0
    for row in asked.select("query", "text").toLocalIterator():
        block.append((row["query"], row["text"].encode()))
        size += len(block[-1][1])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _ranked_block(docs: DataFrame, block: list[tuple[int, bytes]], scratch: Scratch, name: str, top: int, part_postings: int, id_column: str, text_column: str, columns: str) -> DataFrame:
    asked = [(query, list(counted(text))) for query, text in block]
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
    held = scratch.write(held_terms(docs, vocabulary, id_column, text_column), name)
    sums = held.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    documents, all_terms = sums["docs"], sums["terms"]
    weight = np.array([term_weight(documents, int(h)) for h in holders(held, len(vocabulary))], np.int64)
    queries = [(query, np.array([vocabulary[t] for t in terms], np.int64)) for query, terms in asked]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, postings = [], 0

        def answer() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting)
            # Ids in order, so that a document's number decides ties.
            table = table.take(pc.sort_indices(table, sort_keys=[("doc", "ascending")], null_placement="at_end"))
            lists = indexed(table, weight, documents, all_terms)
            ids = table.column("doc").combine_chunks()
            numbers, doc, score = [], [], []
            for query, terms in queries:
                best, points = lists.best(terms, top)
                numbers.append(np.full(len(best[:top]), query))
                doc.append(best[:top])
                score.append(points[:top])
            taken = ids.take(pa.array(np.concatenate(doc)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(numbers)), taken, pa.array(np.concatenate(score))], names=["query", "doc", "score"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                waiting.append(part)
                postings += sum(len(t.as_py()) for t in part.column(2)) // 4
                if postings >= part_postings:
                    yield answer()
                    waiting, postings = [], 0
        if waiting:
            yield answer()

    return held.mapInArrow(search, columns)


def indexed(table: pa.Table, weight: np.ndarray, documents: int, all_terms: int) -> Lists:
    """Impact lists of documents (doc, n, terms, times) in the order of their ids, by the corpus's statistics."""
    terms, times = table.column("terms").to_pylist(), table.column("times").to_pylist()
    term = np.frombuffer(b"".join(terms), "<i4").astype(np.int64)
    count = np.frombuffer(b"".join(times), "<i8")
    doc = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
    # Whole numbers of any size, then 64 bits: 50 * n * N may exceed them.
    share = np.array([50 + 50 * n * documents // all_terms for n in table.column("n").to_pylist()], np.int64)
    impact = weight[term] * ((1_000_000_000 * count) // (1000 * count + 20 * share[doc]))
    useful = impact > 0
    return Lists(doc[useful], term[useful], impact[useful], len(terms), len(weight))
