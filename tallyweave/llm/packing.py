"""Lexical retrieval packing: fixed windows of tokens filled with documents that resemble each other.

1. Documents are tokenised once and kept as packed ids.
2. One pass counts, over the whole corpus, in how many documents each token id occurs and how many tokens lie under each
   routing key (a document's rarest token by merge order). The vocabulary bounds both tables.
3. Documents are dealt into shards of about equal token volume along the keys, so lexical neighbours meet. A
   key with much volume reaches over as many shards as it needs.
4. Each shard builds a BM25 inverted index of its documents with the corpus's statistics. A seed opens a window; its
   unused neighbours are taken in order of score until the window is full. What the last one has left opens the
   next window. Only the last window of a shard may need padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch, texts
from tallyweave.llm.token_counts import Chunks, WordMerger

#: Tokens in a shard, about. A longer document makes a longer shard.
SHARD_TOKENS = 1 << 19
REMEMBERED = 600_000
K1, B = 1.2, 0.75


class WordTokens:
    """Token ids of texts as packed little-endian numbers, by the library's own model for each word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        self.vocabulary = tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.rules = WordMerger(path)
        self.special_ids = {s.encode(): self._pack([tokenizer.token_to_id(s)]) for s in (t.content for t in tokenizer.get_added_tokens_decoder().values())}
        self.known = Chunks(self._chunk)

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        letter, out = self.rules.letter, []
        for word in self.rules.split(chunk):
            out += [t.id for t in self.model.tokenize("".join([letter[b] for b in word.encode()]))]
        return self._pack(out)

    def _plain(self, text: bytes) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, text.lower().split()))

    def ids(self, text: bytes) -> bytes:
        special = self.rules.special
        if not special or b"<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for found in special.finditer(text):
            out += [self._plain(text[at : found.start()]), self.special_ids[found.group()]]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One for each Python worker, kept between its tasks."""
    return WordTokens(path)


def tokenised(docs: DataFrame, path: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """(doc, key, n, ids): all ids of each document and the end id, packed; key is the largest id but the end's."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        end, width = np.array([end_id], tokens.kind).tobytes(), tokens.kind.itemsize
        for batch in batches:
            ids = [tokens.ids(text) for text in texts(batch, "text")]
            key = [int(np.frombuffer(i, tokens.kind).max()) if i else 0 for i in ids]
            size = [len(i) // width + 1 for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(key, pa.int32()), pa.array(size, pa.int64()), pa.array([i + end for i in ids], pa.binary())], names=["doc", "key", "n", "ids"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(docs[id_column].alias("doc"), docs[text_column].alias("text")).mapInArrow(encode, f"doc {kind}, key int, n long, ids binary")


def statistics(tokens: DataFrame, kind: str, vocabulary: int) -> DataFrame:
    """(token, docs, volume): documents that hold it, and tokens of the documents whose key it is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, volume = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        for batch in batches:
            np.add.at(volume, batch.column(0).to_numpy(), batch.column(1).to_numpy())
            for ids in batch.column(2):
                seen = np.zeros(vocabulary, bool)
                seen[np.frombuffer(ids.as_py(), kind)] = True
                docs += seen
        token = np.nonzero(docs + volume)[0]
        yield pa.RecordBatch.from_arrays([pa.array(token.astype(np.int32)), pa.array(docs[token]), pa.array(volume[token])], names=["token", "docs", "volume"])

    parts = tokens.select("key", "n", "ids").mapInArrow(count, "token int, docs long, volume long")
    return parts.groupBy("token").agg(F.sum("docs").alias("docs"), F.sum("volume").alias("volume"))


class Index:
    """BM25 over the documents of one shard. Tokens in half of the corpus or more weigh nothing."""

    def __init__(self, docs: list[np.ndarray], weight: np.ndarray, mean: float):
        term, doc, times = [], [], []
        self.terms = []
        for number, ids in enumerate(docs):
            found, count = np.unique(ids, return_counts=True)
            useful = weight[found] > 0
            found, count = found[useful], count[useful]
            self.terms.append(found)
            term.append(found)
            doc.append(np.full(len(found), number, np.int32))
            times.append(count)
        term, doc, times = np.concatenate(term), np.concatenate(doc), np.concatenate(times).astype(np.float64)
        length = np.array([len(d) for d in docs])[doc]
        score = weight[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * length / mean))
        order = np.argsort(term, kind="stable")
        term, self.doc, self.score = term[order], doc[order], score[order]
        self.vocabulary, first = np.unique(term, return_index=True)
        self.first, self.size = first, np.diff(np.append(first, len(term)))
        self.count = len(docs)

    def neighbours(self, number: int) -> np.ndarray:
        """All documents of the shard, best first; equal scores in order."""
        at = np.searchsorted(self.vocabulary, self.terms[number])
        first, size = self.first[at], self.size[at]
        rows = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        scores = np.bincount(self.doc[rows], self.score[rows], self.count)
        return np.argsort(-scores, kind="stable")


def pack(docs: list[np.ndarray], index: Index, window: int) -> list[tuple[int, int, int, int, int, int]]:
    """(document, start, length, sequence, offset, seed) of each piece; every window but the last is full."""
    pieces, used, following = [], np.zeros(len(docs), bool), 0
    sequence, offset, seed, ranking = 0, 0, -1, iter(())
    while True:
        if offset:
            chosen = next((int(d) for d in ranking if not used[d]), None)
        else:
            while following < len(docs) and used[following]:
                following += 1
            chosen = following if following < len(docs) else None
        if chosen is None:
            return pieces
        used[chosen] = True
        start, length = 0, len(docs[chosen])
        while start < length:
            if not offset:
                seed = chosen
            take = min(window - offset, length - start)
            pieces.append((chosen, start, take, sequence, offset, seed))
            start, offset = start + take, offset + take
            if offset == window:
                sequence, offset = sequence + 1, 0
        if offset and seed == chosen:
            ranking = iter(index.neighbours(seed))


def pack_documents(
    docs: DataFrame, path: str, end_id: int, window: int, scratch: Scratch, shard_tokens: int = SHARD_TOKENS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, seed (id of the window's first document).

    Null and empty texts are the end id alone. Every id of every row lies in one piece, repeated rows and null ids
    included; other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    spec = WordTokens(path)
    kind, vocabulary = spec.kind.str, spec.vocabulary
    tokens = scratch.write(tokenised(docs, path, end_id, id_column, text_column), "tokens")
    counts = statistics(tokens, kind, vocabulary).collect()  # a row for each token of the vocabulary at most
    held, volume = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
    for row in counts:
        held[row["token"]], volume[row["token"]] = row["docs"], row["volume"]
    total = int(held[end_id])  # every document holds the end id
    weight = np.maximum(0.0, np.log((total - held + 0.5) / (held + 0.5)))
    mean = max(1.0, float(volume.sum()) / max(1, total))
    begins = np.cumsum(volume) - volume
    rows = [(int(k), int(begins[k]), int(volume[k])) for k in np.nonzero(volume)[0]]
    keys = docs.sparkSession.createDataFrame(rows, "key int, begins long, volume long")
    share = F.shiftrightunsigned(F.xxhash64(F.col("doc").cast("string"), "ids"), 11) / float(1 << 53)
    shard = F.floor((F.col("begins") + share * F.col("volume")) / shard_tokens)
    dealt = tokens.join(F.broadcast(keys), "key").select(shard.alias("shard"), "doc", "ids")

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc", "ascending"), ("ids", "ascending")])
        ids = [np.frombuffer(i.as_py(), kind) for i in table.column("ids")]
        pieces = pack(ids, Index(ids, weight, mean), window)
        doc, start, length, sequence, offset, seed = (np.array(c, np.int64) for c in zip(*pieces))
        crc = [zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes()) for d, s, n, *_ in pieces]
        names = table.column("doc")
        return pa.table(
            {
                id_column: names.take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": np.array([len(i) for i in ids], np.int64)[doc],
                "sequence_id": sequence + (key[0].as_py() << 32),
                "offset": offset,
                "seed": names.take(pa.array(seed)),
            }
        )

    kind_of_id = docs.schema[id_column].dataType.simpleString()
    columns = f"`{id_column}` {kind_of_id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, seed {kind_of_id}"
    return dealt.groupBy("shard").applyInArrow(fill, columns)
