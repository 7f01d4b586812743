"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of each text; where its top bits are zero, and the chunk is long enough, a chunk ends.
A place's hash depends on the 16 bytes before it alone, so an insertion moves boundaries only nearby. Chunks are
deduplicated by digest: the first occurrence by document id, row and place stays. Runs of neighbouring repeated chunks that
are long enough are repeated passages; chance repeats of a short chunk are not. Within passages, chunks that occurred before go.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.common import Scratch, free_name, quoted, texts, with_row_keys


@dataclass(frozen=True)
class Settings:
    #: Bytes of a chunk at least and at most; beyond the least, one place in 2^bits ends it.
    least: int = 24
    most: int = 96
    bits: int = 4
    #: Bytes of a run of repeated chunks that make it a passage.
    passage: int = 100


#: A random number for each byte value, always the same.
GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear(text: bytes) -> np.ndarray:
    """The rolling hash at each place: the sum of the last 16 bytes' numbers, each shifted by its age."""
    hashed = GEAR[np.frombuffer(text, np.uint8)]
    for age in (1, 2, 4, 8):  # sums over 2, 4, 8 and 16 bytes
        longer = hashed.copy()
        longer[age:] += hashed[:-age] << np.uint16(age)
        hashed = longer
    return hashed


def cuts(text: bytes, settings: Settings) -> list[int]:
    """Where chunks end; the last is the text's end. An empty text has none."""
    if not text:
        return []
    places = (np.nonzero(gear(text) < np.uint16(1 << (16 - settings.bits)))[0] + 1).tolist()
    out, begin, k, n = [], 0, 0, len(text)
    while begin < n:
        while k < len(places) and places[k] < begin + settings.least:
            k += 1
        end = min(places[k] if k < len(places) else n, begin + settings.most, n)
        out.append(end)
        begin = end
    return out


def chunks(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc, key, start, length, digest) of every chunk of every text of (doc, key, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, lengths, digests = [], [], [], []

            def flush() -> pa.RecordBatch:
                at = pa.array(rows, pa.int64())
                made = pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(digests, pa.binary())],
                    names=["doc", "key", "start", "length", "digest"],
                )
                for column in (rows, starts, lengths, digests):
                    column.clear()
                return made

            for row, text in enumerate(texts(batch, "text")):
                ends = cuts(text, settings)
                begins = [0, *ends[:-1]] if ends else []
                rows += [row] * len(ends)
                starts += begins
                lengths += [b - a for a, b in zip(begins, ends)]
                digests += [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(begins, ends)]
                if len(rows) > 100_000:
                    yield flush()
            yield flush()

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc {kind}, key long, start long, length int, digest binary")


def _passages(docs: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """(doc, key, start, length, n_chunks, removed_chunks, removed_bytes, removed: spans that go) of each passage of (doc, key, text)."""
    table = scratch.write(chunks(docs, settings), "chunks")
    place = F.struct("doc", "key", "start")
    repeated = table.groupBy("digest").agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1")
    # Written, so that the join has an exchange of its own and Spark can split the chunks of a very common passage.
    repeated = scratch.write(repeated.select("digest", F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start")), "repeated")
    gone = (F.col("key") != F.col("first_key")) | (F.col("start") != F.col("first_start"))
    found = table.join(repeated, "digest").select("doc", "key", "start", "length", gone.alias("gone"))
    order = Window.partitionBy("key").orderBy("start")
    ends = F.lag(F.col("start") + F.col("length")).over(order)
    runs = found.withColumn("opens", F.when(ends >= F.col("start"), 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    went = F.col("gone").cast("int")
    passages = runs.groupBy("key", "run").agg(
        F.first("doc").alias("doc"),
        F.min("start").alias("start"),
        (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"),
        F.count("*").alias("n_chunks"),
        F.sum(went).alias("removed_chunks"),
        F.sum(went * F.col("length")).alias("removed_bytes"),
        F.sort_array(F.collect_list(F.when(F.col("gone"), F.struct("start", "length")))).alias("removed"),
    )
    return passages.where(F.col("length") >= settings.passage)


def _keyed(docs: DataFrame, scratch: Scratch, id_column: str, text_column: str) -> tuple[DataFrame, str, DataFrame]:
    """`docs` with a key for each row, the key's name, and (doc, key, text)."""
    keyed, key = with_row_keys(docs, scratch)
    return keyed, key, keyed.select(quoted(keyed, id_column).alias("doc"), quoted(keyed, key).alias("key"), quoted(keyed, text_column).alias("text"))


def repeated_passages(docs: DataFrame, scratch: Scratch, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per passage: id, start, length (bytes), n_chunks, removed_chunks, removed_bytes, removed (spans of chunks not first).

    A passage is a run of chunks that each occur elsewhere as well, in this or another document. Null and empty texts
    have none. Rows are documents of their own, also where they share an id, are repeated or have none; the order of
    occurrences is that of ids, null first, then of rows. Other columns are ignored, whatever their names; an empty table
    gives an empty one. The chunks of one text are sorted by one task, a long text's too.
    """
    _, _, rows = _keyed(docs, scratch, id_column, text_column)
    return _passages(rows, scratch, settings).select(F.col("doc").alias(id_column), "start", "length", "n_chunks", "removed_chunks", "removed_bytes", "removed")


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A UTF-8 text without (start, length) spans in order; characters that a span's ends cut stay whole."""
    out, at = [], 0
    merged: list[list[int]] = []
    for start, length in spans:
        if merged and merged[-1][1] >= start:
            merged[-1][1] = max(merged[-1][1], start + length)
        else:
            merged.append([start, start + length])
    for start, end in merged:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def without_repeated_passages(docs: DataFrame, scratch: Scratch, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with the spans that `repeated_passages` names cut out of the texts, and a column n_removed of bytes cut.

    All rows and columns stay; n_removed replaces a column of that name. A text that is a repeat as a whole is empty but for
    what no passage covers. Null, empty and long texts, shared ids, repeated rows and empty tables are as stated there.
    """
    keyed, key, rows = _keyed(docs, scratch, id_column, text_column)
    spans = _passages(rows, scratch, settings).where("removed_chunks > 0").groupBy("key").agg(F.sort_array(F.flatten(F.collect_list("removed"))).alias("spans"))
    # Written, so that the join has an exchange of its own on either side.
    spans = scratch.write(spans, "spans")
    columns = [c for c in docs.columns if c != "n_removed"]
    at = columns.index(text_column)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, gone in zip(batch.column(at), batch.column(len(columns))):
                text, gone = text.as_py(), gone.as_py()
                if gone:
                    whole = text.encode()
                    part = without_spans(whole, [(g["start"], g["length"]) for g in gone])
                    kept.append(part.decode())
                    removed.append(len(whole) - len(part))
                else:
                    kept.append(text)
                    removed.append(0)
            out = [pa.array(kept, pa.string()) if k == at else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*out, pa.array(removed, pa.int64())], names=[*columns, "n_removed"])

    lists = spans.select(F.col("key").alias(row := free_name(keyed, "row")), F.col("spans").alias(held := free_name(keyed, "spans"))).hint("merge")
    marked = keyed.join(lists, quoted(keyed, key) == lists[row], "left").select(*(quoted(keyed, c) for c in columns), lists[held])
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema if f.name != "n_removed"), T.StructField("n_removed", T.LongType())])
    return marked.mapInArrow(cut, schema)
