"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping windows. A text stretch that equals a window of m bytes up to e edits shares
at least m + 1 - q (e + 1) of its q-grams, all on diagonals (place in text less place in window) that span no more
than e. So, per window, shared q-grams are counted in overlapping bands of 2 (e + 1) diagonals; bands that meet the
bound are verified by banded alignment. A document leaks an item if a window of it is found within its edit budget.

Windows of 64 bytes begin at every 16th byte, so a verbatim quotation of 79 bytes holds a whole one wherever it is cut.
Texts are compared with the case of all letters folded, with ASCII punctuation and blanks taken as one blank. The benchmark is worked
through in blocks of bounded size, each shipped to the tasks that scan the documents; documents are not shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyweave.llm.common import texts

#: Bytes of a q-gram: eight, so that one fits a machine word.
Q = 8
#: Bytes of benchmark text in a block, about; each block is one pass over the documents.
BLOCK_BYTES = 4_000_000
#: Bytes of documents that are scanned at once.
SCAN_BYTES = 2_000_000
#: Bytes of stretches that may hold a match whose q-grams are looked up at once, about.
STRETCH_BYTES = 50_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)

KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
PLAIN = bytes(b if b in KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def normalised(text: bytes) -> bytes:
    """Folding makes no ASCII punctuation or blanks, so the words are those of the text."""
    if not text.isascii():
        text = text.decode(errors="surrogateescape").casefold().encode(errors="surrogateescape")
    return b" ".join(text.translate(PLAIN).split())


@dataclass(frozen=True)
class Rules:
    window: int = 64
    stride: int = 16
    error_rate: float = 0.08


class Index:
    """The q-grams of all windows of some items."""

    def __init__(self, items: list[bytes], rules: Rules):
        self.window, self.item, self.errors, self.tiny = [], [], [], []
        start, grams, place, at = [], [], [], 0  # places count through all items
        for number, item in enumerate(items):
            if not item:
                continue
            if len(item) < Q:
                self.tiny.append(number)
                continue
            starts = [*range(0, max(1, len(item) - rules.window + 1), rules.stride)]
            if starts[-1] + rules.window < len(item):
                starts.append(len(item) - rules.window)
            for s in starts:
                part = item[s : s + rules.window]
                self.window.append(part)
                self.item.append(number)
                self.errors.append(min(int(rules.error_rate * len(part)), len(part) // Q - 1))
                start.append(at + s)
            codes = all_grams(item)
            grams.append(codes)
            place.append(np.arange(at, at + len(codes)))
            at += len(item)
        self.items = items
        size = np.array([len(w) for w in self.window], np.int64)
        self.start = np.array(start, np.int64)
        self.need = np.array([len(w) + 1 - Q * (e + 1) for w, e in zip(self.window, self.errors)], np.int64)
        self.step = np.array(self.errors, np.int64) + 1
        codes, place = np.concatenate([np.zeros(0, np.uint64), *grams]), np.concatenate([np.zeros(0, np.int64), *place])
        order = np.argsort(codes, kind="stable")
        self.gram, self.first = np.unique(codes[order], return_index=True)
        self.last = np.append(self.first[1:], len(codes))
        self.place = place[order]
        # The windows that hold the q-gram at a place follow each other.
        self.owners_from = np.searchsorted(self.start + size - Q, self.place, "left").astype(np.int32)
        self.owners_to = np.searchsorted(self.start, self.place, "right").astype(np.int32)
        self.shift = np.uint64(64 - max(16, (8 * len(self.gram)).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), bool)
        self.table[self.slot(self.gram)] = True
        #: No stretch of `reach` places with fewer hits than `least` can hold a match.
        self.reach = max((len(w) + e for w, e in zip(self.window, self.errors)), default=0)
        self.least = int(self.need.min()) if len(self.need) else 0

    def slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams * SPREAD) >> self.shift


def all_grams(text: bytes) -> np.ndarray:
    """The q-gram at each place, as a number."""
    out = np.empty(max(0, len(text) - Q + 1), np.uint64)
    for phase in range(min(Q, len(out))):
        part = np.frombuffer(text, "<u8", (len(text) - phase) // Q, phase)
        out[phase::Q] = part
    return out


def within(window: bytes, text: bytes, low: int, high: int, errors: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of the whole window to a part of `text`, or None if it takes more edits.

    Only alignments starting on diagonals low to high are looked at; the band is wider by the edit budget.
    """
    left, right = max(0, low), min(len(text), high + len(window) + errors)
    at = text.find(window, left, right)
    if at >= 0:
        return 0, at, at + len(window)
    low, high = low - errors, high + errors
    width, far = high - low + 1, len(window) + 1
    padded = np.full(width + len(window), 10, np.uint8)  # a byte that no normalised text has
    a, b = max(0, low), min(len(text), low + len(padded))
    if a < b:
        padded[a - low : b - low] = np.frombuffer(text, np.uint8, b - a, a)
    ramp = np.arange(width)
    cost = np.zeros(width, np.int64)  # on diagonal low + k after i bytes of the window; any start is free
    origin = low + ramp
    for i, byte in enumerate(window):
        match = cost + (padded[i : i + width] != byte)
        skip = np.append(cost[1:] + 1, far)  # a byte of the window without partner
        take = skip < match
        best = np.where(take, skip, match)
        origin = np.where(take, np.append(origin[1:], 0), origin)
        run = np.minimum.accumulate(best - ramp)  # bytes of the text without partner
        moved = run + ramp
        source = np.maximum.accumulate(np.where(best - ramp == run, ramp, 0))
        cost, origin = moved, origin[source]
        if cost.min() > errors:
            return None
    k = int(cost.argmin())
    start, end = max(0, int(origin[k])), min(len(text), low + k + len(window))
    return int(cost[k]), start, end


def matches(documents: list[bytes], index: Index) -> dict[tuple[int, int], list[tuple[int, int, int, int]]]:
    """(document, item) -> (window, edits, start, end) of each window found, in normalised documents."""
    found: dict[tuple[int, int], list[tuple[int, int, int, int]]] = defaultdict(list)
    for number in index.tiny:
        item = index.items[number]
        for d, text in enumerate(documents):
            at = (b" " + text + b" ").find(b" " + item + b" ")
            if at >= 0:
                found[d, number].append((-1, 0, at, at + len(item)))
    if not index.window:
        return found
    begin = 0
    while begin < len(documents):
        end, size = begin + 1, len(documents[begin])
        while end < len(documents) and size + len(documents[end]) < SCAN_BYTES:
            size += len(documents[end])
            end += 1
        _scan(documents, begin, end, index, found)
        begin = end
    return found


def _scan(documents: list[bytes], begin: int, end: int, index: Index, found: dict) -> None:
    text = b"\n".join(documents[begin:end]) + b"\n"
    if len(text) < Q:
        return
    hit = np.empty(len(text) - Q + 1, bool)
    for phase in range(min(Q, len(hit))):
        part = np.frombuffer(text, "<u8", (len(text) - phase) // Q, phase)
        hit[phase::Q] = index.table[index.slot(part)]
    seen = np.concatenate(([0], np.cumsum(hit, dtype=np.int32)))
    reach = min(index.reach, len(hit))
    dense = np.nonzero(seen[reach:] - seen[:-reach] >= index.least)[0]
    if not len(dense):
        return
    # Stretches of places that may hold a match, and the hits in them.
    gap = np.nonzero(np.diff(dense) > reach)[0]
    lows, highs = dense[np.append(0, gap + 1)], dense[np.append(gap, len(dense) - 1)] + reach
    places = np.nonzero(hit)[0]
    starts = np.cumsum([0] + [len(d) + 1 for d in documents[begin:end]])
    exact: dict[tuple[int, int], list[int]] = defaultdict(list)  # places of windows found without edits: a band over one needs no second look
    # The q-grams of a match lie in one stretch, so stretches can be looked at one after the other.
    group = np.cumsum(highs - lows) // STRETCH_BYTES
    for part in np.split(np.arange(len(lows)), np.nonzero(np.diff(group))[0] + 1):
        a, b = np.searchsorted(places, lows[part]), np.searchsorted(places, highs[part])
        _verify(documents, begin, end, text, places[_ranges(a, b)], starts, exact, index, found)


def _verify(documents: list[bytes], begin: int, end: int, text: bytes, places: np.ndarray, starts: np.ndarray, exact: dict, index: Index, found: dict) -> None:
    bytes_ = np.frombuffer(text, np.uint8)
    codes = np.zeros(len(places), np.uint64)
    for k in range(Q):
        codes |= bytes_[places + k].astype(np.uint64) << np.uint64(8 * k)
    row = np.minimum(np.searchsorted(index.gram, codes), len(index.gram) - 1)
    same = index.gram[row] == codes
    places, row = places[same], row[same]
    first, last = index.first[row], index.last[row]
    posting, places = _ranges(first, last), np.repeat(places, last - first)
    first, last = index.owners_from[posting].astype(np.int64), index.owners_to[posting].astype(np.int64)
    owner = _ranges(first, last)
    diagonal = np.repeat(places - index.place[posting], last - first) + index.start[owner]
    band = diagonal // index.step[owner]
    span = np.int64(len(text) + 2 * index.reach)
    keys = np.concatenate([owner * span + band + 1 + index.reach, owner * span + band + index.reach])  # each diagonal is in two bands
    keys, count = np.unique(keys, return_counts=True)
    owner, band = keys // span, keys % span - 1 - index.reach
    enough = count >= index.need[owner]
    for w, low in zip(owner[enough].tolist(), (band[enough] * index.step[owner[enough]]).tolist()):
        e = index.errors[w]
        high = low + 2 * e + 1
        # The band may begin in one document and end in the next.
        for d in range(max(0, int(np.searchsorted(starts, low - e, "right")) - 1), min(end - begin, int(np.searchsorted(starts, high + len(index.window[w]) + e, "right")))):
            document, at = documents[begin + d], int(starts[d])
            if any(low - at <= place < high - at for place in exact[w, d][-2:]):
                continue
            best = within(index.window[w], document, low - at, high - at, e)
            if best:
                found[begin + d, index.item[w]].append((w, *best))
                if not best[0]:
                    exact[w, d].append(best[1])


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0]..last[0]-1, first[1]..last[1]-1, ..."""
    size = last - first
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


def original_span(text: bytes, start: int, end: int) -> tuple[int, int]:
    """Byte offsets in the text of a span of its normalised form, widened to whole words."""
    plain, clean = text.translate(PLAIN), normalised(text)
    first, last = clean.count(b" ", 0, start), clean.count(b" ", 0, max(start, end - 1))
    begin = finish = 0
    for number, word in enumerate(re.finditer(rb"[^ ]+", plain)):
        if number == first:
            begin = word.start()
        if number == last:
            finish = word.end()
            break
    return begin, finish


_last: list = []


def _of(shipped, rules: Rules) -> Index:
    """The index of a block; a Python worker keeps the one it used last."""
    if not _last or _last[0] is not shipped or _last[1] != rules:
        _last[:] = [shipped, rules, Index([text for _, text in shipped.value], rules)]
    return _last[2]


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple]]:
    """The items (id, normalised text), block by block."""
    items = benchmark.select(benchmark[id_column].alias("id"), F.coalesce(benchmark[text_column], F.lit("")).cast("binary").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    for number in range(blocks):
        rows = items.where(block == number).collect() if blocks > 1 else items.collect()
        yield sorted(((row[0], normalised(bytes(row[1]))) for row in rows), key=lambda item: (str(item[0]), item[1]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per document and leaked item: ids, n_windows found, edits (fewest), span_start and span_end.

    The span holds all places of all windows found, as byte offsets in the document's text. A long text costs time in
    proportion, and is held whole by its task. Null and empty texts leak nothing, null
    and empty items are found nowhere; items under 8 bytes must stand as they are. Repeated documents and
    repeated items each give their rows; other columns are ignored, whatever their names; an empty
    table on either side gives an empty one.
    """
    context = docs.sparkSession.sparkContext
    doc_kind, item_kind = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType
    item_arrow = to_arrow_type(item_kind)
    rows = docs.select(docs[doc_id].alias("d"), docs[text].alias("text"))
    schema = f"`{doc_id}` {doc_kind}, `{item_id}` {item_kind.simpleString()}, n_windows int, edits int, span_start long, span_end long"
    out = None
    for items in _blocks(benchmark, item_id, text):
        shipped = context.broadcast(items)

        def scan(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            index, names = _of(shipped, rules), [i for i, _ in shipped.value]
            for batch in batches:
                raw = list(texts(batch, "text"))
                found = matches([normalised(t) for t in raw], index)
                at = sorted(found)
                spans = [original_span(raw[d], min(f[2] for f in found[d, i]), max(f[3] for f in found[d, i])) for d, i in at]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([d for d, _ in at], pa.int64())),
                        pa.array([names[i] for _, i in at], item_arrow),
                        pa.array([len({f[0] for f in found[k]}) for k in at], pa.int32()),
                        pa.array([min(f[1] for f in found[k]) for k in at], pa.int32()),
                        pa.array([s[0] for s in spans], pa.int64()),
                        pa.array([s[1] for s in spans], pa.int64()),
                    ],
                    names=[doc_id, item_id, "n_windows", "edits", "span_start", "span_end"],
                )

        part = rows.mapInArrow(scan, schema)
        out = part if out is None else out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The documents that leak nothing, unchanged; no shuffle.

    Nulls, empty and long texts, repeated rows and empty tables count as in `find_leaks`: null and empty texts stay, equal rows
    go or stay together, an empty benchmark keeps all rows.
    """
    context = docs.sparkSession.sparkContext
    for items in _blocks(benchmark, item_id, text):
        shipped = context.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            index = _of(shipped, rules)
            for batch in batches:
                leaking = {d for d, _ in matches([normalised(t) for t in texts(batch, text)], index)}
                yield batch.filter(pa.array([i not in leaking for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
