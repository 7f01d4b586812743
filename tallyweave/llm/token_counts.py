"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A word starts as its symbols. The heap holds the adjacent pairs that can merge, by rank and then place; the lowest is
popped, merged in the linked list, and its new neighbours are pushed. Every merge takes one symbol away, so the count
is initial symbols minus merges and no identifier is ever made. A word's count does not depend on its surroundings, so
each task remembers counts of words it has met, in a table of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyweave.llm.common import texts

#: Chunks a Python worker remembers at most; then it starts afresh.
REMEMBERED = 1_000_000
#: Bytes of a chunk that is remembered, at most.
LONGEST_REMEMBERED = 64

# Fixed values of the tokenizer family: contractions, letters, single digits, everything else that isn't blank.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Characters of later Unicode versions that the tokenizers know and Python's tables may lack.
NEW_LETTERS = (
    "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b-1138b 1138e-1138e "
    "11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff-18cff "
    "1e5d0-1e5ed 1e5f0-1e5f0"
)
NEW_DIGITS = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
#: Lower case is taken character by character: no final form of sigma.
LOWER_FIRST = NEW_LOWER | {ord("Σ"): ord("σ")}


@lru_cache(maxsize=4)
def word_pattern(last: int) -> re.Pattern:
    """Finds words of texts whose characters go up to `last`; letters and digits by their Unicode category."""
    spans: dict[str, list[list[int]]] = {"L": [], "N": []}
    for code in range(last + 1):
        kind = spans.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            if kind and kind[-1][1] == code - 1:
                kind[-1][1] = code
            else:
                kind.append([code, code])
    for kind, added in (("L", NEW_LETTERS), ("N", NEW_DIGITS)):
        spans[kind] += [[a, b] for a, b in (map(lambda x: int(x, 16), r.split("-")) for r in added.split()) if b <= last]
    letter, digit = ("".join(rf"\U{a:08x}-\U{b:08x}" for a, b in spans[k]) for k in "LN")
    return re.compile(rf"{CONTRACTIONS}|[{letter}]+|[{digit}]|[^{BLANK}{letter}{digit}]+")


class WordMerger:
    """Counts tokens of texts by the merges of a byte-level BPE file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.end = spec["model"]["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))).encode()) if special else None
        self.letter = _byte_letters()
        self.latin_words = word_pattern(255)
        self.known = Chunks(self._chunk)

    def merged(self, word: str) -> int:
        """Tokens of one word."""
        symbol = [self.letter[b] for b in word.encode()]
        symbol[-1] += self.end
        n, rank = len(symbol), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := rank.get((symbol[i], symbol[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            r, i, j = heapq.heappop(heap)
            if symbol[i] is None or after[i] != j or rank.get((symbol[i], symbol[j])) != r:
                continue  # one of the two has merged meanwhile
            symbol[i] += symbol[j]
            symbol[j] = None
            left -= 1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (r := rank.get((symbol[i], symbol[k]))) is not None:
                    heapq.heappush(heap, (r, i, k))
            if h >= 0 and (r := rank.get((symbol[h], symbol[i]))) is not None:
                heapq.heappush(heap, (r, h, i))
        return left

    def split(self, chunk: str) -> list[str]:
        """The words of what stands between two blanks: normal form, lower case."""
        try:
            chunk.encode("latin-1")
        except UnicodeEncodeError:
            chunk = unicodedata.normalize("NFC", chunk)
            return word_pattern(sys.maxunicode).findall(chunk.translate(LOWER_FIRST).lower())
        return self.latin_words.findall(chunk.lower())

    def _chunk(self, chunk: str) -> int:
        words = self.split(chunk)
        if len(words) == 1:
            return self.merged(words[0])
        # "word," and "word." have most of their work in common; a word is not split again, so it has a key of its own kind.
        total, known = 0, self.known
        for word in words:
            tokens = known.get(word)
            if tokens is None:
                tokens = self.merged(word)
                if len(word) <= LONGEST_REMEMBERED:
                    known[word] = tokens
            total += tokens
        return total

    def count(self, text: bytes) -> int:
        if self.special and b"<|" in text:
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: bytes) -> int:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return sum(map(self.known.__getitem__, text.lower().split()))


class Chunks(dict):
    """What has been worked out for the byte strings between two ASCII blanks.

    No word reaches over a blank and no character composes with one, so each can be looked up by itself.
    """

    def __init__(self, work_out):
        super().__init__()
        self.work_out = work_out

    def __missing__(self, chunk: bytes):
        value = self.work_out(chunk.decode())
        if len(chunk) <= LONGEST_REMEMBERED:
            self[chunk] = value
        return value


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=2)
def merger(path: str) -> WordMerger:
    """One for each Python worker, kept between its tasks."""
    return WordMerger(path)


def count_tokens(docs: DataFrame, path: str, max_tokens: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens; other columns are ignored, whatever their names; repeated rows
    are counted each; an empty table gives an empty one. No shuffle.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in batches:
            size, tokens = [], []
            for text in texts(batch, "text"):
                size.append(len(text))
                tokens.append(m.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array([t > max_tokens for t in tokens], pa.bool_())],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(docs[id_column].alias(id_column), docs[text_column].alias("text"))
    return rows.mapInArrow(tally, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
