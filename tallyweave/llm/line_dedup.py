"""Fuzzy line deduplication.

1. Lines are normalised. Each gets a digest; equal digests become one line. A line too short for the edit similarity to allow
   an edit can only be equal to another and goes no further.
2. The others get a SimHash of their longer words, 320 bits in 20 blocks, in the same pass. Distinct lines that agree in a block, as by the pigeonhole
   principle all within 19 bits do and most within 50, and whose lengths allow the similarity, are compared by the first
   128 bits. Entries are dealt out by (block, value), packed by the sending task; a bucket of a very common value is cut
   into tiles, each a task of its own. Each task returns a forest of its links, not all pairs.
3. Components of the forests bring together all lines that could be linked. The texts of just these lines are
   fetched. Within each component, pairs within the bit distance are verified by edit similarity; its lines are cut into
   cells by length and these into chunks, and every pair of chunks of the same or neighbouring cells is a task of its own.
4. Lines linked by verified pairs form groups. The first occurrence of each group stays, by document id, row and line number.

Lines of every length count, only blank ones aside (also those of ASCII punctuation alone). Rows are told apart by a key of
their own, not by their id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.common import Scratch, Sets, free_name, join_all, quoted, texts, with_row_keys
from tallyweave.llm.components import components

#: Lines of a component's cell that one task compares with each other or with as many others, at least.
CHUNK = 100
#: Chunks are so large that all copies of lines for their tasks have no more than so many times the lines' bytes, or COPIED_BYTES.
COPIES, COPIED_BYTES = 8, 256 << 20
#: What one round sends between tasks: half of the bytes of all distinct lines, or so many.
ROUND_BYTES = 1 << 30
#: Pairs of SimHashes that are compared at once.
TILE = 2_000_000
#: Blocks of 16 bits in a SimHash.
BLOCKS = 20
#: Columns of 64 bits that hold them.
LANES = ("point", "more", "third", "fourth", "fifth")
#: Bytes of packed entries that one task compares, about; entries of a bucket that isn't cut into tiles.
PART_BYTES = 16 << 20
HOT = 20_000
#: Words that a worker remembers.
REMEMBERED = 400_000
#: A step of length classes: eight make the share that the similarity leaves.
STEPS = 8
#: Words skipped in either line to where two lines may go on alike, the fewest first.
SKIPS = [(k, n - k) for n in range(1, 9) for k in sorted(range(n + 1), key=lambda k: abs(2 * k - n))]
#: Words of 64 bits, times 16, of the pairs whose edit distances are computed side by side, and pairs that are verified at once.
ROW_CELLS = 1 << 15
BATCH = 6000
#: Bytes beyond which two lines are compared by wavefronts.
LONG = 16384
#: Bytes whose neighbours are counted at once.
COUNTED = 1 << 20


@dataclass(frozen=True)
class Rules:
    #: Bits of the first 128 of a SimHash in which lines that are compared may differ.
    distance: int = 28
    similarity: float = 0.9

    def may_be_edited(self, length: int) -> bool:
        """False if an edit makes any line of this length, or a similar one, too different."""
        return int((1 - self.similarity) * (length / self.similarity) + 1e-9) > 0


# Letters in lower case, digits alike, other ASCII as blanks; line ends stay.
PLAIN = bytes(10 if b == 10 else b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def lines_of(text: bytes) -> list[tuple[int, list[bytes]]]:
    """(line number, words) of the normalised lines that aren't blank."""
    return [(number, words) for number, line in enumerate(text.translate(PLAIN).split(b"\n")) if (words := line.split())]


def features(words: list[bytes]) -> list[bytes]:
    """The words of four bytes or more, or all if there are none; of long ones, as in scripts without blanks, their shingles.

    `SimHashes` takes the same from many lines at once.
    """
    out = [w for w in words if len(w) > 3] or words
    if len(out) < 8 and max(map(len, out)) > 24:
        out = [f for w in out for f in ([w] if len(w) <= 24 else [w[k : k + 6] for k in range(len(w) - 5)])]
    return out


class Known:
    """Hashes of features as rows, and their numbers by the features' codes; row 0 is empty."""

    def __init__(self, lanes: int):
        self.hashes = np.zeros((1, lanes), np.uint64)
        self.codes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __call__(self, codes: np.ndarray, feature: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Numbers of distinct codes in order; `feature` gives the features at these of them."""
        at = np.searchsorted(self.codes, codes)
        new = np.ones(len(codes), bool)
        inside = at < len(self.codes)
        new[inside] = self.codes[at[inside]] != codes[inside]
        seeds = range((self.hashes.shape[1] + 1) // 2)
        digests = b"".join([xxhash.xxh3_128_digest(f, seed) for f in feature(np.nonzero(new)[0]) for seed in seeds])
        numbers = np.arange(len(self.hashes), len(self.hashes) + new.sum())
        out = np.empty(len(codes), np.int64)
        out[new], out[~new] = numbers, self.numbers[at[~new]]
        self.hashes = np.concatenate([self.hashes, np.frombuffer(digests, np.uint64).reshape(-1, 2 * len(seeds))[:, : self.hashes.shape[1]]])
        self.codes, self.numbers = np.insert(self.codes, at[new], codes[new]), np.insert(self.numbers, at[new], numbers)
        return out


#: The first n bytes of eight.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _codes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64 bits for each data[start:start + size], none of which holds a zero: up to eight bytes as they are, more of them mixed."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    codes = eight[start] & MASKS[np.minimum(size, 8)]
    more, at = np.nonzero(size > 8)[0], 8
    while len(more):
        mixed = codes[more]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        codes[more] = mixed ^ eight[start[more] + at] & MASKS[np.minimum(size[more] - at, 8)]
        at += 8
        more = more[size[more] > at]
    return codes


def _feature_places(data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the features of lines of these lengths, each with a blank behind it, and how many each line has; see `features`."""
    blank = np.nonzero(data == 32)[0]
    start = np.append(0, blank[:-1] + 1)
    length = blank - start
    ends = np.cumsum(size + 1)
    first = np.searchsorted(start, ends - size - 1)
    line = np.searchsorted(ends, start, "right")
    taken = length > 3
    taken |= (np.add.reduceat(taken, first, dtype=np.int64) == 0)[line]
    few = (np.add.reduceat(taken, first, dtype=np.int64) < 8)[line]
    start, length, line, few = start[taken], length[taken], line[taken], few[taken]
    cut = few & (length > 24)
    if cut.any():
        pieces = np.where(cut, length - 5, 1)
        begin = np.cumsum(pieces) - pieces
        start = np.repeat(start - begin, pieces) + np.arange(pieces.sum())
        length, line = np.repeat(np.where(cut, 6, length), pieces), np.repeat(line, pieces)
    return start, length, np.bincount(line, minlength=len(size))


class SimHashes:
    """Bit i of a line's SimHash is 1 if it is set in more than half of its features' hashes."""

    def __init__(self, lanes: int):
        self.lanes, self.known = lanes, Known(lanes)

    def __call__(self, lines: list[bytes]) -> np.ndarray:
        """(lines, lanes) of 64 bits each; lines are not empty, one blank stands between words."""
        out = np.zeros((len(lines), self.lanes), np.uint64)
        if not lines:
            return out
        number, count = self._numbers(lines)
        place = np.cumsum(count) - count
        order = np.argsort(count, kind="stable")
        begin = 0
        while begin < len(order):
            # Lines of about the same size are added up side by side.
            end = min(begin + 4096, int(np.searchsorted(count[order], count[order[begin]] * 1.25 + 2, "right")))
            rows = order[begin:end]
            some = count[rows]
            at = np.repeat(place[rows] - (np.cumsum(some) - some), some) + np.arange(some.sum())
            out[rows] = self._majority(number[at], some)
            begin = end
        return out

    def _numbers(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all lines' features, and how many each line has."""
        if len(self.known.codes) > REMEMBERED:
            self.known = Known(self.lanes)
        joined = b" ".join(lines) + b" "
        start, length, count = _feature_places(np.frombuffer(joined, np.uint8), np.fromiter(map(len, lines), np.int64, len(lines)))
        # Distinct codes by hashing, as sorting all of them costs more.
        coded = pa.array(_codes(np.frombuffer(joined, np.uint8), start, length)).dictionary_encode()
        codes, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        first = np.empty(len(codes), np.int64)
        first[which] = np.arange(len(which))
        order = np.argsort(codes)
        begin = start[first[order]]
        end = begin + length[first[order]]
        numbers = np.empty(len(codes), np.int64)
        numbers[order] = self.known(codes[order], lambda at: [joined[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist())])
        return numbers[which], count

    def _majority(self, number: np.ndarray, count: np.ndarray) -> np.ndarray:
        total = len(number)
        table = self.known.hashes
        longest = int(count.max())
        if longest > 32 * len(count):
            ends = np.cumsum(count).tolist()
            return np.concatenate([self._of_long(table, number[a:b]) for a, b in zip([0, *ends], ends)])
        # Row 0 pads the shorter lines.
        grid = np.zeros((longest, len(count)), np.int64)
        row = np.repeat(np.arange(len(count)), count)
        grid[np.arange(total) - np.repeat(np.cumsum(count) - count, count), row] = number
        # Counters of all bits as planes of binary digits.
        planes: list[np.ndarray] = []
        for k in range(longest):
            carry = table[grid[k]]
            for p in range((k + 1).bit_length() - 1 if k else 0):
                planes[p], carry = planes[p] ^ carry, planes[p] & carry
            if (k + 1) & k == 0:
                planes.append(carry)
            else:
                planes[-1] = planes[-1] ^ carry
        half = count // 2
        above, equal = np.zeros_like(planes[0]), np.full_like(planes[0], np.uint64(0xFFFFFFFFFFFFFFFF))
        for p in range(len(planes) - 1, -1, -1):
            digit = np.where((half >> p & 1).astype(bool), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))[:, None]
            above |= equal & planes[p] & ~digit
            equal &= ~(planes[p] ^ digit)
        return above


    def _of_long(self, table: np.ndarray, number: np.ndarray) -> np.ndarray:
        ones = np.zeros(64 * self.lanes, np.int64)
        for at in range(0, len(number), 4096):
            ones += np.unpackbits(table[number[at : at + 4096]].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return np.packbits(ones * 2 > len(number), bitorder="little").view(np.uint64)[None, :]


def simhashes(lines: list[list[bytes]], lanes: int = 1) -> np.ndarray:
    return SimHashes(lanes)([b" ".join(words) for words in lines])


def _in_portions(batch: pa.RecordBatch, size: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """A batch's texts, some megabytes at a time, and the row of the first."""
    begin, portion, held = 0, [], 0
    for row, text in enumerate(texts(batch, "text")):
        portion.append(text)
        held += len(text)
        if held > size:
            yield begin, portion
            begin, portion, held = row + 1, [], 0
    if portion:
        yield begin, portion


def _plain_lines(portion: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Texts' numbers, line numbers and normalised lines, as of `lines_of` with one blank between words."""
    data = np.frombuffer(b"\n".join([b"", *portion, b""]).translate(PLAIN), np.uint8)
    letters = (data != 32) & (data != 10)
    edges = np.nonzero(letters[1:] != letters[:-1])[0] + 1
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    line = np.searchsorted(np.nonzero(data == 10)[0], start) - 1
    first = np.nonzero(np.append(True, line[1:] != line[:-1]))[0]
    # A word and one byte behind it are kept.
    letters[end] = True
    kept = data[letters]
    after = np.cumsum(end - start + 1)
    kept[after - 1] = 32
    plain = kept.tobytes()
    begin = np.append(0, after)[first]
    lines = [plain[a : b - 1] for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(plain)])]
    line = line[first]
    begins = np.cumsum([0] + [text.count(b"\n") + 1 for text in portion[:-1]])
    row = np.searchsorted(begins, line, "right") - 1
    return row, line - begins[row], lines


def line_table(docs: DataFrame, rules: Rules, kind: str) -> DataFrame:
    """(doc, key, line, digest, length and the SimHash in LANES) of every line of (doc, key, text).

    No SimHash if the line can only be equal to another. Lines are grouped by the first 64 bits.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = SimHashes(len(LANES))
        for batch in batches:
            for begin, portion in _in_portions(batch):
                row, number, plain = _plain_lines(portion)
                fuzzy = {line: k for k, line in enumerate({line: 0 for line in plain if rules.may_be_edited(len(line))})}
                at = np.fromiter((fuzzy.get(line, len(fuzzy)) for line in plain), np.int64, len(plain))
                lanes = np.concatenate([hashed(list(fuzzy)), np.zeros((1, len(LANES)), np.uint64)])[at].view(np.int64)
                exact = at == len(fuzzy)
                rows = pa.array(begin + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(number.astype(np.int32)),
                        pa.array([xxhash.xxh3_128_digest(line) for line in plain], pa.binary()),
                        pa.array([len(line) for line in plain], pa.int32()),
                        *(pa.array(lanes[:, k], pa.int64(), mask=exact) for k in range(len(LANES))),
                    ],
                    names=["doc", "key", "line", "digest", "length", *LANES],
                )

    return docs.select("doc", "key", "text").mapInArrow(cut, f"doc {kind}, key long, line int, digest binary, length int, {', '.join(f'{c} long' for c in LANES)}")


# An entry is a bucket (block and value), a length class in its lowest bits, and the first 128 bits.
ENTRY = np.dtype([("code", "<u4"), ("point", "<u8"), ("more", "<u8")])
CLASS_BITS = 11


def _length_class(length: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(np.log(length) / -math.log(similarity) * STEPS, (1 << CLASS_BITS) - 2 * STEPS).astype(np.uint32)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    """(blocks, lines): the bucket of each block's value."""
    values = hashes.view("<u2").reshape(len(hashes), -1)[:, :BLOCKS]
    return (values.astype(np.uint32) + (np.arange(BLOCKS, dtype=np.uint32) << np.uint32(16))).T


def point_links(lines: DataFrame, rules: Rules, parts: int, scratch: Scratch, hot: int = HOT, rounds: int = 1) -> DataFrame:
    """Links (a, b) between the first 64 bits of distinct lines (length, LANES) that agree in a block, and are of like length and near enough.

    A round deals out the entries of some blocks, to so many parts, and its shuffle is gone before the next.
    """

    def deal(batches: Iterator[pa.RecordBatch], blocks: slice) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = _length_class(batch.column(0).to_numpy(), rules.similarity)
            hashes = np.column_stack([c.to_numpy().view(np.uint64) for c in batch.columns[1:]])
            buckets = _buckets(hashes)[blocks]
            entries = np.empty(buckets.shape, ENTRY)
            entries["code"] = buckets << np.uint32(CLASS_BITS) | length
            entries["point"], entries["more"] = hashes[:, 0], hashes[:, 1]
            part = ((buckets * np.uint32(2654435761)) >> np.uint32(8)).ravel() % np.uint32(parts)
            # Numbers of 16 bits are sorted by digits.
            order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
            packed, part = entries.ravel()[order], part[order]
            begin = np.concatenate(([0], np.nonzero(np.diff(part))[0] + 1, [len(part)])).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[begin[:-1]].astype(np.int32)), pa.array([packed[a:b].tobytes() for a, b in zip(begin, begin[1:])], pa.binary())], names=["part", "packed"]
            )

    def compare(table: pa.Table) -> pa.Table:
        entries = _ordered(np.frombuffer(b"".join(table.column("packed").to_pylist()), ENTRY))
        bucket = entries["code"] >> CLASS_BITS
        begin = np.concatenate(([0], np.nonzero(np.diff(bucket))[0] + 1, [len(entries)]))
        large = np.nonzero(np.diff(begin) > hot)[0].tolist()
        small = np.ones(len(entries), bool)
        tiles: list[tuple[bytes, bytes]] = []
        for k in large:
            small[begin[k] : begin[k + 1]] = False
            chunks = [entries[at : min(at + hot, begin[k + 1])] for at in range(begin[k], begin[k + 1], hot)]
            for i, left in enumerate(chunks):
                for right in chunks[i:]:  # by length: once one is too long, so are all behind it
                    if right is left or right["code"][0] - left["code"][-1] <= STEPS + 1:
                        tiles.append((left.tobytes(), b"" if right is left else right.tobytes()))
        a, b = _forest(entries[small], rules.distance)
        links = pa.table({"a": a, "b": b, "left": pa.nulls(len(a), pa.binary()), "right": pa.nulls(len(a), pa.binary())})
        none = pa.nulls(len(tiles), pa.int64())
        return pa.concat_tables([links, pa.table({"a": none, "b": none, "left": pa.array([t[0] for t in tiles], pa.binary()), "right": pa.array([t[1] for t in tiles], pa.binary())})])

    def compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                both = np.frombuffer(left.as_py() + right.as_py(), ENTRY)
                a, b = _forest(both, rules.distance)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    each = []
    for begin, end in zip(steps := [BLOCKS * k // rounds for k in range(rounds + 1)], steps[1:]):
        dealt = lines.where("point is not null").select("length", *LANES).mapInArrow(partial(deal, blocks=slice(begin, end)), "part int, packed binary")
        each.append(scratch.write(dealt.groupBy("part").applyInArrow(compare, "a long, b long, left binary, right binary"), f"compared/{begin}"))
    compared = reduce(DataFrame.union, each)
    tiles = compared.where("left is not null").select("left", "right").repartition(F.xxhash64("left", "right"))
    return compared.where("left is null").select("a", "b").union(tiles.mapInArrow(compare_tiles, "a long, b long"))


def _ordered(entries: np.ndarray) -> np.ndarray:
    """Entries by code; of equal ones that come to stand together one is left, as lines of the same words can be very many."""
    code = entries["code"].astype(np.uint64)
    entries = entries[np.argsort(code << np.uint64(32) | entries["point"] >> np.uint64(32))]
    return entries[np.append(True, (entries["code"][1:] != entries["code"][:-1]) | (entries["point"][1:] != entries["point"][:-1]) | (entries["more"][1:] != entries["more"][:-1]))]


def _forest(entries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest (a, b) of the links between sorted entries of one bucket that are of like length and within the distance."""
    code, point, more = entries["code"].astype(np.int64), np.ascontiguousarray(entries["point"]), np.ascontiguousarray(entries["more"])
    # One class more than the similarity leaves, as classes are rounded down.
    end = np.searchsorted(code, code + STEPS + 1, "right")
    left, right = [], []
    active, ahead = np.arange(len(code)), 1
    while len(active := active[active + ahead < end[active]]):
        step = max(1, TILE // len(active))
        for k in range(ahead, ahead + step):
            rows = active[active + k < end[active]] if k > ahead else active
            if not len(rows):
                break
            x, y = point[rows], point[rows + k]
            apart = np.bitwise_count(x ^ y) + np.bitwise_count(more[rows] ^ more[rows + k])
            near = np.nonzero((apart <= distance) & (x != y))[0]
            left.append(x[near])
            right.append(y[near])
        ahead += step
    if not left or not sum(map(len, left)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    points, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    sets = Sets(len(points))
    join_all(sets, both[: len(a)], both[len(a) :])
    root = sets.roots()
    moved = np.nonzero(root != np.arange(len(root)))[0]
    points = points.view(np.int64)
    return points[moved], points[root[moved]]


def similar(a: bytes, b: bytes, similarity: float) -> bool:
    """Edit similarity (1 less edits over the longer length) by bit-parallel edit distance."""
    longest = max(len(a), len(b))
    most = int((1 - similarity) * longest + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    return similar_by_words(a, b, most) or _similar_by_letters(a, b, most)


def similar_by_words(a: bytes, b: bytes, most: int) -> bool:
    """True only if a and b are at most so many edits apart, which words left out, put in and replaced show."""
    left, right = a.split(b" "), b.split(b" ")
    i = j = cost = 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            i, j = i + 1, j + 1
            continue
        # The nearest words at which both go on alike.
        skip = next((s for s in SKIPS if left[i + s[0] : i + s[0] + 1] == right[j + s[1] : j + s[1] + 1] != []), (1, 1))
        cost += max(_joined(left[i : i + skip[0]]), _joined(right[j : j + skip[1]]))
        if cost > most:
            return False
        i, j = i + skip[0], j + skip[1]
    return cost + max(_joined(left[i:]), _joined(right[j:])) <= most


def _joined(words: list[bytes]) -> int:
    """The length of words with a blank for each."""
    return sum(map(len, words)) + len(words)


def _similar_by_letters(a: bytes, b: bytes, most: int) -> bool:
    # Common ends cost nothing and leave little to compare.
    start = _common(a, b)
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    return edits(a, b, most) <= most


def edits_within(left: list[bytes], right: list[bytes], most: np.ndarray) -> np.ndarray:
    """Whether each pair is at most so many edits apart: rows of the table of edit distances, for many pairs of like length side by side.

    Only the diagonals are kept on which so few edits can lead from end to end; they are bits of words. No line holds a zero.
    """
    out = np.zeros(len(left), bool)
    size = np.array([sorted(map(len, pair)) for pair in zip(left, right)]).reshape(-1, 2)
    possible = (size[:, 1] - size[:, 0] <= most) & (size[:, 0] > 0)
    out[(size[:, 0] == 0) & (size[:, 1] <= most)] = True
    order = np.nonzero(possible)[0]
    # As many words as hold the diagonals, and seven bits more, rounded up to a power of two.
    words = 1 << np.ceil(np.log2((most + 8) / 64).clip(0)).astype(np.int64)
    order = order[np.lexsort((size[order, 0], words[order]))]
    while len(order):
        wide = int(words[order[0]])
        rows = order[: max(1, ROW_CELLS // (16 * wide))]
        rows = rows[words[rows] == wide]
        order = order[len(rows) :]
        pairs = [(left[r], right[r]) if len(left[r]) >= len(right[r]) else (right[r], left[r]) for r in rows.tolist()]
        if wide > 1 and len(rows) < 20 + 12 * wide:
            out[rows] = [_similar_by_letters(a, b, e) for (a, b), e in zip(pairs, most[rows].tolist())]
        else:
            out[rows] = _banded([p[0] for p in pairs], [p[1] for p in pairs], most[rows], wide)
    return out


#: The bits of a band's last word that are used, and the last of them.
LAST_WORD, LAST_BIT = np.uint64((1 << 57) - 1), np.uint64(1 << 56)


def _banded(long: list[bytes], short: list[bytes], most: np.ndarray, wide: int) -> np.ndarray:
    """Bit-parallel edit distance (Myers) in a band (Hyyrö): the steps between neighbours on 64 * wide - 7 diagonals are bits.

    The cost is followed down the last diagonal that counts, then along the last row of the longer line.
    """
    m, n = (np.fromiter(map(len, side), np.int64, len(side)) for side in (long, short))
    spare = np.minimum((most - (m - n)) // 2, n)
    low, bits, every = m - n + spare, 64 * wide - 7, np.arange(len(m))
    a, b = np.zeros((len(m), int(n.max()) + bits + 8), np.uint8), np.zeros((int(n.max()), len(m)), np.uint8)
    for k, (x, y, skip) in enumerate(zip(long, short, (bits - 1 - low).tolist())):
        x = x[: a.shape[1] - skip]
        a[k, skip : skip + len(x)] = np.frombuffer(x, np.uint8)
        b[: len(y), k] = np.frombuffer(y, np.uint8)
    # Where each byte that occurs stands in the longer lines, as bits that can be read from any byte on.
    letters = np.unique(b)
    where = np.zeros((len(letters), len(m), -(-a.shape[1] // 8) + 8 * wide), np.uint8)
    for k, letter in enumerate(letters[letters > 0].tolist(), int(letters[0] == 0)):
        marks = np.packbits(a == letter, axis=1, bitorder="little")
        where[k, :, : marks.shape[1]] = marks
    number = np.zeros(256, np.int64)
    number[letters] = np.arange(len(letters))
    place = (number[b] * len(m) + every) * where.shape[2]
    eight = np.ndarray((where.size - 7,), "<u8", where, 0, (1,))
    one, top = np.uint64(1), np.uint64(63)
    # A step down costs one at first, above the first row nothing.
    begin = bits - 1 - low - 64 * np.arange(wide)[:, None]
    more = np.where(begin >= 64, np.uint64(0), ~np.uint64(0) << begin.clip(0, 63).astype(np.uint64))
    less, cost, turn = np.zeros_like(more), low.copy(), n - spare
    first_turn, last_turn = int(turn.min()), int(turn.max())
    word = 8 * np.arange(wide)[:, None]
    for j in range(len(b)):
        same = eight[place[j] + (word + j // 8)]
        if aside := np.uint64(j % 8):
            after = same[1:] << np.uint64(64) - aside
            same >>= aside
            same[:-1] |= after
        same[-1] &= LAST_WORD
        add = same & more
        total = add + more
        if wide > 1:
            over = total < add
            for w in range(1, wide):
                total[w] += over[w - 1]
                over[w] |= over[w - 1] & (total[w] == 0)
        level = (total ^ more) | same | less
        right, back = less | ~(level | more), level & more
        # The last bit down the diagonal; then the last row's, one lower with each byte.
        if j < last_turn:
            cost += (level[-1] & LAST_BIT == 0) & (j < turn)
        if j >= first_turn and len(along := np.nonzero((j >= turn) & (j < n))[0]):
            bit = bits - 2 - (j - turn[along])
            at = (bit & 63).astype(np.uint64)
            cost[along] += (right[bit >> 6, along] >> at & one).astype(np.int64) - (back[bit >> 6, along] >> at & one).astype(np.int64)
        moved = level >> one
        moved[:-1] |= level[1:] << top
        more, less = back | ~(moved | right), moved & right
        if j % 32 == 31 and (cost - np.maximum(0, n - np.maximum(j + 1, turn)) > most).all():
            break
    return cost <= most


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.nonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))[0]
    return int(differ[0]) if len(differ) else n


def edits(a: bytes, b: bytes, most: int) -> int:
    """Edit distance, or any number above `most` once it is sure to exceed it."""
    if not a or not b:
        return max(len(a), len(b))
    if min(len(a), len(b)) > LONG:
        return wavefront_edits(a, b, most)
    where: dict[int, int] = {}
    for i, byte in enumerate(a):
        where[byte] = where.get(byte, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, cost = full, 0, len(a)
    for left, byte in zip(range(len(b) - 1, -1, -1), b):
        match = where.get(byte, 0)
        cross = match | down
        flow = (((match & up) + up) ^ up) | match
        rise = down | ~(flow | up) & full
        fall = up & flow
        if rise & top:
            cost += 1
        elif fall & top:
            cost -= 1
        if cost - left > most:
            return most + 1
        rise = (rise << 1 | 1) & full
        up = (fall << 1 & full) | ~(cross | rise) & full
        down = rise & cross
    return cost


def wavefront_edits(a: bytes, b: bytes, most: int) -> int:
    """As `edits`, by wavefronts: how far each diagonal gets with 0, 1, 2 ... edits. Long texts that differ little cost little."""
    m, n = len(a), len(b)
    x, y = (np.lib.stride_tricks.sliding_window_view(np.frombuffer(t + bytes([pad]) * 8, np.uint8), 8) for t, pad in ((a, 1), (b, 2)))
    x, y = (np.ascontiguousarray(t).view("<u8")[:, 0] for t in (x, y))
    low, reach = 0, np.array([_run(a, b, 0, 0)])
    for cost in range(most + 1):
        at = n - m - low
        if 0 <= at < len(reach) and reach[at] >= n:
            return cost
        # The column that each diagonal (column less row) reaches: by a byte more of b, of both, or of a.
        padded = np.concatenate(([-2, -2], reach, [-2, -2]))
        best = np.maximum(np.maximum(padded[:-2] + 1, padded[1:-1] + 1), padded[2:])
        low -= 1
        # Diagonals from which the end is too far are left out.
        skip = max(0, (n - m) - (most - cost - 1) - low)
        keep = min(len(best), (n - m) + (most - cost - 1) - low + 1)
        best, low = best[skip:keep], low + skip
        if not len(best):
            break
        diagonal = np.arange(low, low + len(best))
        best = np.minimum(best, np.minimum(n, m + diagonal))
        going = np.nonzero((best >= 0) & (best - diagonal >= 0))[0]
        for _ in range(4):
            column = best[going]
            differ = x[column - diagonal[going]] ^ y[column]
            same = np.bitwise_count((differ & -differ) - np.uint64(1)) // 8
            best[going] = column + np.where(differ == 0, 8, same)
            going = going[differ == 0]
        best = np.minimum(best, np.minimum(n, m + diagonal))
        for k in going.tolist():
            best[k] = _run(a, b, int(best[k] - diagonal[k]), int(best[k]))
        reach = best
    return most + 1


def _run(a: bytes, b: bytes, i: int, j: int) -> int:
    """The column up to which a from i and b from j are equal."""
    step = 256
    while True:
        x, y = a[i : i + step], b[j : j + step]
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return j + _common(x, y)
        if n < step:
            return j + n
        i, j, step = i + n, j + n, step * 4


def _verified(table: pa.Table, rules: Rules) -> pa.Table:
    """A forest of the verified links between lines of like (component, i, j), which stand together; where i and j differ, between the two sides."""
    digest, text = table.column("digest").to_pylist(), table.column("text").to_pylist()
    point, more = (table.column(c).to_numpy().view(np.uint64) for c in ("point", "more"))
    side, two = table.column("side").to_numpy(), pc.not_equal(table.column("i"), table.column("j")).to_numpy()
    length = np.fromiter(map(len, text), np.int64, len(text))
    most = ((1 - rules.similarity) * length + 1e-9).astype(np.int64)
    # Lines of a tile by length: once one is too long for another, so are all behind it.
    tile = _tiles(table)
    order = np.lexsort((length, tile))
    key = tile[order] * (int(length.max(initial=0)) + 1)
    end = np.searchsorted(key + (length - most)[order], key + length[order], "right")
    # Most pairs are shown by short runs of bytes to be too far apart; pairs of longer lines, whose edits cost most, by longer runs.
    counts, large = _run_counts(text, 2, 256), np.nonzero(most >= 64)[0]
    place = np.zeros(len(text), np.int64)
    place[large] = np.arange(len(large))
    large_counts = _run_counts([text[k] for k in large.tolist()], 4, 2048)
    sets, label = Sets(len(text)), np.arange(len(text))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        x, y = (np.concatenate([w[k] for w in waiting]) if waiting else np.zeros(0, np.int64) for k in (0, 1))
        waiting.clear()
        for at in range(0, len(x), BATCH):
            label = sets.roots()
            apart = label[x[at : at + BATCH]] != label[y[at : at + BATCH]]
            i, j = x[at : at + BATCH][apart], y[at : at + BATCH][apart]
            allowed = np.maximum(most[i], most[j])
            narrow = allowed < 64
            _join_within(sets, text, i[narrow], j[narrow], allowed[narrow])
            # Of longer lines, many are shown to be alike by their words.
            i, j, allowed = i[~narrow], j[~narrow], allowed[~narrow]
            alike = np.fromiter((sets.root(k) == sets.root(o) or similar_by_words(text[k], text[o], e) for k, o, e in zip(i.tolist(), j.tolist(), allowed.tolist())), bool, len(i))
            join_all(sets, i[alike], j[alike])
            label = sets.roots()
            left = ~alike & (label[i] != label[j])
            i, j, allowed = i[left], j[left], allowed[left]
            long = np.maximum(length[i], length[j]) > LONG
            _join_within(sets, text, i[~long], j[~long], allowed[~long])
            for k, other, e in zip(i[long].tolist(), j[long].tolist(), allowed[long].tolist()):
                if sets.root(k) != sets.root(other) and _similar_by_letters(text[k], text[other], e):
                    sets.join(k, other)

    active, ahead, held = np.arange(len(text)), 1, 0
    while len(active := active[active + ahead < end[active]]):
        x, y = order[active], order[active + ahead]
        near = np.bitwise_count(point[x] ^ point[y]) + np.bitwise_count(more[x] ^ more[y]) <= rules.distance
        near &= (~two[x] | (side[x] != side[y])) & (label[x] != label[y])
        x, y = x[near], y[near]
        possible = _may_be_within(counts[x], counts[y], most[y], 2)
        more_runs = np.nonzero(possible & (most[x] >= 64))[0]
        if len(more_runs):
            i, j = x[more_runs], y[more_runs]
            possible[more_runs] = _may_be_within(large_counts[place[i]], large_counts[place[j]], most[j], 4)
        waiting.append((x[possible], y[possible]))
        held += len(waiting[-1][0])
        if held >= BATCH:
            settle()
            label, held = sets.roots(), 0
        ahead += 1
    settle()
    root = sets.roots()
    moved = np.nonzero(root != np.arange(len(root)))[0].tolist()
    return pa.table({"a": pa.array([digest[k] for k in moved], pa.binary()), "b": pa.array([digest[root[k]] for k in moved], pa.binary())})


def _run_counts(text: list[bytes], size: int, counters: int) -> np.ndarray:
    """How often runs of so many bytes stand in each line, in counters up to 255 that several runs share."""
    out = np.zeros((len(text), counters), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, text), np.int64, len(text)))
    begin = 0
    while begin < len(text):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + COUNTED, "right")))
        data = np.frombuffer(b"".join(text[begin:end]), np.uint8)
        total = np.zeros((end - begin) * counters, np.int64)
        for at in range(0, len(data) - size + 1, COUNTED):  # only a line of its own is longer
            some = data[at : at + COUNTED + size - 1]
            code = np.zeros(len(some) - size + 1, np.uint32)
            for k in range(size):
                code = code * np.uint32(0x9E3779B1) + some[k : k + len(code)] + np.uint32(1)
            code = (code ^ code >> np.uint32(15)) * np.uint32(0x85EBCA6B)
            line = np.searchsorted(ends[begin:end] - before, np.arange(at, at + len(some)), "right")
            place = line[: len(code)] * counters + (code >> np.uint32(13)) % np.uint32(counters)
            total += np.bincount(place[line[: len(code)] == line[size - 1 :]], minlength=len(total))
        out[begin:end] = total.clip(max=255).reshape(-1, counters)
        begin = end
    return out


def _may_be_within(a: np.ndarray, b: np.ndarray, most: np.ndarray, size: int) -> np.ndarray:
    """False only for pairs, by their counts of runs of this size, that are more edits apart: an edit ends so many runs at most and begins as many."""
    return (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64) <= 2 * size * most


def _join_within(sets: Sets, text: list[bytes], left: np.ndarray, right: np.ndarray, most: np.ndarray) -> None:
    alike = edits_within([text[k] for k in left.tolist()], [text[k] for k in right.tolist()], most)
    join_all(sets, left[alike], right[alike])


def _tiles(table: pa.Table) -> np.ndarray:
    """Numbers, from 0, of the stretches of rows with like (component, i, j)."""
    new = np.zeros(len(table), bool)
    for name in ("component", "i", "j"):
        column = table.column(name)
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy()
    return np.cumsum(new)


def dealt_tiles(lines: DataFrame, rules: Rules, scratch: Scratch, chunk: int = CHUNK, copied_bytes: int = COPIED_BYTES) -> tuple[DataFrame, int]:
    """Lines (component, digest, point, more, text) in tiles (component, i, j), with the side of a tile that a line is on, and the bytes of all copies.

    Similar lines of a component lie in the same or neighbouring cells by length. A line is copied for every chunk of these.
    """
    # Somewhat wider than the similarity leaves, so that rounding sets no similar lines two cells apart.
    width = -math.log(rules.similarity) * (1 + 1e-6)
    lines = lines.withColumn("bytes", F.octet_length("text").cast("long")).withColumn("cell", F.floor(F.log("bytes") / F.lit(width)))
    cells = lines.groupBy("component", "cell").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    ways = cells.select("component", F.explode(F.array(*(F.col("cell") + d for d in (-1, 0, 1)))).alias("at"), "cell", "n", "bytes")
    mine = F.col("cell") == F.col("at")
    met = ways.groupBy("component", "at").agg(F.collect_list(F.struct("cell", "n")).alias("met"), *(F.max(F.when(mine, F.col(c))).alias(c) for c in ("n", "bytes")))
    met = scratch.write(met.where("n is not null").withColumnRenamed("at", "cell"), "met")
    sizes = [chunk << k for k in range(20)]
    copied = [F.sum(F.expr(f"bytes * ((other.n + {size - 1}) div {size})")) for size in sizes]
    pairs = met.select("cell", "bytes", F.explode("met").alias("other"))
    whole, *sent = (total or 0 for total in pairs.agg(F.sum(F.expr("if(other.cell = cell, bytes, 0)")), *copied).first())
    size, sent = next(((s, b) for s, b in zip(sizes, sent) if b <= max(copied_bytes, COPIES * whole)), (sizes[-1], sent[-1]))
    spread = lines.select("component", "cell", "digest", "point", "more", "text").join(met.select("component", "cell", "met", "n"), ["component", "cell"])
    spread = spread.withColumn("mine", F.expr(f"shiftleft(cell, 32) + pmod(xxhash64(digest), (n + {size - 1}) div {size})"))
    # Each chunk meets every chunk of its cell and of the neighbouring ones once: tile (i, j) with i <= j.
    others = f"flatten(transform(met, c -> transform(sequence(0L, (c.n + {size - 1}) div {size} - 1), k -> shiftleft(c.cell, 32) + k)))"
    tiles = spread.withColumn("other", F.explode(F.expr(others)))
    return tiles.select("component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.col("mine").alias("side"), "digest", "point", "more", "text"), sent


def verified_links(lines: DataFrame, rules: Rules, scratch: Scratch, chunk: int = CHUNK, copied_bytes: int = COPIED_BYTES, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Links (a, b) between digests of lines (component, digest, point, more, text). Tiles of so many bytes are verified in one round."""
    tiles, sent = dealt_tiles(lines, rules, scratch, chunk, copied_bytes)
    rounds = max(1, -(-sent // round_bytes))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last tile of a batch waits for its other rows."""
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            tile = _tiles(table)
            whole = int(np.searchsorted(tile, tile[-1])) if len(tile) else 0
            held = table.slice(whole)
            if whole:
                yield from _verified(table.slice(0, whole), rules).to_batches()
        if held is not None:
            yield from _verified(held, rules).to_batches()

    each = []
    for number in range(rounds):
        some = tiles.where(F.pmod(F.xxhash64("component", "i", "j"), F.lit(rounds)) == number) if rounds > 1 else tiles
        # Many small tiles stand in one batch. By digest, so that links go to a tile's smallest and the components need fewer rounds.
        links = some.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "digest").mapInArrow(verify, "a binary, b binary")
        each.append(scratch.write(links, f"verified-{number}") if rounds > 1 else links)
    return reduce(DataFrame.union, each)


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(component, digest, point, more, text) of wanted lines (component, digest, point, more, key, line) of (key, text)."""
    kind = wanted.schema["component"].dataType.simpleString()
    per_row = wanted.groupBy("key").agg(F.collect_list(F.struct("line", "component", "digest", "point", "more")).alias("wanted"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wants in zip(texts(batch, "text"), batch.column(1).to_pylist()):
                lines = dict(lines_of(text))
                rows += [(w["component"], w["digest"], w["point"], w["more"], b" ".join(lines[w["line"]])) for w in wants]
            columns = list(zip(*rows)) or [[], [], [], [], []]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["component", "digest", "point", "more", "text"])

    return docs.join(per_row.hint("shuffle_hash"), "key").select("text", "wanted").mapInArrow(pick, f"component {kind}, digest binary, point long, more long, text binary")


def _repeated(docs: DataFrame, scratch: Scratch, rules: Rules) -> DataFrame:
    """(doc, key, line, keep) of rows (doc, key, text): every line that goes, and the place (doc, key, line) of the one that stays."""
    lines = scratch.write(line_table(docs, rules, docs.schema["doc"].dataType.simpleString()), "lines")
    # Any place will do to fetch a line's text; the smallest, which Spark finds by sorting, is sought of repeated lines only.
    distinct = lines.groupBy("digest").agg(F.first("key").alias("key"), F.first("line").alias("line"), F.count("*").alias("times"), *(F.max(c).alias(c) for c in ("length", *LANES)))
    distinct = scratch.write(distinct, "distinct")
    points = distinct.where("point is not null").groupBy("point").agg(F.count("*").alias("texts"))
    fuzzy, held = distinct.where("point is not null").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    round_bytes, entries = max(ROUND_BYTES, held // 2), fuzzy * BLOCKS * ENTRY.itemsize
    rounds = min(BLOCKS, max(1, -(-entries // round_bytes)))
    parts = max(1, entries // rounds // PART_BYTES)
    linked = components(point_links(distinct, rules, parts, scratch, rounds=rounds), scratch, "points")
    scratch.remove("compared")
    alike = points.join(linked.withColumnRenamed("node", "point"), "point", "left").where("component is not null or texts > 1")
    alike = alike.select("point", F.coalesce("component", "point").alias("component"))
    wanted = distinct.join(alike, "point").select("component", "digest", "point", "more", "key", "line")
    fetched = scratch.write(_fetch(docs.select("key", "text"), wanted), "fetched")
    groups = components(verified_links(fetched, rules, scratch, round_bytes=round_bytes), scratch, "groups")
    scratch.remove("fetched")
    grouped = distinct.join(groups.withColumnRenamed("node", "digest"), "digest", "left").where("times > 1 or component is not null")
    grouped = grouped.select("digest", F.coalesce("component", "digest").alias("component"))
    places = scratch.write(lines.join(grouped, "digest").select("component", F.struct("doc", "key", "line").alias("place")), "places")
    # Written, so that the join has an exchange of its own and Spark can split a large group.
    for done in ("lines", "distinct"):
        scratch.remove(done)
    keep = scratch.write(places.groupBy("component").agg(F.min("place").alias("keep")), "keep")
    return places.join(keep, "component").where("keep.key <> place.key or keep.line <> place.line").select("place.doc", "place.key", "place.line", "keep")


def _keyed(docs: DataFrame, scratch: Scratch, id_column: str, text_column: str) -> tuple[DataFrame, str, DataFrame]:
    """`docs` with a key for each row, the key's name, and (doc, key, text)."""
    keyed, key = with_row_keys(docs, scratch)
    return keyed, key, keyed.select(quoted(keyed, id_column).alias("doc"), quoted(keyed, key).alias("key"), quoted(keyed, text_column).alias("text"))


def repeated_lines(docs: DataFrame, scratch: Scratch, rules: Rules = Rules(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, line, keep_doc, keep_line): every line that goes, and the line that stays for its group. Lines count from 0 between line ends."""
    _, _, rows = _keyed(docs, scratch, id_column, text_column)
    return _repeated(rows, scratch, rules).select("doc", "line", F.col("keep.doc").alias("keep_doc"), F.col("keep.line").alias("keep_line"))


def without_repeated_lines(docs: DataFrame, scratch: Scratch, rules: Rules = Rules(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` and a column n_dropped: texts without the lines that repeat a line seen before, fuzzily.

    All rows and columns stay; n_dropped replaces a column of that name. The order is that of ids, a null id first; rows that
    share an id, or are repeated, are documents of their own in the order of their keys, so all but one of equal rows
    lose all lines. Null and empty texts stay as they are; a text all of whose lines went is empty. Lines as
    similar as each other form one group, of which the first stays. An empty table gives an empty one. A long text costs
    its task time in proportion; two long lines are compared in time that grows with their length times their edits.
    """
    keyed, key, rows = _keyed(docs, scratch, id_column, text_column)
    gone = _repeated(rows, scratch, rules)
    # Written, so that the join has an exchange of its own on either side.
    per_row = scratch.write(gone.groupBy(F.col("key").alias("row")).agg(F.sort_array(F.collect_list("line")).alias("gone")), "gone")
    for done in ("places", "keep"):
        scratch.remove(done)
    # A hash table of the lists, which are far smaller than the texts, so that whole texts needn't be sorted. The lists are
    # stored compressed, so their size on disk is no ground for a broadcast.
    lists = per_row.select(F.col("row").alias(row := free_name(keyed, "row")), F.col("gone").alias(gone_name := free_name(keyed, "gone"))).hint("shuffle_hash")
    marked = keyed.join(lists, quoted(keyed, key) == lists[row], "left")
    text, lost = quoted(keyed, text_column), lists[gone_name]
    left = F.concat_ws("\n", F.filter(F.split(text, "\n", -1), lambda _, number: ~F.array_contains(lost, number)))
    columns = [F.when(lost.isNull(), text).otherwise(left).alias(c) if c == text_column else quoted(keyed, c) for c in docs.columns if c != "n_dropped"]
    return marked.select(*columns, F.when(lost.isNull(), 0).otherwise(F.size(lost)).alias("n_dropped"))
