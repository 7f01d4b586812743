import random
from collections import Counter, defaultdict

import xxhash

from tallyweave.llm.chunk_dedup import GEAR, Settings, cuts, gear, repeated_passages, without_repeated_passages, without_spans
from tallyweave.llm.common import Scratch


def test_rolling_hash():
    text = bytes(random.Random(1).randrange(256) for _ in range(200))
    value = 0
    for place, byte in enumerate(text):
        value = ((value << 1) + int(GEAR[byte])) % (1 << 16)
        assert gear(text)[place] == value


def test_chunks_join_to_the_text_and_keep_their_sizes(prose):
    s = Settings()
    for text in [b"", b"a", prose(1, 3000).encode(), b"x" * 5000]:
        ends = cuts(text, s)
        assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(text)]
        sizes = [b - a for a, b in zip([0, *ends], ends)]
        assert all(s.least <= n <= s.most for n in sizes[:-1])


def test_an_insertion_moves_boundaries_only_nearby(prose):
    text = prose(2, 2000).encode()
    longer = text[:3000] + b"inserted " + text[3000:]
    a, b = set(cuts(text, Settings())), {e - 9 for e in cuts(longer, Settings())}
    assert {e for e in a if e > 3500} == {e for e in b if e > 3500}


def brute_force(rows, s):
    """Passages (id, start, length, chunks, removed chunks, removed bytes) and the cut texts, of rows in their order."""
    seen = defaultdict(list)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    for rank, k in enumerate(order):
        data = (rows[k][1] or "").encode()
        ends = cuts(data, s)
        for a, b in zip([0, *ends], ends):
            seen[xxhash.xxh3_128_digest(data[a:b])].append((rank, a, b))
    per_row = defaultdict(list)
    for places in seen.values():
        if len(places) > 1:
            for p in places:
                per_row[p[0]].append((p[1], p[2], p != min(places)))
    out, texts = [], {k: t for k, (_, t) in enumerate(rows)}
    for rank, parts in per_row.items():
        run, gone = [], set()
        for part in [*sorted(parts), (1 << 60, 1 << 60, False)]:
            if run and part[0] > run[-1][1]:
                if run[-1][1] - run[0][0] >= s.passage:
                    out.append((rows[order[rank]][0], run[0][0], run[-1][1] - run[0][0], len(run), sum(p[2] for p in run), sum(p[1] - p[0] for p in run if p[2])))
                    gone |= {at for p in run if p[2] for at in range(p[0], p[1])}
                run = []
            run.append(part)
        # A character goes only if all of its bytes do.
        kept, at = [], 0
        for c in rows[order[rank]][1]:
            size = len(c.encode())
            if not all(k in gone for k in range(at, at + size)):
                kept.append(c)
            at += size
        texts[order[rank]] = "".join(kept)
    return Counter(out), [texts[k] for k in range(len(rows))]


PASSAGE = ["doc_id", "start", "length", "n_chunks", "removed_chunks", "removed_bytes"]


def test_planted_passages(spark, documents, scratch, prose):
    rng, rows, planted = random.Random(5), [], set()
    passages = [prose(1000 + k, 55) for k in range(8)]
    for k in range(120):
        text = prose(k, rng.randint(60, 200))
        if k % 3 == 0:
            text += "\n" + passages[k % 8] + "\n" + prose(500 + k, 40)
            planted.add(k)
        rows.append((k, text))
    rows += [(200, None), (201, ""), (202, "short"), (203, "short"), (204, prose(9999, 30_000))]
    docs = documents(rows).withColumnRenamed("lang", "start")
    got = Counter(tuple(r) for r in repeated_passages(docs, scratch).select(*PASSAGE).collect())
    assert got == brute_force(rows, Settings())[0]
    caught = {r[0] for r in got}
    assert len(planted & caught) >= 0.95 * len(planted) and not caught - planted


def test_cut_texts(documents, scratch, prose):
    a, b, c = prose(1, 70), "é😀ü " * 60, prose(2, 90)
    rows = [(5, a), (7, a), (7, c), (1, c + "\n" + b), (1, c + "\n" + b), (None, prose(8, 50) + a), (9, b + c), (3, None), (4, ""), (6, a + a), (8, "only")]
    docs = documents(rows, parts=1)
    for name, new in (("lang", "row"), ("source", "spans"), ("n_chars", "row_key")):
        docs = docs.withColumnRenamed(name, new)
    docs = docs.selectExpr("*", "map('a', 1) as m", "0 as n_removed")
    passages, texts = brute_force(rows, Settings())
    cut = without_repeated_passages(docs, scratch)
    assert cut.columns == docs.columns
    got = cut.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for (i, _), t in zip(rows, texts))
    assert sum(r.n_removed for r in got) == sum(len((t or "").encode()) for _, t in rows) - sum(len((t or "").encode()) for t in texts) > 1000
    other = Scratch(docs.sparkSession, "again")
    assert Counter(tuple(r) for r in repeated_passages(docs, other).select(*PASSAGE).collect()) == passages
    other.remove()


def test_spans_leave_characters_whole():
    text = "aé😀b".encode()
    assert without_spans(text, [(2, 3)]).decode() == "aé😀b"
    assert without_spans(text, [(1, 2), (3, 2)]).decode() == "a😀b"
    assert without_spans(text, [(0, 7), (7, 1)]).decode() == ""


def test_copies_repeated_ids_and_empty_table(spark, documents, scratch, prose):
    text = prose(3, 100)
    docs = documents([(1, text), (2, text), (None, prose(4, 50)), (3, prose(5, 50))])
    got = {r.doc_id: r for r in repeated_passages(docs, scratch).collect()}
    assert set(got) == {1, 2} and got[1].removed_chunks == 0 and got[2].removed_bytes == got[2].length == len(text.encode())
    other = Scratch(spark, "none")
    assert repeated_passages(docs.limit(0), other).count() == 0
    other.remove()
