import random

from tallyweave.llm.decontaminate import Index, Rules, find_leaks, matches, normalised, original_span, within, without_leaks


def best_alignment(window, text):
    """Fewest edits of the whole window against any part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, text, times):
    out = bytearray(text)
    for _ in range(times):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(b"abcdefgh")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice(b"abcdefgh"))
    return bytes(out)


def test_matches_are_those_of_the_full_table(prose):
    rng, rules = random.Random(3), Rules()
    items = [normalised(prose(k, 30).encode()) for k in range(6)]
    index = Index(items, rules)
    documents = []
    for k in range(60):
        part = items[k % 6][: rules.window] if k % 2 else items[k % 6]
        inner = edited(rng, part, rng.randint(0, 12))
        documents.append(normalised(prose(100 + k, 15).encode() + b" " + inner + b" " + prose(200 + k, 15).encode()))
    found = matches(documents, index)
    for d, text in enumerate(documents):
        for i in range(6):
            want = {w for w in range(len(index.window)) if index.item[w] == i and best_alignment(index.window[w], text) <= index.errors[w]}
            got = {w for w, *_ in found.get((d, i), [])}
            assert got == want, (d, i)
            for w, edits, start, end in found.get((d, i), []):
                assert edits == best_alignment(index.window[w], text) or edits <= index.errors[w]
                assert abs(end - start - len(index.window[w])) <= index.errors[w]


def test_within_finds_the_best_place():
    assert within(b"abcdefghij", b"xxabcdefghijxx", 0, 4, 2) == (0, 2, 12)
    edits, start, end = within(b"abcdefghij", b"xxabcdXfghijxx", 0, 4, 2)
    assert (edits, start, end) == (1, 2, 12)
    assert within(b"abcdefghij", b"zzzzzzzzzzzzzz", 0, 4, 2) is None


def test_span_is_in_the_original_text():
    text = "Ein  Satz,\n– THE Answer: 42!".encode()
    clean = normalised(text)
    at = clean.index(b"the answer")
    begin, end = original_span(text, at, at + len(b"the answer"))
    assert text[begin:end] == b"THE Answer"


def test_rows_and_filter(spark, documents, prose):
    passage = prose(1, 40)
    benchmark = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (4, "tiny"), (None, prose(2, 40))], "item_id long, text string")
    rows = [
        (1, prose(10, 50) + "\n" + passage.upper().replace(" ", ",  ") + " " + prose(11, 20)),
        (2, prose(12, 80)),
        (3, None),
        (4, ""),
        (5, "a tiny thing"),
        (6, prose(2, 40)),
        (7, prose(13, 40_000) + " " + passage),
        (8, "tinyness"),
    ]
    docs = documents(rows).withColumnRenamed("lang", "item_id")
    found = find_leaks(docs, benchmark).collect()
    assert sorted({(r.doc_id, str(r.item_id)) for r in found}) == [(1, "1"), (5, "4"), (6, "None"), (7, "1")]
    assert sum(r.doc_id == 1 for r in found) == 2  # the item stands twice in the benchmark
    text = dict(rows)[1].encode()
    row = next(r for r in found if r.doc_id == 1)
    assert normalised(text[row.span_start : row.span_end]) == normalised(passage.encode())
    kept = without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 8]
    assert find_leaks(docs.limit(0), benchmark).count() == 0 and find_leaks(docs, benchmark.limit(0)).count() == 0
    assert without_leaks(docs, benchmark.limit(0)).count() == len(rows)


def test_blocks_give_the_same_rows(spark, documents, prose, monkeypatch):
    import tallyweave.llm.decontaminate as module

    items = [(k, prose(k, 30)) for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([(k, prose(50 + k, 20) + " " + items[k % 12][1]) for k in range(20)])
    whole = {tuple(r) for r in find_leaks(docs, benchmark).collect()}
    monkeypatch.setattr(module, "BLOCK_BYTES", 600)
    assert {tuple(r) for r in find_leaks(docs, benchmark).collect()} == whole and len(whole) == 20


def test_ids_of_other_types(spark, documents, prose):
    docs = documents([(1, prose(1, 40)), (2, prose(2, 40))])
    for kind, value in (("string", "one"), ("int", 7)):
        benchmark = spark.createDataFrame([(value, prose(1, 40))], f"item_id {kind}, text string")
        assert [tuple(r)[:2] for r in find_leaks(docs, benchmark).collect()] == [(1, value)]


def test_quotations_of_fifteen_words_and_capitals_of_all_letters(spark, documents, prose):
    rng = random.Random(5)
    items = [(k, "Où " + prose(k, 18) + " ÉTÉ groß Ünal Žižek İçin " + prose(100 + k, 18)) for k in range(40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [], set()
    for k, item in items:
        words = item.split()
        at = rng.randrange(len(words) - 14)
        part = " ".join(words[at : at + 15])
        while len(normalised(part.encode())) < Rules().window + Rules().stride - 1:
            part = " ".join(words[at : at + len(part.split()) + 1]) if at + len(part.split()) < len(words) else words[(at := at - 1)] + " " + part
        rows += [(3 * k, prose(200 + k, 40) + " " + part + " " + prose(300 + k, 40)), (3 * k + 1, item.upper()), (3 * k + 2, prose(400 + k, 90))]
        want |= {(3 * k, k), (3 * k + 1, k)}
    got = {(r.doc_id, r.item_id) for r in find_leaks(documents(rows), benchmark).collect()}
    assert got == want


def test_span_holds_every_occurrence(spark, documents, prose):
    item = prose(1, 30)
    text = prose(2, 10) + " " + item + " " + prose(3, 200) + " " + item + " " + prose(4, 10)
    row = find_leaks(documents([(1, text)]), spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert (row.span_start, row.span_end) == (len(prose(2, 10)) + 1, len(text) - len(prose(4, 10)) - 1) and row.edits == 0
