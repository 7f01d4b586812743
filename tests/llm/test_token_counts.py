import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweave.llm.queries import word_tokenizer
from tallyweave.llm.token_counts import NEW_DIGITS, NEW_LETTERS, WordMerger, count_tokens

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(word_tokenizer())


@pytest.fixture(scope="module")
def mine():
    return WordMerger(word_tokenizer())


ODD = ["ΣΑΣ ΟΔΟΣ", "İstanbul", "a\x1cb\x85c d e", "ȩ́ ẛ̣", "don't we'll 'twas 's", "<|endoftext|>x<|startoftext|>", "<|ENDOFTEXT|>", "中文 ½² ٣", "…—“x”", "a" * 500, "İ̜ İ̗x", ""]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40))
def test_any_text_counts_as_the_library_counts(library, mine, text):
    assert mine.count(text.encode()) == len(library.encode(text, add_special_tokens=False))


def test_characters_that_python_may_not_know(library, mine):
    for ranges in (NEW_LETTERS, NEW_DIGITS):
        for span in ranges.split():
            for code in {int(end, 16) for end in span.split("-")}:
                for text in (f"a{chr(code)}b", chr(code) * 3, f"{chr(code)}\u00ce!"):
                    assert mine.count(text.encode()) == len(library.encode(text, add_special_tokens=False)), hex(code)


def test_odd_texts(library, mine):
    rng = random.Random(2)
    for text in ODD + ["".join(rng.choice(ODD)[:6] for _ in range(8)) for _ in range(200)]:
        assert mine.count(text.encode()) == len(library.encode(text, add_special_tokens=False)), text


def test_rows(spark, documents, library, prose):
    long = prose(1, 30_000)
    docs = documents([(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "x y"), (4, long)]).withColumnRenamed("lang", "n_tokens")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, word_tokenizer()).collect()), key=str)
    size = len(library.encode(long, add_special_tokens=False))
    assert got == sorted([(1, 11, 2, False), (1, 11, 2, False), (2, 0, 0, False), (3, 0, 0, False), (None, 3, 2, False), (4, len(long.encode()), size, size > 2048)], key=str)
    assert count_tokens(docs.limit(0), word_tokenizer()).count() == 0
