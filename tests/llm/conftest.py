import uuid

import pytest

from tallyweave.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def scratch(spark):
    made = Scratch(spark, f"test-{uuid.uuid4().hex[:6]}")
    yield made
    made.remove()


@pytest.fixture
def documents(spark):
    """A table of documents from (id, text) or (id, text, source)."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture
def word():
    """Invented words: the same number gives the same word."""
    import random

    def make(k):
        rng = random.Random(k)
        return "".join(rng.choice(["ta", "ro", "min", "es", "lu", "kor", "ve", "shi", "un", "dol"]) for _ in range(rng.randint(1, 4)))

    return make


@pytest.fixture
def prose(word):
    """n words, decided by the seed."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(word(rng.randrange(3000)) for _ in range(n))

    return make
