import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyweave.llm.license_scan import BASE, Rule, rules, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

TEXTS = [
    None,
    "",
    "no words of law",
    "Released under the MIT License.",
    "mit-license, MIT\nlicense and the mit. license",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU General Public License, version 2 or (at your option) any later version",
    "Licensed under the Apache License, Version 2.0.",
    "apache license 2.0 APACHE LICENSE",
    "Licensed under CC BY-NC 4.0.",
    "Creative Commons Attribution-NonCommercial 4.0 International; https://creativecommons.org/licenses/by-nc/4.0/",
    "SPDX-License-Identifier: Apache-2.0",
    "All rights reserved.",
    "GNU Lesser General Public License, version 2.1",
    "ÉCOLE mit license ß GÉNÉRAL",
    "Mozilla Public License, v. 2.0 and Eclipse Public License 1.0",
    "limit license permit licenses",
    "x " * 20_000 + "the MIT license",
    "\U0001d54f mit license \U0001d54f",
]


def plain(text, ordered):
    """The same by Python's own patterns."""
    text = (text or "").translate(LOWER)
    words = WORD.findall(text)
    base = [(label, k) for k in range(len(words)) for phrase, label in BASE.items() if tuple(words[k : k + len(phrase)]) == phrase]
    found = [(r, m.start(), m.end(), k) for k, r in enumerate(ordered) if r.keyword in text for m in re.finditer(r.pattern, text)]

    def hidden(d):
        r, a, b, k = d
        return any(
            x <= a and y >= b and o.priority >= r.priority and (y - x > b - a or o.priority > r.priority or j < k) for o, x, y, j in found
        )

    kept = [d for d in found if not hidden(d)]
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((k for _, k in base), default=None),
        "last_word": max((k for _, k in base), default=None),
        "base_labels": ",".join(sorted({label for label, _ in base})),
        "labels": ",".join(sorted({label for label, _ in base} | {d[0].label for d in kept})),
        "score": max([0.6 if base else 0.0, *(d[0].confidence for d in kept)]),
        "spans": sorted((d[0].label, d[1], d[2]) for d in kept),
    }


def test_same_as_plain_patterns(spark, documents):
    ordered = rules()
    docs = documents(list(enumerate(TEXTS)) + [(3, TEXTS[3])]).withColumnRenamed("lang", "labels")
    rows = scan_licenses(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        want = plain(TEXTS[r.doc_id], ordered)
        # Spark counts a character beyond the basic plane as one, as Python does.
        got = {k: r[k] for k in want if k != "spans"} | {"spans": sorted((d.label, d.start, d.end) for d in r.detections)}
        assert got == want, TEXTS[r.doc_id][:80] if TEXTS[r.doc_id] else TEXTS[r.doc_id]


def test_dense_texts_and_own_columns_of_any_name(spark, documents):
    rng, ordered = random.Random(9), rules()
    parts = [t for t in TEXTS[3:18] if len(t) < 200] + ["apache", "gpl-2.0+", "version 2", "mit", "\n", "or later", "public license"]
    texts = [" ".join(rng.choice(parts) for _ in range(n)) for n in (30, 200, 1500)]  # the last has more than RUN detections
    docs = documents(list(enumerate(texts))).withColumns({n: F.lit(n) for n in ("_text", "_even", "_held", "_found", "_words")})
    for r in scan_licenses(docs).collect():
        want = plain(texts[r.doc_id], ordered)
        assert [(d.label, d.start, d.end) for d in sorted(r.detections, key=lambda d: (d.label, d.start, d.end))] == want["spans"]
        assert r.labels == want["labels"] and r._text == "_text" and r._even == "_even" and r._held == "_held" and r._found == "_found" and r._words == "_words"
        assert [(d.rule, d.start) for d in r.detections] == sorted((d.rule, d.start) for d in r.detections)
    assert len(want["spans"]) > 1024


def test_what_is_known_of_the_labels(spark, documents):
    labels = {r.doc_id: r.labels for r in scan_licenses(documents(list(enumerate(TEXTS)))).collect()}
    assert labels[3] == "mit" and labels[5] == "gpl,gpl-3.0" and labels[6] == "gpl,gpl-2.0-or-later" and labels[7] == "apache,apache-2.0"
    assert labels[9] == "cc-by-nc-4.0" and labels[11] == "apache-2.0" and labels[12] == "proprietary" and labels[2] == ""
    assert labels[13] == "gpl,lgpl-2.1"


def test_every_match_holds_its_keyword():
    """The prefilter can't lose a match: each pattern's alternatives need the keyword or are guarded by it."""
    for r in rules():
        re.compile(r.pattern)
        assert r.keyword == r.keyword.lower() and 0 < r.confidence <= 1


def drawn(tree, rng):
    """A text that the parsed pattern matches; runs of blanks are a line end with indentation, or two blanks."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            kind, last = arg[-1]
            out += "\n" if str(kind) == "CATEGORY" else chr(last) if str(kind) == "LITERAL" else "0"
        elif op == "ANY":
            out += "."
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, part = arg
            blank = str(part[0]) == "(IN, [(CATEGORY, CATEGORY_SPACE)])" and high > 1
            out += rng.choice(["\n  ", "  "]) if blank and low else "".join(drawn(part, rng) for _ in range(rng.randint(low, min(high, low + 1))))
        elif op == "SUBPATTERN":
            out += drawn(arg[-1], rng)
        elif op == "BRANCH":
            out += drawn(rng.choice(arg[1]), rng)
        else:
            assert op in ("AT", "ASSERT_NOT"), op
    return out


def test_gate_loses_no_match_of_wrapped_text(spark, documents):
    rng, ordered, texts = random.Random(3), rules(), []
    for r in ordered:
        tree = re._parser.parse(r.pattern)
        found = {t for t in (drawn(tree, rng) for _ in range(8)) if re.search(r.pattern, t)}
        assert found, r.pattern
        texts += sorted(found)
    docs = documents(list(enumerate(texts)), 8)
    gated = {r.doc_id: r for r in scan_licenses(docs).collect()}
    free = {r.doc_id: r for r in scan_licenses(docs, ordered=[replace(r, keyword="") for r in ordered]).collect()}
    for k, text in enumerate(texts):
        assert gated[k].labels == free[k].labels and sorted(gated[k].detections) == sorted(free[k].detections), text
    assert len(texts) > 1000


def test_wrapped_names_and_notices(spark, documents):
    texts = {
        "lgpl-2.1": "GNU Lesser General\nPublic License, version 2.1",
        "boost-1.0": "under BSL-1.0",
        "bsd-3-clause": "Neither the name of the University nor the names of its\n contributors may be used to\nendorse",
        "proprietary": "may not be copied\nin whole or part without\npermission",
        "cc-by-sa-4.0": "CC BY-SA\n4.0",
        "lgpl": "under the terms of the GNU Library General Public License as published by others",
    }
    got = {r.doc_id: r.labels.split(",") for r in scan_licenses(documents(list(enumerate(texts.values())))).collect()}
    assert all(label in got[k] for k, label in enumerate(texts)), got


def test_empty_table_and_own_rules(spark, documents):
    docs = documents([(1, "alpha beta alpha")])
    assert scan_licenses(docs.limit(0)).count() == 0
    row = scan_licenses(docs, ordered=[Rule("a", "alpha", "alpha", 1, 0.5), Rule("ab", "beta", r"alpha\s+beta", 1, 0.7)]).first()
    assert row.labels == "a,ab" and [(d.label, d.start) for d in row.detections] == [("a", 11), ("ab", 0)]


@pytest.mark.parametrize("needle", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, documents, needle):
    plan = scan_licenses(documents([(1, "x")]).select("doc_id", F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert needle not in plan and "Exchange SinglePartition" not in plan
