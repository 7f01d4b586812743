"""License scans by ordered signature rules.

A rule is a pattern with the keyword that every match of it contains once runs of blanks and line ends are made one blank, a
label, a priority and a confidence. A text is searched only with the rules whose keyword it then contains. Where detections overlap, one that lies inside another of the same or
a higher priority is suppressed; of two equal ones the earlier rule stays. Besides the rules, fixed base phrases are looked for as
consecutive words; their labels always stay.

Everything is one projection of built-in functions over the text: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import free_name

#: A word: digits, letters in lower case, everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases, their labels.
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
BASE_CONFIDENCE = 0.6


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


# Priorities: an identifier or address names the license beyond doubt; a name with a version beats a bare name.
NAME, VERSIONED, NOTICE, EXACT = 1, 2, 3, 4
V = r",?\s+(?:version\s+|v\.?\s*)?"


def _versioned(label: str, keyword: str, name: str, versions: str, address: str = "") -> list[Rule]:
    """Rules for a license known by name, by name and version, by identifier, and by address."""
    rules = []
    for version in versions.split():
        short = version.removesuffix(".0")
        number = rf"{short.replace('.', '[.]')}(?:[.]0)?(?![.]?\d)" if version.endswith(".0") else rf"{version.replace('.', '[.]')}(?![.]?\d)"
        rules += [
            Rule(f"{label}-{version}-or-later", keyword, rf"{name}{V}{number},?\s+or\s+(?:\(at\s+your\s+option\)\s+)?(?:any\s+)?later", NOTICE, 0.95),
            Rule(f"{label}-{version}", keyword, rf"{name}{V}{number}", VERSIONED, 0.9),
            Rule(f"{label}-{version}", label, rf"\b{label}[- ]?v?{number}(?:-only|-or-later|\+)?", VERSIONED, 0.8),
            Rule(f"{label}-{version}", "spdx-license-identifier", rf"spdx-license-identifier:\s*{label}-{version}", EXACT, 1.0),
        ]
        if address:
            rules.append(Rule(f"{label}-{version}", address.split("/")[0], rf"{address.replace('.', '[.]').format(version)}", EXACT, 1.0))
    return [*rules, Rule(label, keyword, name, NAME, 0.7)]


def _creative_commons() -> list[Rule]:
    words = {"by": "attribution", "sa": "share-?\\s?alike", "nc": "non-?\\s?commercial", "nd": "no-?\\s?deriv(?:ative)?s?(?:\\s+works)?"}
    rules = []
    for kind, version in product("by by-sa by-nc by-nd by-nc-sa by-nc-nd".split(), "4.0 3.0 2.5 2.0 1.0".split()):
        number, label = version.replace(".", "[.]"), f"cc-{kind}-{version}"
        long = r"[-\s]+".join(words[p] for p in kind.split("-"))
        rules += [
            Rule(label, "cc by", rf"\bcc\s+{kind.replace('-', r'[-\s]+')}[-\s]+{number}", VERSIONED, 0.9),
            Rule(label, "cc-by", rf"\bcc-{kind}[-\s]+{number}", VERSIONED, 0.9),
            Rule(label, "creative commons", rf"creative\s+commons\s+{long}{V}{number}", VERSIONED, 0.9),
            Rule(label, "creative commons", rf"creative\s+commons\s+{long}\s+{number}\s+international", NOTICE, 0.95),
            Rule(label, "creativecommons.org", rf"creativecommons[.]org/licenses/{kind}/{number}", EXACT, 1.0),
        ]
    return [
        *rules,
        Rule("cc0-1.0", "cc0", r"\bcc0(?:[- ]1[.]0)?\b", VERSIONED, 0.9),
        Rule("cc0-1.0", "creativecommons.org", r"creativecommons[.]org/publicdomain/zero/1[.]0", EXACT, 1.0),
        Rule("cc", "creative commons", r"creative\s+commons(?:\s+licen[sc]e)?", NAME, 0.5),
    ]


def _notices() -> list[Rule]:
    """Licenses known by one name or by a sentence of their text."""
    return [
        Rule("mit", "mit", r"\b(?:the\s+)?mit(?:\s*\(expat\))?\s+licen[sc]e", VERSIONED, 0.9),
        Rule("mit", "permission is hereby granted, free of charge", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person", NOTICE, 0.9),
        Rule("mit", "spdx-license-identifier", r"spdx-license-identifier:\s*mit\b", EXACT, 1.0),
        Rule("mit", "opensource.org", r"opensource[.]org/licenses/mit", EXACT, 1.0),
        Rule("isc", "isc", r"\bisc\s+licen[sc]e", VERSIONED, 0.9),
        Rule("isc", "permission to use, copy, modify", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software", NOTICE, 0.8),
        Rule("bsd-2-clause", "bsd", r"\b(?:simplified|freebsd|2-clause|two-clause)\s+bsd(?:\s+licen[sc]e)?|\bbsd[- ]2-clause", VERSIONED, 0.9),
        Rule("bsd-3-clause", "bsd", r"\b(?:new|modified|revised|3-clause|three-clause)\s+bsd(?:\s+licen[sc]e)?|\bbsd[- ]3-clause", VERSIONED, 0.9),
        Rule("bsd-4-clause", "bsd", r"\b(?:original|4-clause|four-clause)\s+bsd(?:\s+licen[sc]e)?|\bbsd[- ]4-clause", VERSIONED, 0.9),
        Rule("bsd-3-clause", "neither the name of", r"neither\s+the\s+name\s+of\b[\s\S]{1,120}?may\s+be\s+used\s+to\s+endorse", NOTICE, 0.9),
        Rule("bsd", "redistribution and use", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", NOTICE, 0.8),
        Rule("bsd", "bsd", r"\bbsd(?:[- ]style)?\s+licen[sc]e", NAME, 0.7),
        Rule("zlib", "zlib", r"\bzlib(?:/libpng)?\s+licen[sc]e", VERSIONED, 0.9),
        Rule("zlib", "altered source versions", r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked", NOTICE, 0.9),
        Rule("unlicense", "unlicense", r"\b(?:the\s+)?unlicense\b|unlicense[.]org", VERSIONED, 0.9),
        Rule("unlicense", "released into the public domain", r"free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain", NOTICE, 0.95),
        Rule("public-domain", "public domain", r"(?:in|into|to)\s+the\s+public\s+domain", NAME, 0.5),
        Rule("wtfpl", "wtfpl", r"\bwtfpl\b", VERSIONED, 0.9),
        Rule("boost-1.0", "boost", r"\bboost\s+software\s+licen[sc]e(?:[\s,-]+(?:version\s+)?1[.]0)?", VERSIONED, 0.9),
        Rule("boost-1.0", "bsl", r"\bbsl-1[.]0", VERSIONED, 0.9),
        Rule("postgresql", "postgresql", r"\bpostgresql\s+licen[sc]e", VERSIONED, 0.9),
        Rule("openssl", "openssl", r"\bopenssl\s+licen[sc]e", VERSIONED, 0.9),
        Rule("sleepycat", "sleepycat", r"\bsleepycat\s+licen[sc]e", VERSIONED, 0.9),
        Rule("ncsa", "ncsa", r"\b(?:university\s+of\s+illinois/)?ncsa\s+open\s+source\s+licen[sc]e", VERSIONED, 0.9),
        Rule("upl-1.0", "universal permissive", r"\buniversal\s+permissive\s+licen[sc]e", VERSIONED, 0.9),
        Rule("vim", "vim", r"\bvim\s+licen[sc]e", VERSIONED, 0.9),
        Rule("x11", "x11", r"\bx11\s+licen[sc]e|\bmit/x11", VERSIONED, 0.9),
        Rule("ms-pl", "microsoft public", r"\bmicrosoft\s+public\s+licen[sc]e", VERSIONED, 0.9),
        Rule("ms-rl", "microsoft reciprocal", r"\bmicrosoft\s+reciprocal\s+licen[sc]e", VERSIONED, 0.9),
        Rule("beerware", "beer", r"\bbeer-?ware\s+licen[sc]e", VERSIONED, 0.9),
        Rule("jquery", "jquery", r"\bjquery\s+licen[sc]e", VERSIONED, 0.8),
        Rule("sil", "sil open font", r"\bsil\s+open\s+font\s+licen[sc]e", NAME, 0.8),
        Rule("gpl", "free software foundation", r"under\s+the\s+terms\s+of\s+the\s+gnu\s+general\s+public\s+licen[sc]e\s+as\s+published\s+by\s+the\s+free\s+software\s+foundation", NOTICE, 0.95),
        Rule("lgpl", "general public", r"under\s+the\s+terms\s+of\s+the\s+gnu\s+(?:lesser|library)\s+general\s+public\s+licen[sc]e\s+as\s+published", NOTICE, 0.95),
        Rule("agpl", "affero", r"under\s+the\s+terms\s+of\s+the\s+gnu\s+affero\s+general\s+public\s+licen[sc]e", NOTICE, 0.95),
        Rule("apache", "apache software foundation", r"licensed\s+to\s+the\s+apache\s+software\s+foundation", NOTICE, 0.9),
        Rule("proprietary", "all rights reserved", r"all\s+rights\s+reserved", NAME, 0.5),
        Rule("proprietary", "proprietary", r"proprietary\s+and\s+confidential", NOTICE, 0.9),
        Rule("proprietary", "without permission", r"may\s+not\s+be\s+(?:copied|reproduced|distributed)\b[\s\S]{0,60}?without\s+permission", NOTICE, 0.7),
    ]


def rules() -> list[Rule]:
    """All rules in order, built from license families."""
    families = [
        ("agpl", "affero", r"(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e", "3.0 1.0", "gnu.org/licenses/agpl-{}"),
        ("lgpl", "general public", r"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[sc]e", "3.0 2.1 2.0", "gnu.org/licenses/lgpl-{}"),
        ("gfdl", "free documentation", r"(?:gnu\s+)?free\s+documentation\s+licen[sc]e", "1.3 1.2 1.1", "gnu.org/licenses/fdl-{}"),
        ("gpl", "general public", r"(?:gnu\s+)?general\s+public\s+licen[sc]e", "3.0 2.0 1.0", "gnu.org/licenses/gpl-{}"),
        ("apache", "apache", r"apache\s+(?:software\s+)?licen[sc]e", "2.0 1.1 1.0", "apache.org/licenses/license-{}"),
        ("mpl", "mozilla", r"mozilla\s+public\s+licen[sc]e", "2.0 1.1 1.0", "mozilla.org/mpl/{}"),
        ("epl", "eclipse", r"eclipse\s+public\s+licen[sc]e", "2.0 1.0", "eclipse.org/legal/epl-{}"),
        ("cddl", "common development", r"common\s+development\s+and\s+distribution\s+licen[sc]e", "1.1 1.0", ""),
        ("cpl", "common public", r"common\s+public\s+licen[sc]e", "1.0", ""),
        ("ipl", "ibm public", r"ibm\s+public\s+licen[sc]e", "1.0", ""),
        ("eupl", "european union", r"european\s+union\s+public\s+licen[sc]e", "1.2 1.1", ""),
        ("artistic", "artistic", r"artistic\s+licen[sc]e", "2.0 1.0", ""),
        ("afl", "academic free", r"academic\s+free\s+licen[sc]e", "3.0 2.1", ""),
        ("osl", "open software", r"open\s+software\s+licen[sc]e", "3.0 2.1", ""),
        ("ofl", "open font", r"(?:sil\s+)?open\s+font\s+licen[sc]e", "1.1", ""),
        ("odbl", "open database", r"open\s+(?:data\s+commons\s+open\s+)?database\s+licen[sc]e", "1.0", ""),
        ("lppl", "latex project", r"latex\s+project\s+public\s+licen[sc]e", "1.3 1.0", ""),
        ("zpl", "zope", r"zope\s+public\s+licen[sc]e", "2.1 2.0", ""),
        ("psf", "python software", r"python\s+software\s+foundation\s+licen[sc]e", "2.0", ""),
        ("php", "php", r"\bphp\s+licen[sc]e", "3.01 3.0", ""),
        ("cpal", "common public attribution", r"common\s+public\s+attribution\s+licen[sc]e", "1.0", ""),
        ("ecl", "educational community", r"educational\s+community\s+licen[sc]e", "2.0", ""),
        ("sspl", "server side", r"server\s+side\s+public\s+licen[sc]e", "1.0", ""),
        ("busl", "business source", r"business\s+source\s+licen[sc]e", "1.1", ""),
    ]
    return [r for family in families for r in _versioned(*family)] + _creative_commons() + _notices()


ELEMENT = "struct<label:string,priority:int,confidence:double,start:int,end:int,rule:int>"
DETECTION = f"array<{ELEMENT}>"


#: Elements that a running state adds to one array before the next array begins.
RUN = 512


def _bound(value: Column, use) -> Column:
    """use(value), the value being computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _running(items: Column, zero: Column, kind: str, step) -> Column:
    """One element of type `kind` for each of `items`, from a state that runs over them; step gives (next state, element).

    An array grows by copying, so elements are gathered in arrays of RUN and these put together at the end.
    """

    def one(state: Column, item: Column) -> Column:
        after, made = step(state["state"], item)
        return F.struct(after.alias("state"), F.concat(state["out"], F.array(made)).alias("out"))

    def run(state: Column, at: Column) -> Column:
        part = F.aggregate(F.slice(items, at, F.lit(RUN)), F.struct(state["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("out")), one)
        return _bound(part, lambda p: F.struct(p["state"].alias("state"), F.concat(state["out"], F.array(p["out"])).alias("out")))

    begin = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    runs = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(runs, begin, run, lambda state: F.flatten(state["out"]))


def _spans(text: Column, rule: Column) -> Column:
    """All matches of a rule as detections, places in characters; built from the matches and what stands between them."""
    found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    between = F.split(text, rule["pattern"], -1)
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("size")))

    def add(at: Column, s: Column) -> tuple[Column, Column]:
        start = at + s["gap"]
        end = start + s["size"]
        return end, F.struct(rule["label"].alias("label"), rule["priority"].alias("priority"), rule["confidence"].alias("confidence"), start.alias("start"), end.alias("end"), rule["rule"].alias("rule"))

    return _bound(sizes, lambda held: _running(held, F.lit(0), ELEMENT, add))


def _suppressed(found: Column, priorities: list[int]) -> Column:
    """Detections that lie in no other of the same or a higher priority, by rule and place; of equal ones the first rule's.

    In the order of (start, longest, highest priority, first rule) whatever hides a detection stands before it. So one
    sweep suffices that remembers, for each priority, how far the detections of that or a higher one have reached.
    """
    key = F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("below"), d["rule"].alias("rule"), d.alias("detection")))
    ordered = F.transform(F.array_sort(key), lambda k: k["detection"])

    levels = F.array(*[F.lit(p) for p in priorities])

    def sweep(reach: Column, d: Column) -> tuple[Column, Column]:
        level = F.array_position(levels, d["priority"]).cast("int")
        after = F.transform(reach, lambda r, i: F.when(i < level, F.greatest(r, d["end"])).otherwise(r))
        return after, F.when(F.get(reach, level - 1) < d["end"], d)

    kept = _bound(ordered, lambda held: F.array_compact(_running(held, F.array(*[F.lit(-1) for _ in priorities]), ELEMENT, sweep)))
    by_rule = F.array_sort(F.transform(kept, lambda d: F.struct(d["rule"].alias("rule"), d["start"].alias("start"), d.alias("detection"))))
    return F.transform(by_rule, lambda k: k["detection"])


def scan_licenses(docs: DataFrame, text_column: str = "text", ordered: list[Rule] | None = None) -> DataFrame:
    """`docs` with n_words, base (struct of label, start word), detections, n_base, first_word, last_word, base_labels, labels, score.

    A-Z count as lower case. Null texts are taken as empty: no words, no labels, score 0. All rows, repeated ones too, and the other
    columns stay as they are, whatever their names; columns of the names above are replaced. The score is the greatest
    confidence of what was found. Detections are in the order of the rules, then of their places. A long text costs time in proportion to its length and
    detections. An empty table gives an empty one.
    """
    ordered = rules() if ordered is None else ordered
    held_text, even_name, held_name, found_name, words_name = (free_name(docs, n) for n in ("_text", "_even", "_held", "_found", "_words"))
    text = F.translate(F.coalesce(docs[text_column], F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = docs.withColumn(held_text, text)
    text = F.col(held_text)
    keywords = sorted({r.keyword for r in ordered})
    table = F.array(*[F.struct(F.lit(r.keyword).alias("keyword"), F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"), F.lit(k).alias("rule")) for k, r in enumerate(ordered)])
    # Patterns allow any blanks between words, keywords one.
    out = out.withColumn(even_name, F.regexp_replace(text, r"[\t-\r]\s*| \s+", " "))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col(even_name), F.lit(k)), F.lit(k)) for k in keywords]))
    out = out.withColumn(held_name, held)
    applied = F.filter(table, lambda r: F.array_contains(F.col(held_name), r["keyword"]))
    found = F.flatten(F.transform(applied, lambda r: _spans(text, r)))
    out = out.withColumn(found_name, F.when(F.size(held_name) > 0, found).otherwise(F.array().cast(DETECTION)))
    out = out.withColumn("detections", F.when(F.size(found_name) > 1, _suppressed(F.col(found_name), sorted({r.priority for r in ordered}))).otherwise(F.col(found_name)))

    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    last = sorted({phrase[-1] for phrase in BASE})
    named = F.lit(False)
    for word in last:
        named = named | F.contains(text, F.lit(word))
    out = out.withColumn(words_name, F.when(named, words))

    def phrase_at(i: Column) -> Column:
        hit = F.lit(None).cast("struct<label:string,start:long>")
        for phrase, label in BASE.items():
            same = F.lit(True)
            for k, word in enumerate(phrase):
                same = same & (F.get(F.col(words_name), i + k) == word)
            hit = F.when(same, F.struct(F.lit(label).alias("label"), i.cast("long").alias("start"))).otherwise(hit)
        return hit

    places = F.filter(F.transform(F.sequence(F.lit(0), F.size(words_name) - 1), phrase_at), lambda h: h.isNotNull())
    out = out.withColumn("base", F.when(F.coalesce(F.size(words_name), F.lit(0)) > 0, places).otherwise(F.array().cast("array<struct<label:string,start:long>>")))
    base_labels = F.array_sort(F.array_distinct(F.col("base.label")))
    every = F.array_sort(F.array_union(base_labels, F.col("detections.label")))
    confidence = F.array_max(F.concat(F.array(F.when(F.size("base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))), F.col("detections.confidence")))
    out = out.withColumns(
        {
            "n_words": F.regexp_count(text, F.lit(WORD)).cast("long"),
            "n_base": F.size("base").cast("long"),
            "first_word": F.array_min(F.col("base.start")),
            "last_word": F.array_max(F.col("base.start")),
            "base_labels": F.array_join(base_labels, ","),
            "labels": F.array_join(every, ","),
            "score": confidence,
        }
    )
    return out.drop(held_text, even_name, held_name, found_name, words_name)
