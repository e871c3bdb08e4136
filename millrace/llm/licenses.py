"""License scan with ordered signature rules.

Texts are normalised to words (lower case, separated by one blank). A rule is a
regular expression over the normalised text with a label, a priority, a confidence
and a gate of keywords that must all occur before the expression is tried. Some rules are written
one by one (``license_rules.LISTED`` and ``TEXTS``), others put each license name into each of the phrases in which names stand. Detections that lie
inside another one of the same or higher priority are suppressed; detections that
only overlap stay. Base rules (exact phrases) find all their places, are never
suppressed and suppress nothing.

Each row is handled alone, nothing is shuffled; time is linear in the text for
texts without keywords.

Defined cases: a missing or empty text has no words and no detections; an empty table gives an empty result; repeated rows
are judged alike; ties between equal intervals go to the higher priority, then to
the earlier rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ALNUM
from millrace.llm.license_rules import LISTED

# The phrases every scan must report, and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
BASE_CONFIDENCE = 0.9

# Label, keyword, full title, short name as it stands in notices and identifiers.
# Patterns are over normalised words: "2.0" reads "2 0", "BSD-3-Clause" reads "bsd 3 clause".
NAMES = (
    ("mit", "mit", "mit licen[cs]e", "mit"),
    ("mit-0", "mit", "mit no attribution(?: licen[cs]e)?", "mit 0"),
    ("apache-1.1", "apache", "apache(?: software)? licen[cs]e(?: version)? 1 1", "apache 1 1"),
    ("apache-2", "apache", "apache(?: software)? licen[cs]e(?: version)? 2(?: 0)?", "apache 2(?: 0)?"),
    ("gpl-1", "gnu", "gnu general public licen[cs]e(?: version)? 1(?: 0)?", "gpl 1(?: 0)?"),
    ("gpl-2", "gnu", "gnu general public licen[cs]e(?: version)? 2(?: 0)?", "gpl 2(?: 0)?"),
    ("gpl-3", "gnu", "gnu general public licen[cs]e(?: version)? 3(?: 0)?", "gpl 3(?: 0)?"),
    ("gpl", "gnu", "gnu general public licen[cs]e", "gnu gpl"),
    ("lgpl-2", "gnu", "gnu (?:library|lesser) general public licen[cs]e(?: version)? 2(?: [01])?", "lgpl 2(?: [01])?"),
    ("lgpl-3", "gnu", "gnu lesser general public licen[cs]e(?: version)? 3(?: 0)?", "lgpl 3(?: 0)?"),
    ("lgpl", "gnu", "gnu (?:library|lesser) general public licen[cs]e", "gnu lgpl"),
    ("agpl-3", "gnu", "gnu affero general public licen[cs]e(?: version)?(?: 3(?: 0)?)?", "agpl 3(?: 0)?"),
    ("gfdl", "gnu", "gnu free documentation licen[cs]e(?: version)?(?: 1 [123])?", "gfdl 1 [123]"),
    ("bsd-0", "bsd", "(?:zero clause|0 clause) bsd licen[cs]e", "0bsd"),
    ("bsd-1", "bsd", "(?:one|1) clause bsd licen[cs]e", "bsd 1 clause"),
    ("bsd-2", "bsd", "(?:two|2) clause bsd licen[cs]e", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:three|3) clause bsd licen[cs]e", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:four|4) clause bsd licen[cs]e", "bsd 4 clause"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e", "bsd"),
    ("isc", "isc", "isc licen[cs]e", "isc"),
    ("mpl-1", "mozilla", "mozilla public licen[cs]e(?: version)? 1 [01]", "mpl 1 [01]"),
    ("mpl-2", "mozilla", "mozilla public licen[cs]e(?: version)? 2(?: 0)?", "mpl 2(?: 0)?"),
    ("epl-1", "eclipse", "eclipse public licen[cs]e(?: version)? 1(?: 0)?", "epl 1(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public licen[cs]e(?: version)? 2(?: 0)?", "epl 2(?: 0)?"),
    ("cddl-1", "common", "common development and distribution licen[cs]e(?: version)?(?: 1 [01])?", "cddl 1 [01]"),
    ("cpl-1", "common", "common public licen[cs]e(?: version)?(?: 1(?: 0)?)?", "cpl 1(?: 0)?"),
    ("cc0", "cc0", "cc0 1 0(?: universal)?", "cc0"),
    ("cc-by", "attribution", "creative commons attribution(?: [1234] 0)?(?: international| unported| generic)?", "cc by(?: [1234] 0)?"),
    ("cc-by-sa", "attribution", "creative commons attribution share ?alike(?: [1234] 0)?", "cc by sa(?: [1234] 0)?"),
    ("cc-by-nd", "attribution", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] 0)?", "cc by nd(?: [1234] 0)?"),
    ("cc-by-nc", "attribution", "creative commons attribution non ?commercial(?: [1234] 0)?", "cc by nc(?: [1234] 0)?"),
    ("cc-by-nc-sa", "attribution", "creative commons attribution non ?commercial share ?alike(?: [1234] 0)?", "cc by nc sa(?: [1234] 0)?"),
    ("cc-by-nc-nd", "attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] 0)?", "cc by nc nd(?: [1234] 0)?"),
    ("unlicense", "unlicen", "the unlicen[cs]e", "unlicen[cs]e"),
    ("wtfpl", "public", "do what the fuck you want to public licen[cs]e", "wtfpl"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", "zlib"),
    ("boost-1", "boost", "boost software licen[cs]e(?: version)?(?: 1(?: 0)?)?", "bsl 1(?: 0)?"),
    ("artistic-1", "artistic", "artistic licen[cs]e(?: version)? 1(?: 0)?", "artistic 1(?: 0)?"),
    ("artistic-2", "artistic", "artistic licen[cs]e(?: version)? 2(?: 0)?", "artistic 2(?: 0)?"),
    ("python-2", "python", "python software foundation licen[cs]e(?: version)?(?: 2(?: 0)?)?", "psf 2(?: 0)?"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("php-3", "php", "php licen[cs]e(?: version)?(?: 3 0?[01])?", "php 3 0?[01]"),
    ("ruby", "ruby", "ruby licen[cs]e", "ruby"),
    ("eupl-1", "european", "european union public licen[cs]e(?: version)?(?: 1 [012])?", "eupl 1 [012]"),
    ("afl-3", "academic", "academic free licen[cs]e(?: version)?(?: 3(?: 0)?)?", "afl 3(?: 0)?"),
    ("osl-3", "open", "open software licen[cs]e(?: version)?(?: 3(?: 0)?)?", "osl 3(?: 0)?"),
    ("ofl-1", "font", "sil open font licen[cs]e(?: version)?(?: 1 [01])?", "ofl 1 [01]"),
    ("odbl-1", "open", "open (?:data commons open )?database licen[cs]e(?: version)?(?: 1(?: 0)?)?", "odbl 1(?: 0)?"),
    ("odc-by-1", "open", "open data commons attribution licen[cs]e(?: version)?(?: 1(?: 0)?)?", "odc by 1(?: 0)?"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e", "ms rl"),
    ("upl-1", "universal", "universal permissive licen[cs]e(?: version)?(?: 1(?: 0)?)?", "upl 1(?: 0)?"),
    ("ncsa", "illinois", "university of illinois(?: ncsa)? open source licen[cs]e", "ncsa"),
    ("x11", "x11", "x11 licen[cs]e", "x11"),
    ("vim", "vim", "vim licen[cs]e", "vim"),
    ("openssl", "openssl", "openssl licen[cs]e", "openssl"),
    ("bsl-1.1", "business", "business source licen[cs]e(?: version)?(?: 1 1)?", "busl 1 1"),
    ("sspl-1", "server", "server side public licen[cs]e(?: version)?(?: 1(?: 0)?)?", "sspl 1(?: 0)?"),
    ("elastic-2", "elastic", "elastic licen[cs]e(?: version)?(?: 2(?: 0)?)?", "elastic 2(?: 0)?"),
    ("openrail", "rail", "(?:creativeml |bigscience )?open ?rail(?: m| s)?(?: licen[cs]e)?", "openrail(?: m| s)?"),
)

GRANT = "(?:licen[cs]ed|released|distributed|available|provided|published|redistributed|covered|governed)"
# Name, keywords, expression around {title} or {short}, priority, confidence. A rule is
# gated by these keywords and by that of its title or the first word of its short name.
PHRASES = (
    ("identifier", ("spdx",), "spdx licen[cs]e identifier {short}(?: only| or later)?", 100, 1.0),
    ("operand", ("spdx",), "(?:or|and) {short}(?: only| or later)?", 97, 1.0),
    ("grant", (" under ",), GRANT + " under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{title}", 80, 0.95),
    ("short grant", (" under ",), GRANT + " under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{short}(?: licen[cs]e)?", 75, 0.9),
    ("notice", ("licen",), "(?:licen[cs]e|subject to)(?: is)?(?: the)? {title}", 70, 0.85),
    ("later", ("later",), "{title} or (?:at your option )?(?:any )?later(?: version)?", 60, 0.8),
    ("title", (), "{title}", 50, 0.7),
)
# Label, gate, expression, priority, confidence: texts that stand for themselves.
TEXTS = (
    ("mit", ("permission",), "permission is hereby granted free of charge to any person obtaining a copy", 90, 0.95),
    ("isc", ("permission",), "permission to use copy modify and or distribute this software for any purpose", 90, 0.9),
    ("bsd", ("redistribution",), "redistribution and use in source and binary forms with or without modification", 90, 0.9),
    ("proprietary", ("rights",), "all rights reserved", 30, 0.4),
    ("public-domain", ("public domain",), "(?:released into|dedicated to|in) the public domain", 60, 0.7),
    ("unlicense", ("public domain",), "free and unencumbered software released into the public domain", 90, 0.95),
    ("apache-2", ("compliance",), "you may not use this file except in compliance with the licen[cs]e", 85, 0.9),
    ("wtfpl", ("want",), "you just do what the fuck you want to", 85, 0.9),
    ("zlib", ("provided as is",), "this software is provided as is without any express or implied warranty in no event will the authors", 85, 0.85),
    ("non-commercial", ("commercial",), "(?:for )?non ?commercial (?:use|purposes) only", 40, 0.6),
    ("no-derivatives", ("deriv",), "no deriv(?:ative|ed) works(?: are)? (?:allowed|permitted)", 40, 0.6),
    ("evaluation", ("evaluation",), "for evaluation purposes only", 40, 0.5),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    gate: tuple[str, ...]
    pattern: str
    priority: int
    confidence: float


def rules() -> list[Rule]:
    """All ordered rules: every name in every phrase, and the self-standing texts."""
    built = [
        Rule(
            f"{label}:{phrase}",
            label,
            (*words, " " + re.match("[a-z0-9]+", short)[0] if "{short}" in text else keyword),
            text.format(title=title, short=short),
            priority,
            sure,
        )
        for phrase, words, text, priority, sure in PHRASES
        for label, keyword, title, short in NAMES
        # Behind "or" and "and", names of one everyday word say nothing.
        if not (phrase == "operand" and re.fullmatch("[a-z0-9]+", short))
    ]
    built += [Rule(f"{label}:listed{i}", label, *rule) for i, (label, *rule) in enumerate(LISTED)]
    built += [Rule(f"{label}:text", label, gate, text, priority, sure) for label, gate, text, priority, sure in TEXTS]
    return sorted(built, key=lambda r: -r.priority)


@lru_cache(maxsize=1)
def _compiled():
    """Rules by gate, so that a missing keyword skips all rules behind it."""
    gated: dict[tuple[bytes, ...], list] = {}
    for i, r in enumerate(rules()):
        gate = tuple(k.encode() for k in r.gate)
        gated.setdefault(gate, []).append((i, r, re.compile(rb"(?<= )(?:" + r.pattern.encode() + rb")(?= )")))
    return list(gated.items())


def detect(text: bytes) -> tuple[int, list[tuple]]:
    """Word count and detections (rule, label, base, first word, end word, confidence) by position."""
    words = text.translate(ALNUM).split()
    line = b" " + b" ".join(words) + b" "
    base = []
    for phrase, label in BASE:
        needle = b" " + phrase.encode() + b" "
        at = line.find(needle)
        while at >= 0:
            base.append((at + 1, at + len(needle) - 1, label))
            at = line.find(needle, at + 1)
    hits = []
    present: dict[bytes, bool] = {}
    for gate, members in _compiled():
        for k in gate:
            if k not in present:
                present[k] = k in line
            if not present[k]:
                break
        else:
            for i, r, pattern in members:
                hits += [(m.start(), m.end(), r.priority, i, r) for m in pattern.finditer(line)]
    found = [(a, b, "base:" + label, label, True, BASE_CONFIDENCE) for a, b, label in base]
    found += [(a, b, r.name, r.label, False, r.confidence) for a, b, r in _outermost(hits)]
    found.sort(key=lambda d: (d[0], d[1], d[2]))
    out, at, word = [], 0, -1  # a word starts behind each blank
    for a, b, rule, label, is_base, sure in found:
        word += line.count(b" ", at, a)
        at = a
        out.append((rule, label, is_base, word, word + line.count(b" ", a, b) + 1, sure))
    return len(words), out


def _outermost(hits: list[tuple]) -> list[tuple]:
    """Hits not inside another one of the same or higher priority."""
    kept, reach = [], {}
    for a, b, priority, i, r in sorted(hits, key=lambda h: (h[0], -h[1], -h[2], h[3])):
        if all(end < b for p, end in reach.items() if p >= priority):
            kept.append((a, b, r))
            reach[priority] = max(b, reach.get(priority, 0))
    return kept


SCHEMA = (
    "n_words bigint, detections array<struct<rule: string, label: string, base: boolean, "
    "first_word: bigint, end_word: bigint, confidence: double>>"
)
_DETECTIONS = pa.list_(
    pa.struct(
        [("rule", pa.string()), ("label", pa.string()), ("base", pa.bool_())]
        + [("first_word", pa.int64()), ("end_word", pa.int64()), ("confidence", pa.float64())]
    )
)


def _scan(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _DETECTIONS.value_type]
    for batch in batches:
        n_words, found = [], []
        for raw in batch.column(1).cast(pa.binary()).to_pylist():
            n, hits = detect(raw or b"")
            n_words.append(n)
            found.append([dict(zip(names, h, strict=True)) for h in hits])
        columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(found, _DETECTIONS)]
        yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "detections"])


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, detections) of every document."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(lambda batches: _scan(batches, key), f"`{key}` {kind}, {SCHEMA}")
