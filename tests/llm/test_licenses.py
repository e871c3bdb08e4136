import re

import pytest

from millrace.llm.licenses import BASE, _compiled, _outermost, detect, rules, scan_licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    """Every rule tried on every text, with quadratic suppression."""
    line = " " + " ".join(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) + " "
    hits = []
    for i, r in enumerate(rules()):
        if all(k in line for k in r.gate):
            hits += [(m.start(), m.end(), r.priority, i, r.label) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line)]
    kept = set()
    for h in hits:
        inside = [o for o in hits if o is not h and o[0] <= h[0] and h[1] <= o[1] and o[2] >= h[2]]
        if not any(o[:2] != h[:2] or o[2] > h[2] or o[3] < h[3] for o in inside):
            kept.add(h)
    return sorted((line.count(" ", 0, a) - 1, line.count(" ", 0, b) - 1 + 1, label) for a, b, _, _, label in kept)


TEXTS = [
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "under the MIT license, under the mit license under The MIT-License",
    "SPDX-License-Identifier: GPL-2.0-or-later AND CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 3 or any later version. All rights reserved.",
    "Licensed under CC BY-NC 4.0. Dedicated to the public domain, distributed under the terms of the Mozilla Public License 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy; BSD-3-Clause; 3-clause BSD license",
    "ich bin mit dir under the bridge", "", None, "ÄPACHE license version 2", "apache license version 2 apache license version 2",
]


@pytest.mark.parametrize("text", TEXTS)
def test_gates_and_suppression_change_nothing(text):
    found = [(d[3], d[4], d[1]) for d in detect((text or "").encode())[1] if not d[2]]
    assert sorted(found) == plain(text)


@pytest.mark.parametrize("text", TEXTS)
def test_base_places(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    n, hits = detect((text or "").encode())
    assert n == len(words)
    places = [(i, label) for phrase, label in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    assert sorted((d[3], d[1]) for d in hits if d[2]) == sorted(places)


def test_rules_are_many_ordered_and_gated_rightly():
    ordered = rules()
    assert len(ordered) > 300 and [r.priority for r in ordered] == sorted((r.priority for r in ordered), reverse=True)
    assert len({r.name for r in ordered}) == len(ordered) or len(_compiled()) < len(ordered)


def test_containment():
    a, b, c = ("wide", "inner", "late")
    hits = [(0, 10, 50, 0, a), (2, 5, 50, 1, b), (2, 5, 60, 2, b), (8, 15, 10, 3, c)]
    assert [(h[0], h[1], h[2]) for h in _outermost(hits)] == [(0, 10, a), (2, 5, b), (8, 15, c)]


def test_table_form(docs):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (0, TEXTS[0])]
    got = scan_licenses(docs(rows, 3, ["n_words", "detections"])).collect()
    assert len(got) == len(rows)
    assert all(len(r["detections"]) == len(detect((dict(rows)[r["doc_id"]] or "").encode())[1]) for r in got)
    assert scan_licenses(docs([], 1)).collect() == []


def test_many_detections_in_a_long_text():
    n, hits = detect(b"Released under the MIT License. " * 5000)
    assert n == 25000 and sum(d[2] for d in hits) == 5000


DECLARED = {
    "License: MIT": {"mit"},
    "License: Apache-2.0": {"apache-2"},
    "It is GPLv3 code": {"gpl-3"},
    "licensed under the GPL v3": {"gpl-3"},
    "Apache License v2.0": {"apache-2"},
    "distributed under the terms of the GPL": {"gpl"},
    "This package is MIT licensed": {"mit"},
    "BSD-3-Clause": {"bsd-3"},
    "LGPL-2.1-or-later": {"lgpl-2"},
    "SPDX-License-Identifier: (MIT OR Apache-2.0)": {"mit", "apache-2"},
    "SPDX-License-Identifier: Apache-2.0 OR MIT": {"mit", "apache-2"},
    "SPDX-License-Identifier: GPL-2.0-only AND BSD-2-Clause AND CC-BY-4.0": {"gpl-2", "bsd-2", "cc-by"},
    "See https://opensource.org/licenses/MIT": {"mit"},
    "http://creativecommons.org/licenses/by-nc-sa/4.0/": {"cc-by-nc-sa"},
    "license: CC-BY-NC-ND 4.0": {"cc-by-nc-nd", "cc-by-nc"},  # the base phrase stands, too
    "lgplv3, agpl-3.0": {"lgpl-3", "agpl-3"},
    "Neither the name of the University of Nowhere nor the names of its contributors may be used to endorse or promote products": {"bsd-3"},
}


@pytest.mark.parametrize("text", DECLARED)
def test_common_declarations(text):
    assert {d[1] for d in detect(text.encode())[1]} == DECLARED[text]
    found = [(d[3], d[4], d[1]) for d in detect(text.encode())[1] if not d[2]]
    assert sorted(found) == plain(text)


HARMLESS = [
    "Ich komme mit dir oder mit ihr, und die Lizenz mit der Nummer", "The driver's license with a photo", "a ruby ring, vim and vigour",
    "The apache tribe settled near the river", "She took an artistic approach in 2 or 3 steps", "python snakes and boosts of energy",
    "the public was in a good mood", "eclipse of the sun in version 2", "general knowledge, lesser known facts", "license plates and licences",
    "le permis de conduire", "no one knows the creative commons", "distributed systems under load", "I see it as is",
]


@pytest.mark.parametrize("text", HARMLESS)
def test_harmless_texts_stay_clean(text):
    assert detect(text.encode())[1] == []


def test_rules_of_each_kind():
    from millrace.llm.license_rules import LISTED

    names = [r.name for r in rules()]
    listed = sum(":listed" in n or n.endswith(":text") for n in names)
    assert listed == len(LISTED) + 12 and listed > 180
    assert len({(label, pattern) for label, _, pattern, *_ in LISTED}) == len(LISTED)
