import re

from tests.llm import odd
from tidewater.llm import licenses
from tidewater.llm.license_rules import KEYWORDS, RULES, gates

PATTERNS = [(r, re.compile(r.pattern.replace(r"\x{A9}", "\xa9").replace(r"\x{E9}", "\xe9"), re.I | re.A)) for r in RULES]


def plain(text):
    return re.sub(r"[-\s]+", " ", text.lower())


def detections(text):
    """Surviving (start, end, label) by comparing every two matches."""
    found = []
    if any(g in plain(text) for g in gates()):
        for i, (rule, pattern) in enumerate(PATTERNS):
            if rule.keyword in plain(text):
                found += [(m.start(), m.end(), rule.priority, -i, rule) for m in pattern.finditer(text)]

    def beaten(a, b):
        inside = b[0] <= a[0] and b[1] >= a[1]
        return inside and (b[2] > a[2] or b[2] == a[2] and ((b[0], b[1]) != (a[0], a[1]) or b[3] > a[3]))

    return sorted((a[0], a[1], a[4].label) for a in found if not any(beaten(a, b) for b in found if b is not a))


def base(text):
    words = odd.PLAIN_WORD.findall(odd.lower(text))
    places = {}
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places.update({i: label for i in range(len(words)) if words[i:i + len(p)] == p})
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(set(places.values())))


def check(rows, texts):
    assert len(rows) == len(texts)
    want = {}
    for d, t in texts:
        n = base(t)
        labels = set(n[4].split(",")) - {""} | {x[2] for x in detections(t or "")}
        want.setdefault(d, []).append((*n, ",".join(sorted(labels))))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    assert {d: sorted(v, key=str) for d, v in got.items()} == {d: sorted(v, key=str) for d, v in want.items()}


TEXTS = [
    (100, "SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0"),
    (101, "Released under the MIT License. See https://opensource.org/licenses/MIT"),
    (102, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
          "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    (103, "Permission is\nhereby granted, free of charge, to any person obtaining a copy"),
    (104, "CC BY-NC 4.0 and cc-by-sa and Creative Commons Attribution-NonCommercial"),
    (105, "(c) 2020 Acme. Tous droits réservés. Proprietary and confidential."),
    (106, "All rights reserved. " * 400),
    (107, "allrights reserved, all rights reservedly, ccby, cc_by, écc by, cc by é"),
    (108, "permit the mitre to license nothing"),
]


def test_scan_equals_brute_force(spark):
    rows = [(d, t, "en", "s") for d, t in TEXTS] + odd.DOCS
    got = licenses.scan(odd.documents(spark, rows)).collect()
    check(got, [(d, t) for d, t, _, _ in rows])
    by = {r.doc_id: [(s.start, s.end, s.label) for s in r.detections or []] for r in got}
    for d, t in TEXTS:
        assert by[d] == detections(t), d


def test_ids_may_repeat_with_other_texts(spark):
    rows = [(1, "MIT License", "en", "s"), (1, "BSD license", "en", "s"), (1, "MIT License", "en", "s"), (None, "MIT License", "en", "s")]
    check(licenses.scan(odd.documents(spark, rows)).collect(), [(d, t) for d, t, _, _ in rows])


def test_empty_table(spark):
    assert licenses.scan(odd.documents(spark, [])).count() == 0


def test_rules_are_well_formed():
    assert len(RULES) > 300 and len({r.id for r in RULES}) == len(RULES)
    for rule, pattern in PATTERNS:
        assert 1 <= rule.priority <= 5 and 0 < rule.score <= 1 and rule.keyword in KEYWORDS
        assert not pattern.search("")
        assert any(g in rule.keyword for g in gates()) or "licen" in rule.pattern, rule
