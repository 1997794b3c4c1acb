import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_documents import ODD, documents

from pathfold.llm import licenses
from pathfold.llm.queries import op9_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words(text)
    return sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


DOCS = ODD + [(20, "GNU General-Public\nLicense, gnu general public license"), (21, "mit license mit license apache license"), (22, "CC BY 4.0 cc-by-sa"),
              (23, "submit license"), (24, "Licensed under the Apache License, Version 2.0"), (25, "SPDX-License-Identifier: MIT"),
              (26, "Permission is hereby granted, free of charge, to any person obtaining a copy"), (27, "released under the terms of the BSD"),
              (28, "ünmit license émit license"), (29, "mit\x00license")]


def test_base_against_brute_force(spark):
    rows = licenses.scan(documents(spark, DOCS)).collect()
    assert sorted(((r.doc_id, r.n_words, [(p.word, p.label) for p in r.places]) for r in rows), key=str) == sorted(
        ((i, len(words(t)), base(t)) for i, t in DOCS), key=str)
    by = {r.doc_id: r for r in rows}
    labels = lambda i: {d.label for d in by[i].detections}
    assert labels(24) == {"apache"} and labels(25) == {"mit"} and labels(26) == {"mit"} and labels(27) == {"bsd"} and labels(23) == set()
    assert by[25].score == 1.0 and by[9].score == 0.0 and all(0 <= r.score <= 1 for r in rows)


def test_query_on_the_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op9_license_scan(spark, sf).collect():
        b = base(docs[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words(docs[r.doc_id])), len(b), b[0][0] if b else None, b[-1][0] if b else None)
        assert r.base_labels == ",".join(sorted({x for _, x in b}))
        assert {x for _, x in b} <= set(r.labels.split(","))


def test_contained_detections_go():
    found = licenses.Scanner().detect(b" see the license it is licensed under the gnu lesser general public license version 2 1 or so ")
    assert [label for *_, label, _ in found] == ["lgpl"]


def test_rules():
    order = licenses.rules()
    assert len(order) > 300 and [r.priority for r in order] == sorted(r.priority for r in order)
    assert all(re.search(rb"[a-z0-9]", r.keyword) for r in order)


@pytest.mark.parametrize("rule", licenses.TEXTS, ids=lambda r: r[2])
def test_a_rule_has_its_keyword(rule):
    assert rule[3] in rule[4].replace("licen[cs]e", "license")


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).count() == 0


def test_the_other_spelling_is_tried():
    assert licenses.Scanner().scan(b"This text is licenced under foo terms")[2:] == ([(14, 32, "unknown", 0.4)], 0.4)


def slow_detect(scanner, text):
    """Priority and containment by comparing everything with everything."""
    found = sorted((r.priority, m.start() - m.end(), m.start(), m.end(), r.label, r.weight)
                   for r in scanner.rules if r.keyword in text for m in r.pattern.finditer(text))
    kept = []
    for _, _, a, b, label, weight in found:
        if not any(x <= a and b <= y for x, y, *_ in kept):
            kept.append((a, b, label, weight))
    known = [x for x in kept if x[2] != "unknown"]
    return sorted(x for x in kept if x[2] != "unknown" or not any(a < x[1] and x[0] < b for a, b, *_ in known))


WORDS = "mit license gnu general public apache the under licensed version 2 0 cc by sa nc bsd 3 clause see terms of released spdx identifier x".split()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=60))
def test_priority_and_containment_against_brute_force(words):
    scanner = licenses.Scanner()
    text = " ".join(["", *words, ""]).encode()
    assert scanner.detect(text) == slow_detect(scanner, text)


def test_a_megabyte_of_licenses_takes_little_time():
    import time
    scanner, text = licenses.Scanner(), b"mit license " * 90_000
    began = time.process_time()
    n, places, found, score = scanner.scan(text)
    assert time.process_time() - began < 30
    assert n == 180_000 and [w for w, _ in places] == list(range(0, 180_000, 2)) and len(found) == 90_000


@pytest.mark.parametrize("label,text", [
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of it."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list"),
    ("bsd-4", "All advertising materials mentioning features or use of this software must display the following"),
    ("zlib", "The origin of this software must not be misrepresented;"), ("gpl", "You should have received a copy of the GNU General Public License along"),
    ("lgpl", "you should have received a copy of the GNU Lesser General Public License"), ("mpl", "If a copy of the MPL was not distributed with this file, You can"),
    ("epl", "made available under EPL-2.0"), ("eupl", "Licensed under the EUPL, Version 1.2"), ("perl", "under the same terms as Perl itself"),
    ("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1."), ("json", "The Software shall be used for Good, not Evil."),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"), ("cc-by-sa", "Creative Commons Attribution-ShareAlike 3.0 Unported"),
    ("odbl", "https://opendatacommons.org/licenses/odbl/"), ("ogl", "Open Government Licence v3.0"), ("bsl", "SPDX BUSL-1.1 applies"),
    ("commons-clause", "\"Commons Clause\" License Condition v1.0"), ("openrail", "the CreativeML OpenRAIL-M model"), ("ecl", "Educational Community License, Version 2.0"),
    ("beerware", "you can buy me a beer in return"), ("proprietary", "Unauthorized copying of this file, via any medium is strictly prohibited"),
    ("non-commercial", "for non-commercial use only"), ("vim", "There are no restrictions on distributing unmodified copies of Vim"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software")])
def test_wordings(label, text):
    _, _, found, score = licenses.Scanner().scan(text.encode())
    assert label in {x[2] for x in found} and score >= 0.4


def test_every_rule_has_its_keyword_and_leaves_prose_alone():
    scanner = licenses.Scanner()
    assert len(licenses.TEXTS) >= 140 and len(scanner.rules) == len(licenses.TEXTS) + len(licenses.NAMES) * len(licenses.FORMS)
    for _, _, label, keyword, pattern in licenses.TEXTS:
        plain = re.sub(r"licen\[cs\]e", keyword if keyword in ("license", "licence") else "license", pattern)
        assert keyword in plain, (label, keyword)
    prose = "It rained all day, and the free people of the common house read the open book under the old tree, as is their right.".encode()
    assert scanner.scan(prose)[2] == [] and scanner.scan(b"")[2] == []
    for rule in scanner.rules:
        assert not rule.pattern.search(b"  ")
