"""The license scan against plain searches without gate and sweep."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weekloom.llm import license_rules, licenses

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    words = WORD.findall(lowered(text))
    out = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(out)


def found(text):
    """All rules, no gate; every detection against every other."""
    raw = lowered(text).encode()
    every = [
        d for r in licenses.rules() if r.kind != "base" for d in licenses.occurrences(r, raw)
    ]

    def beats(a, b):
        inside = a.start <= b.start and b.end <= a.end
        if not inside or a is b or a.rule.priority < b.rule.priority:
            return False
        same = (a.start, a.end, a.rule.priority) == (b.start, b.end, b.rule.priority)
        return not same or a.rule.order < b.rule.order

    return sorted(
        (d.label, d.rule.kind, raw[d.start : d.end].decode(errors="replace"))
        for d in every
        if not any(beats(o, d) for o in every)
    )


def snippets():
    return [
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "Released under the MIT License.",
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU Lesser General Public License v2.1", "Licensed under CC BY-NC 4.0.",
        "https://creativecommons.org/licenses/by-nc-sa/4.0/", "new BSD license",
        " * GNU General\n * Public\n * License", "apache---license", "xmit license", "mit licenses",
        "GNU Affero General Public License version 3", "Dual-licensed: MIT License / Apache License",
        "public domain", "cc  by", "CC-BY", "ccby", "gnu general public", "Mozilla Public License, v. 2.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Copyright (c) 2001 Somebody Ltd. All rights reserved", "© été mit license ß",
        "mit " * 30 + "license", "apache" + " " * 500 + "license",
    ]


def corpus():
    rng = random.Random(8)
    filler = "the and license public general été by mit cc apache version 2 0 of".split()
    docs = []
    for i in range(120):
        words = [rng.choice(filler) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(snippets()))
        docs.append((i, rng.choice([" ", "\n", ", "]).join(words)))
    docs += list(enumerate(snippets(), 500))
    docs += [(900, None), (901, ""), (902, "\n\t -"), (903, "a" * 300_000)]
    return [*docs, docs[3], docs[3], (None, docs[4][1])]


def test_against_plain_searches(spark):
    docs = corpus()
    rows = [(*d, 1, "x") for d in docs]
    df = spark.createDataFrame(rows, SCHEMA + ", n_words int, TEXT string").repartition(5)
    got = licenses.scan(df).collect()
    key = lambda r: (str(r[0]), repr(r[1:]))
    have = [
        (
            r.doc_id, r.n_words, sorted((d["first"], d["label"]) for d in r.base),
            sorted((d["label"], d["kind"], d["text"]) for d in r.found),
        )
        for r in got
    ]
    want = [(i, *base(t), found(t)) for i, t in docs]
    assert sorted(have, key=key) == sorted(want, key=key)
    assert all((r.score > 0) == bool(r.base or r.found) and 0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
        ("GNU Lesser General Public License, version 2.1", {"lgpl-2.1"}),
        ("the GNU General Public License", {"gpl"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("SPDX-License-Identifier: MIT", {"mit"}),
        ("see https://www.gnu.org/licenses/old-licenses/gpl-2.0.html", {"gpl-2.0"}),
        ("Released under the MIT License. Docs: CC-BY-SA 3.0", {"mit", "cc-by-sa-3.0"}),
        ("GPLv3", {"gpl-3.0"}),
        ("the license of the library", set()),
        ("I admit licensees came by", set()),
    ],
)
def test_labels_after_suppression(text, labels):
    kept = licenses.unsuppressed(
        [d for d in licenses.detected(lowered(text).encode()) if d.rule.kind != "base"]
    )
    assert {d.label for d in kept} == labels


def test_there_are_hundreds_of_rules_of_their_own():
    written = [line for line in licenses.lines() if line[0] not in ("identifier", "base")]
    assert len(written) > 250
    assert len({(k, p) for k, _, _, p in written}) == len(written)
    assert all(label.count("*") == ("(?P<v>" in p) for _, label, _, p in licenses.lines())
    assert {k for k, *_ in written} < set(license_rules.KINDS)


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_keywords_are_part_of_every_match(data):
    rule = data.draw(st.sampled_from(licenses.rules()))
    match = data.draw(st.from_regex(rule.pattern, fullmatch=True))
    assert rule.keyword.search(match)
    assert re.search(licenses.gate(), match.decode("latin-1"))


def test_dense_texts_are_linear(spark):
    text = "MIT License, Apache License 2.0; " * 40_000
    row = licenses.scan(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert len(row.base) == 80_000 and len(row.found) == 80_000
    assert row.base[-1]["first"] == row.n_words - 4


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []
