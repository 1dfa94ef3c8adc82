import random
import re

from lendwatch.llm import license_scan as L

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(df):
    want = sorted(((r.doc_id, *brute(r.text)) for r in df.select("doc_id", "text").collect()), key=str)
    rows = L.scan_licenses(df).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    assert got == want
    for r in rows:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_small_table(all_docs):
    check(all_docs)


def test_random_texts(docs_of):
    rng = random.Random(5)
    parts = ["CC", "by", "cc by", "General Public", "license", "all rights", "Reserved", "é", "-", "  ", "\n", "x\x00y", "ALL", "ß9"]
    texts = [rng.choice([" ", "-", ""]).join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", " ", "cc by cc by cc by", "cc by " * 20_000, "a" * 200_000]
    check(docs_of(texts).selectExpr("*", "1 as labels", "2 as score"))
    assert L.scan_licenses(docs_of([])).collect() == []


def labels(text):
    return L.scan_text(text)[5]


def test_rules_resolve_overlaps():
    assert len(L.rules()) > 200
    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by,cc-by-nc-4.0"
    assert labels("under the GNU General Public License, version 3.") == "gpl,gpl-3.0"
    assert labels("GNU General Public License version 2 or any later version") == "gpl,gpl-2.0-or-later"
    assert labels("GNU Lesser General Public License v2.1") == "gpl,lgpl-2.1"
    assert labels("Licensed under the Apache License, Version 2.0.") == "apache-2.0"
    assert labels("Released under the MIT License.") == "mit"
    assert labels("All rights reserved.") == "reserved"
    assert labels("SPDX-License-Identifier: GPL-2.0-or-later") == "gpl-2.0-or-later"
    assert labels("the general idea of a public park, mit freundlichen Grüßen") == ""


def test_prefilter_loses_nothing():
    texts = ["Creative Commons Attribution NonCommercial 4.0", "BSD 3-Clause License", "Mozilla Public License 2.0", "SIL Open Font License 1.1"]
    for text in texts:
        normal, _ = L.normal_form(text)
        direct = {(m.start(), m.end(), r.label) for r in L.rules() for m in r.pattern.finditer(normal)}
        gated = {(m.start(), m.end(), r.label) for r in L.rules() if r.keyword in normal for m in r.pattern.finditer(normal)}
        assert direct == gated and direct


def test_containment_matches_quadratic_form():
    rng = random.Random(2)
    words = "gnu general public license version 3 or any later apache 2 cc by nc 4 0 all rights reserved mit under the".split()
    for _ in range(200):
        normal, _ = L.normal_form(" ".join(rng.choices(words, k=60)))
        found = sorted((-r.priority, m.start() + 1, -m.end(), i) for i, r in enumerate(L.rules()) for m in r.pattern.finditer(normal))
        kept = []
        for _, s, e, i in found:
            if not any(a <= s and -e <= b for a, b, _ in kept):
                kept.append((s, -e, i))
        want = sorted((s, e, L.rules()[i].label) for s, e, i in kept)
        assert sorted((s, e, r.label) for s, e, r in L.detections(normal)) == want
