"""License scan: ordered signature rules over the words of whole texts.

A text becomes its words, lower-cased and joined by single blanks. Rules are regular expressions
over that form; a rule runs only where its keyword occurs. Detections are then resolved in order
of priority: one whose interval lies inside the interval of a detection kept before it is dropped.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the contract: words are runs of digits, a-z and everything beyond ASCII.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in _LOWER)
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, evidence string"
)


class Rule(NamedTuple):
    """``priority``: higher is resolved first. ``weight``: belief that the text is so licensed."""

    label: str
    keyword: bytes
    pattern: re.Pattern
    priority: int
    weight: float


def _version(text: str) -> str:
    """``3.0`` as words, with an optional zero behind: ``3``, ``3 0``, ``v3``, ``version 3 0``."""
    major, _, minor = text.partition(".")
    tail = f" {minor}" if minor not in ("", "0") else "( 0)?"
    return rf"(v|version |v )?{major}{tail}"


def _families() -> Iterator[tuple[str, str, str, int, float]]:
    """(label, keyword, pattern, priority, weight), grouped by family."""
    grants = r"(licensed under|released under|distributed under|available under|under)( the)?( terms of)?( the)?"
    # Creative Commons: condition sets by version, in short and in full.
    full = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?derivatives?( works)?", "sa": "share ?alike"}
    for parts in ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa"):
        label = "cc-" + parts.replace(" ", "-")
        words = " ".join(full[p] for p in parts.split())
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            for opening in ("cc", "creative commons"):
                yield f"{label}-{version}", f"{opening} {parts}", f"{opening} {parts} {_version(version)}( international| unported)?", 70 + len(parts), 0.97
            yield f"{label}-{version}", "creative commons", f"creative commons {words} {_version(version)}( international| unported)?", 70 + len(parts), 0.97
        yield label, f"cc {parts}", f"cc {parts}", 40 + len(parts), 0.8
        yield label, "creative commons", f"creative commons {words}", 40 + len(parts), 0.85
    for form in ("cc0", "cc zero", "creative commons zero", "cc0 1 0( universal)?"):
        yield "cc0-1.0", form.split(" ")[0].split("(")[0], form, 60, 0.95
    # GNU: three licenses, versions, with and without "or later".
    for label, name in (("gpl", "general"), ("lgpl", "lesser general"), ("agpl", "affero general")):
        long = f"(gnu )?{name} public licen[cs]e"
        for version in {"gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("1.0", "3.0")}[label]:
            for later, ending, more in (("-or-later", r" (or|and)( at your option)? (any )?later( versions?)?", 5), ("-only", " only", 4), ("", "", 0)):
                yield f"{label}-{version}{later}", "public licen", f"{long} {_version(version)}{ending}", 70 + more, 0.97
                yield f"{label}-{version}{later}", label, f"(gnu )?{label} ?{_version(version)}{ending}", 70 + more, 0.95
        yield label, "public licen", long, 40, 0.85
        yield label, label, f"(gnu {label}|{label} (licen[cs]ed?|notice))", 35, 0.7
    # Named licenses with versions: (label, keyword, name, versions).
    named = (
        ("apache", "apache", "apache( software)?", ("1.0", "1.1", "2.0")),
        ("mpl", "mozilla public", "mozilla public", ("1.0", "1.1", "2.0")),
        ("epl", "eclipse public", "eclipse public", ("1.0", "2.0")),
        ("eupl", "european union", "european union public", ("1.0", "1.1", "1.2")),
        ("cddl", "development and", "common development and distribution", ("1.0", "1.1")),
        ("cpl", "common public", "common public", ("1.0",)),
        ("artistic", "artistic licen", "artistic", ("1.0", "2.0")),
        ("osl", "open software", "open software", ("1.0", "2.0", "2.1", "3.0")),
        ("afl", "academic free", "academic free", ("1.1", "1.2", "2.0", "2.1", "3.0")),
        ("bsl", "boost software", "boost software", ("1.0",)),
        ("python", "python software", "python software foundation", ("2.0",)),
        ("ofl", "open font", "(sil )?open font", ("1.0", "1.1")),
        ("odbl", "database licen", "open (data commons open )?database", ("1.0",)),
        ("php", "php licen", "php", ("3.0", "3.01")),
        ("ms-pl", "microsoft public", "microsoft public", ()),
        ("ncsa", "ncsa open source", "university of illinois ncsa open source", ()),
        ("openssl", "openssl licen", "openssl", ()),
        ("zlib", "zlib licen", "zlib", ()),
        ("isc", "isc licen", "isc", ()),
        ("mit", "mit licen", "mit", ()),
        ("postgresql", "postgresql licen", "postgresql", ()),
        ("ruby", "ruby licen", "ruby", ()),
        ("vim", "vim licen", "vim", ()),
        ("w3c", "w3c software licen", "w3c software", ()),
    )
    for label, key, name, versions in named:
        for version in versions:
            yield f"{label}-{version}", key, f"({grants} )?{name} licen[cs]e {_version(version)}", 70, 0.97
            yield f"{label}-{version}", label, f"{label} {_version(version)} licen[cs]ed?", 65, 0.9
        yield label, key, f"{name} licen[cs]e", 45, 0.9
        yield label, key, f"{grants} {name} licen[cs]e", 46, 0.9
    for clauses, word in ((0, "zero"), (2, "two"), (3, "three"), (4, "four")):
        yield f"bsd-{clauses}-clause", "bsd", f"(bsd ({clauses}|{word}) clause|({clauses}|{word}) clause bsd)( licen[cs]e)?", 70, 0.95
    for words, label in (("simplified", 2), ("freebsd", 2), ("new", 3), ("revised", 3), ("modified", 3), ("original", 4)):
        yield f"bsd-{label}-clause", "bsd", f"{words} bsd licen[cs]e", 68, 0.9
    yield "bsd", "bsd", "bsd licen[cs]e", 45, 0.85
    # Texts of licenses, by sentences that belong to one license only.
    texts = (
        ("mit", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        ("mit", "noninfringement", "merchantability fitness for a particular purpose and noninfringement"),
        ("isc", "distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
        ("bsd-3-clause", "endorse", "neither the name of .{1,80} nor the names of its contributors may be used to endorse"),
        ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
        ("apache-2.0", "apache org", "www apache org licenses license 2 0"), ("gpl", "gnu org", "www gnu org licenses"),
        ("mpl-2.0", "mozilla org", "mozilla org mpl 2 0"), ("bsl-1.0", "boost org", "www boost org license 1 0"),
        ("zlib", "altered source", "altered source versions must be plainly marked as such"),
        ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
        ("unlicense", "unlicense", "(the )?unlicense( org)?"), ("public-domain", "public domain", "(in|into|to) the public domain"),
        ("proprietary", "confidential", "(proprietary and confidential|confidential and proprietary)"),
        ("proprietary", "prohibited", "(unauthori[sz]ed|any) (copying|reproduction|use|distribution).{0,80} (is )?strictly prohibited"),
        ("proprietary", "permission of", "without (the )?(prior )?(express )?(written )?permission of the (author|owner|publisher)"),
        ("reserved", "rights reserved", "(all|some) rights reserved"), ("copyright-notice", " copyright ", "copyright (c )?(19|20)[0-9]{2}"),
        ("terms-of-use", "terms of", "terms of (use|service)"), ("license-mention", "licen", "(open source|free software) licen[cs]e"),
    )
    for label, key, pattern in texts:
        yield label, key, pattern, 55 if label not in ("license-mention", "terms-of-use", "copyright-notice") else 10, 0.9 if len(pattern) > 30 else 0.6
    # Machine-readable tags.
    for name in ("mit", "isc", "zlib", "unlicense", "0bsd", "wtfpl", "ncsa", "postgresql", "openssl", "ruby", "vim"):
        yield name, "spdx", f"spdx license identifier {name}", 90, 0.99
    tags = {"apache": ("1.0", "1.1", "2.0"), "gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("1.0", "3.0"), "mpl": ("1.0", "1.1", "2.0"), "epl": ("1.0", "2.0"), "bsl": ("1.0",), "eupl": ("1.1", "1.2"), "cc0": ("1.0",), "cc by": ("3.0", "4.0"), "cc by sa": ("3.0", "4.0")}
    for name, versions in tags.items():
        for version in versions:
            for ending in ("", " only", " or later"):
                yield f"{name.replace(' ', '-')}-{version}{ending.replace(' ', '-')}", "spdx", f"spdx license identifier {name} {version.replace('.', ' ')}{ending}", 90 + len(ending), 0.99


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in the order in which their detections are resolved."""
    made = [
        Rule(label, key.encode(), re.compile(rb" (?:" + pattern.encode() + rb")(?= )"), priority, weight)
        for label, key, pattern, priority, weight in _families()
    ]
    return tuple(sorted(made, key=lambda r: (-r.priority, r.label, r.pattern.pattern)))


@cache
def keywords() -> dict[bytes, tuple[int, ...]]:
    by: dict[bytes, tuple[int, ...]] = {}
    for i, rule in enumerate(rules()):
        by[rule.keyword] = (*by.get(rule.keyword, ()), i)
    return by


def normal_form(text: str | None) -> tuple[bytes, int]:
    """Words joined by single blanks, with a blank at either end; and their number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_WORD).split()
    return b" " + b" ".join(words) + b" ", len(words)


def detections(normal: bytes) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) by start. Equal intervals keep the first in rule order."""
    wanted = sorted(i for key, at in keywords().items() if key in normal for i in at)
    found = []
    for i in wanted:
        rule = rules()[i]
        found += [(-rule.priority, m.start() + 1, -m.end(), i) for m in rule.pattern.finditer(normal)]
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []
    furthest: list[int] = []
    for _, start, end, i in sorted(found):
        at = bisect.bisect_right(starts, start)
        if at and furthest[at - 1] >= -end:
            continue  # some kept interval starts no later and ends no earlier
        kept.insert(at, (start, -end, rules()[i]))
        starts.insert(at, start)
        furthest.insert(at, max(-end, furthest[at - 1] if at else 0))
        for j in range(at + 1, len(furthest)):
            if furthest[j] >= -end:
                break
            furthest[j] = -end
    return kept


def base_places(normal: bytes) -> tuple[list[int], set[str]]:
    """First words of all places of the base phrases, and their labels."""
    places, labels = [], set()
    for phrase, label in BASE_PHRASES:
        needle = b" " + phrase.encode() + b" "
        at = word = last = 0
        while (at := normal.find(needle, at)) >= 0:
            word += normal.count(b" ", last, at)
            last = at
            places.append(word)
            labels.add(label)
            at += 1
    return places, labels


def scan_text(text: str | None) -> tuple:
    normal, n_words = normal_form(text)
    places, base = base_places(normal)
    kept = detections(normal)
    doubt = 1.0
    for _, _, rule in kept:
        doubt *= 1.0 - rule.weight
    if base and not kept:
        doubt = 0.5
    labels = base | {rule.label for _, _, rule in kept}
    evidence = ";".join(f"{r.label}:{normal[s:e].decode('utf-8', 'replace')}" for s, e, r in kept)
    return (
        n_words, len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 - doubt, evidence,
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels, score and evidence.

    A NULL or empty text has no words, labels or evidence and score 0. Rows that repeat an id are
    scanned one by one. Nothing is shuffled; the texts of one Arrow batch are all a task holds.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            rows = [scan_text(t.as_py()) for t in batch.column(1)]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds[1:]]
            arrays = [batch.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)
