import re
from collections import defaultdict

import pytest

from lendwatch.llm import mixing as M


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), share=1.5, stop=2):
    """Excess above the stops reshared by weight until there is none."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, got, open_ = share * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    left = total
    while open_ and left > 1e-9:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if got[s] + unit * w[s] >= stop * sizes[s]}
        for s in open_ - full:
            got[s] += unit * w[s]
        for s in full:
            got[s] = stop * sizes[s]
        left, open_ = total - sum(got.values()), open_ - full
    return got


def check(df):
    rows = {(r.doc_id, r.text, r.source) for r in df.collect()}
    size_of = defaultdict(int)
    for r in df.collect():
        size_of[r.source] += words(r.text)
    wanted, taken = targets(size_of), defaultdict(int)
    out = M.mix(df).collect()
    assert len(out) == df.count() and {(r.doc_id, r.text, r.source) for r in out} == rows
    largest = defaultdict(int)
    for r in out:
        assert r.size == words(r.text) and r.source_size == size_of[r.source] and 0 <= r.copies <= 2
        assert r.target == pytest.approx(wanted[r.source], rel=1e-9, abs=1e-6)
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for s in wanted:
        assert abs(taken[s] - wanted[s]) <= max(0.02 * wanted[s], largest[s] / 2)
    return out


def test_small_table(all_docs):
    check(all_docs)


def test_edges(docs_of):
    rows = [(i, "w " * (i % 37), "ab"[i % 2]) for i in range(200)]
    rows += [(i, "x y\tz\n", None) for i in range(50)] + [(7, None, "é"), (7, None, "é"), (None, "one", "zz"), (8, "", "")]
    rows += [(9, "\x0b \x0c  a b ", "zz")]
    out = check(docs_of(rows))
    again = M.mix(docs_of(rows, parts=7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_hot_size_is_dealt_evenly(docs_of):
    out = M.mix(docs_of([(i, "one two three", "s") for i in range(300)] + [(900, "x " * 9, "t")])).collect()
    assert sum(r.copies for r in out if r.source == "s") in range(448, 450)  # (1.5 * 909 - 18) / 3


def test_empty_and_clashing(docs_of):
    assert M.mix(docs_of([])).collect() == []
    clash = docs_of(["a b", "c"]).selectExpr("*", "'x' as size", "9 as copies", "1 as src", "2 as tilt", "3 as d0")
    out = M.mix(clash).collect()
    assert sorted(r.size for r in out) == [1, 2] and out[0].src == 1 and out[0].d0 == 3
    copies = M.mixed_documents(docs_of(["a b", "c", None]))
    assert copies.columns == docs_of([]).columns


def test_plan_is_native(all_docs):
    assert "Python" not in M.mix_report(all_docs)._jdf.queryExecution().toString()
