import random
import time
import tracemalloc

import numpy as np
import pytest

from lendwatch.llm import bloom
from lendwatch.llm import kept
from lendwatch.llm import near_dup as N

CFG = N.SketchConfig()


def brute(rows):
    """(doc_id, size, component, kept) by comparing all pairs of word sets."""
    def shingles(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = low.encode().split()
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)):
                near[i].append(j)
                near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = None if rows[i][0] is None else min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(sets[i]), low, low == rows[i][0]))
    return sorted(out, key=str)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, groups=25):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(3, 260))]
        texts += [edited(rng, base, rng.randint(0, 4)) for _ in range(rng.randint(1, 9))]
        texts.append(" ".join(base).upper())
    texts += [None, "", "  \n", "one two", "One\ttwo ", "é ß", "a b c d e", "a b c d e"]
    rng.shuffle(texts)
    return texts


def got(df, cfg=CFG):
    return sorted((tuple(r) for r in N.cluster(df, cfg).collect()), key=str)


def test_against_all_pairs(docs_of):
    rows = list(enumerate(corpus(1))) + [(3, "one two"), (None, "one two"), (9, None)]
    assert got(docs_of(rows).selectExpr("*", "1 as kept", "2 as rep", "3 as block")) == brute(rows)
    assert got(docs_of([])) == []


def test_components_larger_than_a_block(docs_of):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    texts = [edited(rng, base, rng.randint(0, 6)) for _ in range(120)] + corpus(2, 5)
    rows = list(enumerate(texts))
    small = N.SketchConfig(block_shingles=4000)
    assert got(docs_of(rows), small) == brute(rows)


def test_kept_documents(docs_of):
    df = docs_of([(5, "a b c d e f"), (2, "A b c d e f"), (7, "other"), (None, "x"), (8, None)])
    assert sorted(str(r.doc_id) for r in N.without_copies(df).collect()) == ["2", "7", "8", "None"]


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, size=4000, dtype=np.uint64)
    a, b = np.unique(pool[:2400]), np.unique(pool[400:2600])
    both = N.sketch(np.unique(pool[:2600]), CFG)
    assert (np.maximum(N.sketch(a, CFG), N.sketch(b, CFG)) == both).all()
    true = 2000 / 2600
    wide = N.SketchConfig(bands=600)
    x, y = N.sketch(a, wide), N.sketch(b, wide)
    counts = np.array([[(x > y).sum()], [(x < y).sum()], [(x == y).sum()]])
    grid = np.linspace(0, 0.9, 181)
    best = grid[np.argmax([N.log_likelihood(counts, np.array([2400 / 4600]), np.array([g]), wide.base)[0] for g in grid])]
    assert best == pytest.approx(true, abs=0.03)
    pair = N.may_reach(x, np.stack([x, y, N.sketch(np.unique(pool[3000:]), wide)]), 2400, np.array([2400, 2200, 1000]), wide)
    assert pair.tolist() == [True, False, False]


def test_many_near_copies_below_the_threshold():
    """They share bands but no link: all pairs are compared, in bounded memory and without a list of pairs."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    texts = [edited(rng, base, 4) for _ in range(2000)] + [" ".join(base)] * 2
    sets = [N.shingle_set(t, 5) for t in texts]
    registers = np.stack([N.sketch(s, CFG) for s in sets])
    tracemalloc.start()
    begin = time.process_time()
    links = N.links_of(sets, registers, np.zeros(len(sets), bool), CFG)
    assert time.process_time() - begin < 60 and tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    words = [set(s.tolist()) for s in sets]
    for i, j in links:
        both = len(words[i] & words[j])
        assert 100 * both >= 85 * (len(words[i]) + len(words[j]) - both)
    # The same components as by all pairs that share a band.
    assert components(len(sets), links) == components(len(sets), [
        (i, j) for i in range(len(sets)) for j in range(i) if 100 * (b := len(words[i] & words[j])) >= 85 * (len(words[i]) + len(words[j]) - b)])


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_a_very_long_text(docs_of):
    rng = random.Random(11)
    words = [f"w{rng.randrange(10**6)}" for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, edited(rng, words, 1000)), (3, " ".join(words[:100_000])), (4, "short text of five words")]
    got_ = {r.doc_id: (r.n_shingles, r.component_id) for r in N.cluster(docs_of(rows)).collect()}
    assert got_[1][1] == got_[2][1] == 1 and got_[3][1] == 3 and got_[1][0] > 149_000


@pytest.mark.parametrize("largest", [1 << 27, 1 << 10])
def test_narrowed_rows_hold_all_wanted(spark, monkeypatch, largest):
    monkeypatch.setattr(bloom, "_LARGEST", largest)
    rows = spark.range(20_000).selectExpr("id as rep", "repeat('x', 10) as text").unionByName(spark.sql("select cast(null as bigint) rep, 'n' text"))
    ids = rows.filter("rep % 100 = 7")
    found = {r.rep for r in bloom.narrowed(rows, ids, "rep").collect()}
    assert set(range(7, 20_000, 100)) <= found and None not in found
    assert len(found) < 600 or largest == 1 << 10
    assert bloom.narrowed(rows, ids.limit(0), "rep").count() == 0


def test_likelihood_finds_its_maximum():
    rng = np.random.default_rng(3)
    for n_one, n_two, both in ((1000, 1000, 850), (500, 580, 420), (90, 100, 80), (300, 300, 150), (40, 44, 40)):
        pool = rng.integers(0, 1 << 63, size=n_one + n_two - both, dtype=np.uint64)
        a, b = N.sketch(pool[:n_one], CFG), N.sketch(pool[n_one - both :], CFG)
        counts = np.array([[(a > b).sum()], [(a < b).sum()], [(a == b).sum()]], float)
        share, least = np.array([n_one / (n_one + n_two)]), CFG.share / 100
        grid = np.linspace(0, min(n_one, n_two) / max(n_one, n_two), 2001)
        values = [N.log_likelihood(counts, share, np.array([g]), CFG.base)[0] for g in grid]
        wanted = N.log_likelihood(counts, share, np.array([least]), CFG.base)[0]
        hopeless = grid[int(np.argmax(values))] < least and 2 * (max(values) - wanted) >= CFG.reject
        assert N.may_reach(a, b[None], n_one, np.array([n_two]), CFG).tolist() == [not hopeless]


def test_workers_let_go_what_another_operator_kept(monkeypatch):
    """A worker that scored texts before does not hold the index beside the texts it compares."""
    class Captured:
        def __getattr__(self, name):
            return lambda *a: a[0] if name in ("mapInArrow", "applyInPandas") else self

    rows = N.pd.DataFrame({"rep": [1, 2], "joined": False, "text": ["a b c d e f", "a b c d e f g"], "block": 1})
    for step, given in ((N._sign, iter([])), (N._bands, iter([])), (N._verified, rows)):
        monkeypatch.setattr(kept, "_kept", {})
        kept.kept_by("toxicity")["index"] = object()
        assert kept.kept_by("toxicity")
        list(step(Captured(), CFG)(given))
        assert "toxicity" not in kept._kept


def test_texts_go_to_workers_in_small_batches(spark, docs_of):
    spark.conf.unset(kept._BATCH)
    docs = docs_of([f"text number {i} of many" for i in range(3000)], 1)
    N.cluster(docs)
    sizes = docs.select("doc_id").mapInArrow(lambda batches: (b.slice(0, 1) if b.num_rows <= 1024 else b for b in batches), "doc_id long")
    assert sizes.count() == 3
    spark.conf.set(kept._BATCH, 100)
    N.cluster(docs)
    assert spark.conf.get(kept._BATCH) == "100"  # a smaller setting stays
    spark.conf.unset(kept._BATCH)
