import gc
import math
import random
import re
import weakref
import zlib
from collections import Counter

import numpy as np
import pytest

from lendwatch.llm import block_max as B
from lendwatch.llm import kept, packing, pieces
from lendwatch.llm import terms as H
from lendwatch.llm import toxicity as T
from lendwatch.llm.settings import PACKING, PIECE_MODEL


def vector(weights):
    terms = np.array(sorted(weights), np.int64)
    return terms, np.array([weights[t] for t in terms.tolist()], np.float32)


def index_of(vectors, block):
    pairs = [vector(v) for v in vectors]
    joined = [np.concatenate([p[i] for p in pairs] or [np.empty(0)]) for i in range(2)]
    return B.BlockMaxIndex(np.array([len(v) for v in vectors], int), joined[0].astype(int), joined[1], block)


def normal(weights):
    norm = math.sqrt(sum(w * w for w in weights.values())) or 1
    return {t: float(np.float32(w / norm)) for t, w in weights.items()}


def nearest(query, vectors, k, skip=-1):
    scores = ((sum(w * v.get(t, 0) for t, w in query.items()), i) for i, v in enumerate(vectors) if i != skip)
    return sorted(((round(s, 12), i) for s, i in scores if s > 0), key=lambda f: (-f[0], f[1]))[:k]


def same(got, want):
    return [i for _, i in got] == [i for _, i in want] and [s for s, _ in got] == pytest.approx([s for s, _ in want], abs=1e-11)


@pytest.mark.parametrize("dense, often, part", [(512, 16, 10**6), (3, 2, 50), (0, 1, 1)])
def test_index_is_exact(monkeypatch, dense, often, part):
    monkeypatch.setattr(B, "_PART", part)
    monkeypatch.setattr(B, "_DENSE", dense)
    monkeypatch.setattr(B, "_OFTEN", often)
    rng = random.Random(1)
    for trial in range(30):
        vectors = [normal({t: rng.random() for t in rng.sample(range(12), rng.randint(0, 5))}) for _ in range(200)]
        vectors += vectors[:40]  # ties
        index = index_of(vectors, rng.choice([1, 7, 32]))
        queries = [normal({t: rng.random() for t in rng.sample(range(14), 4)}) for _ in range(70)]
        got = index.nearest_of_each([vector(q) for q in queries], 6, skip=[i % 50 - 1 for i in range(70)])
        for i, (query, near) in enumerate(zip(queries, got, strict=True)):
            assert same(near, nearest(query, vectors, 6, i % 50 - 1)), trial
    assert index_of([], 8).nearest_of_each([vector({1: 1.0})], 3) == [[]]
    assert index_of([{}, {}], 8).nearest_of_each([vector({1: 1.0}), vector({})], 3) == [[], []]


def test_vectors_go_as_the_index_fills(monkeypatch):
    monkeypatch.setattr(B, "_PART", 40)
    rng = random.Random(7)
    vectors = [normal({t: rng.random() for t in rng.sample(range(30), rng.randint(0, 9))}) for _ in range(300)]
    joined = B.Joined()
    for v in vectors:
        joined.add(vector(v))
    joined.end()
    assert len(joined.terms) > 20 and sum(map(len, joined.terms)) == sum(map(len, vectors))
    index = B.BlockMaxIndex(np.array(joined.sizes), joined.terms, joined.weights, 8)
    assert not any(len(t) + len(w) for t, w in zip(joined.terms, joined.weights, strict=True))
    for query in vectors[:50]:
        assert same(index.nearest_of_each([vector(query)], 5)[0], nearest(query, vectors, 5))
    nothing = B.Joined()
    nothing.end()
    assert B.BlockMaxIndex(np.empty(0, int), nothing.terms, nothing.weights).nearest_of_each([vector({1: 1.0})], 3) == [[]]


def test_tokenizers_are_let_go():
    """A worker that goes on to the classifier holds neither the packing's tokenizer nor the pieces' model."""
    one, two = packing.text_ids(PACKING), pieces.pieces_of(PIECE_MODEL)
    gone = weakref.ref(one), weakref.ref(two)
    del one, two
    kept.kept_by("toxicity")
    gc.collect()
    assert [g() for g in gone] == [None, None]
    assert packing.text_ids(PACKING) is packing.text_ids(PACKING)


def test_rare_terms_of_long_vectors_and_bounds_from_elsewhere():
    rng = random.Random(2)
    draw = lambda: normal({int(rng.paretovariate(0.6)) % 4000: rng.random() for _ in range(60)})
    vectors = [draw() for _ in range(700)]
    index = index_of(vectors, 16)
    assert 0 < index.dense.shape[1] < 200 < len(index.postings)
    queries = [draw() for _ in range(70)]
    for query, near in zip(queries, index.nearest_of_each([vector(q) for q in queries], 9), strict=True):
        assert same(near, nearest(query, vectors, 9))
    halves = [vectors[:300], vectors[300:]]
    first = index_of(halves[0], 16).nearest_of_each([vector(q) for q in queries], 9)
    second = index_of(halves[1], 16).nearest_of_each([vector(q) for q in queries], 9, [f[-1][0] for f in first])
    for query, one, two in zip(queries, first, second, strict=True):
        assert same(B.merged(one, [(s, i + 300) for s, i in two], 9), nearest(query, vectors, 9))


def test_each_kind_has_its_own_frequent_terms(monkeypatch):
    """The words of two languages are dense where they are used, however many the other has."""
    monkeypatch.setattr(B, "_DENSE", 20)
    rng = random.Random(3)
    draw = lambda i: normal({t + 20 * (i % 2): rng.random() for t in rng.sample(range(20), 15)})
    vectors = [draw(i) for i in range(400)]
    index = index_of(vectors, 16)
    assert index.dense.shape[1] == 20 and len(index.postings) == 0
    assert (index.order >= 0).sum() == 400 and len(set(index.kind_of.tolist())) > 1
    queries = [draw(i) for i in range(50)] + [normal({3: 1.0, 25: 1.0, 90: 1.0})]
    for query, near in zip(queries, index.nearest_of_each([vector(q) for q in queries], 7), strict=True):
        assert same(near, nearest(query, vectors, 7))


def test_blocks_below_the_kth_score_are_not_multiplied(monkeypatch):
    """The best runs of blocks come first, and their k-th score spares the others."""
    vectors = [normal({t: 1.0 + 0.001 * i, 50: 0.2}) for t in range(8) for i in range(64)]
    index, partition, seen = index_of(vectors, 8), np.partition, []
    monkeypatch.setattr(B, "_RUN", 1)
    monkeypatch.setattr(B.np, "partition", lambda a, *b, **c: seen.append(a.shape[0]) or partition(a, *b, **c))
    near = index.nearest_of_each([vector(normal({5: 1.0, 50: 0.1}))], 5)
    monkeypatch.undo()
    assert same(near[0], nearest(normal({5: 1.0, 50: 0.1}), vectors, 5)) and sum(seen) <= index.blocks // 4


def test_known_terms_by_ranges():
    rng = np.random.default_rng(5)
    for n in (1, 2, 700, 100_000):
        hashes = np.unique(np.concatenate((rng.integers(-(1 << 63), (1 << 63) - 1, n), 12345 + np.arange(30))))
        asked = np.unique(np.concatenate((hashes[::3], hashes[:5] + 1, rng.integers(-(1 << 63), (1 << 63) - 1, 500), [-(1 << 63), (1 << 63) - 1])))
        plain, ranged = T.known(hashes, (asked, asked)), T.known(hashes, (asked, asked), T.begins(hashes))
        assert (plain[0] == ranged[0]).all() and (plain[1] == ranged[1]).all() and set(plain[1]) == set(asked) & set(hashes)


WORD = re.compile(r"[^\W\d_]+")


def plain_terms(text, prefix=5):
    words, found = Counter(WORD.findall((text or "").lower())), Counter()
    for w, n in words.items():
        found[w, 0] += n
        if len(w) > prefix:
            found[w[:prefix], 1] += n
    return found


def hash_of(term, begins=0):
    """A word's hash, or that of the beginning of a longer word."""
    both = set(H_terms(term + "x" * begins)[0].tolist())
    return next(iter(both - set(H_terms(term + "x")[0].tolist()))) if not begins else next(iter(both & set(H_terms(term + "yy")[0].tolist())))


def H_terms(text, prefix=5):
    return next(H.terms_of_each([text], prefix))


def test_terms_are_those_of_the_words(monkeypatch):
    rng = random.Random(9)
    letters = "abcdefgh" * 9 + " " * 30 + "éßĲİ₂½_7.\n\x00ж中😀ªꙮ"
    texts = ["".join(rng.choices(letters, k=rng.randrange(300))) for _ in range(400)] + [None, "", " ", "a" * 4000, "word " * 900]
    monkeypatch.setattr(H, "_SLICE", 1000)
    hashes, seen = {}, {}
    for text, (found, counts) in zip(texts, H.terms_of_each(texts, 5), strict=True):
        plain = plain_terms(text)
        assert sorted(counts.tolist()) == sorted(plain.values()) and found.tolist() == sorted(set(found.tolist()))
        for term in plain:
            hashes.setdefault(term, set(found.tolist())).intersection_update(found.tolist())
        seen[text] = set(found.tolist())
    named = {t: next(iter(h)) for t, h in hashes.items() if len(h) == 1}
    assert len(named) > 100 and len(set(named.values())) == len(named)  # a term has one hash, wherever it stands
    assert hash_of("abcde") != hash_of("abcde", 1) and len(H_terms("abcdef abcdeg abcde")[0]) == 4


def test_vectors():
    cfg, none = T.ToxicConfig(), np.empty(0, int)
    hashes = sorted([(hash_of("bad"), 2.0, 3), (hash_of("lowei", 1), 1.5, 1)])
    vocabulary = T.Vocabulary(*(np.array([h[i] for h in hashes]) for i in range(3)), np.array([1, 1]), (10, 90), cfg)
    vector = lambda text, own=None: vocabulary.vector(*T.known(vocabulary.hashes, H_terms(text)), own)
    for text in ("", "Good lowei", None):
        assert len(vector(text)[0]) == 0
    numbers, weights = vector("BAD loweig bad Loweixy")
    by_hash = dict(zip(vocabulary.hashes[numbers].tolist(), weights.tolist()))
    assert by_hash[hash_of("bad")] > by_hash[hash_of("lowei", 1)] > 0
    assert sum(w * w for w in weights.tolist()) == pytest.approx(1)
    alone = vector("bad loweix loweix", 1)[1].tolist()  # without the own label
    assert alone != vector("bad loweix loweix")[1].tolist() and sum(w * w for w in alone) == pytest.approx(1)
    assert len(T.Vocabulary(none, none, none, none, (0, 0), cfg).vector(*T.known(none, H_terms("bad")))[0]) == 0
    for numbers in (np.empty(0, int), np.array([0]), np.array([3, 70_000, 5_000_000])):
        again = T.unpacked(T.packed(numbers, numbers + 1))
        assert again[0].tolist() == numbers.tolist() and again[1].tolist() == (numbers + 1).tolist()


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    return read("documents"), read("labels")


def brute(docs, labels, cfg):
    """Scores and evidence of every text by plain dictionaries and all pairs."""
    sampled = sorted((r.doc_id, r.text, r.toxic) for r in T.training_rows(docs, labels, cfg).collect())

    terms = lambda text: plain_terms(text, cfg.prefix)
    rows = [(r.doc_id, terms(r.text)) for r in docs.select("doc_id", "text").collect()]
    have = Counter(t for _, found in rows for t in found)
    counts = [Counter(t for _, text, toxic in sampled if toxic == label for t in terms(text)) for label in (0, 1)]
    sizes = [sum(t == label for _, _, t in sampled) for label in (0, 1)]
    weight = {}
    share = [cfg.smoothing * n / sum(sizes) for n in sizes]
    for t in counts[0] | counts[1]:
        of = [math.log((counts[i][t] + share[i]) / (sizes[i] + 2 * share[i])) for i in (0, 1)]
        odds = of[1] - of[0]
        weight[t] = (math.log((1 + len(rows)) / (1 + have[t])) + 1) * (cfg.even + abs(odds))
    vector = lambda found: normal({t: (1 + math.log(n)) * weight[t] for t, n in found.items() if t in weight})
    examples = [(key, vector(terms(text)), toxic) for key, text, toxic in sampled]
    postings = {}
    for i, (_, v, _) in enumerate(examples):
        for t, w in v.items():
            postings.setdefault(t, []).append((i, w))
    prior = (sizes[1] + 1) / (len(sampled) + 2)

    def near(v, own=None):
        scores = Counter()
        for t, w in v.items():
            for i, x in postings.get(t, ()):
                scores[i] += w * x
        best = sorted((-s, examples[i][0], examples[i][2]) for i, s in scores.items() if examples[i][0] != own)[: cfg.neighbours]
        return [(-s, key, label) for s, key, label in best]

    def vote(found):
        return (sum(s * label for s, _, label in found) + cfg.prior_weight * prior) / (sum(s for s, _, _ in found) + cfg.prior_weight)

    return {key: (vote(f), [k for _, k, _ in f[:5]]) for key, found in rows for f in [near(vector(found))]}


def test_whole_result_against_all_pairs(tables):
    """Nearest neighbours of whole vectors end to end, over several pieces and shards."""
    docs, labels = tables
    cfg = T.ToxicConfig(shard=100, piece=20_000)
    want, model = brute(docs, labels, cfg), T.fit(docs, labels, cfg)
    assert len(model.judge.shards) > 1 and max(map(len, model.judge.shards.values())) > 1
    exact = 0
    for r in T.score(docs, model).select("doc_id", "score", "evidence").collect():
        vote, keys = want[r.doc_id]
        chance = np.interp(vote, model.at, model.chance)
        assert bool(r.evidence) == bool(keys)
        if keys:
            assert r.score == pytest.approx(0.999 * chance + 0.001 * vote, abs=2e-3)
            exact += [int(e.split(":")[0]) for e in r.evidence.split(";")] == keys
    assert exact >= 0.99 * sum(bool(keys) for _, keys in want.values())  # single precision may turn a near tie


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = T.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    toxic, clean = [s for s, t in out if t], [s for s, t in out if not t]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc >= 0.8 and sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)


def test_held_out_recall_on_more_documents(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    docs, labels = read("documents"), read("labels")
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi").filter(T.held_out("doc_id"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    told = [(r.score >= 0.5, truth[r.doc_id]) for r in T.score(some, T.fit(docs, labels)).select("doc_id", "score").collect()]
    toxic, clean = [p for p, t in told if t], [p for p, t in told if not t]
    assert sum(toxic) >= 0.88 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_held_out_labels_are_not_read(tables, spark):
    docs, labels = tables
    other = labels.withColumn("toxic", T.F.when(T.held_out("doc_id"), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    one, two = T.fit(docs, labels), T.fit(docs, other.unionByName(other))
    assert (one.judge.vocabulary.value.hashes == two.judge.vocabulary.value.hashes).all()
    assert (one.judge.vocabulary.value.weights == two.judge.vocabulary.value.weights).all()
    assert (one.chance == two.chance).all()


def test_document_frequencies_count_all_documents(docs_of, spark):
    docs = docs_of([(i, f"every {'some' if i % 3 else 'other'} {'' if i % 7 else 'seven'}") for i in range(60)], 4)
    hashes = np.sort(np.array([hash_of(w) for w in ("every", "some", "other", "seven", "never")]))
    have, n = T._document_counts(docs, hashes, T.ToxicConfig())
    want = {"every": 60, "some": 40, "other": 20, "seven": 9, "never": 0}
    assert n == 60 and dict(zip(hashes.tolist(), have.tolist())) == {hash_of(w): c for w, c in want.items()}


def test_edges(docs_of, spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    df = docs_of([(1, None), (1, ""), (None, "some text"), (2, "word " * 200_000)]).selectExpr("*", "1 as score", "2 as toxic", "3 as `a.b`")
    rows = T.toxicity_report(df, empty).collect()
    assert len(rows) == 4 and {r.predicted for r in rows} <= {0, 1} and all(0 <= r.score <= 1 for r in rows)
    assert T.toxicity_report(docs_of([]), empty).collect() == []
    wild = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 1)], "doc_id long, toxic int")
    assert len(T.toxicity_report(df, wild).collect()) == 4
    taught = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert {r["a.b"] for r in T.without_toxic(df, T.fit(df, taught)).collect()} <= {3}


def test_planted_words_and_sample_bound(docs_of, spark):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(1500):
        toxic = int(rng.random() < 0.15)
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(60)]
        if toxic:
            words[rng.randrange(60)] = rng.choice(["scumble", "trashy", "moronic"])
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    docs, labels = docs_of(rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in T.toxicity_report(docs, labels).collect()}
    assert sum(got[i] != t for i, t in marks) <= 15
    assert len(T.training_rows(docs, labels, T.ToxicConfig(examples=100)).collect()) == 100
    model = T.fit(docs, labels)
    assert {r.doc_id for r in T.without_toxic(docs, model).collect()} == {i for i, p in got.items() if not p}


def test_every_text_with_words_is_searched(tables):
    """Every term of every example is in the vectors: a text without a toxic word has neighbours as well."""
    docs, labels = tables
    model = T.fit(docs, labels)
    hashes = model.judge.vocabulary.value.hashes
    for r in T.score(docs, model).select("text", "evidence").collect():
        assert bool(len(T.known(hashes, H_terms(r.text))[0])) == bool(r.evidence)
    sampled = T.training_rows(docs, labels, model.cfg).collect()
    assert {t for r in sampled for t in H_terms(r.text)[0].tolist()} == set(hashes.tolist())
