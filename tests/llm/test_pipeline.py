import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as C
from test_near_dup import brute as near_brute
from test_packing import CFG, Tokenizer, PATH
from test_secret_scan import base, hot

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    small = "/root/testdata/sf0.001"
    docs, kept = spark.read.parquet(f"{small}/documents.parquet"), []
    kept.append(docs)
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
    return kept


def test_columns_and_order(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "minhash_near_dedup", "secret_scan", "source_mix", "packing"]
    assert all(sorted(d.columns) == sorted(COLUMNS) for d in stages[:-1])


def test_toxicity_keeps_rows_unchanged(stages):
    before = Counter(map(tuple, stages[0].select(*COLUMNS).collect()))
    after = Counter(map(tuple, stages[1].select(*COLUMNS).collect()))
    assert not after - before and sum(after.values()) >= 0.8 * sum(before.values())


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(i for i, _, _, kept in near_brute(rows) if kept)


def test_secrets_are_gone_and_the_rest_stays(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    for r in stages[3].collect():
        text, parts, at = before[r.doc_id], [], 0
        for s, _, e in sorted(base(text) + hot(text)):
            if s >= at:
                parts.append(text[at:s] + "[SECRET]")
            at = max(at, e)
        assert r.text == "".join(parts) + text[at:] and r.n_chars == len(r.text)


def test_mix_repeats_whole_documents(stages):
    before = {r.doc_id: tuple(r) for r in stages[3].select(*COLUMNS).collect()}
    rows = [tuple(r) for r in stages[4].select(*COLUMNS).collect()]
    assert all(before[r[0]] == r for r in rows) and max(Counter(r[0] for r in rows).values()) <= 2
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken, all_ = sum(words(r[1]) for r in rows), sum(words(r[1]) for r in before.values())
    assert abs(taken - 1.5 * all_) <= 0.03 * all_


def test_packed_pieces_hold_every_token(stages):
    tokenizer, want, got = Tokenizer.from_file(PATH), Counter(), Counter()
    for r in stages[4].collect():
        want[r.doc_id] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    sequences = defaultdict(int)
    for r in stages[5].collect():
        got[r.doc_id] += r.length
        sequences[r.sequence_id] += r.length
    assert got == want and max(sequences.values()) <= CFG.capacity


def test_run(spark, stages):
    ours = sorted(tuple(r) for r in C.run(spark, "/root/testdata/sf0.001").drop("sequence_id", "offset").collect())
    assert ours == sorted(tuple(r) for r in stages[5].drop("sequence_id", "offset").collect())


def test_empty_table(spark, docs_of):
    docs = docs_of([])
    for _, stage in C.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.collect() == []


def test_stages_on_odd_rows(spark, docs_of):
    """NULL and repeated ids, NULL, empty and very long texts, repeated rows and clashing columns in every stage."""
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(60_000))
    rows = [(1, None), (1, ""), (None, "no id at all"), (2, long), (2, long), (3, long + " x"), (4, " " * 200_000), (5, "a b"), (5, "a b", None)]
    rows += [(10 + i, f"text {i} password=0123456789abcdef{i:02d} end", "s") for i in range(20)]
    docs = docs_of(rows)
    for name, stage in C.STAGES[:-1]:
        before = docs
        docs = C.materialize(stage(spark, docs, "/root/testdata/sf0.001"), "odd")
        assert sorted(docs.columns) == sorted(COLUMNS), name
        if name == "toxicity":
            assert docs.count() >= 0.8 * before.count()
        elif name == "minhash_near_dedup":
            assert {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()} == {3}
        elif name == "secret_scan":
            assert docs.count() == before.count() and docs.filter("text like '%0123456789abcdef%'").isEmpty()
    packed = C.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
