import random
import zlib
from hashlib import sha256

import pytest

from lendwatch.llm import merkle as M


def test_addresses_are_a_van_emde_boas_order():
    for fanout, levels in ((2, 5), (3, 4), (16, 3), (2, 1)):
        places = [M.addresses(d, levels, fanout).tolist() for d in range(levels)]
        flat = sorted(p for row in places for p in row)
        assert flat == list(range(M.nodes_in(levels, fanout)))
    # Four levels of fan-out 2: the upper two, then four subtrees of two levels.
    assert [M.addresses(d, 4, 2).tolist() for d in range(4)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def reduced(nodes, fanout=16):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, at, fanout=16):
    for level in levels[:-1]:
        first = at - at % fanout
        yield "".join(level[first:at]), "".join(level[at + 1 : first + fanout])
        at //= fanout


def brute(rows, fanout=16):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    def leaf(row):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)

    def lowered(row):
        text = row[4] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        return leaf((*row[:4], text)) if hit else leaf(row)

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), lowered(row), row[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda g: g[:3])
        trees[s] = reduced([g[2] for g in groups[s]], fanout)
    top = reduced([trees[s][-1][0] for s in names], fanout) if names else None
    out = []
    for n, s in enumerate(names):
        for at, (_, _, own, claimed, key) in enumerate(groups[s]):
            steps = [*path(trees[s], at, fanout), *path(top, n, fanout)]
            found = claimed
            for left, right in steps:
                found = h((left, found, right))
            out.append((key, own, trees[s][-1][0], top[-1][0], h(l + r for l, r in steps), found, found == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def got(docs, cfg=M.ManifestConfig()):
    return sorted((tuple(r) for r in M.manifest_report(docs, cfg).select(*COLUMNS).collect()), key=str)


def test_whole_table(all_docs):
    rows = [tuple(r) for r in all_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = brute(rows)
    assert got(all_docs) == want
    assert any(not w[6] for w in want) and any(w[6] for w in want)


@pytest.mark.parametrize("fanout, edges", [(2, 1), (2, 3), (3, 2), (16, 1)])
def test_layers_of_blocks_and_many_sources(docs_of, fanout, edges):
    """Sizes around the powers of the fan-out, so that last runs have one node and trees several layers."""
    rng = random.Random(fanout)
    sizes = [1, 2, fanout, fanout + 1, fanout**2, fanout**2 + 1, 37] + [rng.randint(1, 9) for _ in range(30)]
    rows = [(i * 100 + j, f"Text {j}" * rng.randrange(3), f"s{i:02d}é") for i, n in enumerate(sizes) for j in range(n)]
    rng.shuffle(rows)
    docs = docs_of(rows)
    full = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got(docs, M.ManifestConfig(fanout=fanout, edges=edges)) == brute(full, fanout)


def test_edges(docs_of, spark):
    rows = [(5, None, "a"), (5, "", "a"), (None, "No id", "a"), (7, "Same"), (7, "Same"), (9, "X" * 3_000_000, None), (1, "é", None), (-3, "A", "Z"), (2**62, "a", "a")]
    docs = docs_of(rows)
    full = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert got(docs.selectExpr("*", "1 as tree", "2 as leaf", "3 as place")) == brute(full)
    assert got(docs_of([])) == [] and got(docs_of([(3, "Lone")])) == brute([(3, "a", "en", 4, "Lone")])


def test_stored_siblings():
    leaves = [sha256(bytes([i])).digest() for i in range(23)]
    made = M.Subtree.build(leaves, 3, 3)
    again = M.Subtree(made.nodes, 23, 3, 3)
    levels = reduced([x.hex() for x in leaves], 3)
    assert again.node(0, 0) == levels[-1][0] and len(made.nodes) <= M.nodes_in(4, 3) * M.WIDTH
    assert [list(p) for p in again.paths()] == [list(path(levels, i, 3)) for i in range(23)]
    assert all(M.folded(x.hex(), p) == levels[-1][0] for x, p in zip(leaves, again.paths()))
