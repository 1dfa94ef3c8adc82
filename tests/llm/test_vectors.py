import numpy as np
import pytest

from lendwatch.llm import embedding_dedup as D
from lendwatch.llm import top_k as K

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(seed, n=300, dim=12, extra=()):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)).astype(np.float32)
    base[n // 2 : n // 2 + 40] = base[0] + rng.normal(scale=0.05, size=(40, dim)).astype(np.float32)
    base[n // 2 + 40 : n // 2 + 90] = base[1]
    rows = [(i, base[i].tolist(), int(i % 3)) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dim, [nan] * dim, [inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0, 2.0], [1.0, 2.1]]
    rows += [(1000 + 50 * i, v, 0) for i, v in enumerate(odd)] + [(5000, rows[0][1], None), (None, rows[0][1], 0)]
    return rows + [rows[4], *extra]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def brute_top(rows, k=5):
    pts = [(i, np.floor(256 * np.array(v, np.float64))) for i, v, _ in rows if i is not None and usable(v)]
    out = []
    for q, x in {(i, tuple(v)): (i, v) for i, v in pts if i % 50 == 0}.values():
        near = sorted((-int(x @ y), i) for i, y in pts if i != q and len(x) == len(y))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def test_top_k(spark):
    cfg = K.SearchConfig(shard_rows=64, block_rows=3, leaf_rows=4)
    rows = rows_of(1)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as shard").repartition(3)
    got = sorted(tuple(r) for r in K.top_k_report(df, cfg=cfg).collect())
    assert got == brute_top(rows)
    assert K.top_k_report(df.limit(0)).collect() == []


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.3, size=(200, 4)) for c in (-9, 0, 9)])
    order, nodes, boxes = K.build_tree(points, 8)
    tree = K.Tree(order, points[order], nodes, boxes)
    seen = []
    real = tree.nodes
    tree.nodes = type("Seen", (), {"__getitem__": lambda _, i: seen.append(i) or real[i]})()
    query = np.ones(4)
    found = tree.search(-1, query, tree.bounds(query[None])[0], float("-inf"), 5)
    want = sorted(((float(p @ query), i) for i, p in enumerate(points)), reverse=True)[:5]
    found = sorted(found, reverse=True)
    assert [i for _, i in found] == [i for _, i in want] and len(seen) < len(real) / 2
    assert [s for s, _ in found] == pytest.approx([s for s, _ in want])
    low, high = boxes[:, 0], boxes[:, 1]
    for (start, end, _, _), a, b in zip(real, low, high, strict=True):
        own = points[order[start:end]]
        assert (own.min(axis=0) == a).all() and (own.max(axis=0) == b).all()


def brute_links(rows, least=0.93):
    ok = [i is not None and lab is not None and usable(v) and any(v) for i, v, lab in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if o else None for (_, v, _), o in zip(rows, ok, strict=True)]
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), low, low == rows[i][0]))
    return sorted(out, key=str)


def test_links(spark):
    chain = [(7000 + i, [float(np.cos(i / 3)), float(np.sin(i / 3))], 1) for i in range(12)]
    rows = rows_of(2, extra=[*chain, (3, [9.0, 1.0], 1), (3, [-9.0, 1.0], 1)])
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n_links", "2 as rep", "3 as block").repartition(3)
    got = sorted((tuple(r) for r in D.link_report(df, D.LinkConfig(block_rows=16)).collect()), key=str)
    assert got == brute_links(rows)
    assert D.link_report(df.limit(0)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for scale in (1e-30, 1.0, 1e30):
        a = rng.normal(size=(80, 7)) * scale
        a[40:] = a[:40] * (1 + rng.normal(scale=0.2, size=(40, 7)))
        q = D.quantise(a)
        u = a / np.linalg.norm(a / scale, axis=1, keepdims=True) / scale
        true = {tuple(p) for p in np.argwhere(u @ u.T >= 0.93)}
        assert true <= set(zip(*[x.tolist() for x in D.possible_pairs(q, q, 0.93, 1e-6)], strict=True))


def test_extreme_components_and_labels_of_other_types(spark):
    tiny = [[1e-200, 1e-200], [1e-200, 1.01e-200], [1e200, 1e200], [-1e-310, 1e-310], [1.0, 0.0], [5e-324, 5e-324]]
    rows = [(i, v, label) for i, v in enumerate(tiny) for label in ("b c",)] + [(90, [1.0, 1.0], "x"), (91, [1.0, 1.1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in D.link_report(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 5: (3, 0), 3: (0, 3), 4: (0, 4), 90: (0, 90), 91: (0, 91)}


def test_scores_beyond_a_long_are_held_at_its_ends(spark):
    rows = [(0, [1e30, 1e30]), (1, [1e30, 1.0]), (2, [-1e30, -1e30]), (3, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in K.top_k_report(df).orderBy("rank").collect()]
    assert got == [(0, 1, 1, (1 << 63) - 1), (0, 2, 3, (1 << 63) - 1), (0, 3, 2, -(1 << 63))]
