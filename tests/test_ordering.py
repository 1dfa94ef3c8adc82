"""Global order without a global window: against NumPy, with ties and hot values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendwatch.operators import ordering
from lendwatch.operators.metrics import binary_metrics, decile_lift
from lendwatch.operators.ordering import exact_quantiles, row_numbers, running_totals


def frame(spark, values, schema):
    return spark.createDataFrame([tuple(v) for v in values], schema).repartition(5)


def test_running_totals_within_groups(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "hot" if i % 3 else "cold", int(rng.integers(0, 9))) for i in range(900)]
    df = frame(spark, rows, "i long, g string, v long")
    got = running_totals(df, [F.col("i").desc()], {"s": F.col("v")}, ["g"]).collect()
    assert len(got) == 900
    for group in ("hot", "cold"):
        total, expected = 0, {}
        for i, g, v in sorted(rows, reverse=True):
            if g == group:
                total += v
                expected[i] = total
        assert {r.i: r.s for r in got if r.g == group} == expected
        assert {r.s_total for r in got if r.g == group} == {total}


def test_row_numbers_with_nulls(spark):
    rows = [(x,) for x in ["b", None, "a", "", "c"]]
    numbered = row_numbers(frame(spark, rows, "x string"), [F.col("x").asc_nulls_first()], "n")
    assert [r.x for r in numbered.orderBy("n").collect()] == [None, "", "a", "b", "c"]


@pytest.mark.parametrize("n", [1, 2, 4, 37, 100, 1001])
def test_quantiles_like_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n), 1)
    values[: n // 3] = 0.5
    df = frame(spark, [(float(v),) for v in values] + [(None,)], "v double")
    row = exact_quantiles(df, "v", [0.0, 0.5, 0.7, 0.9, 1.0]).first()
    assert np.allclose(list(row), np.quantile(values, [0.0, 0.5, 0.7, 0.9, 1.0]), rtol=0, atol=1e-15)


def brute_metrics(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    ks, ap, before = 0.0, 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tpr, fpr = (pos >= t).mean(), (neg >= t).mean()
        ks = max(ks, abs(tpr - fpr))
        ap += (tpr - before) * (y[s >= t] == 1).mean()
        before = tpr
    return pairs, ks, ap


@pytest.mark.parametrize("decimals", [1, 2, 8])
def test_metrics_like_brute_force(spark, decimals):
    rng = np.random.default_rng(decimals)
    y = (rng.random(600) < 0.3).astype(int)
    s = np.round(rng.random(600) * 0.7 + 0.2 * y, decimals)
    s[:200] = s[0]
    df = frame(spark, zip(y.tolist(), s.tolist()), "y int, s double")
    row = binary_metrics(df, "y", "s").first()
    auc, ks, ap = brute_metrics(y, s)
    assert np.allclose([row.auc, row.gini, row.ks, row.ap], [auc, 2 * auc - 1, ks, ap])


def test_metrics_by_group(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.2), ("b", 0, 0.2), ("b", 0, 0.8)]
    got = binary_metrics(frame(spark, rows, "g string, y int, s double"), "y", "s", ["g"]).collect()
    assert {r.g: r.auc for r in got} == {"a": 1.0, "b": 0.25}


def test_decile_sizes(spark):
    """The published sizes at 13,643 rows: the extra rows fall in tenths 1, 5 and 10."""
    df = spark.range(13_643).select(
        (F.col("id") % 7 == 0).cast("int").alias("y"), (F.col("id") % 100).alias("s"), "id"
    )
    table = sorted(decile_lift(df, "y", "s", ["id"]).collect(), key=lambda r: r.decil)
    assert [r.segmentos for r in table] == [1365, 1364, 1364, 1364, 1365, 1364, 1364, 1364, 1364, 1365]
    assert table[-1].captura_acumulada == 1.0
    assert sum(r.deterioraram for r in table) == 1949


@pytest.mark.parametrize("kind", ["spread", "ties", "few", "skewed"])
def test_bracketed_quantiles_are_exact(spark, kind, monkeypatch):
    rng = np.random.default_rng(len(kind))
    values = {
        "spread": rng.normal(size=40_000), "ties": rng.integers(0, 5, 20_000) * 1.0, "few": rng.normal(size=7),
        "skewed": np.concatenate([np.full(30_000, 2.0), rng.exponential(size=5_000) * 1e9])}[kind]
    probabilities = [0.0, 0.1, 0.5, 0.7, 0.9, 1.0]
    df = frame(spark, [(float(v),) for v in values], "v double").unionByName(spark.sql("select cast(null as double) v"))
    ordered = []
    real = ordering.running_totals
    monkeypatch.setattr(ordering, "running_totals", lambda d, *a: ordered.append(d) or real(d, *a))
    got = ordering.exact_quantiles(df, "v", probabilities).first()
    assert np.allclose([got[f"q{i}"] for i in range(6)], np.quantile(values, probabilities), rtol=1e-12)
    if kind == "spread":
        assert ordered[0].select("v").distinct().count() < 0.05 * len(values)
    halves = df.withColumn("g", F.col("v") > 0)
    both = {r.g: r.q0 for r in ordering.exact_quantiles(halves, "v", [0.25], ["g"]).collect()}
    for side in (True, False):
        own = values[(values > 0) == side]
        assert len(own) == 0 or np.isclose(both[side], np.quantile(own, 0.25), rtol=1e-12)


def test_a_bracket_that_misses_is_opened(spark, monkeypatch):
    """A sketch whose values lie beside the quantile costs time, not exactness."""
    monkeypatch.setattr(ordering, "_BRACKET", 0.0)
    monkeypatch.setattr(ordering, "_ACCURACY", 2)
    values = np.random.default_rng(1).permutation(5000) * 1.0
    df = frame(spark, [(v,) for v in values.tolist()], "v double")
    got = ordering.exact_quantiles(df, "v", [0.3, 0.5]).first()
    assert np.allclose([got.q0, got.q1], np.quantile(values, [0.3, 0.5]))
    assert ordering.exact_quantiles(df.limit(0), "v", [0.5], []).first().q0 is None


def test_null_groups_keep_their_rows(spark):
    rows = [(None, 1), (None, 3), ("a", 2), ("a", 4), ("b", 5)]
    df = spark.createDataFrame(rows, "g string, v long")
    totals = running_totals(df, [F.col("v")], {"upto": F.col("v")}, ["g"]).collect()
    assert sorted((str(r.g), r.v, r.upto, r.upto_total) for r in totals) == [
        ("None", 1, 1, 4), ("None", 3, 4, 4), ("a", 2, 2, 6), ("a", 4, 6, 6), ("b", 5, 5, 5)
    ]
    found = exact_quantiles(df, "v", [0.5], ["g"]).collect()
    assert sorted((str(r.g), r.q0) for r in found) == [("None", 2.0), ("a", 3.0), ("b", 5.0)]
