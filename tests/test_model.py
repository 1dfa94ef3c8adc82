"""Model mechanics on a panel whose target follows one feature."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendwatch.config import FEATURES, SEGMENT_KEYS, TARGET, EwConfig
from lendwatch.plans import model, pipeline

CFG = EwConfig(min_portfolio=1, gbt_iterations=8, gbt_min_leaf=5, importance_repeats=2)


@pytest.fixture(scope="module")
def features(spark):
    """60 segments by 30 months; the target is 1 in a middle band of one feature."""
    month = F.add_months(F.lit(dt.date(2022, 1, 1)), (F.col("id") % 30).cast("int"))
    noise = {f: F.rand(i) for i, f in enumerate(FEATURES)}
    df = spark.range(1800, numPartitions=4).select(
        F.format_string("s%02d", (F.col("id") / 30).cast("int")).alias("segment_id"),
        month.alias("reference_month"),
        *[F.lit(c).alias(c) for c in SEGMENT_KEYS],
        F.lit(100.0).alias("active_portfolio"),
        *[v.alias(f) for f, v in noise.items()],
    )
    driver = F.col("early_delinquency_rate")
    labelled = F.col("reference_month") < F.lit(dt.date(2024, 1, 1))
    target = F.when(labelled, driver.between(0.3, 0.6).cast("int"))
    df = df.withColumns({TARGET: target, "default_rate_forward": F.lit(0.0)})
    hole = F.when(F.col("portfolio_growth_6m") > 0.1, F.col("portfolio_growth_6m"))
    path_free = df.withColumn("portfolio_growth_6m", hole)
    from lendwatch.storage import materialize

    return materialize(path_free, "features")


@pytest.fixture(scope="module")
def validation(features):
    return model.fit_models(features, CFG)


def test_split_leaves_a_horizon_between(features, validation):
    assert validation.test_start == dt.date(2023, 7, 1) and validation.limit == dt.date(2023, 1, 1)
    rows = features.filter(F.col(TARGET).isNotNull())
    strict = model.oot_split(rows, CFG, strict=True)
    assert strict[2] == dt.date(2022, 12, 1)
    assert validation.train.count() == 60 * 13 and validation.test.count() == 60 * 6


def test_boosting_beats_logistic_on_a_band(validation):
    results = validation.results
    assert results[model.BOOSTING]["ks"] > 0.9 > results[model.LOGISTIC]["ks"]
    assert validation.best == model.BOOSTING


def test_importance_finds_the_driver(validation):
    rows = model.permutation_importance(validation.models[model.BOOSTING], validation.test, CFG)
    found = {r.feature: r.queda_de_auc for r in rows.collect()}
    assert max(found, key=found.get) == "early_delinquency_rate"
    assert all(abs(v) < 0.1 for f, v in found.items() if f != "early_delinquency_rate")


def test_importance_carries_one_value_of_a_donor(validation, monkeypatch):
    """No row of features is shuffled to its receiver, and a known AUC is not computed again."""
    best = validation.models[model.BOOSTING]
    rows = model.permutation_importance(best, validation.test, CFG, validation.results[model.BOOSTING]["auc"])
    again = {r.feature: r.queda_de_auc for r in model.permutation_importance(best, validation.test, CFG).collect()}
    assert {r.feature: r.queda_de_auc for r in rows.collect()} == again
    seen = []
    monkeypatch.setattr(model, "with_score", lambda m, df: seen.append(df) or df.withColumn("score", F.lit(0.5)))
    model.permutation_importance(best, validation.test, CFG, 0.5)
    assert len(seen) == 1 and "named_struct" not in seen[0]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(4))
def test_first_split_with_null_equals_brute_force(spark, seed):
    """The rows that go left are those of the best split, NULL on the better side."""
    import random

    rng = random.Random(seed)
    cfg = EwConfig(gbt_iterations=1, gbt_depth=1, gbt_min_leaf=5, gbt_early_stop=False)
    rows = []
    for i in range(160):
        a = None if rng.random() < 0.25 else round(rng.random(), 3)
        b = None if rng.random() < 0.1 else round(rng.random(), 3)
        chance = (0.9 if seed % 2 else 0.1) if a is None else 0.8 * (a > 0.55) + 0.1
        rows.append((f"s{i:03d}", dt.date(2024, 1, 1), int(rng.random() < chance), a, b))
    given = {FEATURES[0]: F.col("a"), FEATURES[1]: F.col("b")}
    df = spark.createDataFrame(rows, "segment_id string, reference_month date, y int, a double, b double").select(
        "segment_id", "reference_month", F.col("y").alias(TARGET), *[given.get(f, F.lit(0.0)).alias(f) for f in FEATURES])
    fitted = model.fit(model.BOOSTING, df, cfg, {})
    tree = fitted.stages[-1].trees[0]
    scores = {r.segment_id: r.score for r in model.with_score(fitted, df).collect()}
    low = min(scores.values())
    ones = sum(r[2] for r in rows)
    weight = {1: 160 / (2 * ones), 0: 160 / (2 * (160 - ones))}
    sides, best = [], None
    for f in (3, 4):
        real = sorted({r[f] for r in rows if r[f] is not None})
        for t in real:
            for null_left in (True, False):
                left = [r for r in rows if (null_left if r[f] is None else r[f] <= t)]
                right = [r for r in rows if not (null_left if r[f] is None else r[f] <= t)]
                if min(len(left), len(right)) >= cfg.gbt_min_leaf:
                    gain = 0.0
                    for part in (left, right):
                        n = sum(weight[r[2]] for r in part)
                        total = sum(weight[r[2]] * (2 * r[2] - 1) for r in part)
                        gain += total * total / n
                    sides.append((gain, frozenset(r[0] for r in left), frozenset(r[0] for r in right)))
    top = max(g for g, _, _ in sides)
    parts = {frozenset((l, r)) for g, l, r in sides if g > top - 1e-9}
    assert tree.numNodes == 3
    assert frozenset((frozenset(k for k, v in scores.items() if v == low), frozenset(k for k, v in scores.items() if v > low))) in parts


@pytest.mark.parametrize("kept", ["training", "none"])
def test_one_class_in_the_test_months_still_gives_every_table(features, kept):
    """Without a positive, no KS is defined; tables, importance and scores are made all the same."""
    early = F.col("reference_month") < F.lit(dt.date(2023, 7, 1)) if kept == "training" else F.lit(False)
    calm = features.withColumn(TARGET, F.when(F.col(TARGET).isNotNull(), F.when(early, F.col(TARGET)).otherwise(0)))
    found = model.fit_models(calm, CFG)
    assert {r["ks"] for r in found.results.values()} == {None} and found.best == model.LOGISTIC
    rows = model.metrics_table(found, CFG).collect()
    assert [r.model for r in rows if r.is_selected] == [model.LOGISTIC]
    assert {(r.roc_auc, r.ks, r.base_rate_test) for r in rows} == {(None, None, 0.0)}
    deciles = model.deciles_table(found, CFG).collect()
    assert sum(r.segmentos for r in deciles) == 60 * 6 and {r.deterioraram for r in deciles} == {0}
    drops = model.permutation_importance(found.models[found.best], found.test, CFG).collect()
    assert {r.feature for r in drops} == set(FEATURES) and {r.queda_de_auc for r in drops} == {None}
    scores = model.score_latest(calm, found, CFG).collect()
    assert len(scores) == 60 and all(0 <= r.score <= 1 for r in scores)


@pytest.mark.parametrize("stop", [True, False])
def test_null_tells_and_stopping_is_a_choice(features, stop):
    """A target that follows the holes of one feature is learnt with and without early stopping."""
    hole = F.col("portfolio_growth_6m").isNull()
    rows = features.filter(F.col(TARGET).isNotNull()).withColumn(TARGET, hole.cast("int"))
    cfg = EwConfig(min_portfolio=1, gbt_iterations=12, gbt_min_leaf=5, gbt_early_stop=stop)
    fitted = model.fit(model.BOOSTING, rows, cfg, {})
    told = model.with_score(fitted, rows).agg(F.min(F.when(hole, F.col("score"))).alias("a"), F.max(F.when(~hole, F.col("score"))).alias("b")).first()
    assert told.a > 0.5 > told.b
    assert fitted.stages[-1].getNumTrees <= 12 and (stop or fitted.stages[-1].getNumTrees == 12)


def test_logistic_matches_a_direct_solution(validation):
    """Same penalised likelihood, solved by Newton steps in NumPy."""
    import numpy as np

    train = validation.train.toPandas()
    x, y = train[FEATURES], train[TARGET].to_numpy()
    x = x.fillna(x.median()).to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    n = len(y)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    design, penalty = np.c_[x, np.ones(n)], np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (w * (p - y)) + penalty @ beta
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + penalty
        beta -= np.linalg.solve(hessian, gradient)
    fitted = validation.models[model.LOGISTIC].stages[-1]
    assert np.allclose(fitted.coefficients.toArray(), beta[:-1], atol=1e-4)
    assert abs(fitted.intercept - beta[-1]) < 1e-4


def test_scores_and_history(spark, features, tmp_path):
    out = str(tmp_path)
    tables = pipeline.train_and_score(features, out, CFG)
    scores = tables["ew_segment_scores"].collect()
    assert len(scores) == 60 and {r.reference_month for r in scores} == {dt.date(2024, 6, 1)}
    tables = pipeline.train_and_score(features, out, CFG)
    history = spark.read.parquet(f"{out}/ew_segment_scores_history")
    assert history.count() == 60
    assert tables["ew_model_metrics"].filter("is_selected").first().model == model.BOOSTING
    assert tables["ew_model_deciles"].count() == 10
    assert tables["ew_flagged_trend"].filter("is_forecast_window").count() == 18
