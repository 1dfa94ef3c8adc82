import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendwatch.config import EwConfig
from lendwatch.functions import scalars
from lendwatch.operators import quality, serving, star
from lendwatch.operators.features import (
    latest_month,
    read_features_csv,
    segment_features,
    segment_month,
    target_base_rate,
)
from lendwatch.operators.reports import report_by, report_sums, top_k_sectors
from lendwatch.plans import pipeline

STG = (
    "reference_date date, state string, institution_segment string, client_type string, "
    "economic_activity string, client_size string, credit_modality string, "
    "credit_submodality string, number_of_operations bigint, outstanding_balance double, "
    "overdue_balance double, overdue_15_to_90_balance double, overdue_over_90_balance double, "
    "active_portfolio double, default_portfolio double, problem_assets double"
)
JAN = dt.date(2024, 1, 31)


def stg_row(state="SP", kind="PF", activity="A", modality="M", sub="m", active=100.0, bad=5.0):
    names = (JAN, state, "S1", kind, activity, "S", modality, sub)
    return (*names, 2, 0.0, 0.0, 1.0, 0.0, active, bad, 0.0)


@pytest.fixture
def stg(spark):
    rows = [
        stg_row(),
        stg_row(activity="", state="RJ"),
        stg_row(activity=None, kind=None),
        stg_row(modality="", sub=""),
        stg_row(activity="Outros", active=0.0, bad=0.0),
    ]
    return spark.createDataFrame(rows, STG)


def test_keys_null_and_empty(stg):
    dims = star.build_dims(stg)
    fact = star.build_fact(stg, dims)
    assert fact.count() == stg.count()
    keys = ["state", "active_portfolio", "modality_id", "client_id", "economic_activity_id"]
    assert {tuple(r) for r in fact.select(*keys).collect()} == {
        ("SP", 100.0, 2, 2, 1),
        ("RJ", 100.0, 2, 2, None),
        ("SP", 100.0, 2, None, None),
        ("SP", 100.0, 1, 2, 1),
        ("SP", 0.0, 2, 2, 2),
    }
    assert [r.client_type for r in dims["client"].orderBy("client_id").collect()] == [None, "PF"]
    assert [r.default_rate for r in fact.filter("active_portfolio = 0").collect()] == [None]


def test_reports(spark, stg):
    dims = star.build_dims(stg)
    fact = star.build_fact(stg, dims)
    rates = spark.createDataFrame([(JAN, 11.75)], "reference_date date, selic_target_rate_annual double")
    state = {r.state: r for r in report_by(fact, dims, rates, ["state"]).collect()}
    assert state["RJ"].active_portfolio_total == 100.0 and state["SP"].default_rate == 0.05
    both = report_by(fact, dims, rates, ["state", "sector"], relabel=scalars.relabel_unclassified)
    found = {(r.sector, r.default_rate) for r in both.collect()}
    assert found == {("A", 0.05), ("Other / unclassified activity", None)}
    sector = report_by(fact, dims, rates, ["sector"], exact_rate_date=True)
    assert [r.sector for r in top_k_sectors(sector, 1).collect()] == ["A"]
    later = rates.withColumn("reference_date", F.lit(dt.date(2024, 1, 1)))
    rate = "selic_target_rate_annual"
    exact = report_by(fact, dims, later, ["sector"], exact_rate_date=True).select(rate).distinct()
    aligned = report_by(fact, dims, later, ["state"]).select(rate).distinct()
    assert exact.first()[0] is None and aligned.first()[0] == 11.75


def panel(spark, rows):
    """rows: (month number from 2024-01, portfolio, default)"""
    data = [
        (dt.date(2024 + m // 12, m % 12 + 1, 1), "SP", "M", "PF", "S", float(a), float(d), 1.0, 4)
        for m, a, d in rows
    ]
    return spark.createDataFrame(
        data,
        "month_start date, state string, credit_modality string, client_type string, "
        "client_size string, active_portfolio double, default_portfolio double, "
        "overdue_15_to_90_balance double, number_of_operations bigint",
    )


def no_rates(spark):
    return spark.createDataFrame([], "reference_date date, selic_target_rate_annual double")


def test_lags_are_calendar_months(spark):
    """Month 3 is missing: at month 6 the 3-month change is unknown, the 6-month one is not."""
    months = [(m, 100, m) for m in range(13) if m != 3]
    cfg = EwConfig(min_portfolio=1)
    rows = segment_features(panel(spark, months), no_rates(spark), cfg).collect()
    by = {r.reference_month: r for r in rows}
    assert sorted(by)[0] == dt.date(2024, 7, 1)
    july = by[dt.date(2024, 7, 1)]
    assert july.default_rate_chg_3m is None and abs(july.default_rate_chg_6m - 0.06) < 1e-12
    assert july.default_rate_forward == 0.12 and july.target_deterioration == 1
    assert dt.date(2024, 10, 1) not in by  # its lag is the missing month
    assert by[dt.date(2025, 1, 1)].target_deterioration is None


def test_small_months_still_serve_as_lag_and_lead(spark):
    months = [(0, 5, 1), (6, 100, 20), (12, 5, 4)]
    rows = segment_features(panel(spark, months), no_rates(spark), EwConfig(min_portfolio=50)).collect()
    assert [r.reference_month for r in rows] == [dt.date(2024, 7, 1)]
    assert rows[0].default_rate_forward == 0.8 and rows[0].portfolio_growth_6m == 19.0


@pytest.mark.parametrize(
    "now, forward, expected",
    [(0.10, None, None), (0.10, 0.115, 1), (0.10, 0.114, 0), (0.01, 0.014, 0), (0.01, 0.015, 1)],
)
def test_target_rule(spark, now, forward, expected):
    df = spark.createDataFrame([(now, forward)], "a double, b double")
    cfg = EwConfig(target_min_pp=0.004999999, target_min_relative=0.1499999999)
    got = df.select(scalars.deterioration_target(F.col("a"), F.col("b"), cfg).alias("t")).first().t
    assert got == expected


def test_feature_csv(spark, tmp_path):
    features = segment_features(
        panel(spark, [(m, 100, m) for m in range(13)]), no_rates(spark), EwConfig(min_portfolio=1)
    )
    features.coalesce(1).write.option("header", True).csv(str(tmp_path / "f"))
    back = read_features_csv(spark, str(tmp_path / "f"))
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in features.schema]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, features.collect()), key=str)
    assert latest_month(back).count() == 1
    assert not target_base_rate(back).first().is_healthy


def test_gate(spark, stg):
    dims = star.build_dims(stg)
    fact = star.build_fact(stg, dims)
    report = pipeline.mart_checks(fact, dims)
    assert report.count() == 12
    with pytest.raises(quality.GateError, match="client_id"):
        quality.gate(report)
    month = segment_month(fact, dims)  # rows without a client key are left out
    assert month.filter("client_type IS NULL").count() == 0
    assert month.agg({"number_of_operations": "sum"}).first()[0] == 8
    whole = stg.filter("client_type IS NOT NULL")
    dims = star.build_dims(whole)
    quality.gate(pipeline.mart_checks(star.build_fact(whole, dims), dims))
    month = segment_month(star.build_fact(whole, dims), dims)
    quality.gate(pipeline.panel_checks(month))
    with pytest.raises(quality.GateError, match="unique_combination"):
        quality.gate(pipeline.panel_checks(month.unionByName(month)))


def test_each_rule_can_fail(spark):
    df = spark.createDataFrame([(None, 1), (-1.0, 2), (3.0, None)], "a double, t int")
    rules = [quality.not_null("a"), quality.at_least("a", 0), quality.accepted_values("t", [0, 1])]
    rules.append(quality.between("a", 0, 2))
    assert [r.failures for r in quality.check_columns(df, "x", rules).collect()] == [1, 1, 1, 2]
    parents = spark.createDataFrame([(1,)], "k int")
    assert quality.check_relationship(df, "x", "t", parents, "k").first().failures == 1
    assert quality.check_unique(df.union(df), "x", ["t"]).first().failures == 2
    assert quality.reconcile(df, df.limit(1), "x").first().failures == 2


def test_a_missing_or_doubled_month_stops_the_job(spark):
    def months(*rows):
        df = spark.createDataFrame([(dt.date(2024, m, 28), f) for m, f in rows], "d date, f string")
        return quality.complete_months(df, "x", "d", "f")

    quality.gate(months((1, "a"), (2, "b"), (2, "b"), (3, "c")))
    with pytest.raises(quality.GateError, match="missing_month x.d: 1"):
        quality.gate(months((1, "a"), (3, "c")))
    with pytest.raises(quality.GateError, match="duplicate_month x.d: 1"):
        quality.gate(months((1, "a"), (1, "b")))


def test_reports_from_sums_equal_those_from_the_fact(stg, spark):
    dims = star.build_dims(stg)
    fact = star.build_fact(stg, dims)
    for keys in (["state"], ["sector"], ["state", "sector"]):
        one, other = (report_by(f, dims, no_rates(spark), keys) for f in (fact, report_sums(fact)))
        assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, other.collect()), key=str)


def test_freshness_warning_does_not_stop(spark):
    df = spark.createDataFrame([(JAN,)], "d date")
    for days, status in ((60, "pass"), (90, "warn"), (91, "error")):
        now = F.lit(JAN + dt.timedelta(days=days))
        report = quality.freshness(df, "x", "d", now, 60, 90)
        assert report.first().status == status
        if status == "error":
            with pytest.raises(quality.GateError):
                quality.gate(report)
        else:
            quality.gate(report)


def test_band_trend_has_six_empty_months(spark):
    f = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "a", 0.1, 0.2, 10.0), (dt.date(2024, 1, 1), "b", 0.4, 0.2, 30.0)],
        "reference_month date, segment_id string, default_rate double, "
        "early_delinquency_rate double, active_portfolio double",
    )
    s = spark.createDataFrame([("a", "High"), ("b", "High")], "segment_id string, risk_band string")
    rows = serving.band_trend(f, s).collect()
    assert len(rows) == 19 and sum(r.is_forecast_window for r in rows) == 18
    assert [round(r.default_rate, 12) for r in rows if not r.is_forecast_window] == [0.325]
    assert max(r.reference_month for r in rows) == dt.date(2024, 7, 1)
    assert serving.band_trend(f.limit(0), s).count() == 0
