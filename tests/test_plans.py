"""Shapes of physical plans that must hold at any size."""

import pytest

import __spark_entry__ as entry
from lendwatch import fixture, oracle, queries
from lendwatch.operators.features import segment_features
from lendwatch.sources import raw_text

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(oracle.statements()) - {"zip_members_to_lines"}))
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert node not in text


def test_feature_window_needs_one_shuffle(spark, small):
    panel = queries.materialize(queries.panel_of(spark, small), "panel")
    rates = queries.materialize(queries.month_rates(spark, small), "rates")
    text = plan(segment_features(panel, rates, fixture.CONFIG))
    assert text.count("Window [") == 1
    assert text.count("hashpartitioning(segment_id") == 1


def test_parsing_has_no_shuffle(spark, small, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    parsed = raw_text.parse_rows(raw_text.read_raw_lines(spark, str(tmp_path)))
    assert "Exchange" not in plan(parsed)
    good = plan(raw_text.good_rows(parsed))
    assert good.count("RLIKE") == plan(parsed).count("RLIKE")


def test_report_aggregates_before_joining(spark, small):
    text = plan(QUERIES["rpt_sector_default_by_month"](spark, small))
    above, below = text.split("economic_activity_id", 1)
    assert "HashAggregate" in below


def test_scan_reads_needed_columns_only(spark, small):
    text = plan(QUERIES["rpt_state_default_by_month"](spark, small))
    scans = [s for s in text.split("FileScan parquet ") if s.startswith("[l_orderkey")]
    assert scans and all("l_tax" not in s.split("]")[0] for s in scans)


def test_stored_fact_is_pruned(spark, small):
    text = plan(QUERIES["fact_partition_pruned"](spark, small))
    assert "PartitionFilters: [isnotnull(reference_date" in text
