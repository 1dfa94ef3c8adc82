"""Reporting marts: portfolio totals and weighted default rates by month."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwatch.functions.scalars import month_start, ratio_of_sums

SUMS = ["active_portfolio", "default_portfolio", "number_of_operations"]


def _with_rate(rows: DataFrame, rates: DataFrame, exact_date: bool) -> DataFrame:
    """Left equi-join to the rate of the same date, or of the same month."""
    if exact_date:
        return rows.join(rates, "reference_date", "left")
    monthly = rates.select(
        month_start(F.col("reference_date")).alias("rate_month"), "selic_target_rate_annual"
    )
    return (
        rows.withColumn("rate_month", month_start(F.col("reference_date")))
        .join(monthly, "rate_month", "left")
        .drop("rate_month")
    )


def report_sums(fact: DataFrame) -> DataFrame:
    """The fact summed by the keys of all reports, which are roll-ups of it."""
    keys = ["reference_date", "state", "economic_activity_id"]
    return fact.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def report_by(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    rates: DataFrame,
    keys: Sequence[str],
    exact_rate_date: bool = False,
    relabel: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Totals by month and ``keys`` (``state``, ``sector`` or both).

    The fact is summed by its own keys first, so that the joins to dates,
    activities and rates see one row per group instead of every operation, and
    a hot group is reduced inside each task before the shuffle. ``report_sums``
    of the fact may stand in for it.
    """
    fact_keys = ["reference_date"]
    if "state" in keys:
        fact_keys.append("state")
    if "sector" in keys:
        fact_keys.append("economic_activity_id")
    rows = fact.groupBy(*fact_keys).agg(*[F.sum(c).alias(c) for c in SUMS])
    rows = rows.join(dims["date"].select("reference_date", "year", "month"), "reference_date")
    if "sector" in keys:
        sector = F.col("economic_activity")
        named = dims["activity"].select(
            "economic_activity_id", (relabel(sector) if relabel else sector).alias("sector")
        )
        rows = rows.join(named, "economic_activity_id")
    return (
        _with_rate(rows, rates, exact_rate_date)
        .groupBy("reference_date", "year", "month", *keys, "selic_target_rate_annual")
        .agg(
            F.sum("active_portfolio").alias("active_portfolio_total"),
            F.sum("default_portfolio").alias("default_portfolio_total"),
            ratio_of_sums("default_portfolio", "active_portfolio").alias("default_rate"),
            F.sum("number_of_operations").alias("number_of_operations"),
        )
    )


def top_k_sectors(report: DataFrame, k: int = 8) -> DataFrame:
    """Report rows of the ``k`` sectors with the largest exposure over all months."""
    top = (
        report.groupBy("sector")
        .agg(F.sum("active_portfolio_total").alias("total_exposure"))
        .orderBy(F.desc("total_exposure"), "sector")
        .limit(k)
    )
    return report.join(top.select("sector"), "sector", "left_semi").select(*report.columns)
