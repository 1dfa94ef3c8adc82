"""Ratios, calendar keys and business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendwatch.config import EwConfig


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is zero or either side is NULL."""
    return F.try_divide(numerator, denominator)


def ratio_of_sums(numerator: str, denominator: str) -> Column:
    """Portfolio-weighted rate; never a mean of rates."""
    return F.try_divide(F.sum(numerator), F.sum(denominator))


def growth(now: Column, before: Column) -> Column:
    return safe_divide(now, before) - 1


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def month_index(date: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(date) * 12 + F.month(date)


def segment_id(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(p, F.lit("NA")) for p in parts])


def relabel_unclassified(activity: Column) -> Column:
    return F.coalesce(F.nullif(activity, F.lit("Outros")), F.lit("Other / unclassified activity"))


def deterioration_target(rate: Column, forward: Column, cfg: EwConfig) -> Column:
    """1 on a material absolute and relative rise, NULL while unpublished."""
    risen = (forward - rate >= F.lit(float(cfg.target_min_pp))) & (
        forward >= rate * F.lit(1 + cfg.target_min_relative)
    )
    return F.when(forward.isNotNull(), F.when(risen, 1).otherwise(0)).cast("int")


def risk_band(score: Column, medium_cut: Column, high_cut: Column) -> Column:
    return F.when(score >= high_cut, "Alto").when(score >= medium_cut, "Médio").otherwise("Baixo")
