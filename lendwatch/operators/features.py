"""Segment-by-month panel, early-warning features and target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendwatch.config import FEATURES, SEGMENT_KEYS, TARGET, EwConfig
from lendwatch.functions import scalars
from lendwatch.sources.rates import rate_changes

PANEL_SUMS = [
    "active_portfolio",
    "default_portfolio",
    "overdue_15_to_90_balance",
    "number_of_operations",
]


def segment_month(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Totals by month, state, modality, client type and size.

    Summed by surrogate keys before the joins to the dimensions; a second, small
    sum merges submodalities.
    """
    sums = [F.sum(c).alias(c) for c in PANEL_SUMS]
    month = scalars.month_start(F.col("reference_date")).alias("month_start")
    by_key = fact.groupBy(month, "state", "modality_id", "client_id").agg(*sums)
    return (
        by_key.join(dims["modality"].select("modality_id", "credit_modality"), "modality_id")
        .join(dims["client"], "client_id")
        .groupBy("month_start", *SEGMENT_KEYS)
        .agg(*sums)
    )


def segment_features(panel: DataFrame, rates: DataFrame, cfg: EwConfig) -> DataFrame:
    """One row per segment and month with features up to t and the target at t + H.

    Lags and lead are calendar distances, not row distances: one window by
    segment over a month number, with one-month RANGE frames, in a single sort.
    The size floor applies after the window, so a month below it still serves as
    another month's lag or lead.
    """
    rate = scalars.safe_divide(F.col("default_portfolio"), F.col("active_portfolio"))
    early = scalars.safe_divide(F.col("overdue_15_to_90_balance"), F.col("active_portfolio"))
    base = panel.filter(F.col("active_portfolio") > 0).select(
        scalars.segment_id(*[F.col(c) for c in SEGMENT_KEYS]).alias("segment_id"),
        F.col("month_start").alias("reference_month"),
        *SEGMENT_KEYS,
        "active_portfolio",
        "number_of_operations",
        rate.alias("default_rate"),
        early.alias("early_delinquency_rate"),
        scalars.month_index(F.col("month_start")).alias("mi"),
    )
    calendar = Window.partitionBy("segment_id").orderBy("mi")

    def at(column: str, months: int):
        return F.first(column).over(calendar.rangeBetween(months, months))

    moved = base.withColumns(
        {
            "rate_3": at("default_rate", -3),
            "rate_6": at("default_rate", -6),
            "early_3": at("early_delinquency_rate", -3),
            "portfolio_6": at("active_portfolio", -6),
            "default_rate_forward": at("default_rate", cfg.horizon_months),
        }
    )
    now = F.col("default_rate")
    portfolio = F.col("active_portfolio")
    kept = moved.filter(
        (portfolio >= F.lit(float(cfg.min_portfolio))) & F.col("rate_6").isNotNull()
    )
    features = kept.withColumns(
        {
            "default_rate_chg_3m": now - F.col("rate_3"),
            "default_rate_chg_6m": now - F.col("rate_6"),
            "early_delinquency_chg_3m": F.col("early_delinquency_rate") - F.col("early_3"),
            "portfolio_growth_6m": scalars.growth(portfolio, F.col("portfolio_6")),
            "avg_balance_per_operation": scalars.safe_divide(
                portfolio, F.col("number_of_operations")
            ),
            "log_active_portfolio": F.log10(portfolio),
            TARGET: scalars.deterioration_target(now, F.col("default_rate_forward"), cfg),
        }
    ).join(
        rate_changes(rates).withColumnRenamed("month_start", "reference_month"),
        "reference_month",
        "left",
    )
    return features.select(
        "segment_id",
        "reference_month",
        *SEGMENT_KEYS,
        "active_portfolio",
        *FEATURES,
        "default_rate_forward",
        TARGET,
    )


FEATURE_SCHEMA = (
    "segment_id string, reference_month date, "
    + ", ".join(f"{c} string" for c in SEGMENT_KEYS)
    + ", active_portfolio double, "
    + ", ".join(f"{c} double" for c in FEATURES)
    + f", default_rate_forward double, {TARGET} int"
)


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """Features from a CSV with a header, columns in any order.

    The target may be written ``1`` or ``1.0``; the month as a date or a timestamp.
    """
    text = spark.read.option("header", True).csv(path)
    wanted = [f.strip().split(" ") for f in FEATURE_SCHEMA.split(",")]
    month = F.substring("reference_month", 1, 10).cast("date").alias("reference_month")
    return text.select(
        *[
            month
            if name == "reference_month"
            else F.col(name).cast("double").cast(kind).alias(name)
            if kind != "string"
            else F.col(name)
            for name, kind in wanted
        ]
    )


def labelled(features: DataFrame) -> DataFrame:
    return features.filter(F.col(TARGET).isNotNull()).withColumn(TARGET, F.col(TARGET).cast("int"))


def latest_month(features: DataFrame) -> DataFrame:
    """Rows of the last month: an equi-join to a one-row maximum."""
    last = features.agg(F.max("reference_month").alias("reference_month"))
    return features.join(last, "reference_month", "left_semi").select(*features.columns)


def panel_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("n_rows"),
        F.count(TARGET).alias("n_labelled"),
        F.countDistinct("segment_id").alias("n_segments"),
        F.min("reference_month").alias("first_month"),
        F.max("reference_month").alias("last_month"),
        F.avg(TARGET).alias("target_mean"),
    )


def target_base_rate(features: DataFrame, low: float = 0.03, high: float = 0.40) -> DataFrame:
    """Share of positive targets and whether it lies in the healthy range."""
    return features.agg(F.avg(TARGET).alias("base_rate")).select(
        "base_rate", F.col("base_rate").between(low, high).alias("is_healthy")
    )
