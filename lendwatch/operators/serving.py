"""Tables behind the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwatch.functions.labels import (
    BAND_LABELS,
    BANDS,
    CLIENT_SIZE_LABELS,
    CLIENT_TYPE_LABELS,
    MODALITY_LABELS,
    translate_label,
)
from lendwatch.storage import materialize

BREAKDOWN_COLUMNS = ("credit_modality", "client_type", "client_size")


def label_view(scores: DataFrame) -> DataFrame:
    """Scores with English labels."""
    labels = {
        "credit_modality": MODALITY_LABELS,
        "client_type": CLIENT_TYPE_LABELS,
        "client_size": CLIENT_SIZE_LABELS,
        "risk_band": BAND_LABELS,
    }
    return scores.withColumns({c: translate_label(F.col(c), ls) for c, ls in labels.items()})


def band_trend(features: DataFrame, scores_en: DataFrame, future_months: int = 6) -> DataFrame:
    """Weighted rates by month and *current* band, then empty months to come.

    Today's band is applied to a segment's whole history: a look back, not a
    backtest.
    """
    weight = F.col("active_portfolio")

    def weighted(rate: str):
        return F.try_divide(F.sum(F.col(rate) * weight), F.sum(weight)).cast("double").alias(rate)

    history = (
        features.join(scores_en.select("segment_id", "risk_band"), "segment_id")
        .groupBy("reference_month", "risk_band")
        .agg(
            weighted("default_rate"),
            weighted("early_delinquency_rate"),
            F.sum(weight).cast("double").alias("active_portfolio"),
        )
        .withColumn("is_forecast_window", F.lit(False))
    )
    # A few rows, read twice: for the trend and for its last month.
    history = materialize(history, "band_history")
    last = history.agg(F.max("reference_month").alias("mx"))
    months = F.sequence(
        F.add_months("mx", 1), F.add_months("mx", future_months), F.expr("interval 1 month")
    )
    nothing = F.lit(None).cast("double")
    future = (
        last.select(F.explode(months).alias("reference_month"))
        .withColumn("risk_band", F.explode(F.array(*[F.lit(b) for b in BANDS])))
        .select(
            "reference_month",
            "risk_band",
            nothing.alias("default_rate"),
            nothing.alias("early_delinquency_rate"),
            nothing.alias("active_portfolio"),
            F.lit(True).alias("is_forecast_window"),
        )
    )
    return history.unionByName(future)


def _high_portfolio():
    return F.sum(F.when(F.col("risk_band") == "High", F.col("active_portfolio")).otherwise(0.0))


def _shares():
    return [
        F.count_if(F.col("risk_band") == "High").alias("high_risk_segments"),
        _high_portfolio().alias("high_risk_portfolio"),
        F.try_divide(_high_portfolio(), F.sum("active_portfolio")).alias("high_risk_share"),
    ]


def kpis(scores_en: DataFrame) -> DataFrame:
    return scores_en.agg(F.count("*").alias("segments"), *_shares())


def state_share(scores_en: DataFrame) -> DataFrame:
    """Share of each state's portfolio that lies in high-risk segments."""
    return scores_en.groupBy("state").agg(*_shares())


def breakdown(scores_en: DataFrame, by: Sequence[str]) -> DataFrame:
    """High-risk portfolio by each column of ``by``, as ``(dimension, value)`` rows."""
    lines = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in by]
    )
    long = scores_en.select("risk_band", "active_portfolio", F.inline(lines))
    return long.groupBy("dimension", "value").agg(*_shares()[:2])


def watchlist(scores: DataFrame, n: int = 10, **equals: str) -> DataFrame:
    """The ``n`` highest scores, optionally for one product, type, size or band."""
    for column, value in equals.items():
        scores = scores.filter(F.col(column) == value)
    return scores.orderBy(F.desc("score"), "segment_id").limit(n)


def dashboard(features: DataFrame, scores_en: DataFrame) -> dict[str, DataFrame]:
    """The tables of the dashboard besides the scores, by name."""
    return {
        "ew_flagged_trend": band_trend(features, scores_en),
        "ew_kpis": kpis(scores_en),
        "ew_state_share": state_share(scores_en),
        "ew_high_risk_breakdown": breakdown(scores_en, BREAKDOWN_COLUMNS),
        "ew_watchlist": watchlist(scores_en),
    }
