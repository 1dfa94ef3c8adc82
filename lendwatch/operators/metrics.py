"""Classifier validation: AUC, Gini, KS, average precision, deciles, bands.

All of them come from cumulative class counts along the score, computed with
``running_totals`` so that no task orders the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendwatch.functions.scalars import risk_band
from lendwatch.operators.ordering import exact_quantiles, row_numbers, running_totals


def binary_metrics(
    df: DataFrame, label: str, score: str, within: Sequence[str] = ()
) -> DataFrame:
    """One row (per group): ``auc, gini, ks, ap``.

    Rows with the same score count as one threshold. ``ap`` is the step form:
    precision weighted by the gain in recall.
    """
    by_score = df.groupBy(*within, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    curve = running_totals(
        by_score, [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")}, within
    )
    tp, fp, pos = (F.col(c).cast("double") for c in ("tp", "fp", "pos"))
    p, n = (F.col(c).cast("double") for c in ("tp_total", "fp_total"))
    # A negative is beaten by every positive above it and by half of its ties.
    auc = F.sum(F.try_divide(F.col("neg") * (tp - pos / 2), p * n))
    ks = F.max(F.abs(F.try_divide(tp, p) - F.try_divide(fp, n)))
    ap = F.sum(F.try_divide(pos, p) * F.try_divide(tp, tp + fp))
    return (
        curve.groupBy(*within)
        .agg(auc.alias("auc"), ks.alias("ks"), ap.alias("ap"))
        .select(*within, "auc", (2 * F.col("auc") - 1).alias("gini"), "ks", "ap")
    )


def decile_lift(df: DataFrame, label: str, score: str, tiebreak: Sequence[str]) -> DataFrame:
    """Ten rows: size, positives, rate, cumulative capture and lift."""
    ranked = row_numbers(
        df.select(label, score, *tiebreak), [F.desc(score), *[F.col(c) for c in tiebreak]], "r"
    )
    # Cuts the range of ranks evenly (not ``ntile``); needs at least 10 rows.
    tenth = F.expr("greatest(1, (10 * (r - 1) + r_total - 2) div (r_total - 1))")
    table = ranked.groupBy(tenth.alias("decil")).agg(
        F.count("*").alias("segmentos"), F.sum(label).alias("deterioraram")
    )
    upto = Window.orderBy("decil").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ten_rows = Window.partitionBy()
    positives = F.col("deterioraram")
    rate = positives / F.col("segmentos")
    base_rate = F.sum(positives).over(ten_rows) / F.sum("segmentos").over(ten_rows)
    return table.select(
        "decil",
        "segmentos",
        "deterioraram",
        rate.alias("taxa"),
        F.try_divide(F.sum(positives).over(upto), F.sum(positives).over(ten_rows)).alias(
            "captura_acumulada"
        ),
        F.try_divide(rate, base_rate).alias("lift"),
        base_rate.alias("base_rate"),
    )


def risk_cuts(scored_test: DataFrame, score: str, quantiles: Sequence[float]) -> DataFrame:
    """One row: the score above which the medium and the high band start."""
    return exact_quantiles(scored_test, score, quantiles).select(
        F.col("q0").alias("medium_cut"), F.col("q1").alias("high_cut")
    )


def assign_bands(scores: DataFrame, cuts: DataFrame, score: str = "score") -> DataFrame:
    """Attach ``risk_band``; ``cuts`` is the single row of ``risk_cuts``."""
    row = cuts.first()
    if row is None:
        raise ValueError("no test scores to cut into bands")
    medium, high = row
    return scores.withColumn("risk_band", risk_band(F.col(score), F.lit(medium), F.lit(high)))


def feature_medians(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, median)`` over non-NULL values, all features in one pass."""
    long = train.unpivot([], list(features), "feature", "value")
    return exact_quantiles(long, "value", [0.5], ["feature"]).select(
        "feature", F.col("q0").alias("median")
    )
