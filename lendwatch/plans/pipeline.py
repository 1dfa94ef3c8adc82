"""The monthly job: raw files to served tables, with a gate between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwatch.config import TARGET, EwConfig
from lendwatch.functions.scalars import relabel_unclassified
from lendwatch.operators import quality, serving, star
from lendwatch.operators.features import segment_features, segment_month
from lendwatch.operators.reports import report_by, report_sums, top_k_sectors
from lendwatch.plans import model
from lendwatch.sources import rates as rate_source
from lendwatch.sources import sinks
from lendwatch.storage import materialize


def _table(df: DataFrame, out: str, name: str) -> DataFrame:
    """Store a table and go on from its files."""
    sinks.overwrite(df, f"{out}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/{name}")


def mart_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The twelve checks on dimensions and fact."""
    reports = []
    for name, table in (
        ("modality", "dim_credit_modality"),
        ("client", "dim_client"),
        ("activity", "dim_economic_activity"),
    ):
        key = star.KEYED[name][0]
        reports.append(quality.check_columns(dims[name], table, [quality.not_null(key)]))
        reports.append(quality.check_unique(dims[name], table, [key]))
    # The fact is scanned once: seven checks read its counts by key.
    active = F.col("active_portfolio")
    counts = materialize(
        fact.groupBy(
            "modality_id",
            "client_id",
            active.isNull().alias("missing"),
            (active < 0).alias("negative"),
        ).agg(F.count("*").alias("n")),
        "fact_counts",
    )
    rules = [
        quality.not_null("modality_id"),
        quality.not_null("client_id"),
        ("not_null", "active_portfolio", F.col("missing")),
        ("accepted_range", "active_portfolio", F.col("negative")),
    ]
    table = "fact_credit_operation"
    reports.append(quality.check_columns(counts, table, rules, weight="n"))
    for name in ("modality", "client"):
        key = star.KEYED[name][0]
        reports.append(quality.check_relationship(counts, table, key, dims[name], key, "n"))
    return quality.combine(reports)


def panel_checks(panel: DataFrame) -> DataFrame:
    keys = ["month_start", "state", "credit_modality", "client_type", "client_size"]
    rules = [quality.not_null("active_portfolio"), quality.at_least("active_portfolio", 0)]
    return quality.combine(
        [
            quality.check_unique(panel, "ew_segment_month", keys),
            quality.check_columns(panel, "ew_segment_month", rules),
        ]
    )


def feature_checks(features: DataFrame) -> DataFrame:
    rules = [
        quality.not_null("segment_id"),
        quality.not_null("default_rate"),
        quality.at_least("default_rate", 0),
        quality.accepted_values(TARGET, [0, 1]),
    ]
    return quality.combine(
        [
            quality.check_unique(features, "ew_features", ["segment_id", "reference_month"]),
            quality.check_columns(features, "ew_features", rules),
        ]
    )


def load_rates(daily: DataFrame, out: str, low: float = 2.0, high: float = 15.0) -> DataFrame:
    """Replace the month-end rate table, unless it would be empty or a value is implausible."""
    daily = materialize(daily, "daily-rates")
    table = rate_source.with_provisional(rate_source.month_end_table(daily), daily)
    if table.isEmpty():
        raise ValueError("no rates to load; the stored table is kept")
    rules = [quality.not_null("selic_meta_aa"), quality.between("selic_meta_aa", low, high)]
    quality.gate(quality.check_columns(table, "dim_taxa_selic", rules))
    return _table(table, out, "dim_taxa_selic")


def build_marts(
    bronze: DataFrame, rate_table: DataFrame, out: str, cfg: EwConfig, now: Column
) -> dict[str, DataFrame]:
    """Star schema, reports and features; stops at the first failed gate."""
    quality.gate(
        quality.freshness(
            bronze, "bronze", "data_base", now, cfg.freshness_warn_days, cfg.freshness_error_days
        )
    )
    quality.gate(quality.complete_months(bronze, "bronze", "data_base", "source_file"))
    stg = star.build_staging(bronze)
    dims = star.build_dims(stg)
    for name, table in {
        "date": "dim_date",
        "modality": "dim_credit_modality",
        "client": "dim_client",
        "activity": "dim_economic_activity",
    }.items():
        dims[name] = _table(dims[name], out, table)
    tables = {f"dim_{name}": d for name, d in dims.items()}
    tables["dim_state"] = _table(star.dim_state(stg), out, "dim_state")
    rates = _table(rate_source.dim_rate(rate_table), out, "dim_selic_rate")

    sinks.write_fact(star.build_fact(stg, dims), f"{out}/fact_credit_operation")
    fact = bronze.sparkSession.read.parquet(f"{out}/fact_credit_operation")
    quality.gate(mart_checks(fact, dims))
    quality.gate(quality.reconcile(fact, stg, "fact_credit_operation = staging"))

    # One scan and shuffle of the fact for all reports.
    sums = materialize(report_sums(fact), "report_sums")
    sector = report_by(sums, dims, rates, ["sector"], exact_rate_date=True)
    sector = _table(sector, out, "rpt_sector_default_by_month")
    tables["rpt_sector_default_by_month"] = sector
    tables["rpt_top_sector_default_by_month"] = _table(
        top_k_sectors(sector, cfg.top_sectors), out, "rpt_top_sector_default_by_month"
    )
    tables["rpt_state_default_by_month"] = _table(
        report_by(sums, dims, rates, ["state"]), out, "rpt_state_default_by_month"
    )
    tables["rpt_credit_by_state_sector_month"] = _table(
        report_by(sums, dims, rates, ["state", "sector"], relabel=relabel_unclassified),
        out,
        "rpt_credit_by_state_sector_month",
    )

    panel = _table(segment_month(fact, dims), out, "ew_segment_month")
    quality.gate(panel_checks(panel))
    features = _table(segment_features(panel, rates, cfg), out, "ew_features")
    quality.gate(feature_checks(features))
    return {
        **tables,
        "dim_selic_rate": rates,
        "fact_credit_operation": fact,
        "ew_segment_month": panel,
        "ew_features": features,
    }


def train_and_score(features: DataFrame, out: str, cfg: EwConfig) -> dict[str, DataFrame]:
    """Validate both models out of time, score the last month, keep the history.

    The month's scores replace an earlier run's scores of the same month.
    """
    v = model.fit_models(features, cfg)
    scores = _table(model.score_latest(features, v, cfg), out, "ew_segment_scores")
    sinks.replace_month(scores, f"{out}/ew_segment_scores_history", "reference_month")
    scores_en = _table(serving.label_view(scores), out, "ew_segment_scores_en")
    served = serving.dashboard(features, scores_en)
    return {
        "ew_segment_scores": scores,
        "ew_model_deciles": _table(model.deciles_table(v, cfg), out, "ew_model_deciles"),
        "ew_model_metrics": _table(model.metrics_table(v, cfg), out, "ew_model_metrics"),
        "ew_model_importance": _table(
            model.permutation_importance(v.models[v.best], v.test, cfg, v.results[v.best]["auc"]), out, "ew_model_importance"
        ),
        "ew_segment_scores_en": scores_en,
        **{name: _table(table, out, name) for name, table in served.items()},
    }
