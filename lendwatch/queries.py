"""Registered queries: every operator run over a whole test-data folder.

Amounts are rounded to 4 places and rates to 6 at this edge only, so that sums
of doubles compare equal whatever order they were added in.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch import fixture
from lendwatch.config import FEATURES, SEGMENT_KEYS, TARGET
from lendwatch.functions import parsing, scalars
from lendwatch.operators import features as feature_ops
from lendwatch.operators import metrics, quality, reports, serving, star
from lendwatch.plans import model, pipeline
from lendwatch.schema import AMOUNT_COLUMNS, MEASURES
from lendwatch.sources import archives, discovery, rates, raw_text, sinks
from lendwatch.storage import materialize, new_path
from lendwatch.streaming.incremental import load_incremental

CFG = fixture.CONFIG
ROW_KEY = model.ROW_KEY

_built: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    """Tables several queries share are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def rounded(df: DataFrame, amounts: tuple = (), ratios: tuple = ()) -> DataFrame:
    places = {**{c: 4 for c in amounts}, **{c: 6 for c in ratios}}
    return df.withColumns({c: F.round(F.col(c), p) for c, p in places.items()})


# --- shared inputs ---------------------------------------------------------


def dims_of(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Each dimension is numbered on its own, so those built with others serve as well, the most first."""
    here = (spark.sparkContext.applicationId, sf_dir)
    made = [built for key, built in _built.items() if key[:2] == here and key[2].startswith("dims:")]
    for built in sorted(made, key=len, reverse=True):
        if built.keys() >= set(names):
            return {n: built[n] for n in names}
    columns = {c for n in names if n in star.KEYED for c in star.KEYED[n][1]}
    columns |= {"reference_date"} if "date" in names else set()
    ordered = [c for c in star.STAGING_COLUMNS if c in columns]
    return _once(
        spark,
        sf_dir,
        "dims:" + ",".join(names),
        lambda: star.build_dims(fixture.staging(spark, sf_dir, ordered), names),
    )


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.read_rates(fixture.daily_rate_documents(spark, sf_dir))


def month_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written table, so that joins to it know how small it is."""
    return _once(
        spark,
        sf_dir,
        "rates",
        lambda: materialize(rates.month_end_rates(daily_rates(spark, sf_dir)), "rates"),
    )


def fact_of(spark: SparkSession, sf_dir: str, dims: dict, *columns: str) -> DataFrame:
    """The fact with the keys of ``dims`` and the staging columns named."""
    needed = {c for n in dims if n in star.KEYED for c in star.KEYED[n][1]}
    needed |= {"default_portfolio", "active_portfolio", *columns}
    ordered = [c for c in star.STAGING_COLUMNS if c in needed]
    return star.build_fact(fixture.staging(spark, sf_dir, ordered), dims)


def full_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dims_of(spark, sf_dir, "modality", "client", "activity")
    return star.build_fact(fixture.staging(spark, sf_dir), dims)


def panel_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written table: checks and features read it, none sums the fact again."""

    def build() -> DataFrame:
        dims = dims_of(spark, sf_dir, "modality", "client")
        fact = fact_of(spark, sf_dir, dims, "reference_date", "state", *feature_ops.PANEL_SUMS)
        return materialize(feature_ops.segment_month(fact, dims), "panel")

    return _once(spark, sf_dir, "panel", build)


def features_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_ops.segment_features(
        panel_of(spark, sf_dir), month_rates(spark, sf_dir), CFG
    )


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "features", lambda: materialize(features_of(spark, sf_dir), "features")
    )


def scored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with a deterministic score that has ties."""
    score = F.round("early_delinquency_rate", 4).alias("score")
    return feature_table(spark, sf_dir).select("*", score)


def scored_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_ops.labelled(scored_features(spark, sf_dir))


def scores_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last month's segments with score and band, cut on the out-of-time test."""

    def build() -> DataFrame:
        _, test, _, _ = model.oot_split(scored_labelled(spark, sf_dir), CFG)
        cuts = metrics.risk_cuts(test, "score", CFG.band_quantiles)
        latest = feature_ops.latest_month(scored_features(spark, sf_dir))
        return materialize(metrics.assign_bands(latest, cuts), "scores")

    return _once(spark, sf_dir, "scores", build).select(
        "reference_month",
        "segment_id",
        *SEGMENT_KEYS,
        "active_portfolio",
        "default_rate",
        "early_delinquency_rate",
        "score",
        "risk_band",
    )


def scores_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.label_view(scores_table(spark, sf_dir))


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """Raw monthly text files of the whole fixture."""

    def build() -> str:
        root = new_path(spark, "raw")
        fixture.write_raw_files(fixture.raw_parts(spark, sf_dir), root)
        return root

    return _once(spark, sf_dir, "raw", build)


def validation(spark: SparkSession, sf_dir: str) -> model.Validation:
    return _once(
        spark, sf_dir, "models", lambda: model.fit_models(feature_table(spark, sf_dir), CFG)
    )


def _file_name(path: str) -> Column:
    return F.regexp_extract(path, r"scrdata_[0-9]{6}\.csv", 0)


# --- sources and parsing ---------------------------------------------------


def raw_line_scan(spark, sf_dir):
    lines = raw_text.read_raw_lines(spark, raw_root(spark, sf_dir))
    return lines.groupBy(_file_name("source_file").alias("file")).agg(
        F.count("*").alias("n_lines"),
        F.count_if(parsing.is_header(F.col("value"))).alias("n_headers"),
    )


def raw_header_filter(spark, sf_dir):
    lines = fixture.damaged_lines(spark, sf_dir)
    kept = raw_text.data_lines(lines)
    return kept.groupBy(F.col("source_file").alias("file")).agg(F.count("*").alias("n_lines"))


def csv_parse_typed(spark, sf_dir):
    good, _ = raw_text.parse_lines(fixture.raw_lines(spark, sf_dir))
    return rounded(good, ratios=tuple(AMOUNT_COLUMNS))


def csv_quarantine_counts(spark, sf_dir):
    parsed = raw_text.parse_rows(fixture.damaged_lines(spark, sf_dir))
    counted = parsed.groupBy(F.coalesce("reason", F.lit("ok")).alias("outcome")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.when(~F.col("rejected"), F.col("carteira_ativa"))).alias("active"),
        F.sum(F.when(~F.col("rejected"), F.col("numero_de_operacoes"))).alias("operations"),
        F.count_if(F.col("cnae_ocupacao") == 'x "q" ; y').alias("n_unquoted"),
    )
    return rounded(counted, amounts=("active",))


def _variants(choices: dict[int, Column], usual: Column) -> Column:
    quantity = F.col("l_quantity").cast("int")
    chain = reduce(lambda c, kv: c.when(quantity == kv[0], kv[1]), choices.items(), F)
    return chain.otherwise(usual)


def parse_br_number(spark, sf_dir):
    printed = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    text = _variants(
        {
            1: F.lit(""),
            2: F.lit("NA"),
            3: F.lit(" null\t"),
            4: F.lit("-"),
            5: F.lit("abc"),
            6: F.lit("1,2,3"),
            7: F.lit("1d"),
            8: F.lit("NaN"),
            9: F.lit("Infinity"),
            10: F.lit("1,5e3"),
            11: F.lit("1_000"),
            12: F.lit("_1"),
            13: F.lit("1e999"),
            14: F.concat(F.lit("-"), printed),
            15: F.concat(F.lit("  +"), printed, F.lit(" ")),
            16: F.lit(",5"),
            17: F.lit("--1"),
            18: F.lit("- 1"),
        },
        printed,
    )
    return _parsed_amounts(fixture.line_items(spark, sf_dir), text)


def _parsed_amounts(rows, text):
    out = (
        rows.select("l_quantity", parsing.br_number(text).alias("v"))
        .groupBy(F.col("l_quantity").cast("int").alias("variant"))
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("v").isNull()).alias("n_rejected"),
            F.sum("v").alias("total"),
        )
    )
    return rounded(out, amounts=("total",))


def parse_reference_date(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    text = _variants(
        {
            1: F.date_format(day, "yyyyMM"),
            2: F.date_format(day, "yyyyMMdd"),
            3: F.concat(F.lit(" "), day.cast("string"), F.lit("\t")),
            4: F.concat(F.substring(day.cast("string"), 1, 4), F.lit("-13-45")),
            5: F.lit("2025-1-31"),
            6: F.date_format(day, "dd/MM/yyyy"),
            7: F.lit(""),
            8: F.lit("202513"),
            9: F.lit("2025-02-30"),
        },
        day.cast("string"),
    )
    parsed = fixture.line_items(spark, sf_dir).select(
        F.col("l_quantity").cast("int").alias("variant"),
        parsing.reference_date(text).alias("lenient"),
        parsing.reference_date(text, strict_iso=True).alias("strict"),
    )
    return parsed.groupBy("variant").agg(
        F.count("*").alias("n_rows"),
        F.count("lenient").alias("n_lenient"),
        F.count("strict").alias("n_strict"),
        F.min("lenient").alias("first_day"),
        F.max("lenient").alias("last_day"),
    )


def parse_operation_count(spark, sf_dir):
    number = F.col("l_partkey").cast("string")
    text = _variants(
        {
            1: F.lit(""),
            2: F.lit(" "),
            3: F.lit("1.234"),
            4: F.concat(F.lit(" "), number, F.lit(" ")),
            5: F.concat(F.lit("-"), number),
            6: F.concat(F.lit("+"), number),
            7: F.lit("1_000"),
            8: F.lit("1e3"),
            9: F.lit("99999999999999999999"),
            10: F.lit("1-2"),
        },
        number,
    )
    return (
        fixture.line_items(spark, sf_dir)
        .select(
            F.col("l_quantity").cast("int").alias("variant"),
            parsing.operation_count(text).alias("v"),
        )
        .groupBy("variant")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("v").isNull()).alias("n_rejected"),
            F.sum("v").alias("total"),
        )
    )


def _loads(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(_file_name("source_file").alias("file")).agg(
        F.count("*").alias("n_rows"),
        F.min("data_base").alias("first_day"),
        F.max("data_base").alias("last_day"),
    )


def rows_per_source_file(spark, sf_dir):
    good, _ = raw_text.parse_lines(raw_text.read_raw_lines(spark, raw_root(spark, sf_dir)))
    return _loads(good)


def sample_preview(spark, sf_dir):
    drawn = raw_text.preview(raw_text.parse_rows(fixture.raw_lines(spark, sf_dir)), 5, seed=7)
    return rounded(drawn, ratios=tuple(AMOUNT_COLUMNS))


def zip_members_to_lines(spark, sf_dir):
    paths = _once(
        spark,
        sf_dir,
        "archives",
        lambda: fixture.write_archives(
            fixture.raw_lines(spark, sf_dir), new_path(spark, "archives")
        ),
    )
    lines = archives.explode_archives(spark, paths)
    return lines.groupBy(F.col("member").alias("file")).agg(
        F.count("*").alias("n_lines")
    )


def incremental_new_files(spark, sf_dir):
    def build() -> DataFrame:
        stg = fixture.staging(spark, sf_dir, ["reference_date"])
        files = stg.select(fixture.file_name().alias("source_file")).distinct()
        return materialize(files, "files")

    available = _once(spark, sf_dir, "files", build)
    loaded = available.filter(F.col("source_file") < "scrdata_200001.csv")
    month = discovery.target_month(F.lit(dt.date(2001, 1, 15)))
    target = discovery.new_files(available, loaded, month).withColumn("is_target", F.lit(True))
    return (
        discovery.new_files(available, loaded)
        .join(target, "source_file", "left")
        .select("source_file", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    )


def rate_json_parse(spark, sf_dir):
    return daily_rates(spark, sf_dir)


def year_pruned_scan(spark, sf_dir):
    lines = raw_text.read_raw_lines(spark, raw_root(spark, sf_dir), years=[1996, 1997])
    return _loads(raw_text.parse_lines(lines)[0])


# --- sinks -----------------------------------------------------------------


def append_idempotent(spark, sf_dir):
    """Load every file, then offer them all again."""

    def build() -> str:
        path = new_path(spark, "bronze")
        for _ in range(2):
            sinks.append_new_files(spark, raw_root(spark, sf_dir), path)
        return path

    return _loads(sinks.read_bronze(spark, _once(spark, sf_dir, "appended", build)))


def incremental_stream_load(spark, sf_dir):
    """Run the file stream, then run it again with nothing new."""

    def build() -> str:
        path, checkpoint = new_path(spark, "stream"), new_path(spark, "stream-checkpoint")
        for _ in range(2):
            load_incremental(spark, raw_root(spark, sf_dir), path, checkpoint)
        return path

    return _loads(sinks.read_bronze(spark, _once(spark, sf_dir, "streamed", build)))


def history_replace_month(spark, sf_dir):
    """Store every month's scores, then store the months from 2000 again, doubled."""

    def build() -> str:
        path = new_path(spark, "history")
        scores = scored_features(spark, sf_dir).select("reference_month", "segment_id", "score")
        sinks.replace_month(scores, path, "reference_month")
        again = scores.filter(F.col("reference_month") >= "2000-01-01")
        sinks.replace_month(
            again.withColumn("score", F.col("score") * 2), path, "reference_month"
        )
        return path

    stored = spark.read.parquet(_once(spark, sf_dir, "history", build))
    out = stored.groupBy("reference_month").agg(
        F.count("*").alias("n_rows"), F.sum("score").alias("score_total")
    )
    return rounded(out, amounts=("score_total",))


def fact_partition_pruned(spark, sf_dir):
    """One year of the stored fact: other dates' folders are not opened."""

    def build() -> str:
        path = new_path(spark, "fact")
        sinks.write_fact(full_fact(spark, sf_dir), path)
        return path

    fact = spark.read.parquet(_once(spark, sf_dir, "fact", build))
    year = fact.filter(F.col("reference_date").between("1998-01-01", "1998-12-31"))
    out = year.groupBy("reference_date", "state").agg(
        F.count("*").alias("n_rows"), F.sum("active_portfolio").alias("active_portfolio")
    )
    return rounded(out, amounts=("active_portfolio",))


# --- staging, dimensions, fact ---------------------------------------------


def stg_projection(spark, sf_dir):
    """Staging from the typed rows of the raw lines."""
    good, _ = raw_text.parse_lines(fixture.raw_lines(spark, sf_dir))
    return rounded(star.build_staging(good), ratios=tuple(MEASURES[1:]))


def dim_date(spark, sf_dir):
    return star.dim_date(fixture.staging(spark, sf_dir, ["reference_date"]))


def dim_state(spark, sf_dir):
    return star.dim_state(fixture.staging(spark, sf_dir, ["state"]))


def _keyed(name: str):
    def query(spark, sf_dir):
        return star.keyed_dim(fixture.staging(spark, sf_dir, star.KEYED[name][1]), name)

    return query


def dim_rate(spark, sf_dir):
    return rates.dim_rate(rates.month_end_table(daily_rates(spark, sf_dir)))


def fact_credit_operation(spark, sf_dir):
    return rounded(
        full_fact(spark, sf_dir), ratios=(*MEASURES[1:], "default_rate")
    )


# --- reports ---------------------------------------------------------------


def _report(spark, sf_dir, keys, **options):
    names = ("date", "activity") if "sector" in keys else ("date",)
    dims = dims_of(spark, sf_dir, *names)
    columns = ["reference_date", *reports.SUMS, *(["state"] if "state" in keys else [])]
    fact = fact_of(spark, sf_dir, dims, *columns)
    return reports.report_by(fact, dims, month_rates(spark, sf_dir), keys, **options)


def _report_edge(report):
    return rounded(
        report, ("active_portfolio_total", "default_portfolio_total"), ("default_rate",)
    )


def rpt_state_default_by_month(spark, sf_dir):
    return _report_edge(_report(spark, sf_dir, ["state"]))


def rpt_sector_default_by_month(spark, sf_dir):
    return _report_edge(_report(spark, sf_dir, ["sector"], exact_rate_date=True))


def rpt_credit_by_state_sector_month(spark, sf_dir):
    return _report_edge(
        _report(spark, sf_dir, ["state", "sector"], relabel=scalars.relabel_unclassified)
    )


def rpt_top_sector_default_by_month(spark, sf_dir):
    report = _report(spark, sf_dir, ["sector"], exact_rate_date=True)
    return _report_edge(reports.top_k_sectors(report, CFG.top_sectors))


def rate_month_end(spark, sf_dir):
    return rates.month_end_table(daily_rates(spark, sf_dir))


def rate_by_month(spark, sf_dir):
    return rounded(rates.rate_by_month(month_rates(spark, sf_dir)), ratios=("selic_rate",))


# --- features --------------------------------------------------------------


def ew_segment_month(spark, sf_dir):
    return rounded(
        panel_of(spark, sf_dir),
        ("active_portfolio", "default_portfolio", "overdue_15_to_90_balance"),
    )


def _feature_edge(features: DataFrame) -> DataFrame:
    """Balances per operation often end in a decimal tie, so they keep 24 bits instead."""
    balance = "avg_balance_per_operation"
    ratios = tuple(c for c in FEATURES if c != balance)
    kept = features.withColumn(balance, F.col(balance).cast("float").cast("double"))
    return rounded(kept, ("active_portfolio",), (*ratios, "default_rate_forward"))


def ew_features(spark, sf_dir):
    return _feature_edge(features_of(spark, sf_dir))


def ew_labelled(spark, sf_dir):
    return feature_ops.labelled(feature_table(spark, sf_dir)).select(*ROW_KEY, TARGET)


def latest_month_population(spark, sf_dir):
    return _feature_edge(feature_ops.latest_month(feature_table(spark, sf_dir)))


def panel_summary(spark, sf_dir):
    return rounded(
        feature_ops.panel_summary(feature_table(spark, sf_dir)), ratios=("target_mean",)
    )


def target_base_rate(spark, sf_dir):
    return rounded(
        feature_ops.target_base_rate(feature_table(spark, sf_dir)), ratios=("base_rate",)
    )


# --- scalar functions ------------------------------------------------------


def scalar_safe_divide(spark, sf_dir):
    stg = fixture.staging(spark, sf_dir, ["state", "active_portfolio", "default_portfolio"])
    share = scalars.safe_divide(F.col("default_portfolio"), F.col("active_portfolio"))
    grown = scalars.growth(
        F.col("default_portfolio"), F.nullif(F.col("active_portfolio"), F.lit(0.0))
    )
    out = (
        stg.select("state", share.alias("share"), grown.alias("grown"))
        .groupBy("state")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("share").alias("n_share"),
            F.sum("share").alias("share_total"),
            F.sum(F.coalesce("grown", F.lit(0.0))).alias("growth_total"),
        )
    )
    return rounded(out, ("share_total", "growth_total"))


def scalar_calendar(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    days = fixture.table(spark, sf_dir, "orders").select(day.alias("day")).distinct()
    first = scalars.month_start(F.col("day"))
    return days.select(
        "day",
        first.alias("month_start"),
        F.add_months(first, -6).alias("six_before"),
        F.add_months(first, 6).alias("six_after"),
        F.last_day("day").alias("month_end"),
        F.year("day").cast("bigint").alias("year"),
        F.month("day").cast("bigint").alias("month"),
        F.quarter("day").cast("bigint").alias("quarter"),
        F.datediff(F.lit(dt.date(2002, 1, 1)), "day").cast("bigint").alias("age_days"),
        F.size(F.sequence(first, F.add_months(first, 5), F.expr("interval 1 month")))
        .cast("bigint")
        .alias("n_months"),
    )


_SAMPLE_MODALITIES = [
    "Financiamentos rurais e agroindustriais",
    "Outros créditos",
    "Empréstimos",
    "Financiamentos",
    "Financiamentos à exportação",
    "Outros",
    "Consórcio",
]
_SAMPLE_SIZES = [
    "Sem rendimento",
    "Mais de 1 a 2 salários mínimos",
    "Acima de 20 salários mínimos",
    "Médio",
    "Até 1 salário mínimo",
    "Gigante",
]


def _nth(values: list[str], n: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[n]


def scalar_label_case(spark, sf_dir):
    items = fixture.line_items(spark, sf_dir)
    raw = items.select(
        _nth(_SAMPLE_MODALITIES, F.col("l_partkey") % 7).alias("credit_modality"),
        _nth(["PF", "PJ", "XX"], F.col("l_partkey") % 3).alias("client_type"),
        _nth(_SAMPLE_SIZES, F.col("l_suppkey") % 6).alias("client_size"),
        _nth(["Alto", "Médio", "Baixo", "Nulo"], F.col("l_suppkey") % 4).alias("risk_band"),
    )
    raw = raw.withColumns(
        {
            "sector": scalars.relabel_unclassified(F.col("credit_modality")),
            "segment_id": scalars.segment_id(
                F.nullif(F.col("client_type"), F.lit("XX")), F.col("client_size")
            ),
        }
    )
    return serving.label_view(raw).groupBy(*raw.columns).agg(F.count("*").alias("n_rows"))


def scalar_target_rule(spark, sf_dir):
    """Target and band from each line's discount (rate) and tax (forward rate)."""
    items = fixture.line_items(spark, sf_dir)
    rate = F.col("l_discount")
    forward = F.when(F.col("l_quantity") > 5, F.col("l_tax"))
    target = scalars.deterioration_target(rate, forward, CFG)
    band = scalars.risk_band(rate, F.lit(0.05), F.lit(0.09))
    return items.groupBy(target.alias("target"), band.alias("band")).agg(
        F.count("*").alias("n_rows")
    )


# --- validation ------------------------------------------------------------


def ks_auc_ap(spark, sf_dir):
    found = metrics.binary_metrics(scored_labelled(spark, sf_dir), TARGET, "score")
    return rounded(found, ratios=("auc", "gini", "ks", "ap"))


def decile_lift(spark, sf_dir):
    table = metrics.decile_lift(scored_labelled(spark, sf_dir), TARGET, "score", ROW_KEY)
    return rounded(table, ratios=("taxa", "captura_acumulada", "lift", "base_rate"))


def feature_medians(spark, sf_dir):
    train, _, _, _ = model.oot_split(scored_labelled(spark, sf_dir), CFG)
    return rounded(metrics.feature_medians(train, FEATURES), amounts=("median",))


def risk_band_cuts(spark, sf_dir):
    _, test, _, _ = model.oot_split(scored_labelled(spark, sf_dir), CFG)
    cuts = metrics.risk_cuts(test, "score", CFG.band_quantiles)
    return rounded(cuts, ratios=("medium_cut", "high_cut"))


def risk_bands(spark, sf_dir):
    return scores_table(spark, sf_dir).select(*ROW_KEY, "score", "risk_band")


def oot_split(spark, sf_dir):
    rows = scored_labelled(spark, sf_dir)
    train, test, limit, test_start = model.oot_split(rows, CFG)
    summary = model.split_summary(train, test).withColumns(
        {"train_limit": F.lit(limit), "test_start": F.lit(test_start)}
    )
    return rounded(summary, ratios=("base_rate",))


def _fitted(name: str):
    def query(spark, sf_dir):
        v = validation(spark, sf_dir)
        return model.comparison(v).filter(F.col("model") == name)

    return query


def model_metrics_table(spark, sf_dir):
    return model.metrics_table(validation(spark, sf_dir), CFG)


def model_deciles_table(spark, sf_dir):
    return model.deciles_table(validation(spark, sf_dir), CFG)


def permutation_importance(spark, sf_dir):
    v = validation(spark, sf_dir)
    return model.permutation_importance(v.models[v.best], v.test, CFG)


def score_latest(spark, sf_dir):
    return model.score_latest(feature_table(spark, sf_dir), validation(spark, sf_dir), CFG)


# --- quality ---------------------------------------------------------------


def dq_report(spark, sf_dir):
    """All twenty checks on dimensions, fact, panel and features."""
    dims = dims_of(spark, sf_dir, "modality", "client", "activity")
    panel = panel_of(spark, sf_dir)
    return quality.combine(
        [
            pipeline.mart_checks(full_fact(spark, sf_dir), dims),
            pipeline.panel_checks(panel),
            pipeline.feature_checks(feature_table(spark, sf_dir)),
        ]
    )


def dq_relationships(spark, sf_dir):
    """Against a dimension without its first ten members: orphans appear."""
    dims = dims_of(spark, sf_dir, "modality", "client", "activity")
    fact = full_fact(spark, sf_dir)
    short = dims["modality"].filter(F.col("modality_id") > 10)
    table = "fact_credit_operation"
    return quality.combine(
        [
            quality.check_relationship(fact, table, "modality_id", short, "modality_id"),
            quality.check_relationship(fact, table, "client_id", dims["client"], "client_id"),
        ]
    )


def dq_unique_combo(spark, sf_dir):
    features = feature_table(spark, sf_dir)
    return quality.combine(
        [
            quality.check_unique(features, "ew_features", ["segment_id", "reference_month"]),
            quality.check_unique(features, "ew_features", ["state", "reference_month"]),
            quality.check_unique(features, "ew_features", ["reference_month"]),
        ]
    )


def source_freshness(spark, sf_dir):
    stg = fixture.staging(spark, sf_dir, ["reference_date"])
    days = [dt.date(2001, 12, 15), dt.date(2002, 2, 15), dt.date(2002, 6, 1)]
    return quality.combine(
        [
            quality.freshness(stg, f"stg@{day}", "reference_date", F.lit(day), 60, 90)
            for day in days
        ]
    )


def dq_gate_status(spark, sf_dir):
    report = quality.combine([dq_unique_combo(spark, sf_dir), source_freshness(spark, sf_dir)])
    return quality.gate_status(report)


def dq_reconciliation(spark, sf_dir):
    """Fact against staging, and the rows the sector reports leave out."""
    stg = fixture.staging(spark, sf_dir)
    fact = full_fact(spark, sf_dir)
    with_sector = fact.filter(F.col("economic_activity_id").isNotNull())
    return quality.combine(
        [
            quality.reconcile(fact, stg, "fact = staging"),
            quality.reconcile(fact, with_sector, "fact = sector rows"),
        ]
    )


def month_completeness(spark, sf_dir):
    """March 1997 is filed under April, so one month is missing and one is double."""
    stg = fixture.staging(spark, sf_dir, ["reference_date"])
    moved = F.when(
        F.col("reference_date") == "1997-03-31", F.lit(dt.date(1997, 4, 30))
    ).otherwise(F.col("reference_date"))
    rows = stg.select(moved.alias("data_base"), fixture.file_name().alias("source_file"))
    return quality.month_gaps(rows, "data_base", "source_file")


def rate_provisional_flag(spark, sf_dir):
    return rates.provisional_flag(daily_rates(spark, sf_dir))


def rate_changes_as_of(spark, sf_dir):
    """Half-year changes as they stood on a day in mid-month: the open month has none."""
    known = rates.known_on(daily_rates(spark, sf_dir), F.lit(dt.date(1997, 5, 17)))
    table = rates.dim_rate(rates.with_provisional(rates.month_end_table(known), known))
    return rounded(rates.rate_changes(table), ratios=("selic_rate", "selic_chg_6m"))


def rate_intervals(spark, sf_dir):
    return rates.rate_intervals(daily_rates(spark, sf_dir))


# --- serving ---------------------------------------------------------------


def label_translation(spark, sf_dir):
    return rounded(
        scores_en(spark, sf_dir),
        ("active_portfolio",),
        ("default_rate", "early_delinquency_rate"),
    )


def band_trend(spark, sf_dir):
    trend = serving.band_trend(feature_table(spark, sf_dir), scores_en(spark, sf_dir))
    return rounded(trend, ("active_portfolio",), ("default_rate", "early_delinquency_rate"))


_SHARES = (("high_risk_portfolio",), ("high_risk_share",))


def kpi_high_risk(spark, sf_dir):
    return rounded(serving.kpis(scores_en(spark, sf_dir)), *_SHARES)


def state_high_risk_share(spark, sf_dir):
    return rounded(serving.state_share(scores_en(spark, sf_dir)), *_SHARES)


def high_risk_breakdown(spark, sf_dir):
    by = serving.breakdown(scores_en(spark, sf_dir), ["client_type", "credit_modality"])
    return rounded(by, _SHARES[0])


def watchlist_top(spark, sf_dir):
    top = serving.watchlist(scores_en(spark, sf_dir), 10, client_type="Businesses")
    return rounded(
        top.select("segment_id", "default_rate", "early_delinquency_rate", "score", "risk_band"),
        ratios=("default_rate", "early_delinquency_rate"),
    )


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        raw_line_scan,
        raw_header_filter,
        csv_parse_typed,
        csv_quarantine_counts,
        parse_br_number,
        parse_reference_date,
        parse_operation_count,
        rows_per_source_file,
        sample_preview,
        zip_members_to_lines,
        incremental_new_files,
        rate_json_parse,
        year_pruned_scan,
        append_idempotent,
        incremental_stream_load,
        history_replace_month,
        fact_partition_pruned,
        stg_projection,
        dim_date,
        dim_state,
        dim_rate,
        fact_credit_operation,
        rpt_state_default_by_month,
        rpt_sector_default_by_month,
        rpt_credit_by_state_sector_month,
        rpt_top_sector_default_by_month,
        rate_month_end,
        rate_by_month,
        ew_segment_month,
        ew_features,
        ew_labelled,
        latest_month_population,
        panel_summary,
        target_base_rate,
        scalar_safe_divide,
        scalar_calendar,
        scalar_label_case,
        scalar_target_rule,
        ks_auc_ap,
        decile_lift,
        feature_medians,
        risk_band_cuts,
        risk_bands,
        oot_split,
        model_metrics_table,
        model_deciles_table,
        permutation_importance,
        score_latest,
        dq_report,
        dq_relationships,
        dq_unique_combo,
        source_freshness,
        dq_gate_status,
        dq_reconciliation,
        month_completeness,
        rate_provisional_flag,
        rate_changes_as_of,
        rate_intervals,
        label_translation,
        band_trend,
        kpi_high_risk,
        state_high_risk_share,
        high_risk_breakdown,
        watchlist_top,
    )
}
REGISTRY["dim_client"] = _keyed("client")
REGISTRY["dim_credit_modality"] = _keyed("modality")
REGISTRY["dim_economic_activity"] = _keyed("activity")
REGISTRY["train_logistic"] = _fitted(model.LOGISTIC)
REGISTRY["train_gbt"] = _fitted(model.BOOSTING)
