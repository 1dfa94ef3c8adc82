"""Out-of-time split, two classifiers, validation tables and scoring."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwatch.config import FEATURES, SEGMENT_KEYS, TARGET, EwConfig
from lendwatch.operators import metrics
from lendwatch.operators.features import labelled, latest_month
from lendwatch.operators.ordering import row_numbers
from lendwatch.storage import materialize, shared_folder

# Model names as stored in the validation tables.
LOGISTIC = "Regressão logística (baseline)"
BOOSTING = "Gradient boosting"
MODELS = [LOGISTIC, BOOSTING]

ROW_KEY = ["segment_id", "reference_month"]
WEIGHT = "class_weight"
HELD_OUT = "is_validation"


def oot_split(
    rows: DataFrame, cfg: EwConfig, strict: bool = False
) -> tuple[DataFrame, DataFrame, dt.date, dt.date]:
    """``(train, test, limit, test_start)``: the last labelled months are the test.

    Training months end a full horizon before the test starts, so that the last
    training target is the first test month; ``strict`` ends them a month earlier.
    """
    month = F.col("reference_month")
    last_months = rows.select(month).distinct().orderBy(month.desc()).limit(cfg.n_test_months)
    back = -cfg.horizon_months - int(strict)
    start = F.min(month)
    test_start, limit = last_months.agg(start, F.add_months(start, back)).first()
    if test_start is None or rows.filter(month <= F.lit(limit)).isEmpty():
        raise ValueError(
            f"no labelled month is left for training before {cfg.n_test_months} test months"
        )
    return rows.filter(month <= F.lit(limit)), rows.filter(month >= F.lit(test_start)), limit, test_start


def split_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    parts = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    return parts.groupBy("part").agg(
        F.count("*").alias("n_rows"),
        F.sum(TARGET).alias("n_positive"),
        F.avg(TARGET).alias("base_rate"),
        F.min("reference_month").alias("first_month"),
        F.max("reference_month").alias("last_month"),
    )


FAR = 1e300  # beyond any value of a feature


def _fill(medians: dict[str, float]) -> SQLTransformer:
    """Median imputation as a projection."""
    filled = [f"coalesce({f}, {medians.get(f, 0.0)!r}D) AS {f}_filled" for f in FEATURES]
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def _routed() -> SQLTransformer:
    """Two copies of each feature, with NULL below and with NULL above every value.

    A split of the first copy sends NULL to the left, one of the second to the right, and one at the
    end of either parts NULL from all values. So a tree learns the side of NULL with each split.
    """
    copies = [f"coalesce({f}, {side!r}D) AS {f}_{name}" for f in FEATURES for name, side in (("left", -FAR), ("right", FAR))]
    return SQLTransformer(statement=f"SELECT *, {', '.join(copies)} FROM __THIS__")


ROUTED = [f"{f}_{name}" for f in FEATURES for name in ("left", "right")]


def _logistic(medians: dict[str, float], n: int) -> Pipeline:
    """Standardised by population deviation; L2 of unit strength over the summed loss."""
    to_population = Vectors.dense([(n / max(n - 1, 1)) ** 0.5] * len(FEATURES))
    return Pipeline(
        stages=[
            _fill(medians),
            VectorAssembler(inputCols=[f"{f}_filled" for f in FEATURES], outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
            ElementwiseProduct(inputCol="scaled", outputCol="features", scalingVec=to_population),
            LogisticRegression(
                labelCol=TARGET,
                weightCol=WEIGHT,
                regParam=1.0 / n,
                elasticNetParam=0.0,
                standardization=False,
                maxIter=2000,
            ),
        ]
    )


def _boosting(cfg: EwConfig) -> Pipeline:
    """Boosted trees on features as they are; each split learns where NULL goes."""
    trees = GBTClassifier(
        labelCol=TARGET,
        featuresCol="assembled",
        weightCol=WEIGHT,
        maxDepth=cfg.gbt_depth,
        stepSize=cfg.gbt_rate,
        maxIter=cfg.gbt_iterations,
        minInstancesPerNode=cfg.gbt_min_leaf,
        maxBins=255,
        seed=cfg.seed,
    )
    if cfg.gbt_early_stop:
        trees = trees.setParams(
            validationIndicatorCol=HELD_OUT, validationTol=cfg.gbt_stop_tolerance
        )
    return Pipeline(stages=[_routed(), VectorAssembler(inputCols=ROUTED, outputCol="assembled"), trees])


def medians_of(rows: DataFrame) -> dict[str, float]:
    """Ten numbers: the median of each feature."""
    return {r["feature"]: r["median"] for r in metrics.feature_medians(rows, FEATURES).collect()}


def fit(name: str, rows: DataFrame, cfg: EwConfig, medians: dict[str, float]) -> PipelineModel:
    """Fit one of ``MODELS`` with balanced class weights."""
    shared_folder(rows.sparkSession)
    counts = {r[TARGET]: r["count"] for r in rows.groupBy(TARGET).count().collect()}
    n = sum(counts.values())
    weight = F.when(F.col(TARGET) == 1, n / (2 * counts.get(1, n))).otherwise(
        n / (2 * counts.get(0, n))
    )
    held_out = F.pmod(F.xxhash64(F.lit(cfg.seed), *ROW_KEY), F.lit(cfg.gbt_hold_out)) == 0
    prepared = rows.withColumns({WEIGHT: weight, HELD_OUT: held_out})
    pipeline = _logistic(medians, n) if name == LOGISTIC else _boosting(cfg)
    return pipeline.fit(prepared)


def with_score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` plus ``score``, the probability of deterioration."""
    scored = model.transform(rows)
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("score"))


@dataclass
class Validation:
    """First fits and what the out-of-time test says about them."""

    models: dict[str, PipelineModel]
    scored: dict[str, DataFrame]
    results: dict[str, dict[str, float]]
    train: DataFrame
    test: DataFrame
    limit: dt.date
    test_start: dt.date

    @property
    def best(self) -> str:
        """Highest KS; the first of equals. A test of one class gives no KS, which ranks lowest."""
        ks = {name: found["ks"] for name, found in self.results.items()}
        return max(ks, key=lambda name: float("-inf") if ks[name] is None else ks[name])


def fit_models(features: DataFrame, cfg: EwConfig, strict: bool = False) -> Validation:
    rows = materialize(labelled(features), "labelled")
    train, test, limit, test_start = oot_split(rows, cfg, strict)
    medians = medians_of(train)
    models = {name: fit(name, train, cfg, medians) for name in MODELS}
    scored = {name: materialize(with_score(m, test), "scored") for name, m in models.items()}
    results = {
        name: metrics.binary_metrics(s, TARGET, "score").first().asDict()
        for name, s in scored.items()
    }
    return Validation(models, scored, results, train, test, limit, test_start)


def metrics_table(v: Validation, cfg: EwConfig) -> DataFrame:
    """One row per model with the run's metadata."""
    spark = v.test.sparkSession
    rows = [(m, r["auc"], r["gini"], r["ks"], r["ap"], m == v.best) for m, r in v.results.items()]
    table = spark.createDataFrame(
        rows,
        "model string, roc_auc double, gini double, ks double, pr_auc double, is_selected boolean",
    )
    ends = split_summary(v.train, v.test).collect()
    part = {r["part"]: r for r in ends}
    return table.withColumns(
        {
            "base_rate_train": F.lit(part["train"]["base_rate"]),
            "base_rate_test": F.lit(part["test"]["base_rate"]),
            "train_start": F.lit(part["train"]["first_month"]),
            "train_end": F.lit(v.limit),
            "test_start": F.lit(v.test_start),
            "test_end": F.lit(part["test"]["last_month"]),
            "horizon_months": F.lit(cfg.horizon_months),
            "model_version": F.lit(cfg.model_version),
            "run_date": F.current_timestamp(),
        }
    )


def deciles_table(v: Validation, cfg: EwConfig) -> DataFrame:
    return metrics.decile_lift(v.scored[v.best], TARGET, "score", ROW_KEY).withColumns(
        {
            "model": F.lit(v.best),
            "model_version": F.lit(cfg.model_version),
            "run_date": F.current_timestamp(),
        }
    )


def permutation_importance(
    model: PipelineModel, test: DataFrame, cfg: EwConfig, base: float | None = None
) -> DataFrame:
    """``(feature, queda_de_auc)``: mean loss of AUC when one column is shuffled.

    Every feature and repetition is a group of one distributed job. Within a
    group rows are ranked by a seeded hash, and the row at position ``i`` takes
    the shuffled value from row ``i``. ``base`` is the model's AUC on ``test``, if it is known.
    """
    indexed = materialize(
        row_numbers(test.select(*ROW_KEY, *FEATURES, TARGET), [F.col(c) for c in ROW_KEY], "idx"),
        "indexed",
    )
    # One value a row: what a donor gives is a double, not a row of features.
    values = indexed.select("idx", *FEATURES).unpivot("idx", FEATURES, "feature", "given")
    trials = values.select("idx", "feature").select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(cfg.importance_repeats))).alias("repeat")
    )
    shuffle_key = F.xxhash64(F.lit(cfg.seed), "feature", "repeat", "idx")
    group = ["feature", "repeat"]
    placed = row_numbers(trials, [shuffle_key, F.col("idx")], "donor", group)
    donors = values.withColumnRenamed("idx", "donor")
    given = placed.select("idx", *group, "donor").join(donors, ["donor", "feature"]).drop("donor")
    shuffled = given.join(indexed, "idx").withColumns(
        {f: F.when(F.col("feature") == f, F.col("given")).otherwise(F.col(f)) for f in FEATURES}
    ).select(*group, *FEATURES, TARGET)
    aucs = metrics.binary_metrics(with_score(model, shuffled), TARGET, "score", group)
    if base is None:
        base = metrics.binary_metrics(with_score(model, test), TARGET, "score").first()["auc"]
    return aucs.groupBy("feature").agg((F.lit(base) - F.avg("auc")).alias("queda_de_auc"))


def score_latest(features: DataFrame, v: Validation, cfg: EwConfig) -> DataFrame:
    """Refit the best model on all labelled months and score the last month.

    Band limits come from the out-of-time scores of the first fit.
    """
    rows = labelled(features)
    final = fit(v.best, rows, cfg, medians_of(rows))
    cuts = metrics.risk_cuts(v.scored[v.best], "score", cfg.band_quantiles)
    scored = metrics.assign_bands(with_score(final, latest_month(features)), cuts)
    return scored.select(
        "reference_month",
        "segment_id",
        *SEGMENT_KEYS,
        "active_portfolio",
        "default_rate",
        "early_delinquency_rate",
        "score",
        "risk_band",
        F.lit(cfg.model_version).alias("model_version"),
        F.current_timestamp().alias("scored_at"),
    )


def comparison(v: Validation) -> DataFrame:
    """Metrics of both models, one row each, as DataFrame functions computed them."""
    return reduce(
        DataFrame.unionByName,
        [
            metrics.binary_metrics(s, TARGET, "score").withColumn("model", F.lit(name))
            for name, s in v.scored.items()
        ],
    )
