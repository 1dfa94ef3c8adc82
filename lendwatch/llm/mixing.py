"""Mixing sources to target token weights by entropy balancing, in DataFrame functions only.

Every document gets a rate between 0 and ``max_copies``. Among all rates whose tokens sum to the
targets of their sources, those of least (bounded) entropy distance from the uniform rate are
``max_copies / (1 + exp(-lambda * size))``: an exponential tilt of the odds, one multiplier per
source. The multipliers are the optimum of a convex dual, found by Newton steps whose gradient
and curvature Spark sums over the (source, size) histogram. Rates become whole copies by
systematic rounding.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendwatch.operators.ordering import row_numbers, running_totals
from lendwatch.storage import materialize

WHITE = "[\\x20\\x09-\\x0D]"
UNIT = 1 << 20  # rates are whole numbers of this fraction, so that their sums are exact


@dataclass(frozen=True)
class MixConfig:
    weights: Sequence[float] = (5.0, 2.0, 1.0)
    share: float = 1.5
    max_copies: int = 2
    tolerance: float = 1e-6
    max_steps: int = 60
    mending_rounds: int = 3


def word_count(text: Column) -> Column:
    """Words between white space; each separator run adds one to the pieces of a split."""
    pieces = F.size(F.split(text, WHITE + "+", -1))
    ends = text.rlike("^" + WHITE).cast("int") + text.rlike(WHITE + "$").cast("int")
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(pieces - ends).cast("bigint")


def source_targets(sized: DataFrame, cfg: MixConfig) -> DataFrame:
    """``(source, src, source_size, target, capped)``: weighted targets stopped at their caps.

    Sources in order (NULL last) take the weights in turn. Raising one level, ``target = min(cap,
    level * weight)``, until the whole share is dealt is the same as resharing excess by weight.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = row_numbers(totals, [F.col("source").asc_nulls_last()], "src")
    weight = F.get(F.array(*[F.lit(float(w)) for w in cfg.weights]), ((F.col("src") - 1) % len(cfg.weights)).cast("int"))
    caps = numbered.select(
        "source", "src", "source_size", weight.alias("w"), (F.col("source_size") * cfg.max_copies).alias("cap")
    ).withColumn("fills_at", F.col("cap") / F.col("w"))
    filled = running_totals(caps, [F.col("fills_at"), F.col("src")], {"caps": F.col("cap"), "ws": F.col("w")})
    all_words = F.col("caps_total") / cfg.max_copies
    level = (all_words * cfg.share - F.col("caps") + F.col("cap")) / (F.col("ws_total") - F.col("ws") + F.col("w"))
    row = (
        filled.withColumn("level", level)
        .filter(F.col("level") <= F.col("fills_at"))
        .agg(F.min_by("level", F.struct("fills_at", "src")).alias("level"))
        .first()
    )
    if row.level is None:  # the share asks for more than every cap together
        target = F.col("cap").cast("double")
    else:
        target = F.least(F.col("cap").cast("double"), F.lit(row.level) * F.col("w"))
    return materialize(
        caps.withColumn("target", target).select(
            "source", "src", "source_size", "target", (F.col("target") >= F.col("cap")).alias("capped")
        ),
        "targets",
    )


def _rate(cfg: MixConfig, capped: Column, tilt: Column, size: Column) -> Column:
    # Rounded in the same way wherever a rate is used: reruns agree whatever order sums took.
    free = F.round(F.lit(float(cfg.max_copies)) / (1 + F.exp(-tilt * size)) * UNIT)
    return F.when(capped, F.lit(cfg.max_copies * UNIT)).otherwise(free).cast("bigint")


def tilt_sources(sized: DataFrame, targets: DataFrame, cfg: MixConfig) -> DataFrame:
    """``(src, capped, tilt)``: Newton steps, halved back into the bracket where they leave it."""
    histogram = materialize(sized.groupBy("src", "size").agg(F.count("*").alias("n")), "sizes")
    scale = histogram.groupBy("src").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    state = materialize(
        targets.join(scale, "src").select(
            "src", "target", "capped", F.greatest("mean", F.lit(1.0)).alias("mean"),
            F.lit(0.0).alias("tilt"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"),
            F.lit(None).cast("double").alias("miss"),
        ),
        "tilts",
    )
    exact = "decimal(38,9)"  # sums of decimals do not depend on their order
    for _ in range(cfg.max_steps):
        x = F.col("size") / F.col("mean")
        odds = F.lit(float(cfg.max_copies)) / (1 + F.exp(-F.col("tilt") * x))
        words = F.col("n") * F.col("size")
        sums = (
            histogram.join(state.select("src", "tilt", "mean"), "src")
            .groupBy("src")
            .agg(
                F.sum((words * odds).cast(exact)).cast("double").alias("got"),
                F.sum((words * x * odds * (1 - odds / cfg.max_copies)).cast(exact)).cast("double").alias("slope"),
            )
        )
        gap = F.col("got") - F.col("target")
        low = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        stepped = state.join(sums, "src").withColumns({"low": low, "high": high, "gap": gap})
        newton = F.col("tilt") - F.col("gap") / F.col("slope")
        good = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        miss = F.when(F.col("capped"), 0.0).otherwise(F.abs("gap") / F.greatest("target", F.lit(1.0)))
        done = miss <= cfg.tolerance
        state = materialize(
            stepped.withColumn("miss", miss).withColumn(
                "tilt",
                F.when(done | (F.col("gap") == 0), F.col("tilt")).when(good, newton).otherwise((F.col("low") + F.col("high")) / 2),
            ).select("src", "target", "capped", "mean", "tilt", "low", "high", "miss"),
            "tilts",
        )
        worst = state.agg(F.max("miss").alias("m")).first().m
        if worst is None or worst <= cfg.tolerance:
            break
    return state.select("src", "capped", (F.col("tilt") / F.col("mean")).alias("tilt"))


KEYS = ("doc_id", "source", "__text")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__text", F.xxhash64("text"))


def _planned(sized: DataFrame, cfg: MixConfig) -> DataFrame:
    """Copies for rows ``(doc_id, source, __text, size)``; rows that agree in all keys are one unit."""
    units = materialize(sized.groupBy(*KEYS).agg(F.sum("size").alias("size")), "units")
    targets = source_targets(units.select("source", "size"), cfg)
    known = targets.select(F.col("source").alias("s2"), "src", "source_size", "target")
    wide = units.join(known, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    tilts = tilt_sources(wide.select("src", "size"), targets, cfg)
    rated = wide.join(tilts, "src").withColumn("units", _rate(cfg, F.col("capped"), F.col("tilt"), F.col("size")))
    order = [F.col("size"), F.xxhash64("doc_id", "__text"), F.col("doc_id"), F.col("__text")]
    summed = running_totals(rated, order, {"upto": F.col("units"), "pos": F.lit(1).cast("bigint")}, ["src"])

    def rounded(total: Column) -> Column:
        return F.floor((total + UNIT // 2) / UNIT)

    first = materialize(
        summed.withColumn("copies", (rounded(F.col("upto")) - rounded(F.col("upto") - F.col("units"))).cast("int")),
        "copies",
    )
    return _mended(first, cfg).select(*KEYS, "source_size", "target", (F.col("units") / UNIT).alias("rate"), "copies")


def _joined(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the plan of their unit; NULL keys agree with NULL."""
    other = plan.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(KEYS)], *[F.col(c).alias(f"__{c}") for c in plan.columns[3:]])
    same = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(KEYS)]
    return rows.join(other, same)


def mix(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """Rows of ``docs`` with ``size, source_size, target, rate, copies`` added.

    Added columns replace columns of the same names. A NULL text has size 0; NULL is a source of
    its own, ordered last. Rows that agree in id, source and text get the same number of copies.
    Documents of size 0 may get copies, which take no words. An empty table gives an empty table.
    Copies follow the order size, hash, id, so reruns agree. Texts are read twice and shuffled at
    most once, to meet their copies.
    """
    added = ("size", "source_size", "target", "rate", "copies")
    kept = [c for c in docs.columns if c not in added]
    size = word_count(F.col("text"))
    sized = materialize(_keyed(docs).select(*KEYS, size.alias("size")), "sized")
    rows = _keyed(docs.select(*[F.col(f"`{c}`") for c in kept]))
    return _joined(rows, _planned(sized, cfg)).select(
        *[F.col(f"`{c}`") for c in kept], size.alias("size"), *[F.col(f"__{c}").alias(c) for c in added[1:]]
    )


def _mended(rows: DataFrame, cfg: MixConfig) -> DataFrame:
    """One document per source and round gives or takes a copy where that brings the total nearer.

    Rounding leaves a source off by at most half its largest document. Changing the document
    whose size is nearest to what is missing leaves the distance to that size.
    """
    for _ in range(cfg.mending_rounds):
        # Written first: a table of known size, to which the rows need not be shuffled by source.
        off = materialize(
            rows.groupBy("src").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off")), "off")
        able = F.when(F.col("off") > 0, F.col("copies") < cfg.max_copies).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs("off") - F.col("size"))
        best = (
            rows.select("src", "size", "copies", "pos")
            .join(off, "src")
            .filter(able & (left < F.abs("off")))
            .groupBy("src")
            .agg(F.min(F.struct(left.alias("left"), "pos")).getField("pos").alias("at"), F.first(F.signum("off")).cast("int").alias("by"))
        )
        change = F.when(F.col("pos") == F.col("at"), F.col("by")).otherwise(0)
        rows = materialize(rows.join(materialize(best, "best"), "src", "left").withColumn("copies", F.col("copies") + change).drop("at", "by"), "copies")
    return rows


def mix_report(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """Per document: ``size, source_size, target, taken`` (words, repeats counted), copies and rate."""
    sized = materialize(_keyed(docs).select(*KEYS, word_count(F.col("text")).alias("size")), "sized")
    return _joined(sized, _planned(sized, cfg)).select(
        "doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__copies") * F.col("size")).alias("taken"), F.col("__copies").alias("copies"), F.col("__rate").alias("rate"),
    )


def mixed_documents(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mix itself: each document as many times as it has copies."""
    sized = materialize(_keyed(docs).select(*KEYS, word_count(F.col("text")).alias("size")), "sized")
    plan = _planned(sized, cfg).filter("copies > 0").select(*KEYS, "copies")
    repeated = _joined(_keyed(docs), plan).withColumn("__i", F.explode(F.expr("sequence(1, __copies)")))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
