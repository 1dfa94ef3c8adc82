"""Running totals, row numbers and exact quantiles over a global order.

A window without ``partitionBy`` would sort the whole input in one task. Here
rows are range-partitioned by the order and written once, so that every slice
has a fixed number; the running total is then the total of the slices before it
plus a window inside the slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwatch.storage import materialize


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    totals: dict[str, Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums, named by ``totals``, along ``order_by``.

    ``order_by`` must be a total order within each ``within`` group. A group
    larger than a slice spans several slices, so no task holds a whole group.
    Each sum also comes with its group total, as ``<name>_total``.
    """
    inputs = {f"__{name}": expr for name, expr in totals.items()}
    groups = [F.col(c) for c in within]
    sliced = materialize(
        df.withColumns(inputs)
        .repartitionByRange(*groups, *order_by)
        .withColumn("__slice", F.spark_partition_id()),
        "ordered",
    )
    # One row per slice and group: at most one more per group than shuffle partitions.
    before = (
        Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*groups)
    offsets = (
        sliced.groupBy(*within, "__slice")
        .agg(*[F.sum(c).alias(c) for c in inputs])
        .select(
            *within,
            "__slice",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in inputs],
            *[F.sum(f"__{name}").over(whole).alias(f"{name}_total") for name in totals],
        )
    )
    inside = Window.partitionBy(*groups, "__slice").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # NULL is a group like any other, so groups are compared with NULL equal to NULL.
    keys = [*within, "__slice"]
    offsets = offsets.select(
        *[F.col(c).alias(f"__of_{c}") for c in keys],
        *[c for c in offsets.columns if c not in keys],
    )
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in keys]
    joined = sliced.join(offsets, same)
    summed = joined.withColumns(
        {name: F.sum(f"__{name}").over(inside) + F.col(f"__{name}_before") for name in totals}
    )
    return summed.select(*df.columns, *totals, *[f"{name}_total" for name in totals])


def row_numbers(
    df: DataFrame, order_by: Sequence[Column], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Dense 1-based positions along a total order, and ``<name>_total`` rows."""
    return running_totals(df, order_by, {name: F.lit(1).cast("bigint")}, within)


_BRACKET = 0.002  # ranks on either side of a quantile that are looked at, as a part of all
_ACCURACY = 10_000  # of the sketch: its ranks are off by one part in so many at most


def _beside(df: DataFrame, groups: DataFrame, name: str, within: Sequence[str]) -> DataFrame:
    """``df`` with its group's value of ``name``; without groups a few numbers, which pass as literals."""
    if within:
        sides = groups.select(*[F.col(c).alias(f"__of_{c}") for c in within], name)
        return df.join(sides, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in within])
    kind = groups.schema[name].dataType
    found = groups.select(F.to_json(F.struct(name)).alias("j")).first().j
    return df.withColumn(name, F.from_json(F.lit(found), T.StructType([T.StructField(name, kind)]))[name])


def _brackets(df: DataFrame, value: str, probabilities: Sequence[float], within: Sequence[str]) -> DataFrame:
    """``(within…, i, q, total, low, high, below)``: values between which each quantile lies.

    A mergeable sketch names the two values; a scan then counts the values below ``low`` and those up
    to ``high``. Should the wanted ranks lie outside, the bracket is opened: NULL bounds nothing.
    """
    ends = [p for q in probabilities for p in (max(q - _BRACKET, 0.0), min(q + _BRACKET, 1.0))]
    sketch = materialize(
        df.groupBy(*within).agg(
            F.count("*").alias("total"), F.percentile_approx(value, [float(p) for p in ends], F.lit(_ACCURACY)).alias("ends")),
        "sketch",
    )
    lines = [
        F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q"), F.col("ends")[2 * i].alias("low"), F.col("ends")[2 * i + 1].alias("high"))
        for i, q in enumerate(probabilities)
    ]
    guessed = sketch.select(*within, "total", F.inline(F.array(*lines)))
    met = _beside(df, sketch, "ends", within)
    counted = met.groupBy(*within).agg(
        *[F.count_if(F.col(value) < F.col("ends")[2 * i]).alias(f"below{i}") for i in range(len(probabilities))],
        *[F.count_if(F.col(value) <= F.col("ends")[2 * i + 1]).alias(f"upto{i}") for i in range(len(probabilities))])
    counts = counted.select(*within, F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"below{i}").alias("below"), F.col(f"upto{i}").alias("upto")) for i in range(len(probabilities))])))
    counts = counts.select(*[F.col(c).alias(f"__of_{c}") for c in within], F.col("i").alias("__i"), "below", "upto")
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in within]
    joined = guessed.join(counts, [*same, F.col("i") == F.col("__i")])
    rank = F.col("q") * (F.col("total") - 1)
    held = (F.col("below") <= F.floor(rank)) & (F.ceil(rank) < F.col("upto"))
    return materialize(
        joined.select(
            *within, "i", "total", F.when(held, F.col("low")).alias("low"), F.when(held, F.col("high")).alias("high"),
            F.when(held, F.col("below")).otherwise(0).alias("below")),
        "brackets",
    )


def _bracketed(df: DataFrame, value: str, brackets: DataFrame, within: Sequence[str]) -> DataFrame:
    """``(within…, i, value, n, total, below)``: the values inside each bracket, counted."""
    wanted = brackets.groupBy(*within).agg(F.collect_list(F.struct("i", "total", "low", "high", "below")).alias("wanted"))
    met = _beside(df, wanted, "wanted", within)
    inside = F.filter("wanted", lambda b: (F.coalesce(F.col(value) >= b["low"], F.lit(True))) & (F.coalesce(F.col(value) <= b["high"], F.lit(True))))
    kept = met.select(*within, value, F.explode(inside).alias("b"))
    return kept.groupBy(*within, F.col("b.i").alias("i"), F.col(value), F.col("b.total").alias("total"), F.col("b.below").alias("below")).agg(
        F.count("*").alias("n"))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], within: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles: one row per group, ``q0``, ``q1``, …

    Only the values near each quantile are ordered: a sketch brackets it, the values below the
    bracket are counted. Equal values are counted before anything is ordered. NULLs do not count; a
    group without values gives no row.
    """
    known = df.filter(F.col(value).isNotNull()).select(*within, value)
    counted = _bracketed(known, value, _brackets(known, value, probabilities, within), within)
    placed = running_totals(counted, [F.col(value)], {"inside": F.col("n")}, [*within, "i"])
    placed = placed.withColumns({"upto": F.col("inside") + F.col("below"), "upto_total": F.col("total")})
    first = F.col("upto") - F.col("n")

    def at(i: int, position: Column) -> Column:
        here = (F.col("i") == i) & (first <= position) & (position < F.col("upto"))
        return F.max(F.when(here, F.col(value)))

    ends = []
    for i, q in enumerate(probabilities):
        exact = F.lit(float(q)) * (F.col("upto_total") - 1)
        ends += [at(i, F.floor(exact)).alias(f"lo{i}"), at(i, F.ceil(exact)).alias(f"hi{i}")]
        ends += [F.max(exact - F.floor(exact)).alias(f"t{i}")]

    def interpolated(i: int) -> Column:
        lo, hi, t = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"t{i}")
        from_below, from_above = lo + (hi - lo) * t, hi - (hi - lo) * (1 - t)
        return F.when(t < 0.5, from_below).otherwise(from_above).alias(f"q{i}")

    found = placed.groupBy(*within).agg(*ends)
    return found.select(*within, *[interpolated(i) for i in range(len(probabilities))])
