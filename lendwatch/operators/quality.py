"""Data-quality checks. Each gives rows of ``(check, target, failures, status)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """Raised when a report holds an ``error`` row."""


def not_null(column: str) -> tuple[str, str, Column]:
    return "not_null", column, F.col(column).isNull()


def at_least(column: str, minimum: float) -> tuple[str, str, Column]:
    return "accepted_range", column, F.col(column) < F.lit(minimum)


def between(column: str, low: float, high: float) -> tuple[str, str, Column]:
    return "accepted_range", column, ~F.col(column).between(low, high)


def accepted_values(column: str, values: Sequence) -> tuple[str, str, Column]:
    return "accepted_values", column, ~F.col(column).isin(list(values))


def _status(failures: Column) -> Column:
    return F.when(failures > 0, "error").otherwise("pass").alias("status")


def _judged(rows: DataFrame) -> DataFrame:
    return rows.select("check", "target", "failures", _status(F.col("failures")))


def check_columns(
    df: DataFrame,
    table: str,
    rules: Sequence[tuple[str, str, Column]],
    weight: str | None = None,
) -> DataFrame:
    """All row-level rules of a table in one scan. NULL passes all but ``not_null``.

    On pre-counted rows ``weight`` names the column that holds the count.
    """
    times = F.col(weight) if weight else F.lit(1)
    counted = df.agg(
        *[
            F.coalesce(F.sum(F.when(broken, times)), F.lit(0)).cast("bigint").alias(f"c{i}")
            for i, (_, _, broken) in enumerate(rules)
        ]
    )
    lines = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(f"{table}.{column}").alias("target"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, (check, column, _) in enumerate(rules)
    ]
    return _judged(counted.select(F.inline(F.array(*lines))))


def counted(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """A report of ``(check, target, count of failures)``, the counts taken in one scan."""
    found = df.agg(*[failures.cast("bigint").alias(f"c{i}") for i, (_, _, failures) in enumerate(rules)])
    lines = [
        F.struct(F.lit(check).alias("check"), F.lit(target).alias("target"), F.col(f"c{i}").alias("failures"))
        for i, (check, target, _) in enumerate(rules)
    ]
    return _judged(found.select(F.inline(F.array(*lines))))


def _one_line(failing: DataFrame, failures: Column, check: str, target: str) -> DataFrame:
    return _judged(
        failing.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
            F.lit(check).alias("check"), F.lit(target).alias("target"), "failures"
        )
    )


def check_unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Number of repeated values. A single column ignores NULLs; a combination does not."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    repeated = rows.groupBy(*columns).count().filter("count > 1")
    check = "unique" if len(columns) == 1 else "unique_combination_of_columns"
    return _one_line(repeated, F.count("*"), check, f"{table}.{'+'.join(columns)}")


def check_relationship(
    child: DataFrame,
    table: str,
    key: str,
    parent: DataFrame,
    parent_key: str,
    weight: str | None = None,
) -> DataFrame:
    """Child rows whose key has no parent. NULL keys pass.

    Keys are counted before the anti-join, so it compares distinct values only.
    """
    times = F.col(weight) if weight else F.lit(1)
    keys = (
        child.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("k"))
        .agg(F.sum(times).alias("n"))
    )
    orphans = keys.join(parent.select(F.col(parent_key).alias("k")), "k", "left_anti")
    return _one_line(orphans, F.sum("n"), "relationships", f"{table}.{key}")


def freshness(df: DataFrame, table: str, column: str, now: Column, warn: int, error: int):
    """Age in days of the newest row: ``error`` beyond ``error``, ``warn`` beyond ``warn``."""
    newest = df.agg(F.max(column).alias("newest"))
    age = F.datediff(now, F.col("newest"))
    return newest.select(
        F.lit("freshness").alias("check"),
        F.lit(f"{table}.{column}").alias("target"),
        age.cast("bigint").alias("failures"),
        F.when(age <= warn, "pass").when(age <= error, "warn").otherwise("error").alias("status"),
    )


def reconcile(left: DataFrame, right: DataFrame, target: str) -> DataFrame:
    """Difference of two row counts, in one job."""
    sides = left.select(F.lit(1).alias("n")).unionAll(right.select(F.lit(-1).alias("n")))
    return _one_line(sides, F.abs(F.sum("n")), "reconciliation", target)


def month_gaps(df: DataFrame, date: str, file: str) -> DataFrame:
    """Months missing between the first and the last, and months found in several files."""
    loads = df.groupBy(F.trunc(date, "MM").alias("month_start"), file).count()
    months = loads.groupBy("month_start").agg(F.count("*").alias("n_files"))
    span = months.agg(F.min("month_start").alias("a"), F.max("month_start").alias("b"))
    calendar = span.select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month_start")
    )
    return (
        calendar.join(months, "month_start", "left")
        .select("month_start", F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"))
        .withColumn(
            "status",
            F.when(F.col("n_files") == 0, "missing")
            .when(F.col("n_files") > 1, "duplicate")
            .otherwise("ok"),
        )
    )


def complete_months(df: DataFrame, table: str, date: str, file: str) -> DataFrame:
    """Number of months that are missing, and of months found in several files."""
    found = ("missing", "duplicate")
    counted = month_gaps(df, date, file).agg(*[F.count_if(F.col("status") == s).alias(s) for s in found])
    lines = [
        F.struct(
            F.lit(f"{s}_month").alias("check"),
            F.lit(f"{table}.{date}").alias("target"),
            F.col(s).alias("failures"),
        )
        for s in found
    ]
    return _judged(counted.select(F.inline(F.array(*lines))))


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def gate_status(report: DataFrame) -> DataFrame:
    """One row: counts by status and whether the next step may run."""
    status = F.col("status")
    return report.agg(
        F.count_if(status == "error").alias("n_error"),
        F.count_if(status == "warn").alias("n_warn"),
        F.count_if(status == "pass").alias("n_pass"),
    ).withColumn("gate", F.when(F.col("n_error") > 0, "stop").otherwise("go"))


def gate(report: DataFrame) -> None:
    """Stop the job when a check failed; a warning does not stop it."""
    failed = [f"{r.check} {r.target}: {r.failures}" for r in report.filter("status = 'error'").collect()]
    if failed:
        raise GateError("; ".join(failed))
