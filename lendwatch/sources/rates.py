"""Daily policy-rate records and their month-end values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch.operators.ordering import row_numbers

RECORDS = "array<struct<data:string,valor:string>>"


def read_rates(documents: DataFrame) -> DataFrame:
    """``(day, value)`` from a ``value`` column of JSON arrays of daily records.

    A document that is no such array is an error: read in the permissive mode it would be NULL
    and vanish.
    """
    parsed = F.from_json("value", RECORDS, {"mode": "FAILFAST"})
    broken = F.raise_error(F.lit("a document of rates is no JSON array"))
    record = documents.select(F.explode(F.coalesce(parsed, broken.cast(RECORDS))).alias("r"))
    return record.select(
        F.to_date("r.data", "d/M/yyyy").alias("day"),
        F.replace(F.col("r.valor"), F.lit(","), F.lit(".")).cast("double").alias("value"),
    )


def read_rate_files(spark: SparkSession, path: str) -> DataFrame:
    return read_rates(spark.read.text(path, wholetext=True))


def month_end_table(daily: DataFrame) -> DataFrame:
    """``(data_base, selic_meta_aa)``: the last record of each month.

    It is dated to the month's last calendar day. Of two records on one day the
    larger value counts.
    """
    return (
        daily.groupBy(F.last_day("day").alias("data_base"))
        .agg(F.max(F.struct("day", "value")).alias("last"))
        .select("data_base", F.col("last.value").alias("selic_meta_aa"))
    )


PROVISIONAL = "is_provisional"


def with_provisional(table: DataFrame, daily: DataFrame) -> DataFrame:
    """The month-end table with a mark on the month the series ends in, unless it ends with the month."""
    open_ = provisional_flag(daily).filter(PROVISIONAL).select(F.last_day("month_start").alias("data_base"), PROVISIONAL)
    return table.join(open_, "data_base", "left").withColumn(PROVISIONAL, F.coalesce(PROVISIONAL, F.lit(False)))


def dim_rate(table: DataFrame) -> DataFrame:
    """Published names; the mark of a provisional month stays, if the table has one."""
    return table.select(
        F.col("data_base").alias("reference_date"),
        F.col("selic_meta_aa").alias("selic_target_rate_annual"),
        *[c for c in table.columns if c == PROVISIONAL],
    )


def rate_changes(rates: DataFrame, months: int = 6) -> DataFrame:
    """``(month_start, selic_rate, selic_chg_6m)`` by calendar month.

    A month that is not closed has its rate so far but no change: a few days would be held against a
    whole month. Nor does any month change against it.
    """
    monthly = rate_by_month(rates)
    if PROVISIONAL in rates.columns:
        marks = rates.groupBy(F.trunc("reference_date", "MM").alias("month_start")).agg(F.max(PROVISIONAL).alias("open"))
        monthly = monthly.join(marks, "month_start")
    else:
        monthly = monthly.withColumn("open", F.lit(False))
    closed = F.when(~F.col("open"), F.col("selic_rate"))
    earlier = monthly.select(F.add_months("month_start", months).alias("month_start"), closed.alias("before"))
    return monthly.join(earlier, "month_start", "left").select(
        "month_start", "selic_rate", (closed - F.col("before")).alias("selic_chg_6m")
    )


def rate_intervals(daily: DataFrame) -> DataFrame:
    """``(valid_from, valid_to, value)``: each recorded rate holds until the next record's day.

    ``valid_to`` is exclusive, and NULL for the last record. Of two records on one day the larger counts.
    """
    days = daily.groupBy("day").agg(F.max("value").alias("value"))
    numbered = row_numbers(days, [F.col("day")], "n")
    after = numbered.select((F.col("n") - 1).alias("n"), F.col("day").alias("valid_to"))
    return numbered.join(after, "n", "left").select(F.col("day").alias("valid_from"), "valid_to", "value")


def known_on(daily: DataFrame, day: Column) -> DataFrame:
    """The records that were there at the end of a day."""
    return daily.filter(F.col("day") <= day)


def month_end_rates(daily: DataFrame) -> DataFrame:
    return dim_rate(month_end_table(daily))


def rate_by_month(rates: DataFrame) -> DataFrame:
    return rates.groupBy(F.trunc("reference_date", "MM").alias("month_start")).agg(
        F.avg("selic_target_rate_annual").alias("selic_rate")
    )


def provisional_flag(daily: DataFrame) -> DataFrame:
    """Last month of the series and whether its last day is still to come."""
    last = daily.agg(F.max("day").alias("last_day_seen"))
    return last.select(
        F.trunc("last_day_seen", "MM").alias("month_start"),
        "last_day_seen",
        (F.last_day("last_day_seen") > F.col("last_day_seen")).alias("is_provisional"),
    )
