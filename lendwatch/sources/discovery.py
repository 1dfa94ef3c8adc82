"""Which raw files a load should take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def target_month(run_date: Column) -> Column:
    """First day of the month before the run."""
    return F.add_months(F.trunc(run_date, "MM"), -1)


def monthly_file_name(month: Column) -> Column:
    """``scrdata_YYYYMM.csv``"""
    return F.concat(F.lit("scrdata_"), F.date_format(month, "yyyyMM"), F.lit(".csv"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, source_file, size, modified)`` of every file below ``root``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(
        "path", F.col("_metadata.file_path").alias("source_file"),
        F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def of_month(files: DataFrame, month: Column | None) -> DataFrame:
    """The files named after a month; all without one."""
    return files if month is None else files.filter(F.contains("source_file", monthly_file_name(month)))


def new_files(available: DataFrame, loaded: DataFrame, month: Column | None = None) -> DataFrame:
    """``source_file`` values available and not loaded.

    With ``month`` only files named after that month count; when it is not
    published, or is loaded already, the result is empty.
    """
    return (
        of_month(available, month).select("source_file")
        .distinct()
        .join(loaded.select("source_file").distinct(), "source_file", "left_anti")
    )
