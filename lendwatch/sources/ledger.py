"""Ledger of loaded files: what was loaded, when, and how many rows each file gave.

A load writes its rows to a folder of its own, ``load_id=…``, below the table. Its last act appends
one row per file to the ledger in ``_ledger``, a folder that table scans pass over. Rows count only
when their load is in the ledger, so a load that died half way leaves nothing behind that is read,
and the next one removes it. Which files are new is decided by the ledger alone; no stored row is
scanned for it. One load at a time writes to a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch.storage import exists, list_names, remove

FILES = "path string, source_file string, size long, modified timestamp"
LEDGER = f"{FILES}, load_id string, loaded_at timestamp, rows long, rejected long, first_day date, last_day date"
LOAD = "load_id"


def folder(table: str) -> str:
    return f"{table}/_ledger"


def new_load() -> str:
    return uuid.uuid4().hex


def load_folder(table: str, load: str) -> str:
    return f"{table}/{LOAD}={load}"


def has_ledger(spark: SparkSession, table: str) -> bool:
    return exists(spark, folder(table))


def read(spark: SparkSession, table: str) -> DataFrame:
    """One row per loaded file; empty where nothing was loaded yet."""
    if not has_ledger(spark, table):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder(table))


def start(spark: SparkSession, table: str) -> None:
    """Give a new table its ledger, before any row is written, and remove what dead loads left."""
    if not has_ledger(spark, table):
        if any(not n.startswith(("_", ".", f"{LOAD}=")) for n in list_names(spark, table)):
            raise ValueError(f"{table} holds rows that no ledger knows, a stream's perhaps")
        commit(spark.createDataFrame([], LEDGER), table)
    drop_unfinished(spark, table)


def unseen(available: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of ``available`` that no load has taken."""
    return available.join(ledger.select("source_file").distinct(), "source_file", "left_anti").select(*available.columns)


def changed(available: DataFrame, ledger: DataFrame) -> DataFrame:
    """Loaded files that differ now in size or time of modification from what was loaded."""
    then = ledger.select("source_file", F.col("size").alias("size_then"), F.col("modified").alias("modified_then"))
    differs = (F.col("size") != F.col("size_then")) | (F.col("modified") != F.col("modified_then"))
    return available.join(then, "source_file").filter(differs).select(*available.columns)


def committed(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows whose load ended; the load's folder is a partition, so others need not be read."""
    return rows.join(ledger.select(LOAD).distinct(), LOAD, "left_semi")


def drop_unfinished(spark: SparkSession, table: str) -> list[str]:
    """Remove the folders of loads that are not in the ledger; returns their ids."""
    finished = {r[LOAD] for r in read(spark, table).select(LOAD).distinct().collect()}  # one per load
    names = [n.split("=", 1)[1] for n in list_names(spark, table) if n.startswith(f"{LOAD}=")]
    left = sorted(set(names) - finished)
    for load in left:
        remove(spark, load_folder(table, load))
    return left


def entries(files: DataFrame, stored: DataFrame, load: str, day: str) -> DataFrame:
    """Ledger rows of one load: every file offered, also one that gave no row.

    ``stored`` has ``source_file``, ``rejected`` and the date column ``day`` of the rows written.
    """
    good = ~F.col("rejected")
    counts = stored.groupBy("source_file").agg(
        F.count_if(good).alias("rows"), F.count_if("rejected").alias("rejected"),
        F.min(F.when(good, F.col(day))).alias("first_day"), F.max(F.when(good, F.col(day))).alias("last_day"))
    told = files.join(counts, "source_file", "left")
    return told.select(
        "path", "source_file", "size", "modified", F.lit(load).alias(LOAD), F.current_timestamp().alias("loaded_at"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("rejected", F.lit(0)).cast("long").alias("rejected"),
        "first_day", "last_day")


def commit(entries_: DataFrame, table: str) -> None:
    """Append the load's rows as one file, which is there as a whole or not at all."""
    entries_.coalesce(1).write.mode("append").parquet(folder(table))
