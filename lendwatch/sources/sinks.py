"""Table writes: append once, replace a month, partition for pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendwatch.operators import quality
from lendwatch.schema import DATE_COLUMN, PARSED_SCHEMA
from lendwatch.sources import discovery, ledger, raw_text
from lendwatch.storage import exists, materialize, move, remove

PARTITIONS = ["rejected", DATE_COLUMN]


def append_rows(parsed: DataFrame, path: str, by_month: bool = True) -> None:
    """Append good and rejected rows in one pass over the input.

    Both kinds go to one table, split by its ``rejected`` partition. Monthly
    files need no shuffle: a task reads one month and writes one partition.
    Input that mixes months (``by_month=False``) is rebalanced by partition
    first; AQE then cuts a hot month into several evenly sized files.
    """
    rows = parsed if by_month else parsed.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    rows.write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table: those of finished loads where it has a ledger, else all (a stream's)."""
    if not ledger.has_ledger(spark, path):
        return spark.read.schema(PARSED_SCHEMA).parquet(path)
    schema = T.StructType([*PARSED_SCHEMA.fields, T.StructField(ledger.LOAD, T.StringType())])
    return ledger.committed(spark.read.schema(schema).parquet(path), ledger.read(spark, path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows of a table written by ``append_new_files`` or the stream."""
    return raw_text.good_rows(_stored(spark, path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return raw_text.quarantined(_stored(spark, path))


def append_new_files(
    spark: SparkSession,
    root: str,
    path: str,
    month: Column | None = None,
    strict_iso: bool = False,
    max_files: int = 10_000,
    max_rejected_share: float | None = None,
    verify: bool = True,
) -> int:
    """Append the files below ``root`` that the table's ledger does not know; returns their number.

    A re-run adds nothing, and a ``month`` not published yet is no error. Files are chosen from the
    listing and the ledger; no stored row is read. A file without a row is loaded once like any
    other. A loaded file that has changed since stops the load before anything is written, for its
    rows would be doubled or missed. At most ``max_files`` paths are in one load, so that their list
    stays bounded; more files make more loads.

    A load ends, and its rows are seen, only if every file's stored rows agree with a count of the
    lines of the file itself (``verify``) and no file has a larger part of its lines rejected than
    ``max_rejected_share``.
    """
    ledger.start(spark, path)
    available = materialize(discovery.list_files(spark, root), "listing")
    known = ledger.read(spark, path)
    broken = ledger.changed(available, known).select("source_file").limit(5).collect()
    if broken:
        raise ValueError(f"loaded files have changed: {', '.join(r.source_file for r in broken)}")
    chosen = materialize(discovery.of_month(ledger.unseen(available, known), month), "new-files")
    count = 0
    while True:
        files = chosen.orderBy("path").offset(count).limit(max_files).toLocalIterator()
        paths = [row["path"] for row in files]
        if not paths:
            return count
        entries = _write_load(spark, chosen, paths, path, strict_iso)
        lines = raw_text.lines_per_file(raw_text.read_files(spark, paths)) if verify else None
        quality.gate(load_checks(entries, lines, max_rejected_share))
        ledger.commit(entries, path)
        count += len(paths)


def _write_load(spark: SparkSession, chosen: DataFrame, paths: list[str], path: str, strict_iso: bool) -> DataFrame:
    """The rows of ``paths`` in a load's folder, and its entries for the ledger."""
    load = ledger.new_load()
    folder = ledger.load_folder(path, load)
    append_rows(raw_text.parse_rows(raw_text.read_files(spark, paths), strict_iso), folder)
    files = chosen.filter((F.col("path") >= paths[0]) & (F.col("path") <= paths[-1]))
    stored = spark.read.schema(PARSED_SCHEMA).parquet(folder).select("source_file", "rejected", DATE_COLUMN)
    return materialize(ledger.entries(files, stored, load, DATE_COLUMN), "ledger-entries")


def load_checks(entries: DataFrame, lines: DataFrame | None = None, max_rejected_share: float | None = None) -> DataFrame:
    """Files whose stored rows differ from their ``lines(source_file, lines)``, or with too many rejected."""
    stored = F.col("rows") + F.col("rejected")
    limit = F.lit(1.0 if max_rejected_share is None else max_rejected_share)
    spoilt = F.count_if(F.col("rejected") > limit * stored)
    if lines is None:
        told, differing = entries, F.lit(0)
    else:
        told = entries.join(lines, "source_file", "full_outer")
        differing = F.count_if(~stored.eqNullSafe(F.coalesce("lines", F.when(F.col("path").isNotNull(), 0))))
    return quality.counted(told, [("rows_per_file", "rows = lines of the file", differing), ("rejected_share", "rejected lines per file", spoilt)])


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a table; until the new one is whole, and if its write fails, the old one stays.

    The rows go to a hidden folder beside the table and take its place by renames. Should the job
    die between the two renames, ``restore`` (or the next ``overwrite``) puts the old table back.
    """
    _replaced(df.sparkSession, path, df.write)


def _replaced(spark: SparkSession, path: str, writer: DataFrameWriter) -> None:
    restore(spark, path)
    staged = _beside(path, "staged")
    remove(spark, staged)
    writer.mode("overwrite").parquet(staged)
    _swap(spark, staged, path)
    spark.catalog.refreshByPath(path)


def _beside(path: str, role: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_{name}.{role}"


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    old = _beside(path, "old")
    if exists(spark, path):
        move(spark, path, old)
    move(spark, staged, path)
    remove(spark, old)


def restore(spark: SparkSession, path: str) -> bool:
    """Undo a replacement that died half way; whether there was one."""
    old = _beside(path, "old")
    if not exists(spark, old):
        return False
    if exists(spark, path):  # the new table was in place already
        remove(spark, old)
    else:
        move(spark, old, path)
    return True


def replace_month(df: DataFrame, path: str, month_col: str) -> None:
    """Replace the months present in ``df``; other months and a missing table are fine."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month_col)
        .parquet(path)
    )


def write_fact(fact: DataFrame, path: str) -> None:
    """Partition by date, cluster by state and modality inside each file.

    ``rebalance`` lets AQE merge small dates and split a hot one; the sort gives
    narrow row-group statistics for the two clustering columns.
    """
    rows = fact.hint("rebalance", F.col("reference_date")).sortWithinPartitions("reference_date", "state", "modality_id")
    _replaced(fact.sparkSession, path, rows.write.partitionBy("reference_date"))
