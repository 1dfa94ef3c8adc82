"""Monthly members of annual ZIP archives, one task per member."""

from __future__ import annotations

import io
import itertools
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch.storage import exists, materialize

from lendwatch.sources.raw_text import line_array

LINES_PER_BATCH = 20_000
# A member is read by one task. Many small ones share a task, as starting one takes longer than reading them.
TASKS_PER_CORE = 8
BYTES_PER_TASK = 64_000_000


def _readers():
    """The two task functions. Being local, they travel to executors by value."""

    def opened(archive: str) -> zipfile.ZipFile:
        """Random access through the archive's own file system; nothing is copied."""
        system, path = fs.FileSystem.from_uri(archive)
        return zipfile.ZipFile(system.open_input_file(path))

    def list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["archive"]:
                with opened(archive) as files:
                    found = [i for i in files.infolist() if i.filename.lower().endswith(".csv")]
                names, sizes, crcs = ([getattr(i, a) for i in found] for a in ("filename", "file_size", "CRC"))
                yield pd.DataFrame({"archive": archive, "member": names, "size": sizes, "crc": crcs})

    def read_members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "member", "value"]
        for batch in batches:
            for archive, *entry in zip(*(batch[c].to_pylist() for c in ("archive", "member", "size", "crc"))):
                member = entry[0]
                with opened(archive) as files:
                    found = next(i for i in files.infolist() if [i.filename, i.file_size, i.CRC] == entry)
                    text = io.TextIOWrapper(files.open(found), encoding="utf-8")
                    while lines := list(itertools.islice(text, LINES_PER_BATCH)):
                        lines = [line.rstrip("\n") for line in lines]
                        told = [pa.repeat(archive, len(lines)), pa.repeat(member, len(lines)), pa.array(lines)]
                        yield pa.RecordBatch.from_arrays(told, names)

    return list_members, read_members


def list_members(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """``(archive, member, size, crc)``: reads the archives' directories only."""
    return archives.select("archive").mapInPandas(
        _readers()[0], "archive string, member string, size long, crc long"
    )


def explode_archives(
    spark: SparkSession, archive_paths: list[str], existing: DataFrame | None = None
) -> DataFrame:
    """``(archive, member, value)``: the lines of every CSV member.

    A member is a compressed stream and is read start to end by one task, in
    bounded batches; neighbouring small members share a task. ``existing`` lists members to
    skip, by name or, where it has ``size`` and ``crc``, by content; a member of several archives
    is read once for each size and CRC.
    """
    return _lines(_wanted(spark, archive_paths, existing))


def _wanted(spark: SparkSession, archive_paths: list[str], existing: DataFrame | None) -> DataFrame:
    uris = [p if "://" in p or p.startswith("file:") else f"file://{p}" for p in archive_paths]
    archives = spark.createDataFrame([(u,) for u in uris], "archive string")
    listed = list_members(spark, archives.repartition(max(1, len(uris))))
    members = listed.groupBy("member", "size", "crc").agg(F.min("archive").alias("archive"))
    if existing is not None:
        known = [c for c in ("member", "size", "crc") if c in existing.columns]
        members = members.join(existing.select(*known).distinct(), known, "left_anti")
    return materialize(members, "members")


def _lines(chosen: DataFrame) -> DataFrame:
    # Rows are tiny and tasks long, so the number of tasks is set, not left to AQE.
    sums = chosen.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    tasks = min(sums.n, max(TASKS_PER_CORE * chosen.sparkSession.sparkContext.defaultParallelism, (sums.bytes or 0) // BYTES_PER_TASK))
    lines = (
        chosen.repartitionByRange(max(1, tasks), "archive", "member", "crc", "size")
        .mapInArrow(_readers()[1], "archive string, member string, value string")
    )
    return lines.withColumn("value", F.explode(line_array(F.col("value"))))


def _by_member(lines: DataFrame) -> DataFrame:
    year = F.regexp_extract("member", r"([0-9]{4})[0-9]{2}\.[cC][sS][vV]$", 1)
    return lines.select("value", year.alias("year"), "member")


def write_raw(lines: DataFrame, root: str) -> None:
    """Members as text below ``year=YYYY/member=NAME``, ready for ``read_raw_lines``."""
    _by_member(lines).write.mode("append").partitionBy("year", "member").text(root)


MEMBERS = "archive string, member string, size long, crc long"


def unpacked_members(spark: SparkSession, root: str) -> DataFrame:
    """The ledger of members written below ``root``."""
    folder = f"{root}/_members"
    return spark.read.schema(MEMBERS).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], MEMBERS)


def unpack(spark: SparkSession, archive_paths: list[str], root: str) -> int:
    """Write the members not unpacked yet below ``root``; returns their number.

    Members are told apart by name, size and CRC, from the archives' directories alone. One that was
    unpacked before and has other content now, or two of one name that differ, stop the step before
    anything is written. A run that died is repeated as a whole: a member replaces what it had written.
    """
    done = unpacked_members(spark, root)
    chosen = _wanted(spark, archive_paths, done)
    twice = chosen.groupBy("member").count().filter("count > 1").select("member")
    differing = chosen.join(done.select("member").distinct(), "member", "left_semi").select("member").unionByName(twice).distinct()
    names = [r.member for r in differing.limit(5).collect()]
    if names:
        raise ValueError(f"members of one name have different content: {', '.join(sorted(names))}")
    count = chosen.count()
    if count:
        writer = _by_member(_lines(chosen)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("year", "member").text(root)
        chosen.select("archive", "member", "size", "crc").coalesce(1).write.mode("append").parquet(f"{root}/_members")
    return count
