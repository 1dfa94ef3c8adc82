"""Raw monthly files: lines in, typed rows and rejected lines out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch.functions import parsing
from lendwatch.schema import (
    AMOUNT_COLUMNS,
    BRONZE_SCHEMA,
    COUNT_COLUMN,
    DATE_COLUMN,
    RAW_COLUMNS,
    TEXT_COLUMNS,
)

# Line breaks other than the \n, \r and \r\n the text source knows.
OTHER_LINE_BREAKS = r"[\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"
# Text of nothing but printable ASCII holds none; that is seen in a fraction of the time.
_PLAIN = r"^[ -~]*\z"


def line_array(value: Column) -> Column:
    """The lines of a text as an array."""
    return F.when(value.rlike(_PLAIN), F.array(value)).otherwise(F.split(value, OTHER_LINE_BREAKS, -1))


def split_lines(text: DataFrame, within: Column | None = None) -> DataFrame:
    """One row per line of ``value``; a text scan has split at \\n, \\r and \\r\\n already.

    ``within`` is the part of ``value`` that can hold a line break, where it is known.
    """
    value = F.col("value")
    parts = line_array(value)
    if within is not None:
        odd = ~within.rlike(_PLAIN) | value.isNull()
        parts = F.when(odd, parts).otherwise(F.array(value))
    return text.withColumn("value", F.explode(parts))


def with_provenance(text: DataFrame) -> DataFrame:
    """``(value, source_file)`` from a text scan."""
    return text.select("value", F.col("_metadata.file_path").alias("source_file"))


def read_raw_lines(
    spark: SparkSession,
    root: str,
    years: list[int] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Every line below ``root``; large files are split over tasks.

    ``years`` prunes ``year=YYYY`` folders before any file is opened, ``pattern``
    is a file-name glob.
    """
    reader = spark.read.option("recursiveFileLookup", years is None)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    text = reader.text(root)
    if years is not None:
        text = text.filter(F.col("year").isin(list(years)))
    return split_lines(with_provenance(text))


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text of the files named, for ``parse_rows``."""
    return with_provenance(spark.read.text(paths))


def _is_data(line: Column) -> Column:
    return ~parsing.is_header(line) & (parsing.without_lead(line) != "")


def data_lines(lines: DataFrame) -> DataFrame:
    """Drop header lines, wherever they stand, and blank lines."""
    return lines.filter(_is_data(F.col("value")))


def lines_per_file(text: DataFrame) -> DataFrame:
    """``(source_file, lines)``: the lines that ``parse_rows`` takes for data, counted without parsing."""
    return data_lines(split_lines(text)).groupBy("source_file").agg(F.count("*").alias("lines"))


def _first_fault(faults: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(condition, F.lit(reason)) for condition, reason in faults])


def parse_rows(text: DataFrame, strict_iso: bool = False) -> DataFrame:
    """Typed columns plus ``source_file``, ``value``, ``reason`` and ``rejected``.

    A narrow projection: no shuffle, no Python. ``value`` keeps the raw line of
    rejected rows only. A clean line is known to be one line and no header, and
    is cut and cast as a whole; the others are split, filtered and read field by
    field.
    """
    width, n_texts, n_amounts = len(RAW_COLUMNS), len(TEXT_COLUMNS), len(AMOUNT_COLUMNS)
    value, clean = F.col("value"), F.col("clean")
    pattern = parsing.clean_line_pattern(n_texts, n_amounts)
    lines = text.select("source_file", "value", value.rlike(pattern).alias("clean")).withColumn(
        "value", F.explode(F.when(clean, F.array(value)).otherwise(line_array(value)))
    )
    head = parsing.clean_head(value, width - n_amounts)
    long_way = parsing.split_fields(parsing.strip(value))
    cut = lines.filter(clean | _is_data(value)).select(
        "*", F.when(clean, head).otherwise(long_way).alias("f")
    )
    # A line with another number of fields yields NULLs.
    parts = cut.select(
        "value",
        "source_file",
        "clean",
        F.when(clean | (F.size("f") == width), F.col("f")).alias("fields"),
    )
    texts = F.slice("fields", 2, n_texts)
    amounts = F.slice("fields", width - n_amounts + 1, n_amounts)
    date, count = F.col("fields")[0], F.col("fields")[n_texts + 1]
    row = F.struct(
        F.when(clean, date.try_cast("date"))
        .otherwise(parsing.reference_date(date, strict_iso))
        .alias(DATE_COLUMN),
        F.when(clean, texts).otherwise(F.transform(texts, parsing.strip)).alias("texts"),
        F.when(clean, count.try_cast("bigint"))
        .otherwise(parsing.operation_count(count))
        .alias(COUNT_COLUMN),
        F.when(clean, parsing.clean_amounts(value, n_amounts))
        .otherwise(F.transform(F.transform(amounts, parsing.strip), parsing.stripped_amount))
        .alias("amounts"),
    )
    # The generator keeps later filters above the parsing, which would otherwise
    # be copied into them.
    typed = parts.select(
        "value", "source_file", F.col("fields").isNull().alias("broken"), F.inline(F.array(row))
    )
    reason = _first_fault(
        [
            (F.col("broken"), "field_count"),
            (F.col(DATE_COLUMN).isNull(), "bad_date"),
            (F.col(COUNT_COLUMN).isNull(), "bad_count"),
            (reduce(Column.__or__, [F.col("amounts")[i].isNull() for i in range(n_amounts)]), "bad_number"),
        ]
    )
    return typed.select(
        DATE_COLUMN,
        *[F.col("texts")[i].alias(c) for i, c in enumerate(TEXT_COLUMNS)],
        COUNT_COLUMN,
        *[F.col("amounts")[i].alias(c) for i, c in enumerate(AMOUNT_COLUMNS)],
        "source_file",
        F.when(reason.isNotNull(), F.col("value")).alias("value"),
        reason.alias("reason"),
        reason.isNotNull().alias("rejected"),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("rejected")).select(BRONZE_SCHEMA.names)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter("rejected").select("value", "source_file", "reason")


def parse_lines(lines: DataFrame, strict_iso: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``; to store both, use ``sinks.append_rows``, which parses once."""
    parsed = parse_rows(lines, strict_iso)
    return good_rows(parsed), quarantined(parsed)


def preview(parsed: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` good rows drawn by the least hashes of their content and the seed.

    Each task keeps its ``n`` least and those are merged, so the sample is the same however the rows
    are dealt, and samples of parts merge to the sample of the whole. Equal rows have equal hashes.
    """
    texts = [F.col(c).cast("string") for c in (DATE_COLUMN, *TEXT_COLUMNS, COUNT_COLUMN, "source_file")]
    cents = [F.round(F.col(c) * 100).cast("bigint").cast("string") for c in AMOUNT_COLUMNS]
    content = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c, F.lit("")) for c in (*texts, *cents)])
    # A column of its own: an ordering by an expression computes it twice for every comparison.
    ranked = good_rows(parsed).withColumn("least", F.md5(content))
    return ranked.orderBy("least").limit(n).drop("least")
