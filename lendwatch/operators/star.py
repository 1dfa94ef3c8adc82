"""Staging, dimensions and the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendwatch.functions.scalars import safe_divide
from lendwatch.operators.ordering import row_numbers
from lendwatch.schema import MEASURES, STAGING_COLUMNS
from lendwatch.storage import materialize

# Dimension -> (surrogate key, columns it numbers)
KEYED = {
    "modality": ("modality_id", ["credit_modality", "credit_submodality"]),
    "client": ("client_id", ["client_type", "client_size"]),
    "activity": ("economic_activity_id", ["economic_activity"]),
}


def build_staging(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("data_base").isNotNull()).select(
        *[F.col(raw).alias(name) for name, raw in STAGING_COLUMNS.items()]
    )


def dim_date(stg: DataFrame) -> DataFrame:
    dates = stg.select("reference_date").distinct()
    return dates.select(
        "reference_date",
        F.year("reference_date").cast("bigint").alias("year"),
        F.month("reference_date").cast("bigint").alias("month"),
        F.quarter("reference_date").cast("bigint").alias("quarter"),
    )


def dim_state(stg: DataFrame) -> DataFrame:
    return stg.select("state").filter(F.col("state") != "").distinct()


def keyed_dim(stg: DataFrame, name: str) -> DataFrame:
    """Distinct values numbered 1… in order, NULLs first.

    Numbers change when a value is added: rebuild dimensions and fact together.
    """
    key, columns = KEYED[name]
    members = stg.select(*columns).distinct()
    if name == "activity":
        members = members.filter(F.col("economic_activity") != "")
    order = [F.col(c).asc_nulls_first() for c in columns]
    return row_numbers(members, order, key).select(key, *columns)


def build_dims(stg: DataFrame, names: Sequence[str] = ("date", *KEYED)) -> dict[str, DataFrame]:
    """Written dimension tables; one scan of staging and one ordering number all keys."""
    dims = {}
    keyed = [n for n in names if n in KEYED]
    if keyed:
        columns = [c for n in keyed for c in KEYED[n][1]]
        entries = []
        for n in keyed:
            first, second = (*(F.col(c) for c in KEYED[n][1]), F.lit(None).cast("string"))[:2]
            entries.append(
                F.struct(F.lit(n).alias("dim"), first.alias("first"), second.alias("second"))
            )
        members = (
            stg.select(*columns)
            .distinct()
            .select(F.inline(F.array(*entries)))
            .distinct()
            .filter((F.col("dim") != "activity") | (F.col("first") != ""))
        )
        order = [F.col("first").asc_nulls_first(), F.col("second").asc_nulls_first()]
        numbered = row_numbers(members, order, "id", ["dim"]).drop("id_total")
        table = materialize(numbered, "dims", partition_by="dim")
        for n in keyed:
            key, names_of = KEYED[n]
            values = [F.col(c).alias(name) for c, name in zip(("first", "second"), names_of)]
            dims[n] = table.filter(F.col("dim") == n).select(F.col("id").alias(key), *values)
    if "date" in names:
        dims["date"] = materialize(dim_date(stg), "dim_date")
    return dims


def build_fact(stg: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Staging rows with the keys of the given dimensions; every row is kept.

    NULL attributes find no key, empty ones do (activities have no empty member).
    Dimensions are written tables: Catalyst broadcasts one whose files are
    small enough, and otherwise sort-merge joins with AQE splitting hot keys.
    """
    keys = {}
    fact = stg
    for name, (key, columns) in KEYED.items():
        if name in dims:
            fact = fact.join(dims[name], columns, "left")
            keys[name] = key
    ordered = ["reference_date", "state", keys.get("modality"), "institution_segment"]
    ordered += [keys.get("client"), keys.get("activity"), *MEASURES]
    present = [c for c in ordered if c is not None and c in fact.columns]
    rate = safe_divide(F.col("default_portfolio"), F.col("active_portfolio"))
    return fact.select(*present, rate.alias("default_rate"))
