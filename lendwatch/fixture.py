"""Staging-shaped input built from the order tables of a test-data folder.

A stand-in with the right shapes, gaps and blanks; the numbers have no credit
meaning.
"""

from __future__ import annotations

import math
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendwatch.config import EwConfig
from lendwatch.schema import AMOUNT_COLUMNS, RAW_COLUMNS, STAGING_COLUMNS, TEXT_COLUMNS
from lendwatch.sources.raw_text import split_lines
from lendwatch.storage import shuffles_dropped, size_of

CONFIG = EwConfig(min_portfolio=50_000)

#: Line items, as stored, whose raw lines are built at once.
PART_BYTES = 256 * 2**20

FROM_ORDERS = {"institution_segment", "client_size"}
FROM_CUSTOMER = {"state", "client_type"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large table. A test file that is one split is dealt out to all cores.

    With as many splits as cores, as any real input has, it is scanned as it is.
    """
    rows = table(spark, sf_dir, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores, "l_orderkey", "l_linenumber")
    return rows


def _amounts() -> dict[str, Column]:
    price, discount, tax = (F.col(f"l_{c}") for c in ("extendedprice", "discount", "tax"))
    active = F.when(F.col("l_quantity") == 1, F.lit(0.0)).otherwise(price)
    default = F.when(F.col("l_quantity") == 1, F.lit(0.0)).otherwise(price * discount)
    overdue = price * tax + default
    return {
        "number_of_operations": F.col("l_quantity").cast("bigint"),
        "outstanding_balance": active - overdue,
        "overdue_balance": overdue,
        "overdue_15_to_90_balance": price * tax,
        "overdue_over_90_balance": default,
        "active_portfolio": active,
        "default_portfolio": default,
        "problem_assets": default * 1.1,
    }


def staging(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = tuple(STAGING_COLUMNS),
    extra: Sequence[str] = (),
    part: tuple[int, int] | None = None,
) -> DataFrame:
    """One staging row per line item.

    Only the tables that ``columns`` come from are joined: every foreign key of
    the test data has its row, so the others would change nothing. ``extra``
    names line-item columns to keep. ``part`` (k, n) keeps the k-th of n parts of
    the orders; the n parts together hold every row once.
    """
    wanted = set(columns)
    rows = line_items(spark, sf_dir)
    if part:
        # Another hash than that of shuffles; Catalyst hands the filter on to the orders.
        rows = rows.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(part[1])) == part[0])
    orders = table(spark, sf_dir, "orders")
    if wanted & FROM_CUSTOMER:
        customers = table(spark, sf_dir, "customer")
        if "state" in wanted:
            nations = table(spark, sf_dir, "nation").join(
                table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
            )
            customers = customers.join(
                nations.select("n_nationkey", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
            )
        # Orders meet their customers first, so that line items are not dealt out by customer as well.
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    if wanted & (FROM_ORDERS | FROM_CUSTOMER):
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if wanted & {"credit_modality", "credit_submodality"}:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "economic_activity" in wanted:
        suppliers = table(spark, sf_dir, "supplier").join(
            table(spark, sf_dir, "nation").select(
                F.col("n_nationkey").alias("k"), F.col("n_name").alias("s_nation")
            ),
            F.col("s_nationkey") == F.col("k"),
        )
        rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))

    household = F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD")
    nation = F.col("s_nation")
    built = {
        "reference_date": F.last_day(F.col("l_shipdate").cast("date")),
        "state": F.col("r_name"),
        "institution_segment": F.col("o_orderstatus"),
        "client_type": F.when(household, "PF").otherwise("PJ"),
        "client_size": F.col("o_orderpriority"),
        "economic_activity": F.when(nation == "NATION_0", "")
        .when(nation == "NATION_1", "Outros")
        .otherwise(nation),
        "credit_modality": F.col("p_type"),
        "credit_submodality": F.col("p_brand"),
        **_amounts(),
    }
    return rows.select(*[built[c].alias(c) for c in columns], *extra)


def daily_rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON arrays of daily records, one array per month (at most 31 records)."""
    day = F.col("o_orderdate").cast("date")
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(day.alias("d"))
        .agg(F.round(F.avg("o_totalprice") / 10000, 2).alias("v"))
    )
    record = F.struct(
        F.date_format("d", "dd/MM/yyyy").alias("data"),
        F.replace(F.col("v").cast("string"), F.lit("."), F.lit(",")).alias("valor"),
    )
    return daily.groupBy(F.trunc("d", "MM").alias("m")).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )


def _printed(amount: str) -> Column:
    """``1.234.567,890000``"""
    text = F.format_number(F.col(amount), 6)
    for old, new in ((",", "|"), (".", ","), ("|", ".")):  # several times faster than ``translate``
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def raw_fields(stg: DataFrame) -> dict[str, Column]:
    """The 24 raw text fields of a staging row; unused ones hold ``0``."""
    fields: dict[str, Column] = {c: F.lit("0") for c in RAW_COLUMNS}
    for name, raw in STAGING_COLUMNS.items():
        fields[raw] = _printed(name) if raw in AMOUNT_COLUMNS else F.col(name).cast("string")
    return fields


def file_name() -> Column:
    return F.concat(F.lit("scrdata_"), F.date_format("reference_date", "yyyyMM"), F.lit(".csv"))


def quoted_line(fields: Sequence[Column]) -> Column:
    return F.concat(F.lit('"'), F.concat_ws('";"', *fields), F.lit('"'))


def raw_lines(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """Raw file lines ``(value, source_file)``, as a monthly export would hold them."""
    stg = staging(spark, sf_dir, part=part)
    line = quoted_line(list(raw_fields(stg).values()))
    texts = F.concat_ws("", *[c for c, raw in STAGING_COLUMNS.items() if raw in TEXT_COLUMNS])
    built = stg.select(line.alias("value"), file_name().alias("source_file"), texts.alias("texts"))
    # The generator keeps filters on the lines from copying their construction.
    return split_lines(built, F.col("texts")).select("value", "source_file")


def raw_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """``raw_lines`` in parts, one for each ``PART_BYTES`` of line items, so that what is shuffled at once has a bound."""
    n = max(1, math.ceil(size_of(spark, f"{sf_dir}/lineitem.parquet") / PART_BYTES))
    return [raw_lines(spark, sf_dir, (k, n) if n > 1 else None) for k in range(n)]


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_lines`` with one kind of damage or oddity per line-item quantity."""
    stg = staging(spark, sf_dir, extra=["l_quantity"])
    fields = raw_fields(stg)
    quantity = F.col("l_quantity").cast("int")
    iso = F.col("reference_date").cast("string")

    def altered(column: str, choices: dict[int, Column]) -> Column:
        out = fields[column]
        for q, text in choices.items():
            out = F.when(quantity == q, text).otherwise(out)
        return out

    fields = {
        **fields,
        "data_base": altered(
            "data_base",
            {
                5: F.concat(F.substring(iso, 1, 4), F.lit("-13-45")),
                11: F.replace(iso, F.lit("-"), F.lit("")),
                12: F.date_format("reference_date", "yyyyMM"),
                18: F.concat(F.lit(" "), iso, F.lit("\t")),
            },
        ),
        "cnae_ocupacao": altered("cnae_ocupacao", {13: F.lit('x ""q"" ; y')}),
        "numero_de_operacoes": altered(
            "numero_de_operacoes", {6: F.lit(" "), 7: F.lit("1.234"), 19: F.lit("")}
        ),
        "carteira_ativa": altered(
            "carteira_ativa",
            {
                4: F.lit("abc"),
                14: F.lit("-"),
                15: F.lit(" na "),
                16: F.lit("null"),
                17: F.lit("1,2,3"),
                20: F.lit("NaN"),
                21: F.lit("1d"),
            },
        ),
    }
    # The generator keeps every kind of line from printing the fields again.
    printed = stg.select(
        file_name().alias("source_file"),
        quantity.alias("quantity"),
        F.inline(F.array(F.struct(F.array(*fields.values()).alias("texts")))),
    )
    texts, quantity = F.col("texts"), F.col("quantity")

    def quoted(values: Column) -> Column:
        return F.concat(F.lit('"'), F.concat_ws('";"', values), F.lit('"'))

    opened = F.concat_ws(
        ";", F.slice(texts, 1, 2), F.concat(F.lit('"'), texts[2]), F.slice(texts, 4, len(fields) - 3)
    )
    line = (
        F.when(quantity == 2, quoted(F.slice(texts, 1, len(fields) - 1)))
        .when(quantity == 3, quoted(F.concat(texts, F.array(F.lit("0")))))
        .when(quantity == 8, opened)
        .when(quantity == 9, F.lit("  \t "))
        .when(quantity == 10, F.lit('\ufeff"DATA_BASE";"uf";"segmento"'))
        .when(quantity == 22, F.concat_ws(";", texts))
        .otherwise(quoted(texts))
    )
    # The generator keeps filters on the lines from copying their construction.
    return split_lines(printed.select(line.alias("value"), "source_file"))


def write_raw_files(lines: DataFrame | Sequence[DataFrame], root: str) -> None:
    """Lines and one header per month, as compressed text below ``year=YYYY/member=NAME``.

    A month is spread over as many files as AQE finds worth reading in parallel. The lines are built
    once: which months need a header is read from the listing of what was written. Lines in parts are
    written part by part, and a part's shuffle files go when it is written.
    """
    parts = [lines] if isinstance(lines, DataFrame) else lines
    spark = parts[0].sparkSession
    for part in parts:
        with shuffles_dropped(spark):
            _write_text(part.hint("rebalance", F.col("source_file")), root)
    header = quoted_line([F.lit(c) for c in RAW_COLUMNS])
    written = spark.read.format("binaryFile").load(root)  # folders only, no content
    if "member" in written.columns:
        months = written.select(F.col("member").alias("source_file")).distinct()
        _write_text(months.select(header.alias("value"), "source_file").coalesce(1), root)


def _write_text(lines: DataFrame, root: str) -> None:
    year = F.substring("source_file", 9, 4)
    (
        lines.select("value", year.alias("year"), F.col("source_file").alias("member"))
        .write.mode("append")
        .option("compression", "gzip")
        .partitionBy("year", "member")
        .text(root)
    )


def write_archives(lines: DataFrame, folder: str) -> list[str]:
    """ZIP archives of monthly members, one archive per task, streamed to ``folder``.

    Each task packs its own rows, so no month is gathered anywhere. Returns the
    paths: as many as there were tasks. A repeated task writes a new archive and
    only the paths of tasks that ended are returned.
    """

    def archive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = f"{folder}/part-{uuid.uuid4().hex}.zip"
        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner.rpartition("/")[0])
        name, member, n = None, None, 0
        with system.open_output_stream(inner) as sink, zipfile.ZipFile(
            sink, "w", zipfile.ZIP_DEFLATED, compresslevel=1
        ) as opened:
            for batch in batches:
                for file, text in batch.groupby("source_file", sort=True)["value"]:
                    if file != name:
                        if member:
                            member.close()
                        name, member = file, opened.open(file, "w", force_zip64=True)
                    member.write(("\n".join(text) + "\n").encode())
                    n += len(text)
            if member:
                member.close()
        yield pd.DataFrame({"path": [path], "n": [n]})

    written = lines.sortWithinPartitions("source_file").mapInPandas(archive, "path string, n long")
    return [row["path"] for row in written.collect()]
