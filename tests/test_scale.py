"""Work that must not be done twice as tables grow: counted rows, and plans without broadcasts."""

import datetime as dt
import re
import time
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendwatch import fixture, queries
from lendwatch.schema import RAW_COLUMNS
from lendwatch.sources import archives, raw_text
from lendwatch.storage import size_of


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _below(plan, text):
    """The subtrees of the plan's lines that hold ``text``."""
    lines = plan.split("\n")
    depth = [len(re.match(r"[ :+\-]*", line)[0]) for line in lines]
    for i, line in enumerate(lines):
        if text in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i + 1 : end])


@pytest.fixture
def orders(spark, tmp_path):
    """Order tables of 40 orders with three line items each, two of them twice, and one of no order; 31 make two lines."""
    day = dt.datetime(1996, 1, 5)
    items = [(k, i % 4, i % 3, i, 1.0 + i % 50, 100.0 + 7 * i, 0.01 * (i % 9), 0.02, day + dt.timedelta(days=11 * k)) for i in range(120) for k in (i // 3,)]
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_regionkey int, n_name string", [(i, 0, f"NATION_{i}") for i in range(3)]),
        "customer": ("c_custkey long, c_nationkey int, c_mktsegment string", [(i, i % 3, "FURNITURE") for i in range(5)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(i, i) for i in range(3)]),
        "part": ("p_partkey long, p_type string, p_brand string", [(i, f"T{i}", f"B{i}" if i else "B\x0b") for i in range(4)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string", [(k, k % 5, "O", "1-URGENT") for k in range(40)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp",
            [*items, items[4], items[77], (None, *items[0][1:])],
        ),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(str(tmp_path / f"orders/{name}.parquet"))
    return str(tmp_path / "orders")


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_raw_lines_in_parts_are_the_same_lines(spark, orders, monkeypatch):
    monkeypatch.setattr(fixture, "PART_BYTES", size_of(spark, f"{orders}/lineitem.parquet") / 5)
    parts = [Counter(map(tuple, part.collect())) for part in fixture.raw_parts(spark, orders)]
    assert len(parts) == 5 and all(parts)
    whole = Counter(map(tuple, fixture.raw_lines(spark, orders).collect()))
    assert sum(parts, Counter()) == whole and sum(whole.values()) == 122 + 31


def test_a_part_joins_its_own_orders_only(spark, orders, no_broadcast):
    plan = _plan(fixture.raw_lines(spark, orders, (1, 3)))
    assert "pmod(xxhash64(l_orderkey" in plan and "pmod(xxhash64(o_orderkey" in plan


def test_shuffle_files_go_with_each_part_of_the_raw_lines(spark, orders, tmp_path, monkeypatch):
    monkeypatch.setattr(fixture, "PART_BYTES", size_of(spark, f"{orders}/lineitem.parquet") / 3)
    before, write, made = _shuffle_files(spark), fixture._write_text, []

    def left():
        end = time.time() + 10
        while (found := _shuffle_files(spark) - before) and time.time() < end:
            time.sleep(0.1)
        return found

    def watched(lines, root):
        made.append(len(left()))
        write(lines, root)

    monkeypatch.setattr(fixture, "_write_text", watched)
    root = str(tmp_path / "raw")
    fixture.write_raw_files(fixture.raw_parts(spark, orders), root)
    assert made == [0] * 4  # three parts and the headers
    monkeypatch.undo()
    lines = raw_text.read_raw_lines(spark, root)
    months = lines.select(F.regexp_extract("source_file", "scrdata_[0-9]+", 0)).distinct().count()
    assert lines.count() == 122 + 31 + months


@pytest.mark.parametrize("name", ["append_idempotent", "incremental_stream_load"])
def test_loads_of_text_built_in_parts_are_whole(spark, orders, monkeypatch, name):
    monkeypatch.setattr(fixture, "PART_BYTES", size_of(spark, f"{orders}/lineitem.parquet") / 3)
    write, made = fixture._write_text, []
    monkeypatch.setattr(fixture, "_write_text", lambda lines, root: made.append(root) or write(lines, root))
    found = {r.file: r.n_rows for r in queries.REGISTRY[name](spark, orders).collect()}
    kept = spark.read.parquet(f"{orders}/lineitem.parquet").filter("l_orderkey is not null and l_partkey > 0")
    file = F.date_format("l_shipdate", "'scrdata_'yyyyMM'.csv'").alias("file")
    assert found == {r.file: r["count"] for r in kept.groupBy(file).count().collect()} and sum(found.values()) == 122 - 31
    assert len(made) == 4  # three parts and the headers


def test_raw_lines_are_built_once_and_stored_compressed(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def line(i):
        seen.add(1)
        return f"line {i}"

    months = F.when(F.col("id") % 3 > 0, F.concat(F.lit("scrdata_20240"), F.col("id") % 3, F.lit(".csv")))
    lines = spark.range(30).select(line.asNondeterministic()("id").alias("value"), months.alias("source_file"))
    root = str(tmp_path / "raw")
    fixture.write_raw_files(lines, root)
    assert seen.value == 30
    found = raw_text.read_raw_lines(spark, root).collect()
    header = ";".join(f'"{c}"' for c in RAW_COLUMNS)
    assert sorted(r.value for r in found) == sorted([f"line {i}" for i in range(30)] + [header] * 3)
    assert all(r.source_file.endswith(".gz") for r in found)
    heads = {r.source_file.split("member=")[1].split("/")[0] for r in found if r.value == header}
    assert heads == {"scrdata_202401.csv", "scrdata_202402.csv", "__HIVE_DEFAULT_PARTITION__"}


def test_no_lines_make_no_files(spark, tmp_path):
    fixture.write_raw_files(spark.createDataFrame([], "value string, source_file string"), str(tmp_path / "raw"))
    assert spark.read.text(str(tmp_path / "raw")).isEmpty()


def test_line_items_are_not_dealt_out_by_customer(spark, small, no_broadcast):
    plan = _plan(fixture.staging(spark, small, ["state", "client_size", "active_portfolio"]))
    shuffled = list(_below(plan, "hashpartitioning(o_custkey"))
    assert shuffled and not any("l_orderkey" in tree for tree in shuffled)


def test_damaged_lines_print_each_field_once(spark, small):
    plan = fixture.damaged_lines(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("format_number(") <= 8

def test_quality_report_reads_written_tables_only(spark, small):
    plan = queries.dq_report(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "l_quantity" not in plan


def test_dimensions_built_with_others_serve(spark, small):
    wide = queries.dims_of(spark, small, "modality", "client", "activity")
    few = queries.dims_of(spark, small, "client")
    assert few.keys() == {"client"} and few["client"] is wide["client"]


def test_lines_are_the_same_for_every_character(spark):
    codes = spark.range(0x3000).filter("id not between 55296 and 57343")
    texts = codes.select(F.concat(F.lit("a"), F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')"), F.lit("b")).alias("value"))
    found = texts.select("value", raw_text.line_array(F.col("value")).alias("lines")).collect()
    assert len(found) == 0x3000
    for row in found:
        assert row.lines == re.split("[\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]", row.value)


def test_amounts_are_checked_without_a_function_for_each(spark, small):
    good, _ = raw_text.parse_lines(fixture.raw_lines(spark, small))
    assert "exists(" not in good._jdf.queryExecution().optimizedPlan().toString()


def test_preview_orders_by_a_column(spark, small):
    plan = _plan(raw_text.preview(raw_text.parse_rows(fixture.raw_lines(spark, small)), 3))
    ordering = re.search(r"TakeOrderedAndProject\(.*?orderBy=\[(.*?) ASC", plan)[1]
    assert "md5(" not in ordering


def test_small_members_share_a_task(spark, tmp_path):
    path = str(tmp_path / "many.zip")
    with zipfile.ZipFile(path, "w") as made:
        for i in range(100):
            made.writestr(f"scrdata_{i:06}.csv", f"x\n{i}\n")
    lines = archives.explode_archives(spark, [path])
    cores = spark.sparkContext.defaultParallelism
    assert lines.rdd.getNumPartitions() <= archives.TASKS_PER_CORE * cores < 100
    assert sorted(r.value for r in lines.collect()) == sorted(["x"] * 100 + [str(i) for i in range(100)])
