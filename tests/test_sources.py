import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lendwatch.operators import quality
from lendwatch.plans import pipeline
from lendwatch.schema import RAW_COLUMNS
from lendwatch.sources import archives, discovery, ledger, rates, raw_text, sinks
from lendwatch.streaming.incremental import load_incremental

HEADER = "﻿" + ";".join(f'"{c}"' for c in RAW_COLUMNS)


def line(month, amount="1.000,50"):
    fields = [month, *"ABCDEFGHI", "3", *["0"] * 10, amount, "0", "0"]
    return ";".join(f'"{f}"' for f in fields)


def write_month(root, month, lines):
    folder = root / f"year={month[:4]}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"scrdata_{month[:4]}{month[5:7]}.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    write_month(root, "2023-12-31", [line("2023-12-31"), "", line("bad")])
    write_month(root, "2024-01-31", [line("2024-01-31"), HEADER, line("2024-01-31", "x")])
    return root


def test_reads_lines_and_rejects(spark, raw):
    good, quarantine = raw_text.parse_lines(raw_text.read_raw_lines(spark, str(raw)))
    assert sorted(r.data_base for r in good.collect()) == [dt.date(2023, 12, 31), dt.date(2024, 1, 31)]
    assert [r.carteira_ativa for r in good.collect()] == [1000.5, 1000.5]
    assert sorted(r.reason for r in quarantine.collect()) == ["bad_date", "bad_number"]
    assert all(r.source_file.endswith(".csv") for r in good.collect())


def test_unusual_line_breaks_separate_lines(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a\x0bb c\r\nd", encoding="utf-8")
    lines = raw_text.read_raw_lines(spark, str(tmp_path))
    assert sorted(r.value for r in lines.collect()) == ["a", "b", "c", "d"]


def test_preview_is_a_mergeable_sample(spark):
    lines = [line(f"2024-01-{d:02d}", f"{d * 7 % 11},{i:02d}") for d in range(1, 29) for i in range(20)]
    df = spark.createDataFrame([(v, "f.csv") for v in lines], "value string, source_file string")
    draw = lambda rows, seed, parts: [tuple(r) for r in raw_text.preview(raw_text.parse_rows(rows.repartition(parts)), 6, seed).collect()]
    whole = draw(df, 3, 1)
    assert len(set(whole)) == 6 and draw(df, 3, 7) == whole and draw(df, 4, 7) != whole
    halves = [df.filter(F.crc32("value") % 2 == k) for k in (0, 1)]
    assert set(whole) <= {r for h in halves for r in draw(h, 3, 2)}


def test_years_prune_folders(spark, raw):
    lines = raw_text.read_raw_lines(spark, str(raw), years=[2024])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [(year" in plan
    assert {r.source_file[-10:] for r in lines.collect()} == {"202401.csv"}


def test_append_twice_adds_nothing_and_new_month_is_added(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    assert sinks.append_new_files(spark, str(raw), path) == 2
    assert sinks.append_new_files(spark, str(raw), path) == 0
    write_month(raw, "2024-02-29", [line("2024-02-29")])
    january = F.lit(dt.date(2024, 1, 1))
    assert sinks.append_new_files(spark, str(raw), path, month=january) == 0
    assert sinks.append_new_files(spark, str(raw), path) == 1
    assert sinks.read_bronze(spark, path).count() == 3
    assert sinks.read_quarantine(spark, path).count() == 2


def test_ledger_tells_files_without_reading_the_table(spark, raw, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    write_month(raw, "2024-03-31", [])  # a header alone
    assert sinks.append_new_files(spark, str(raw), path) == 3
    monkeypatch.setattr(sinks, "_stored", lambda *_: pytest.fail("stored rows were read"))
    assert sinks.append_new_files(spark, str(raw), path) == 0
    told = {r.source_file[-10:-4]: (r.rows, r.rejected, r.first_day, r.last_day, r.size) for r in ledger.read(spark, path).collect()}
    size = lambda m: (raw / f"year={m[:4]}" / f"scrdata_{m}.csv").stat().st_size
    day = dt.date(2024, 1, 31)
    assert told == {
        "202312": (1, 1, dt.date(2023, 12, 31), dt.date(2023, 12, 31), size("202312")),
        "202401": (1, 1, day, day, size("202401")), "202403": (0, 0, None, None, size("202403"))}


def test_a_load_that_dies_leaves_no_rows(spark, raw, tmp_path, monkeypatch):
    path = str(tmp_path / "bronze")
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            sinks.append_new_files(spark, str(raw), path)
    write_month(raw, "2024-02-29", [line("2024-02-29")])
    february = F.lit(dt.date(2024, 2, 1))
    assert sinks.append_new_files(spark, str(raw), path, month=february) == 1
    assert [r.data_base for r in sinks.read_bronze(spark, path).collect()] == [dt.date(2024, 2, 29)]
    assert sinks.append_new_files(spark, str(raw), path) == 2
    assert sinks.read_bronze(spark, path).count() == 3 and sinks.read_quarantine(spark, path).count() == 2
    # A load under way, or one that died: its folder is there, its rows are not.
    (tmp_path / "bronze" / "load_id=half").mkdir()
    assert ledger.drop_unfinished(spark, path) == ["half"] and sinks.read_bronze(spark, path).count() == 3


def test_a_streams_table_is_not_touched(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    load_incremental(spark, str(raw), path, str(tmp_path / "checkpoint"))
    with pytest.raises(ValueError, match="no ledger knows"):
        sinks.append_new_files(spark, str(raw), path)
    assert sinks.read_bronze(spark, path).count() == 2


def test_a_changed_file_stops_the_load(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    assert sinks.append_new_files(spark, str(raw), path) == 2
    write_month(raw, "2024-01-31", [line("2024-01-31"), line("2024-01-31", "7,0")])
    with pytest.raises(ValueError, match="scrdata_202401.csv"):
        sinks.append_new_files(spark, str(raw), path)
    assert sinks.read_bronze(spark, path).count() == 2


def test_loads_of_few_files_and_the_gate(spark, raw, tmp_path):
    path = str(tmp_path / "bronze")
    write_month(raw, "2024-02-29", [line("2024-02-29")])
    with pytest.raises(quality.GateError, match="rejected_share"):
        sinks.append_new_files(spark, str(raw), path, max_rejected_share=0.4)
    assert sinks.read_bronze(spark, path).count() == 0
    assert sinks.append_new_files(spark, str(raw), path, max_files=2) == 3
    assert ledger.read(spark, path).select("load_id").distinct().count() == 2
    entries = ledger.read(spark, path)
    lines = raw_text.lines_per_file(raw_text.read_raw_lines(spark, str(raw)))
    assert [r.status for r in sinks.load_checks(entries, lines).collect()] == ["pass", "pass"]
    more = lines.withColumn("lines", F.col("lines") + F.contains("source_file", F.lit("202401")).cast("int"))
    assert [r.failures for r in sinks.load_checks(entries, more, 0.4).collect()] == [1, 2]
    assert [r.failures for r in sinks.load_checks(entries.filter("rejected > 0"), lines).collect()] == [1, 0]


def test_stream_loads_each_file_once(spark, raw, tmp_path):
    args = (spark, str(raw), str(tmp_path / "bronze"), str(tmp_path / "checkpoint"))
    assert load_incremental(*args) == 8
    assert load_incremental(*args) == 0
    write_month(raw, "2024-02-29", [line("2024-02-29")])
    assert load_incremental(*args) == 2
    assert sinks.read_bronze(spark, args[2]).count() == 3
    assert sinks.read_quarantine(spark, args[2]).count() == 2


def test_archives_round_trip(spark, tmp_path):
    paths = []
    for year in (2023, 2024):
        paths.append(str(tmp_path / f"scrdata_{year}.zip"))
        with zipfile.ZipFile(paths[-1], "w") as z:
            for month in ("01", "02"):
                z.writestr(f"scrdata_{year}{month}.csv", f"{HEADER}\r\n{line(f'{year}-{month}-28')}\n")
            z.writestr("readme.txt", "no")
    lines = archives.explode_archives(spark, paths)
    assert lines.count() == 8
    skip = spark.createDataFrame([("scrdata_202301.csv",)], "member string")
    rest = archives.explode_archives(spark, paths, existing=skip)
    assert rest.select("member").distinct().count() == 3
    archives.write_raw(lines, str(tmp_path / "raw"))
    good, quarantine = raw_text.parse_lines(
        raw_text.read_raw_lines(spark, str(tmp_path / "raw"), years=[2024])
    )
    assert good.count() == 2 and quarantine.count() == 0


def test_members_of_equal_name_are_doubles_only_if_they_agree(spark, tmp_path):
    paths = [str(tmp_path / f"{n}.zip") for n in "abc"]
    for path, text in zip(paths, ("1\n2", "1\n2", "1\n3")):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("m_202401.csv", text)
    assert archives.explode_archives(spark, paths[:2]).count() == 2
    got = archives.explode_archives(spark, paths).collect()
    assert sorted((r.archive[-5:], r.value) for r in got) == [("a.zip", "1"), ("a.zip", "2"), ("c.zip", "1"), ("c.zip", "3")]
    loaded = spark.createDataFrame([("m_202401.csv",)], "member string")
    assert archives.explode_archives(spark, paths, existing=loaded).count() == 0


def test_large_member_arrives_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LINES_PER_BATCH", 7)
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("m.csv", "\n".join(str(i) for i in range(100)))
    got = sorted(int(r.value) for r in archives.explode_archives(spark, [path]).collect())
    assert got == list(range(100))


def test_target_month(spark):
    days = [dt.date(2026, 1, 20), dt.date(2026, 3, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    months = df.select(discovery.target_month(F.col("d")).alias("m"))
    names = [r[0] for r in months.select(discovery.monthly_file_name(F.col("m"))).collect()]
    assert names == ["scrdata_202512.csv", "scrdata_202602.csv"]


def test_replace_month(spark, tmp_path):
    path = str(tmp_path / "history")

    def scores(*rows):
        return spark.createDataFrame(
            [(dt.date(2026, m, 1), s, v) for m, s, v in rows],
            "reference_month date, segment_id string, score double",
        )

    sinks.replace_month(scores((6, "a", 0.1), (6, "b", 0.2)), path, "reference_month")
    sinks.replace_month(scores((7, "a", 0.3)), path, "reference_month")
    sinks.replace_month(scores((7, "a", 0.4)), path, "reference_month")
    stored = spark.read.parquet(path).select("reference_month", "segment_id", "score")
    assert sorted(tuple(r)[1:] for r in stored.collect()) == [("a", 0.1), ("a", 0.4), ("b", 0.2)]


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 2):
        sinks.overwrite(spark.range(n), path)
    assert spark.read.parquet(path).count() == 2


def test_a_failed_overwrite_keeps_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(5), path)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("died")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="died"):
        sinks.overwrite(broken, path)
    assert spark.read.parquet(path).count() == 5
    sinks.overwrite(spark.read.parquet(path).filter("id < 3"), path)  # from its own rows
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("done", [0, 1, 2])
def test_an_overwrite_that_dies_between_its_renames(spark, tmp_path, monkeypatch, done):
    path, real, calls = str(tmp_path / "t"), sinks.move, []
    sinks.overwrite(spark.range(5), path)

    def dying(*args):
        if len(calls) == done:
            raise RuntimeError("killed")
        calls.append(args)
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(sinks, "move", dying)
        if done == 2:
            m.setattr(sinks, "remove", lambda _, p: dying() if p.endswith(".old") else False)
        with pytest.raises(RuntimeError, match="killed"):
            sinks.overwrite(spark.range(9), path)
    sinks.restore(spark, path)
    assert spark.read.parquet(path).count() == (9 if done == 2 else 5)
    sinks.overwrite(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2 and not sinks.restore(spark, path)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_unpack_once_by_content(spark, tmp_path):
    zips, raw = tmp_path / "zips", str(tmp_path / "raw")
    zips.mkdir()

    def put(name, **members):
        with zipfile.ZipFile(zips / name, "w") as z:
            for month, amount in members.items():
                z.writestr(f"scr{month}.csv", f"{HEADER}\n{line(f'{month[4:8]}-{month[8:]}-28', amount)}\n")
        return str(zips / name)

    one = put("2023.zip", data202301="1", data202302="2")
    assert archives.unpack(spark, [one], raw) == 2 and archives.unpack(spark, [one], raw) == 0
    two = put("2023b.zip", data202301="1", data202303="3")
    assert archives.unpack(spark, [one, two], raw) == 1
    assert sorted(r.member for r in archives.unpacked_members(spark, raw).collect()) == [f"scrdata20230{i}.csv" for i in (1, 2, 3)]
    good, _ = raw_text.parse_lines(raw_text.read_raw_lines(spark, raw))
    assert sorted(r.carteira_ativa for r in good.collect()) == [1.0, 2.0, 3.0]
    three = put("2023c.zip", data202302="9")
    with pytest.raises(ValueError, match="scrdata202302.csv"):
        archives.unpack(spark, [three], raw)
    four = [put("x.zip", data202304="4"), put("y.zip", data202304="5")]
    with pytest.raises(ValueError, match="scrdata202304.csv"):
        archives.unpack(spark, four, raw)
    assert raw_text.parse_lines(raw_text.read_raw_lines(spark, raw))[0].count() == 3


def test_rates(spark, tmp_path):
    path = tmp_path / "rates.json"
    days = [("02/01/2023", "13.75"), ("31/01/2023", "13,25"), ("31/01/2023", "12.0"), ("3/2/2023", "9")]
    path.write_text(json.dumps([{"data": d, "valor": v} for d, v in days]))
    daily = rates.read_rate_files(spark, str(path))
    ends = {r.reference_date: r.selic_target_rate_annual for r in rates.month_end_rates(daily).collect()}
    assert ends == {dt.date(2023, 1, 31): 13.25, dt.date(2023, 2, 28): 9.0}
    assert rates.provisional_flag(daily).first().is_provisional
    assert pipeline.load_rates(daily, str(tmp_path)).count() == 2
    with pytest.raises(quality.GateError):
        pipeline.load_rates(daily, str(tmp_path), high=10.0)


def test_an_open_month_has_no_change(spark, tmp_path):
    days = [(dt.date(2023, m, d), 2.0 + m) for m in range(1, 10) for d in (2, 28)] + [(dt.date(2023, 10, 3), 2.5)]
    daily = spark.createDataFrame(days, "day date, value double")
    table = pipeline.load_rates(daily, str(tmp_path))
    assert [r.data_base for r in table.filter("is_provisional").collect()] == [dt.date(2023, 10, 31)]
    got = {r.month_start.month: (r.selic_rate, r.selic_chg_6m) for r in rates.rate_changes(rates.dim_rate(table)).collect()}
    assert got[9] == (11.0, 6.0) and got[10] == (2.5, None) and got[3] == (5.0, None)
    whole = rates.known_on(daily, F.lit(dt.date(2023, 9, 30))).unionByName(spark.createDataFrame([(dt.date(2023, 9, 30), 11.5)], daily.schema))
    closed = rates.dim_rate(rates.with_provisional(rates.month_end_table(whole), whole))
    assert {r.month_start.month: r.selic_chg_6m for r in rates.rate_changes(closed).collect()}[9] == 6.5
    spans = sorted(tuple(r) for r in rates.rate_intervals(daily.unionByName(daily)).collect())
    assert len(spans) == 19 and spans[-1] == (dt.date(2023, 10, 3), None, 2.5)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_broken_or_empty_rates_keep_the_stored_table(spark, tmp_path):
    out, path = str(tmp_path / "out"), tmp_path / "r.json"
    path.write_text('[{"data":"02/01/2023","valor":"13.75"}]')
    pipeline.load_rates(rates.read_rate_files(spark, str(path)), out)
    for n, bad in enumerate(['[{"data":"02/01/2023","val', "[]", "", "null"]):
        file = tmp_path / f"bad{n}.json"
        file.write_text(bad)
        with pytest.raises(Exception):  # noqa: B017
            pipeline.load_rates(rates.read_rate_files(spark, str(file)), out)
        assert spark.read.parquet(f"{out}/dim_taxa_selic").count() == 1


def test_stream_counts_every_batch(spark, tmp_path):
    src = tmp_path / "src" / "year=2023"
    src.mkdir(parents=True)
    for i in range(110):
        (src / f"f{i:03d}.csv").write_text("a\nb\n")
    out = str(tmp_path / "out")
    read = load_incremental(spark, str(tmp_path / "src"), out, str(tmp_path / "cp"), max_files=1)
    assert read == 220
