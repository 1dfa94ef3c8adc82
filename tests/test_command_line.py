"""The four steps on raw files, end to end."""

import json
import zipfile
from dataclasses import replace

import pytest

from lendwatch import __main__ as command
from lendwatch import fixture
from lendwatch.operators.quality import GateError


def test_all_steps(spark, small, tmp_path, capfd, monkeypatch):
    given = command._config
    monkeypatch.setattr(command, "_config", lambda args: replace(given(args), gbt_iterations=5))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "tables")
    paths = fixture.write_archives(fixture.raw_lines(spark, small), str(tmp_path / "zips"))
    zips = str(tmp_path / "zips")
    months = [f"15/{m:02d}/{y}" for y in range(1995, 2002) for m in range(1, 13)]
    records = [{"data": d, "valor": f"{5 + i % 7},25"} for i, d in enumerate(months)]
    (tmp_path / "rates.json").write_text(json.dumps(records))

    def step(*argv):
        command.run(spark, command._arguments([*argv, "--out", out]))

    def rows(name):
        return spark.read.parquet(f"{out}/{name}").count()

    def unpack():
        command.run(spark, command._arguments(["unpack", "--archives", zips, "--raw", raw]))
        return capfd.readouterr().out

    members = sum(len([n for n in zipfile.ZipFile(p.removeprefix("file://")).namelist() if n.endswith(".csv")]) for p in paths)
    assert f"{members} members unpacked" in unpack() and "0 members unpacked" in unpack()
    step("ingest", "--raw", raw, "--limit", "2")
    assert "-RECORD 1" in capfd.readouterr().out
    step("ingest", "--raw", raw, "--month", "2030-01")
    assert "0 files loaded" in capfd.readouterr().out
    step("ingest", "--raw", raw, "--month", "1995-06")
    assert "1 files loaded" in capfd.readouterr().out
    step("ingest", "--raw", raw)
    assert f"{members - 1} files loaded" in capfd.readouterr().out
    step("ingest", "--raw", raw)
    assert "0 files loaded" in capfd.readouterr().out
    step("rates", "--json", str(tmp_path / "rates.json"))
    with pytest.raises(GateError, match="freshness"):
        step("marts")
    step("marts", "--as-of", "2001-12-31", "--min-portfolio", "20000")
    assert rows("fact_credit_operation") == 6000
    assert rows("rpt_state_default_by_month") == 414
    assert rows("dim_taxa_selic") == 84 and rows("dim_state") == 5
    step("train", "--no-write")
    assert "roc_auc" in capfd.readouterr().out
    step("train")
    latest = spark.read.parquet(f"{out}/ew_features").agg({"reference_month": "max"}).first()[0]
    scored = spark.read.parquet(f"{out}/ew_segment_scores")
    assert {r[0] for r in scored.select("reference_month").distinct().collect()} == {latest}
    assert rows("ew_model_deciles") == 10 and rows("ew_model_importance") == 10
    assert rows("ew_segment_scores_history") == scored.count() == rows("ew_segment_scores_en")
    states = scored.select("state").distinct().count()
    assert rows("ew_kpis") == 1 and rows("ew_state_share") == states
    assert rows("ew_watchlist") == min(10, scored.count())
    assert rows("ew_flagged_trend") > 18 and rows("ew_high_risk_breakdown") >= 3
