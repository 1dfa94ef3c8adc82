"""Command line.

    python -m lendwatch unpack --archives ZIPS --raw RAW
    python -m lendwatch ingest --raw RAW --out TABLES [--month YYYY-MM] [--strict-iso] [--limit N]
    python -m lendwatch rates  --json RATES --out TABLES
    python -m lendwatch marts  --out TABLES [--as-of DATE]
    python -m lendwatch train  --out TABLES [--csv FEATURES] [--no-write]
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lendwatch.config import EwConfig
from lendwatch.operators.features import read_features_csv
from lendwatch.plans import model, pipeline
from lendwatch.sources import archives, discovery, rates, raw_text, sinks
from lendwatch.storage import drop_intermediates


def _month(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y-%m").date()


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lendwatch", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)

    unpack = steps.add_parser("unpack", help="write the members of annual archives not unpacked yet")
    unpack.add_argument("--archives", required=True, help="folder of ZIP files")
    unpack.add_argument("--raw", required=True)

    ingest = steps.add_parser("ingest", help="load raw files not loaded yet")
    ingest.add_argument("--month", type=_month, help="only this month's file; before it is published nothing is loaded")
    ingest.add_argument("--max-rejected-share", type=float, help="stop if more of a file's lines are rejected")
    ingest.add_argument("--raw", required=True)
    ingest.add_argument("--strict-iso", action="store_true")
    ingest.add_argument("--limit", type=int, help="show N parsed rows and write nothing")

    daily = steps.add_parser("rates", help="replace the month-end rate table")
    daily.add_argument("--json", required=True, help="file with an array of daily records")

    marts = steps.add_parser("marts", help="build star schema, reports and features")
    train = steps.add_parser("train", help="validate models and score the last month")
    train.add_argument("--csv", help="read features from a CSV instead of the table")
    train.add_argument("--no-write", action="store_true", help="print the validation only")
    marts.add_argument("--as-of", type=dt.date.fromisoformat, help="judge freshness on this day")
    for step in (marts, train):
        step.add_argument("--horizon", type=int, default=EwConfig.horizon_months)
        step.add_argument("--min-portfolio", type=float, default=EwConfig.min_portfolio)
    train.add_argument("--n-test-months", type=int, default=EwConfig.n_test_months)
    for step in (ingest, daily, marts, train):
        step.add_argument("--out", required=True, help="folder of tables")
    return parser.parse_args(argv)


def _config(args: argparse.Namespace) -> EwConfig:
    cfg = replace(
        EwConfig(), horizon_months=args.horizon, min_portfolio=args.min_portfolio
    )
    return replace(cfg, n_test_months=args.n_test_months) if args.step == "train" else cfg


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "unpack":
        zips = discovery.list_files(spark, args.archives).filter(F.lower("path").endswith(".zip"))
        print(archives.unpack(spark, [r.path for r in zips.select("path").collect()], args.raw), "members unpacked")
        return
    bronze = f"{args.out}/bronze"
    if args.step == "ingest" and args.limit:
        rows = raw_text.parse_rows(raw_text.read_raw_lines(spark, args.raw), args.strict_iso)
        raw_text.preview(rows, args.limit).show(args.limit, truncate=False, vertical=True)
    elif args.step == "ingest":
        month = F.lit(args.month) if args.month else None
        loaded = sinks.append_new_files(
            spark, args.raw, bronze, month, args.strict_iso, max_rejected_share=args.max_rejected_share)
        print(loaded, "files loaded")
    elif args.step == "rates":
        pipeline.load_rates(rates.read_rate_files(spark, args.json), args.out)
    elif args.step == "marts":
        table = spark.read.parquet(f"{args.out}/dim_taxa_selic")
        now = F.lit(args.as_of) if args.as_of else F.current_date()
        pipeline.build_marts(sinks.read_bronze(spark, bronze), table, args.out, _config(args), now)
    else:
        features = (
            read_features_csv(spark, args.csv)
            if args.csv
            else spark.read.parquet(f"{args.out}/ew_features")
        )
        if args.no_write:
            v = model.fit_models(features, _config(args))
            model.metrics_table(v, _config(args)).show(truncate=False, vertical=True)
            model.deciles_table(v, _config(args)).orderBy("decil").show(truncate=False)
        else:
            pipeline.train_and_score(features, args.out, _config(args))


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"lendwatch-{args.step}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        run(spark, args)
    finally:
        drop_intermediates(spark)


if __name__ == "__main__":
    main()
