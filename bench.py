"""Time the headline queries and print one JSON line.

Every query runs once, in full, in a fresh application: a query that needs a
shared table (dimensions, features, fitted models) pays for building it. The bulk
load reads raw text files, written beforehand, into the typed, partitioned table;
its rate is the number the published load rate compares with. ``BENCH_COPIES``
multiplies the raw lines for a load of realistic size.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from lendwatch import fixture, queries
from lendwatch.session import local_session
from lendwatch.sources import sinks
from lendwatch.storage import new_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
PUBLISHED_LOAD_ROWS_PER_SEC = 7211

HEADLINE = [
    "csv_quarantine_counts",
    "dim_credit_modality",
    "fact_credit_operation",
    "rpt_state_default_by_month",
    "rpt_sector_default_by_month",
    "rpt_credit_by_state_sector_month",
    "rpt_top_sector_default_by_month",
    "ew_segment_month",
    "ew_features",
    "ks_auc_ap",
    "decile_lift",
    "feature_medians",
    "risk_bands",
    "dq_report",
    "band_trend",
    "watchlist_top",
    "model_metrics_table",
    "score_latest",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    shared = tempfile.mkdtemp(prefix="lendwatch-bench-")
    spark = local_session(CPUS, "bench", **{"spark.checkpoint.dir": shared})
    spark.range(1000).selectExpr("sum(id)").collect()

    raw = queries.raw_root(spark, SF_DIR)
    if COPIES > 1:
        raw = new_path(spark, "raw-copies")
        lines = fixture.raw_lines(spark, SF_DIR)
        fixture.write_raw_files(
            lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).drop("copy"),
            raw,
        )
    bronze = new_path(spark, "bronze")
    load = timed(lambda: sinks.append_new_files(spark, raw, bronze))
    loaded = sinks.read_bronze(spark, bronze).count()

    times = {"bulk_load": load}
    for name in HEADLINE:
        run = queries.REGISTRY[name]
        times[name] = timed(
            lambda: run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "load_rows": loaded,
                "load_rows_per_sec": round(loaded / load),
                "published_load_rows_per_sec": PUBLISHED_LOAD_ROWS_PER_SEC,
            }
        )
    )


if __name__ == "__main__":
    main()
