"""Runs the headline queries once warm and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from siltgauge.plans.queries import QUERIES
from siltgauge.session import local_session

HEADLINE = [
    "validate",
    "inject_all",
    "errors_by_rule",
    "detection_matrix",
    "dq_duplicates",
    "dq_duplicate_rows",
    "schema_drift",
    "null_profile",
    "quality_pct",
    "quality_per_window",
    "events_per_window",
    "running_total",
    "hourly_change",
    "stage_latency",
    "alerts",
    "inject_exact",
    "synth_finite",
    "derive_tax",
    "stream_ingest",
    "stream_quality",
    "quarantine",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="bench-")
    # the files are small: none is put together with others
    splits = {"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "1m"}
    spark = local_session(cores, **splits, **{"spark.checkpoint.dir": shared})
    # A given table is one file of one row group, which is one task. Before the clock starts it becomes a file per
    # core, by ranges of its first column, as a table of any size would be.
    given, sf_dir = sf_dir, f"{shared}/sf"
    for name in ("events", "orders", "lineitem", "part"):
        table = spark.read.parquet(f"{given}/{name}.parquet")
        table.repartitionByRange(int(cores), table.columns[0]).write.parquet(f"{sf_dir}/{name}.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    QUERIES["null_profile"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    timings = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    rates = {name: round(events / timings[name]) for name in ("validate", "inject_all", "quality_pct", "stream_quality")}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
                "event_rows": events,
                "rows_per_sec": rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
