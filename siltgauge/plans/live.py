"""Registered queries of live figures, versions, large arrays, sketches, the stage graph and table upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import REQUIRED_FIELDS
from ..functions.quantiles import exact_quantiles, value_counts
from ..operators import graph, metrics, sketches, versions
from ..operators.records import emit_json
from ..operators.validate import reject_unfit, validate
from ..session import ROCKSDB, landed, scratch_dir, settings
from ..sources import arrays, upkeep, writers
from ..streaming import latency, progress, silence
from . import fixtures as fx
from .queries import FLOW, append_and_read, flow_alerts, joined, query, stream_totals, with_seconds

STAGES = ["ingest", "process", "store"]


def _stage_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "stages")
    return append_and_read(spark, latency.join_stages(fx.stage_logs(spark, sf_dir), "event_id", "at"), base)


@query
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its milliseconds to the later stages and the last stage it reached."""
    found = _stage_times(spark, sf_dir)
    since = [F.unix_millis(f"{s}_time") - F.unix_millis("ingest_time") for s in STAGES[1:]]
    return found.select("event_id", "last_stage", since[0].alias("process_ms"), since[1].alias("store_ms"))


@query
def stream_latency_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = latency.stage_spans(_stage_times(spark, sf_dir), STAGES).where("ms IS NOT NULL")
    counts = landed(value_counts(spans, ["stage"], "ms"), "counts")
    summary = counts.groupBy("stage").agg(F.sum("n").alias("n"), F.max("ms").alias("max_ms"))
    return summary.join(exact_quantiles(counts, ["stage"], "ms", {"p50_ms": 0.5, "p95_ms": 0.95}), "stage")


@query
def stream_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts and recoveries of flows without a record for two hours, over six micro-batches."""
    base = scratch_dir(spark, "silence")
    found = silence.silences(fx.dirty_stream(spark, sf_dir), FLOW, "ingest_ts", "2 hours")
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        rows = append_and_read(spark, found, base)
    return with_seconds(rows, "at")


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of a live stream from its own reports: rows, valid rows, rows dropped as late, quality."""
    base = scratch_dir(spark, "progress")
    log = progress.ProgressLog(spark, f"{base}/reports")
    spark.streams.addListener(log)
    try:
        checked = validate(fx.dirty_stream(spark, sf_dir), metrics="live_rows").select("event_id", "is_valid")
        running = writers.append_table(checked, f"{base}/table", f"{base}/checkpoint")
        running.awaitTermination()
        log.wait_for(running.runId)
    finally:
        spark.streams.removeListener(log)
    return progress.live_totals(progress.read_progress(spark, f"{base}/reports")).drop("query_id")


@query
def schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _version_texts(versions.schema_versions(fx.dirty(spark, sf_dir), "ingest_ts", "24 hours", [FLOW]))


@query
def stream_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream, by the totals it keeps per window."""
    stream = fx.dirty_stream(spark, sf_dir).withWatermark("ingest_ts", "1 hour")
    counts = versions.shape_counts(stream, "ingest_ts", "24 hours", [FLOW])
    return _version_texts(versions.version_timeline(stream_totals(spark, counts, "versions", [FLOW, "window_start", "shape"]), "24 hours", [FLOW]))


def _version_texts(found: DataFrame) -> DataFrame:
    lists = [joined(c) for c in ("added", "removed", "retyped")]
    return with_seconds(found, "first_seen", "last_seen").select(FLOW, "version", "first_seen", "last_seen", "n", *lists)


@query
def ingest_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files of one flow each, of records over many lines, read in splits: records by verdict."""
    path = scratch_dir(spark, "arrays")
    fx.write_arrays(spark, sf_dir, path)
    # several splits a file at any size, and not more than some hundreds of tasks for large ones
    split = max(256 << 10, upkeep.size_of(spark, path) // 512)
    with settings(spark, spark__sql__files__maxPartitionBytes=str(split), spark__sql__files__openCostInBytes="1k"):
        records = arrays.read_json_array_split(spark, path)
    return validate(records).select(joined("errors")).groupBy("errors").agg(F.count(F.lit(1)).alias("n"))


@query
def latency_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of 28-day windows from weekly sketches, and whether their ranks are within the stated bound."""
    times = fx.stages(spark, sf_dir)
    spans = times.select("placed", (F.unix_millis("t_last") - F.unix_millis("placed")).alias("ms"))
    weeks = landed(sketches.latency_sketches(spans, "ms", "placed", "7 days"), "sketches")
    found = landed(sketches.sketch_quantiles(sketches.merged_sketches(weeks, "28 days"), {"p50": 0.5, "p95": 0.95}), "quantiles")
    ranked = spans.where("ms IS NOT NULL").withColumn("window_start", F.window("placed", "28 days")["start"]).join(F.broadcast(found), "window_start")
    checks = []
    for name, p in (("p50", 0.5), ("p95", 0.95)):
        upto, below = F.count_if(F.col("ms") <= F.col(name)), F.count_if(F.col("ms") < F.col(name))
        most, least = p + sketches.RANK_ERROR, p - sketches.RANK_ERROR
        checks.append(((upto >= least * F.count(F.lit(1))) & (below <= most * F.count(F.lit(1)))).alias(f"{name}_holds"))
    return with_seconds(ranked.groupBy("window_start", "n", "mean", "largest").agg(*checks), "window_start")


@query
def stage_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions feed the validation, which feeds the flows, which feed the store; the store feeds back."""
    lag = metrics.lag_alerts(metrics.consumer_lag(*fx.offsets(spark, sf_dir, "2024-01-28 12:00:00")), 500)
    lag = lag.select(F.concat(F.lit("partition "), F.col("partition_id")).alias("stage"), "severity")
    flows = flow_alerts(spark, sf_dir).select(F.concat(F.lit("flow "), F.col(FLOW)).alias("stage"), "window_start", "severity")
    failing = landed(graph.failing_stages(lag, "stage").unionByName(graph.failing_stages(flows, "stage", "window_start")), "failing")
    parts, names = lag.select("stage").distinct(), flows.select("stage").distinct()
    edges = parts.select(F.col("stage").alias("source"), F.lit("validate").alias("target"))
    edges = edges.unionByName(names.select(F.lit("validate").alias("source"), F.col("stage").alias("target")))
    edges = edges.unionByName(names.select(F.col("stage").alias("source"), F.lit("store").alias("target")))
    edges = landed(edges.unionByName(spark.createDataFrame([("store", "validate")], "source string, target string")), "edges")
    stages = edges.select(F.explode(F.array("source", "target")).alias("stage")).distinct()
    health = graph.graph_health(failing, edges, stages)
    return health.select("stage", "status", joined("causes"))


@query
def packed_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the verdict table after four of its six micro-batches were packed, twice."""
    base = scratch_dir(spark, "packed")
    checked = validate(fx.dirty_stream(spark, sf_dir)).select("event_id", "ingest_ts", "value", "is_valid", "errors")
    writers.split_by_verdict(checked, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    for _ in range(2):
        upkeep.pack(spark, f"{base}/table", "ingest_ts", upto=3)
    return upkeep.read_verdicts(spark, f"{base}/table").select("event_id", "value", "is_valid", joined("errors"))


@query
def replay_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is appended of quarantined records of which nine in ten were repaired, replayed twice."""
    path = scratch_dir(spark, "replay")
    bad = validate(fx.dirty(spark, sf_dir)).where("not is_valid").select("event_id", "value")
    mended = emit_json(fx.clean(spark, sf_dir)).select("event_id", F.col("value").alias("clean"))
    value = F.when(F.col("event_id") % 10 == 0, F.col("value")).otherwise(F.col("clean")).alias("value")
    repaired = landed(bad.join(mended, "event_id").select("event_id", value), "repaired")
    for _ in range(2):
        upkeep.replay(spark, repaired, validate, path)
    return spark.read.parquet(path).select("event_id", "value")


@query
def lake_unfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a typed table keeps out: invalid records, and valid ones with a value that its type cannot hold."""
    base = scratch_dir(spark, "unfit")
    checked = reject_unfit(validate(fx.edge_stream(spark, sf_dir), typed=REQUIRED_FIELDS)).select("event_id", "value", "is_valid", "errors")
    writers.split_by_verdict(checked, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return writers.read_quarantined(spark, f"{base}/table").select("event_id", "value", joined("errors"))
