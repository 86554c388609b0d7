"""What running streams report of themselves, kept as a table: rows, rates, late rows, offsets, observed counts."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_METRICS = "map<string,string>"
_SOURCE = "description string, startOffset string, endOffset string, latestOffset string, numInputRows bigint, metrics map<string,string>"
PROGRESS = (
    "id string, runId string, name string, timestamp string, batchId bigint, numInputRows bigint, "
    "inputRowsPerSecond double, processedRowsPerSecond double, durationMs map<string,bigint>, eventTime map<string,string>, "
    "stateOperators array<struct<numRowsTotal bigint, numRowsDroppedByWatermark bigint>>, "
    f"sources array<struct<{_SOURCE.replace(' string', ':string').replace(' bigint', ':bigint').replace(' map', ':map')}>>, "
    "observedMetrics map<string,map<string,bigint>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes every progress report of a session's streams into ``path``, a file per query and batch.

    A batch that is reported again (a repeated one, or one without new data) replaces its report. Add it with
    ``spark.streams.addListener``; ``wait_for`` tells when all reports of an ended query are written.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def _event(self, run: object) -> threading.Event:
        return self._ended.setdefault(str(run), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        text = json.dumps(json.loads(progress.json))
        jvm = self._spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self._path}/{progress.id}-{progress.batchId}.json")
        out = target.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def wait_for(self, run_id: object, seconds: float = 60) -> None:
        if not self._event(run_id).wait(seconds):
            raise TimeoutError(f"Query {run_id} has not reported its end.")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The reports in a table: a row per query and batch."""
    raw = spark.read.text(path).select(F.from_json("value", PROGRESS).alias("p")).select("p.*")
    dropped = F.aggregate(
        F.coalesce("stateOperators", F.array()), F.lit(0).cast("bigint"), lambda n, s: n + F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0))
    )
    return raw.select(
        F.col("id").alias("query_id"),
        F.col("runId").alias("run_id"),
        "name",
        F.to_timestamp("timestamp").alias("reported_at"),
        F.col("batchId").alias("batch_id"),
        F.col("numInputRows").alias("n"),
        F.col("inputRowsPerSecond").alias("in_per_second"),
        F.col("processedRowsPerSecond").alias("done_per_second"),
        F.col("durationMs")["triggerExecution"].alias("batch_ms"),
        F.to_timestamp(F.col("eventTime")["watermark"]).alias("watermark"),
        dropped.alias("dropped"),
        "sources",
        F.col("observedMetrics").alias("observed"),
    )


def _observed(metric: str) -> Column:
    """An observed count, summed over the names it was observed under."""
    per_name = F.transform(F.map_values(F.coalesce("observed", F.create_map())), lambda m: F.coalesce(m[metric], F.lit(0)))
    return F.aggregate(per_name, F.lit(0).cast("bigint"), lambda n, v: n + v)


def live_totals(progress: DataFrame, by: str = "query_id") -> DataFrame:
    """Batches, rows, validated and valid rows, rows dropped as late, and quality of every stream so far."""
    counted = progress.groupBy(by).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("n").alias("n"),
        F.sum(_observed("rows")).alias("n_checked"),
        F.sum(_observed("valid_rows")).alias("n_valid"),
        F.sum("dropped").alias("n_dropped"),
    )
    return counted.withColumn("quality_pct", F.try_divide(F.col("n_valid") * F.lit(100.0), F.col("n_checked")))


def live_rates(progress: DataFrame, width: str = "1 minute") -> DataFrame:
    """Rows and rows per second by query and window of report time."""
    counted = progress.groupBy("query_id", F.window("reported_at", width).alias("_w")).agg(F.sum("n").alias("n"))
    seconds = (F.unix_micros("_w.end") - F.unix_micros("_w.start")) / F.lit(1e6)
    return counted.select("query_id", F.col("_w.start").alias("window_start"), "n", (F.col("n") / seconds).alias("per_second"))


_OFFSETS = "map<string,map<string,bigint>>"


def source_lag(progress: DataFrame) -> DataFrame:
    """Records per query, topic and partition that the newest report leaves unread, from the offsets of sources that
    count records (topic -> partition -> offset). Sources with other offsets give no rows."""
    newest = Window.partitionBy("query_id").orderBy(F.desc("batch_id"))
    last = progress.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1)
    source = last.select("query_id", F.explode("sources").alias("s"))
    ends = source.select("query_id", F.from_json("s.endOffset", _OFFSETS).alias("read"), F.from_json("s.latestOffset", _OFFSETS).alias("there"))
    topics = ends.select("query_id", "read", F.explode("there").alias("topic", "parts"))
    parts = topics.select("query_id", "topic", F.col("read")[F.col("topic")].alias("read"), F.explode("parts").alias("partition_id", "produced"))
    consumed = F.coalesce(F.col("read")[F.col("partition_id")], F.lit(0))
    return parts.select(
        "query_id", "topic", F.col("partition_id").cast("int").alias("partition_id"), "produced", consumed.alias("consumed"), (F.col("produced") - consumed).alias("lag")
    )
