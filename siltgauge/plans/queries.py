"""The registered queries: each runs one operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import REQUIRED_FIELDS, SYNTH_PRODUCTS
from ..operators import aggregates, checks, duplicates, metrics, synth
from ..operators.inject import inject
from ..operators.records import emit_json
from ..operators.validate import validate
from ..session import landed, scratch_dir
from ..sources import readers, writers
from ..streaming import duplicates as stream_duplicates
from ..streaming import quality as stream_quality
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INJECTED = ("event_id", "value", "anomaly_category", "anomaly_detail")
FLOW = "event_type"


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def seconds(name: str) -> Column:
    """A window start as text, so that results compare without time zones."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def joined(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def with_seconds(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: seconds(name) for name in names})


# --- synthesis --------------------------------------------------------------


def _synth_ids(events: DataFrame) -> DataFrame:
    return events.select((F.col("event_id") + 10001).alias("order_id"))


@query
def synth_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _synth_ids(fx.table(spark, sf_dir, "events"))
    return synth.with_transaction(ids, "order_id", fx.SEED).select(*REQUIRED_FIELDS)


@query
def synth_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = synth.with_batch_id(synth_finite(spark, sf_dir), "order_id", 300)
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("order_id").alias("first_id"), F.sum("tax_amount").alias("tax")
    )


@query
def synth_paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _synth_ids(fx.table(spark, sf_dir, "events"))
    return synth.with_transaction(ids, "order_id", fx.SEED, rate=250).select("order_id", "timestamp")


@query
def synth_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "synth")
    ids = _synth_ids(fx.event_stream(spark, sf_dir))
    rows = synth.with_transaction(ids, "order_id", fx.SEED).select(*REQUIRED_FIELDS)
    return append_and_read(spark, rows, base)


@query
def derive_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    taxed = lines.withColumn("tax", synth.tax(F.col("l_extendedprice"), F.col("l_quantity")))
    return taxed.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("tax").cast("decimal(30,2)").alias("tax"), F.count(F.lit(1)).alias("n")
    )


@query
def emit_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit_json(fx.clean(spark, sf_dir)).select("event_id", "value")


@query
def ingest_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records packed into JSON arrays of at most 500 and taken apart again."""
    records = fx.dirty(spark, sf_dir)
    packed = records.groupBy(F.floor(F.col("event_id") / 500).alias("array_id")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")
    )
    checked = validate(readers.records_of_array(packed), parsed="parsed")
    return checked.groupBy("array_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("n_valid"))


# --- validation -------------------------------------------------------------


@query
def validate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(fx.edge(spark, sf_dir)).select("event_id", "is_valid", joined("errors"))


@query
def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(fx.edge(spark, sf_dir), typed=REQUIRED_FIELDS).where("is_valid")
    typed = checked.select("event_id", "record.*").withColumn("unfit", joined("unfit"))
    return typed.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _errors_like(pattern: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        errors = validate(fx.edge(spark, sf_dir)).select("event_id", F.explode("errors").alias("error"))
        return errors.where(F.rlike("error", F.lit(pattern)))

    return run


#: rule family -> pattern of its messages
RULE_FAMILIES = {
    "dq_missing": r"^Missing required field: ",
    "dq_null": r"^NULL value is not allowed: ",
    "dq_type": r"^[a-z_]+ must be (a string|an integer|a number)$",
    "dq_blank": r" cannot be empty$",
    "dq_range": r"( must be greater than 0| cannot be negative)$",
    "dq_enum": r"^Invalid payment_method: ",
    "dq_timestamp": r"ISO 8601",
}
QUERIES.update({name: _errors_like(pattern) for name, pattern in RULE_FAMILIES.items()})


# --- injection --------------------------------------------------------------


def _injected(kind: str, rate: float = 0.05) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fx.dirty(spark, sf_dir, kind, rate).select(*INJECTED)

    return run


#: query -> (kind, rate)
INJECTIONS = {
    "inject_rate": ("null", 0.2),
    "inject_null": ("null", 0.05),
    "inject_schema": ("schema", 0.05),
    "inject_negative_price": ("negative-price", 0.05),
    "inject_invalid_numeric": ("invalid-numeric", 0.05),
    "inject_invalid_enum": ("invalid-enum", 0.05),
    "inject_duplicate": ("duplicate-id", 0.05),
    "inject_all": ("all", 0.05),
}
QUERIES.update({name: _injected(*arguments) for name, arguments in INJECTIONS.items()})


@query
def inject_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.dirty(spark, sf_dir, "all", count=123).select(*INJECTED)


@query
def inject_duplicate_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate ids in a table whose ids follow no formula."""
    orders = fx.clean_from_orders(fx.table(spark, sf_dir, "orders"))
    dirty = inject(orders, "duplicate-id", 0.05, seed=fx.SEED, key="o_orderkey")
    return dirty.select("o_orderkey", "value", "anomaly_category", "anomaly_detail")


# --- aggregates -------------------------------------------------------------


@query
def anomaly_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.anomaly_breakdown(fx.dirty(spark, sf_dir))


@query
def anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.anomaly_rate(fx.dirty(spark, sf_dir))


@query
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.throughput(fx.clean(spark, sf_dir), "ingest_ts")


@query
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.batch_counts(synth.with_batch_id(fx.clean(spark, sf_dir), "event_id", 300, start_order_id=0))


# --- table-level checks -----------------------------------------------------


@query
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.table(spark, sf_dir, "lineitem")
    found = duplicates.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return found.withColumn("first_l_shipdate", F.date_format("first_l_shipdate", "yyyy-MM-dd"))


def _dirty_ids(dirty: DataFrame) -> DataFrame:
    return checks.with_text_fields(dirty.select("event_id", "ingest_ts", "value"), ["order_id"]).drop("value")


@query
def dq_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # event ids rise with the arrival time, so they alone tell the first row
    flagged = duplicates.flag_duplicates(_dirty_ids(fx.dirty(spark, sf_dir)), ["order_id"], ["event_id"])
    return flagged.where("is_duplicate").select("event_id", "order_id")


@query
def dq_duplicate_integer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over ids of the integer kind, which follow no formula."""
    orders = fx.clean_from_orders(fx.table(spark, sf_dir, "orders"))
    dirty = inject(orders, "duplicate-id", 0.05, seed=fx.SEED, key="o_orderkey").select("o_orderkey", "value")
    ids = checks.with_text_fields(dirty, ["order_id"], integers=["order_id"]).drop("value")
    flagged = duplicates.flag_duplicates(ids, ["order_id"], ["o_orderkey"])
    return flagged.where("is_duplicate").select("o_orderkey", F.col("order_id").cast("bigint").alias("order_id"))


def _dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = fx.dirty(spark, sf_dir).select("event_id", "value")
    return checks.with_text_fields(dirty, ["product_id"]).drop("value")


@query
def dq_product_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.product_errors(_dirty_products(spark, sf_dir), SYNTH_PRODUCTS)


@query
def dq_product_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fx.table(spark, sf_dir, "part")
    catalogue = parts.select(F.concat(F.lit("P"), (F.col("p_partkey") % 9 + 501).cast("string")).alias("product_id"))
    return checks.product_errors_by_catalogue(_dirty_products(spark, sf_dir), catalogue)


@query
def dq_unexpected_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = fx.dirty(spark, sf_dir).select("event_id", checks.unexpected_fields().alias("fields"))
    return extra.where(F.size("fields") > 0).select("event_id", joined("fields"))


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.schema_drift(fx.edge(spark, sf_dir))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_profile(fx.dirty(spark, sf_dir))


@query
def errors_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.errors_by_rule(validate(fx.dirty(spark, sf_dir)))


@query
def detection_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(fx.dirty(spark, sf_dir), typed=("order_id", "product_id"))
    product = F.col("record.product_id")
    narrow = checked.select(
        "event_id",
        F.coalesce("anomaly_category", F.lit("clean")).alias("anomaly_category"),
        (~F.col("is_valid")).alias("by_rules"),
        (F.size(checks.unexpected_fields()) > 0).alias("by_fields"),
        (product.isNotNull() & ~product.isin(*SYNTH_PRODUCTS)).alias("by_domain"),
        F.col("record.order_id").alias("order_id"),
    )
    # landed, as marking duplicates reads the rows twice and the records behind them are read once
    flagged = duplicates.flag_duplicates(landed(narrow, "detected"), ["order_id"], ["event_id"], "by_duplicates")
    return checks.detection_matrix(flagged, detectors=("by_rules", "by_fields", "by_domain", "by_duplicates"))


# --- metrics ----------------------------------------------------------------


@query
def events_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.events_per_window(fx.clean(spark, sf_dir), "ingest_ts", "1 hour", by=[FLOW])
    return with_seconds(found, "window_start")


@query
def events_per_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.events_per_window(fx.clean(spark, sf_dir), "ingest_ts", "24 hours", "6 hours")
    return with_seconds(found, "window_start")


@query
def quality_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quality_pct(validate(fx.dirty(spark, sf_dir)))


def flow_metrics(spark: SparkSession, sf_dir: str, width: str = "1 day") -> DataFrame:
    """Quality per flow and window of the corrupted records. The windows are landed, as status and alerts read
    them twice and the records behind them once."""
    windows = metrics.quality_per_window(validate(fx.dirty(spark, sf_dir)), "ingest_ts", width, [FLOW])
    return landed(windows, "windows")


@query
def quality_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = metrics.quality_per_window(validate(fx.dirty(spark, sf_dir)), "ingest_ts", "1 day", [FLOW])
    return with_seconds(windows, "window_start")


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.events_per_window(fx.clean(spark, sf_dir), "ingest_ts", "1 hour").drop("per_second")


@query
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seconds(metrics.running_total(_hourly(spark, sf_dir)), "window_start")


@query
def hourly_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seconds(metrics.change_from_previous(_hourly(spark, sf_dir)), "window_start")


@query
def stage_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stage_latency(fx.stages(spark, sf_dir), "placed", {"first": "t_first", "last": "t_last"})


@query
def flow_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seconds(metrics.flow_status(flow_metrics(spark, sf_dir), FLOW, 95.0), "window_start")


def flow_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.alerts(flow_metrics(spark, sf_dir), FLOW, 95.0, 20.0, step="1 day")


@query
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seconds(flow_alerts(spark, sf_dir), "window_start")


@query
def recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_seconds(metrics.recent_alerts(flow_alerts(spark, sf_dir), FLOW, 7), "window_start")


@query
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag = metrics.consumer_lag(*fx.offsets(spark, sf_dir, "2024-01-28 12:00:00"))
    return metrics.lag_alerts(lag, 500)


@query
def system_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.system_health(flow_alerts(spark, sf_dir), FLOW)


# --- streams ----------------------------------------------------------------


def append_and_read(spark: SparkSession, stream: DataFrame, base: str) -> DataFrame:
    """Run a stream over all available input into a table and read the table."""
    writers.append_table(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines files -> directory stream -> verdicts."""
    base = scratch_dir(spark, "ingest")
    writers.write_json_lines(fx.edge(spark, sf_dir), f"{base}/lines")
    lines = readers.stream_json_lines(spark, f"{base}/lines")
    return append_and_read(spark, validate(lines).select("value", "is_valid", joined("errors")), base)


@query
def lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of a stream, typed, in the append table."""
    base = scratch_dir(spark, "lake")
    checked = validate(fx.dirty_from_events(fx.event_stream(spark, sf_dir)), typed=REQUIRED_FIELDS)
    rows = append_and_read(spark, checked.where("is_valid and size(record.unfit) = 0").select("event_id", "record.*"), base)
    return rows.drop("unfit").withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "quarantine")
    checked = validate(fx.dirty_from_events(fx.event_stream(spark, sf_dir)))
    writers.split_by_verdict(checked, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return writers.read_quarantined(spark, f"{base}/table").select("event_id", "value", joined("errors"))


def stream_totals(spark: SparkSession, stream: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """Run a streaming aggregate over all available input; every window, the open ones too."""
    base = scratch_dir(spark, purpose)
    writers.write_totals(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return writers.read_totals(spark, stream.schema, f"{base}/table", keys)


def _totals(spark: SparkSession, stream: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    return with_seconds(stream_totals(spark, stream, purpose, keys), "window_start")


#: limits of the edge stream: an hour ahead, three days back; arrivals within a file may be in any order
EDGE_LIMITS = {"ahead": "1 hour", "allowed": "3 days"}


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_quality.validate_stream(fx.dirty_from_events(fx.event_stream(spark, sf_dir)))


@query
def stream_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, stream_quality.stream_quality(_timed(spark, sf_dir)), "quality", ["window_start"])


@query
def stream_edge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with far-off, unreadable and missing timestamps, over several micro-batches."""
    timed = stream_quality.validate_stream(fx.edge_stream(spark, sf_dir), delay="60 days", **EDGE_LIMITS)
    return _totals(spark, stream_quality.stream_quality(timed), "edge", ["window_start"])


@query
def stream_off_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the same stream that are in no event-time window."""
    found = stream_quality.off_time_rows(fx.edge_stream(spark, sf_dir), width="24 hours", delay="60 days", **EDGE_LIMITS)
    return _totals(spark, found, "off_time", ["window_start", "time_status"])


@query
def stream_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL and missing fields per arrival window of a stream."""
    found = stream_quality.stream_nulls(fx.dirty_from_events(fx.event_stream(spark, sf_dir)), "24 hours")
    return checks.gap_lines(_totals(spark, found, "nulls", ["window_start"]), ["window_start"])


@query
def stream_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records stored so far as a live total, from a stream in complete mode."""
    base = scratch_dir(spark, "total")
    total = fx.event_stream(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    writers.write_totals(total, f"{base}/table", f"{base}/checkpoint", mode="complete").awaitTermination()
    return writers.read_totals(spark, total.schema, f"{base}/table", ["event_type"])


@query
def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_quality.stream_errors(_timed(spark, sf_dir), "24 hours")
    return _totals(spark, found, "errors", ["window_start", "rule"])


@query
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = fx.dirty_from_events(fx.event_stream(spark, sf_dir))
    return _totals(spark, stream_quality.stream_drift(dirty, "24 hours"), "drift", ["window_start", "field", "type"])


@query
def stream_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over six micro-batches, looked up in the index of keys that it keeps."""
    base = scratch_dir(spark, "flagged")
    ids = _dirty_ids(fx.dirty_stream(spark, sf_dir)).select("event_id", "order_id")
    written = stream_duplicates.write_flagged_duplicates(
        ids, "order_id", "event_id", f"{base}/table", f"{base}/checkpoint"
    )
    written.awaitTermination()
    return spark.read.parquet(f"{base}/table").where("is_duplicate").select("event_id", "order_id")


@query
def stream_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "distinct")
    ids = _dirty_ids(fx.dirty_from_events(fx.event_stream(spark, sf_dir))).withWatermark("ingest_ts", "1 hour")
    return append_and_read(spark, stream_duplicates.drop_stream_duplicates(ids, "order_id", "event_id").select("order_id"), base)


@query
def stream_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _dirty_ids(fx.dirty_from_events(fx.event_stream(spark, sf_dir))).withWatermark("ingest_ts", "1 hour")
    found = stream_duplicates.duplicate_keys_per_window(ids, "order_id", "ingest_ts", "24 hours")
    return _totals(spark, found, "repeated", ["window_start", "order_id"])


from . import live  # noqa: E402, F401 - registers its queries, which build on those above
