"""Validation and quality metrics on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import RuleSet
from ..operators.checks import field_gaps, observed_types, rule_of
from ..operators.metrics import quality
from ..operators.validate import validate


#: where a row stands in time: in its event window, or outside of all of them for one of three reasons
TIMED, UNTIMED, FUTURE, LATE = "timed", "untimed", "future", "late"


def with_event_time(
    checked: DataFrame, arrival: str = "ingest_ts", ahead: str = "1 hour", allowed: str | None = None
) -> DataFrame:
    """Add ``time_status`` and ``event_time`` to validated rows with a typed timestamp.

    Only a timed row has an event time. One without a readable timestamp is untimed, one more than
    ``ahead`` after its arrival is of the future, one more than ``allowed`` before it is late. The
    record decides that, not the state of the stream, so a repeated run decides the same, and no
    single record moves the watermark beyond the arrival of the data. ``off_time_rows`` counts them.
    """
    told = F.col("record.timestamp")
    status = F.when(told.isNull(), F.lit(UNTIMED)).when(told > F.col(arrival) + F.expr(f"interval {ahead}"), F.lit(FUTURE))
    if allowed is not None:
        status = status.when(told < F.col(arrival) - F.expr(f"interval {allowed}"), F.lit(LATE))
    marked = checked.withColumn("time_status", status.otherwise(F.lit(TIMED)))
    return marked.withColumn("event_time", F.when(F.col("time_status") == TIMED, told))


def validate_stream(
    stream: DataFrame,
    rules: RuleSet = RuleSet(),
    delay: str = "1 hour",
    arrival: str = "ingest_ts",
    typed: tuple[str, ...] = ("timestamp",),
    metrics: str = "stream_quality",
    ahead: str = "1 hour",
    allowed: str | None = None,
) -> DataFrame:
    """Validate a stream and give every timed row an event time with a watermark; see ``with_event_time``."""
    checked = validate(stream, rules, typed=typed, metrics=metrics)
    return with_event_time(checked, arrival, ahead, allowed).withWatermark("event_time", delay)


def stream_quality(timed: DataFrame, width: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    """Rows, valid rows and quality per event-time window of a ``validate_stream`` result."""
    counted = timed.where(F.col("event_time").isNotNull()).groupBy(F.window("event_time", width).alias("_w"), *by)
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("n_valid"))
    return counted.select(
        *by,
        F.col("_w.start").alias("window_start"),
        "n",
        "n_valid",
        quality(F.col("n"), F.col("n_valid")).alias("quality_pct"),
    )


def off_time_rows(
    stream: DataFrame,
    rules: RuleSet = RuleSet(),
    width: str = "1 hour",
    delay: str = "1 hour",
    arrival: str = "ingest_ts",
    ahead: str = "1 hour",
    allowed: str | None = None,
) -> DataFrame:
    """Rows in no event-time window, per arrival window and reason. With ``stream_quality`` of the same
    limits every row is counted once."""
    checked = validate(stream.withWatermark(arrival, delay), rules, typed=("timestamp",))
    outside = with_event_time(checked, arrival, ahead, allowed).where(F.col("time_status") != TIMED)
    counted = outside.groupBy(F.window(arrival, width).alias("_w"), "time_status")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("n_valid"))
    return counted.select(F.col("_w.start").alias("window_start"), "time_status", "n", "n_valid")


def stream_nulls(stream: DataFrame, width: str = "1 hour", delay: str = "1 hour", arrival: str = "ingest_ts") -> DataFrame:
    """NULL and missing counts per required field and arrival window, one line per window."""
    counted = field_gaps(stream.withWatermark(arrival, delay), F.window(arrival, width).alias("_w"))
    return counted.withColumn("window_start", F.col("_w.start")).drop("_w")


def stream_errors(timed: DataFrame, width: str = "1 hour") -> DataFrame:
    """Errors per rule and event-time window."""
    exploded = timed.where(F.col("event_time").isNotNull()).select("event_time", F.explode("errors").alias("error"))
    counted = exploded.groupBy(F.window("event_time", width).alias("_w"), rule_of(F.col("error")).alias("rule")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(F.col("_w.start").alias("window_start"), "rule", "n")


def stream_drift(stream: DataFrame, width: str = "1 hour", delay: str = "1 hour", arrival: str = "ingest_ts") -> DataFrame:
    """Observed field types per arrival window: a drifting record may have no readable event time."""
    types = observed_types(stream.select("value", arrival).withWatermark(arrival, delay))
    counted = types.groupBy(F.window(arrival, width).alias("_w"), "field", "type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("_w.start").alias("window_start"), "field", "type", "n")


def late_rows(timed: DataFrame, allowed: str, arrival: str = "ingest_ts") -> DataFrame:
    """Rows that arrive later than ``allowed`` after their event time.

    The stream's own counter counts rows at the state operator, once per sliding window;
    this compares both times of each record.
    """
    return timed.where(F.col(arrival) > F.col("event_time") + F.expr(f"interval {allowed}"))
