"""Observability metrics on event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles, value_counts

WARNING, INFO, SUCCESS = "warning", "info", "success"
RUNNING, MONITORING = "Running", "Monitoring"


def _seconds(window: str) -> Column:
    return (F.unix_micros(f"{window}.end") - F.unix_micros(f"{window}.start")) / F.lit(1e6)


def events_per_window(
    df: DataFrame, time: str, width: str = "1 minute", slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows and rows per second by tumbling or sliding window."""
    counted = df.groupBy(F.window(time, width, slide).alias("_w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        *by, F.col("_w.start").alias("window_start"), "n", (F.col("n") / _seconds("_w")).alias("per_second")
    )


def quality(n: Column, n_valid: Column) -> Column:
    """Valid rows in percent; NULL for no rows."""
    return F.try_divide(n_valid * F.lit(100.0), n)


def quality_pct(validated: DataFrame) -> DataFrame:
    counted = validated.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("n_valid"))
    return counted.withColumn("quality_pct", quality(F.col("n"), F.col("n_valid")))


def quality_per_window(validated: DataFrame, time: str, width: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    counted = validated.groupBy(F.window(time, width).alias("_w"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("n_valid")
    )
    return counted.select(
        *by,
        F.col("_w.start").alias("window_start"),
        "n",
        "n_valid",
        quality(F.col("n"), F.col("n_valid")).alias("quality_pct"),
    )


def running_total(windows: DataFrame, time: str = "window_start", n: str = "n") -> DataFrame:
    """Rows up to and including each window.

    Days are summed up first; only they (one row per day) pass through a window without
    partitions. Inside a day the running sum is partitioned by day.
    """
    # without the filter the join would add it to one side only, and the input would be read twice
    daily = windows.withColumn("_day", F.to_date(time)).where(F.col("_day").isNotNull())
    ahead = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        daily.groupBy("_day")
        .agg(F.sum(n).alias("_day_n"))
        .select("_day", F.coalesce(F.sum("_day_n").over(ahead), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_day").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.withColumn("_within", F.sum(n).over(inside))
        .join(before, "_day")
        .withColumn("total", F.col("_before") + F.col("_within"))
        .drop("_day", "_within", "_before")
    )


def change_from_previous(
    windows: DataFrame,
    by: Sequence[str] = (),
    n: str = "n",
    step: str = "1 hour",
    time: str = "window_start",
    silent: bool = False,
) -> DataFrame:
    """Change in percent from the window one ``step`` earlier; NULL when that one is empty or absent.

    Every window also reports its count to the window one step later, and both meet in one
    aggregate. A self-join would read and validate the input twice. ``windows`` has one row per
    ``by`` and time. With ``silent``, a window without rows after one with rows is a row too: its
    count is 0, its change -100 percent and its other columns are NULL. The window after the newest
    one of all is not over yet and gives no such row.
    """
    row = F.struct(*[F.col(c) for c in windows.columns])
    nothing = F.lit(None).cast(dict(windows.dtypes)[n])
    reports = F.array(
        F.struct(F.col(time).alias("_at"), row.alias("_row"), nothing.alias("previous_n")),
        F.struct(
            (F.col(time) + F.expr(f"interval {step}")).alias("_at"),
            F.when(F.lit(False), row).alias("_row"),
            F.col(n).alias("previous_n"),
        ),
    )
    lined = windows.select(*by, F.explode(reports).alias("_report")).select(*by, "_report.*")
    met = lined.groupBy(*by, "_at").agg(
        F.first("_row", ignorenulls=True).alias("_row"), F.max("previous_n").alias("previous_n")
    )
    change = (F.col(n) - F.col("previous_n")) * F.lit(100.0) / F.col("previous_n")
    if not silent:
        found = met.where(F.col("_row").isNotNull()).select("_row.*", "previous_n")
    else:
        newest = windows.agg(F.max(time)).scalar()
        kept = met.where(F.col("_row").isNotNull() | (F.col("_at") <= newest))
        empty = {time: F.col("_at"), n: nothing_counted(dict(windows.dtypes)[n]), **{b: F.col(b) for b in by}}
        columns = [F.when(F.col("_row").isNull(), empty.get(c)).otherwise(F.col(f"_row.{c}")).alias(c) for c in windows.columns]
        found = kept.select(*columns, "previous_n")
    return found.withColumn("change_pct", F.when(F.col("previous_n") != 0, change))


def nothing_counted(kind: str) -> Column:
    return F.lit(0).cast(kind)


def stage_latency(
    df: DataFrame, start: str, stages: dict[str, str], points: dict[str, float] | None = None
) -> DataFrame:
    """Latency in whole milliseconds per stage and in total.

    ``stages`` maps stage names to the columns with their completion times, in order.
    """
    points = points or {"p50_ms": 0.5, "p95_ms": 0.95}
    previous = [start, *stages.values()]
    spans = [(name, begin, end) for (name, end), begin in zip(stages.items(), previous)]
    spans.append(("total", start, previous[-1]))
    lines = [
        F.struct(
            F.lit(name).alias("stage"),
            F.floor((F.unix_micros(end) - F.unix_micros(begin)) / F.lit(1000)).alias("ms"),
        )
        for name, begin, end in spans
    ]
    long = df.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
    counts = value_counts(long, ["stage"], "ms")
    summary = counts.groupBy("stage").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("ms") * F.col("n")) / F.sum("n")).alias("avg_ms"),
        F.max("ms").alias("max_ms"),
    )
    return summary.join(exact_quantiles(counts, ["stage"], "ms", points), "stage", "left")


def flow_status(metrics: DataFrame, flow: str, floor_pct: float = 90.0) -> DataFrame:
    """Latest window of every flow with its status and rate; a flow without rows in the newest window
    of all flows is not running."""
    newest = F.max_by(F.struct("window_start", "n", "n_valid", "quality_pct"), "window_start")
    latest = metrics.groupBy(flow).agg(newest.alias("_latest")).select(flow, "_latest.*")
    current = F.col("window_start") == metrics.agg(F.max("window_start")).scalar()
    running = current & (F.col("quality_pct") >= floor_pct)
    return latest.withColumn("status", F.when(running, F.lit(RUNNING)).otherwise(F.lit(MONITORING)))


def alerts(
    metrics: DataFrame, flow: str, floor_pct: float = 90.0, drop_pct: float = 50.0, step: str = "1 hour"
) -> DataFrame:
    """One alert per flow and window from threshold rules on quality and on the change of the rate.

    The first window in which a flow has no rows gives a warning, too.
    """
    changed = change_from_previous(metrics, [flow], step=step, silent=True)
    low = F.col("quality_pct") < floor_pct
    dropped = F.col("change_pct") < -drop_pct
    silent = F.col("n") == 0
    severity = (
        F.when(silent | low | dropped, F.lit(WARNING)).when(F.col("quality_pct") == 100, F.lit(SUCCESS)).otherwise(F.lit(INFO))
    )
    message = (
        F.when(silent, F.lit("No records received"))
        .when(low, F.lit(f"Data quality below {floor_pct:g}%"))
        .when(dropped, F.lit(f"Throughput dropped by more than {drop_pct:g}%"))
        .when(F.col("quality_pct") == 100, F.lit("All records valid"))
        .otherwise(F.lit("Processing normally"))
    )
    return changed.select(flow, "window_start", severity.alias("severity"), message.alias("message"))


def lag_alerts(lag: DataFrame, limit: int) -> DataFrame:
    """``lag`` with a severity and a message per partition."""
    severity = F.when(F.col("lag") > limit, F.lit(WARNING)).otherwise(F.lit(SUCCESS))
    message = F.when(F.col("lag") > limit, F.lit("Consumer lag detected")).otherwise(F.lit("Consumer is up to date"))
    return lag.withColumns({"severity": severity, "message": message})


def recent_alerts(found: DataFrame, flow: str, n: int = 3) -> DataFrame:
    """The n newest alerts."""
    return found.orderBy(F.desc("window_start"), F.asc(flow)).limit(n)


def consumer_lag(produced: DataFrame, consumed: DataFrame) -> DataFrame:
    """Lag per partition from two offset logs (``partition_id``, ``offset``).

    A partition without any consumed offset lags by everything produced.
    """
    ends = produced.groupBy("partition_id").agg(F.max("offset").alias("produced"))
    read = consumed.groupBy("partition_id").agg(F.max("offset").alias("consumed"))
    joined = ends.join(read, "partition_id", "left")
    return joined.withColumn("lag", F.col("produced") - F.coalesce(F.col("consumed"), F.lit(-1)))


def system_health(found: DataFrame, flow: str) -> DataFrame:
    """Operational iff the latest alert of every flow is no warning."""
    latest = found.groupBy(flow).agg(F.max_by("severity", "window_start").alias("severity"))
    healthy = F.col("severity") != WARNING
    rank = F.when(~healthy, 2).when(F.col("severity") == INFO, 1).otherwise(0)
    counted = latest.agg(
        F.bool_and(healthy).alias("operational"),
        F.count(F.lit(1)).alias("flows"),
        F.count_if(~healthy).alias("flows_with_warning"),
        F.max(rank).alias("_worst"),
    )
    worst = F.when(F.col("_worst") == 2, WARNING).when(F.col("_worst") == 1, INFO).otherwise(SUCCESS)
    return counted.withColumn("worst_severity", worst).drop("_worst")
