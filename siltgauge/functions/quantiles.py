"""Exact quantiles per group for integer measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _magnitude_bucket(value: Column) -> Column:
    """Order-preserving bucket that keeps the leading ten bits: at most some 28,000 for any BIGINT."""
    # one less for negative values: the smallest BIGINT has no absolute value
    size = F.when(value < 0, -(value + 1)).otherwise(value)
    shift = F.greatest(F.length(F.bin(size)) - F.lit(10), F.lit(0))
    bucket = shift.cast("bigint") * 512 + F.call_function("shiftright", size, shift)
    return F.when(value < 0, -bucket - 1).otherwise(bucket)


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per group and value as ``n``; combines before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(counts: DataFrame, by: Sequence[str], value: str, points: dict[str, float]) -> DataFrame:
    """Nearest-rank quantiles of a BIGINT column from its ``value_counts``, one column per entry of ``points``.

    The builtin ``percentile`` gathers every distinct value of a group in one buffer. Here a
    bounded histogram tells in which bucket the rank lies, and only that bucket is put in order.
    """
    by = list(by)
    counted = counts.select(*by, F.col(value).alias("_value"), F.col("n").alias("_n"))
    counted = counted.withColumn("_bucket", _magnitude_bucket(F.col("_value")))

    group = Window.partitionBy(*by)
    running = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    histogram = counted.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n"))
    histogram = histogram.select(
        *by, "_bucket", "_n", F.sum("_n").over(running).alias("_upto"), F.sum("_n").over(group).alias("_total")
    )
    wanted = F.explode(
        F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in points.items()])
    )
    ranked = histogram.withColumn("_point", wanted).withColumn(
        "_rank", F.greatest(F.ceil(F.col("_point.p") * F.col("_total")), F.lit(1))
    )
    ahead = F.col("_upto") - F.col("_n")
    target = ranked.where((F.col("_upto") >= F.col("_rank")) & (ahead < F.col("_rank"))).select(
        *by, "_bucket", F.col("_point.name").alias("_name"), (F.col("_rank") - ahead).alias("_place")
    )
    inside = Window.partitionBy(*by, "_name").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.join(target, [*by, "_bucket"]).withColumn("_upto", F.sum("_n").over(inside))
    hit = (F.col("_upto") >= F.col("_place")) & (F.col("_upto") - F.col("_n") < F.col("_place"))
    found = placed.where(hit)
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in points])
