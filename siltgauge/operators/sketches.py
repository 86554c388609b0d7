"""Approximate quantiles by window from sketches that can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy parameter of the sketches: ranks are off by some 1.65 % of the rows at most, at 99 % confidence.
K = 200
#: What the ranks of merged sketches are off by at most, as a share of the rows, but for one case in many thousands.
RANK_ERROR = 0.03


def latency_sketches(df: DataFrame, value: str, time: str, width: str = "1 hour", by: Sequence[str] = (), k: int = K) -> DataFrame:
    """A sketch of a whole-number ``value`` per window and ``by``, with its rows, sum and largest value.

    A sketch takes a few kilobytes however many rows there are, and combines before the shuffle. Sketches of
    windows are kept and merged to longer ones without the rows. NULL values are no rows.
    """
    timed = df.where(F.col(value).isNotNull()).groupBy(*by, F.window(time, width).alias("_w"))
    found = timed.agg(
        F.expr(f"kll_sketch_agg_bigint(cast(`{value}` AS bigint), {k})").alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.max(value).alias("largest"),
    )
    return found.select(*by, F.col("_w.start").alias("window_start"), "sketch", "n", "total", "largest")


def merged_sketches(sketches: DataFrame, width: str = "1 day", by: Sequence[str] = ()) -> DataFrame:
    """The sketches of longer windows from those of the windows in them."""
    grouped = sketches.groupBy(*by, F.window("window_start", width).alias("_w"))
    found = grouped.agg(
        F.expr("kll_merge_agg_bigint(sketch)").alias("sketch"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.max("largest").alias("largest"),
    )
    return found.select(*by, F.col("_w.start").alias("window_start"), "sketch", "n", "total", "largest")


def _at(p: float) -> Column:
    return F.expr(f"kll_sketch_get_quantile_bigint(sketch, cast({p} AS double))")


def sketch_quantiles(sketches: DataFrame, points: dict[str, float]) -> DataFrame:
    """Each sketch's quantiles, one column per entry of ``points``, beside its exact rows, mean and largest value."""
    mean = (F.col("total") / F.col("n")).alias("mean")
    return sketches.select(*[c for c in sketches.columns if c not in ("sketch", "total")], mean, *[_at(p).alias(n) for n, p in points.items()])
