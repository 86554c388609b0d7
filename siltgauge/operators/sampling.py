"""Row selection by seeded draw: by rate, and exactly n rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import DRAW_RANGE, draw

_LOW_BITS = 16


def check_fraction(rate: float) -> None:
    if rate < 0.0 or rate > 1.0:
        raise ValueError("Anomaly rate must be between 0.0 and 1.0.")


def picked_by_rate(rate: float, seed: int, key: Column) -> Column:
    """True for each row with probability ``rate``."""
    check_fraction(rate)
    return draw(seed, "pick", key) < F.lit(int(rate * DRAW_RANGE))


def _first_reaching(histogram: DataFrame, bucket: str, before: Column, n: int) -> DataFrame:
    """The bucket in which the n-th row lies, with the number of rows ahead of it.

    ``histogram`` has at most 2**16 rows, so its window may run in one task.
    """
    upto = F.sum("rows").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0))
    return (
        histogram.select(bucket, "rows", (before + upto).alias("upto"))
        .where(F.col("upto") >= n)
        .agg(F.min(F.struct(bucket, (F.col("upto") - F.col("rows")).alias("before"))).alias("cut"))
    )


def picked_exactly(df: DataFrame, n: int, seed: int, key: str) -> Column:
    """True for the ``n`` rows with the smallest draws; ``key`` must be unique.

    Ranking all rows, or keeping the first n of every task, ends in one task. Two
    histograms of the 32-bit draw find the draw of the n-th row instead, and only
    the rows that share that draw (one per 2**32 rows) are ordered by key.
    """
    if n < 0:
        raise ValueError("Anomaly count must be between 0 and total count.")
    if df.isStreaming:
        raise ValueError("An exact number of rows needs a finite table.")
    if n == 0:
        return F.lit(False)
    drawn = df.select(draw(seed, "pick", F.col(key)).alias("draw"), F.col(key).alias("key"))
    high = F.shiftright("draw", _LOW_BITS)

    coarse = drawn.groupBy(high.alias("high")).agg(F.count(F.lit(1)).alias("rows"))
    first = _first_reaching(coarse, "high", F.lit(0), n).first()["cut"]
    if first is None:
        raise ValueError("Anomaly count must be between 0 and total count.")
    inside = drawn.where(high == first["high"]).groupBy("draw").agg(F.count(F.lit(1)).alias("rows"))
    second = _first_reaching(inside, "draw", first["before"], n).scalar()

    tied = drawn.where(F.col("draw") == second["draw"])
    place = F.row_number().over(Window.orderBy("key")) + second["before"]
    last = tied.select("draw", "key", place.alias("place")).where(F.col("place") <= n)
    cut = last.agg(F.max(F.struct("draw", "key"))).scalar()
    own = F.struct(draw(seed, "pick", F.col(key)).alias("draw"), F.col(key).alias("key"))
    return own <= cut
