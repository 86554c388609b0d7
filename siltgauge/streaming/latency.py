"""Latency across live stages: the logs of the stages are joined as streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_stages(logs: dict[str, DataFrame], key: str, time: str, within: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """One row per record of the first log: its key, its time in every stage, and the last stage it reached.

    ``logs`` maps stage names, in order, to streams (or tables) with ``key`` and ``time``. A record belongs
    together with its entry of a later stage if that comes no more than ``within`` after the first one. All
    sides have watermarks and the time between them is bounded, so state is dropped in time, and a record
    that a stage has lost comes out with NULL there, once no entry can come any more. An entry without key
    only moves the watermark: a heartbeat, which lets the last records out.
    """
    names = list(logs)
    sides = []
    for name in names:
        # The watermark has to see heartbeats, so no filter on the key may go below it: a struct is never NULL,
        # which leaves the join none to put there, and the filter here refers to the time, too.
        held = F.struct(F.col(key).alias("key")).alias(f"{name}_key")
        log = logs[name].select(held, F.col(time).alias(f"{name}_time")).withWatermark(f"{name}_time", delay)
        sides.append(log.where(F.when(F.col(f"{name}_time").isNotNull(), F.col(f"{name}_key.key")).isNotNull()))
    first = F.col(f"{names[0]}_time")
    joined = sides[0]
    for name, side in zip(names[1:], sides[1:]):
        after = F.col(f"{name}_time")
        same = F.col(f"{names[0]}_key") == F.col(f"{name}_key")
        joined = joined.join(side, same & (after >= first) & (after <= first + F.expr(f"interval {within}")), "left_outer")
        # a stream has one event time, so a later stage's time is a plain value from here on
        plain = F.timestamp_micros(F.unix_micros(after)).alias(f"{name}_time")
        joined = joined.select(*[c for c in joined.columns if c not in (f"{name}_key", f"{name}_time")], plain)
    reached = reduce(lambda found, n: F.when(F.col(f"{n}_time").isNotNull(), F.lit(n)).otherwise(found), names[1:], F.lit(names[0]))
    times = [F.col(f"{n}_time") for n in names]
    return joined.select(F.col(f"{names[0]}_key.key").alias(key), *times, reached.alias("last_stage"))


def stage_spans(joined: DataFrame, stages: list[str]) -> DataFrame:
    """Milliseconds of each stage, and in total, of the records that reached the last stage."""
    whole = joined.where(F.col("last_stage") == stages[-1])

    def span(begin: str, end: str):
        return F.floor((F.unix_micros(f"{end}_time") - F.unix_micros(f"{begin}_time")) / F.lit(1000))

    lines = [F.struct(F.lit(b).alias("stage"), span(a, b).alias("ms")) for a, b in zip(stages, stages[1:])]
    lines.append(F.struct(F.lit("total").alias("stage"), span(stages[0], stages[-1]).alias("ms")))
    return whole.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
