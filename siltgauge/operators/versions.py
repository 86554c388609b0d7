"""Schema versions: which sets of fields and types the records of a flow have had, and when."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checks import json_class
from .validate import RECORD, parse_record


def record_shape(record: Column) -> Column:
    """The (field, type) pairs of a parsed record in order of the field; NULL for what is no object."""
    fields = record.try_cast("map<string,variant>")
    pairs = F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("field"), json_class(F.schema_of_variant(e["value"])).alias("type")))
    return F.array_sort(pairs)


def shape_text(shape: Column) -> Column:
    return F.array_join(F.transform(shape, lambda p: F.concat(p["field"], F.lit(":"), p["type"])), "|")


def shape_counts(df: DataFrame, time: str, width: str = "1 hour", by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Records per shape and window of a table or watermarked stream, with the first and last time in the window.

    Rows combine before the shuffle; there are as many groups as flows have shapes in a window. Malformed
    records and values that are no objects have no shape.
    """
    shaped = parse_record(df.select(value, time, *by), value).select(*by, time, record_shape(F.col(RECORD)).alias("shape"))
    counted = shaped.where(F.col("shape").isNotNull()).groupBy(*by, F.window(time, width).alias("_w"), "shape")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("first_seen"), F.max(time).alias("last_seen"))
    return counted.select(*by, F.col("_w.start").alias("window_start"), "shape", "n", "first_seen", "last_seen")


def version_timeline(counts: DataFrame, width: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    """Runs of windows in which a flow's records had a shape, from ``shape_counts``, and what changed.

    Windows of a shape that follow each other make one run (gaps and islands). A run has a fingerprint, its first
    and last time, its rows, and ``added``, ``removed`` and ``retyped``: fields compared with the run that began
    before it in the same flow, NULL for the first one. Runs that begin together are put in order by their shape.
    """
    step = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {width}"))
    number = F.floor(F.unix_micros("window_start") / step)
    ranked = Window.partitionBy(*by, "shape").orderBy("window_start")
    islands = counts.withColumn("_island", number - F.row_number().over(ranked))
    runs = islands.groupBy(*by, "shape", "_island").agg(
        F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )
    begun = Window.partitionBy(*by).orderBy("first_seen", "shape")
    runs = runs.withColumn("_before", F.lag("shape").over(begun))
    names, names_before = F.col("shape.field"), F.col("_before.field")
    changed = F.array_except("shape", "_before")
    retyped = F.array_intersect(F.transform(changed, lambda p: p["field"]), names_before)
    return runs.select(
        *by,
        F.md5(shape_text(F.col("shape"))).alias("version"),
        "first_seen",
        "last_seen",
        "n",
        F.array_except(names, names_before).alias("added"),
        F.array_except(names_before, names).alias("removed"),
        retyped.alias("retyped"),
    )


def schema_versions(df: DataFrame, time: str, width: str = "1 hour", by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """The versions of the records of a table; see ``version_timeline``."""
    return version_timeline(shape_counts(df, time, width, by, value), width, by)
