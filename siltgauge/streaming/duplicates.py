"""Repeated order ids on a stream.

``write_flagged_duplicates`` marks the single rows of a stream against an index of all keys so far;
``duplicate_keys_per_window`` and ``drop_stream_duplicates`` run on built-in state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.duplicates import flag_duplicates
from ..operators.lookup import left_join_skewed
from .keyindex import KeyIndex

SALTS = 32


def drop_stream_duplicates(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Keep one row per key within the watermark of the stream; salted like the flags.

    Rows without a key are no repeats of each other: their unique ``order`` stands in for it.
    """
    columns = stream.columns
    unkeyed = F.when(F.col(key).isNull(), F.col(order))
    salted = stream.withColumns({"dup_alone": unkeyed, "dup_route": F.pmod(F.xxhash64(order), F.lit(SALTS))})
    once = salted.dropDuplicatesWithinWatermark([key, "dup_alone", "dup_route"])
    return once.dropDuplicatesWithinWatermark([key, "dup_alone"]).select(*columns)


def duplicate_keys_per_window(stream: DataFrame, key: str, time: str, width: str = "24 hours") -> DataFrame:
    """Keys that occur more than once inside a window of a watermarked stream.

    A plain streaming aggregate: rows are combined before the shuffle, so a frequent key
    costs no more than a rare one.
    """
    counted = stream.where(F.col(key).isNotNull()).groupBy(F.window(time, width).alias("_w"), key)
    repeated = counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.select(F.col("_w.start").alias("window_start"), key, "n")


def write_flagged_duplicates(
    stream: DataFrame,
    key: str,
    order: str,
    path: str,
    checkpoint: str,
    flag: str = "is_duplicate",
    index: str | None = None,
    parts: int = 16,
    fanout: int = 4,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream to a table with every repeated key marked; ``order`` is a unique number or timestamp.

    A row is a repeat if its key has an earlier row in the same micro-batch, or was in an earlier one. That is
    looked up in a :class:`KeyIndex` in the folder ``index`` (below ``path`` by default, where readers do not
    look), of which a batch reads what its filters leave, however long the stream has run. Nothing expires. The
    table is partitioned by batch id, and a repeated batch replaces its own partition and its own keys. Joins and
    aggregates split frequent keys as they do on tables; rows without a key are never repeats.
    """
    folder = index or f"{path}/_index"
    kind = stream.schema[key].dataType

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = KeyIndex(spark, folder, key, kind, parts, fanout)
        keys.tidy(batch_id)
        runs = keys.runs_before(batch_id)
        marked = flag_duplicates(batch, [key], [order], flag).persist()
        try:
            firsts = keys.hashed(marked.where(~F.col(flag)))
            seen, read = keys.lookup(firsts, runs)
            known = left_join_skewed(marked, seen.withColumn("_seen", F.lit(True)), [key], [order])
            known = known.withColumn(flag, F.col(flag) | F.col("_seen").isNotNull()).drop("_seen")
            writer = known.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
            keys.add(batch_id, firsts.join(seen, key, "left_anti"), runs, read)
        finally:
            marked.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
