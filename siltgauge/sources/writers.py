"""Sinks: JSON lines, the append table of validated rows, the accepted/quarantine split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType


def write_json_lines(df: DataFrame, path: str, value: str = "value") -> None:
    df.select(F.col(value).alias("value")).write.text(path)


#: all that is there, then stop
ONCE = {"availableNow": True}


def append_table(
    stream: DataFrame,
    path: str | None,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a table, given by ``path`` or by the name ``table``. ``fmt`` may name any
    streaming table format on the class path. ``trigger`` is what ``DataStreamWriter.trigger`` takes,
    for instance ``{"processingTime": "1 minute"}``; without it the run ends with its input."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or ONCE))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path) if table is None else writer.toTable(table)


def write_totals(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, mode: str = "update") -> StreamingQuery:
    """Keep the totals of a streaming aggregate in a table, open windows included.

    Every micro-batch adds the totals it changed (``mode`` update) or all of them (complete), under its
    batch id; a repeated batch replaces its own. ``read_totals`` gives the newest of each key.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(path)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).foreachBatch(write_batch).start()


def read_totals(spark: SparkSession, schema: StructType, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest totals per key of a ``write_totals`` table with the ``schema`` of its stream."""
    numbered = StructType([*schema.fields, StructField("batch_id", LongType())])
    rest = [f.name for f in schema.fields if f.name not in keys]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("_newest")
    return spark.read.schema(numbered).parquet(path).groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def split_by_verdict(validated: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write accepted rows and quarantined rows of a validated stream in one pass.

    Each micro-batch is validated and written once, partitioned by batch id and verdict.
    ``foreachBatch`` may repeat a batch after a failure; the repeat overwrites just the
    partitions of that batch id, so no row is there twice.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", "is_valid")
            .parquet(path)
        )

    return (
        validated.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )


def _read_verdict(spark: SparkSession, path: str, verdict: str) -> DataFrame:
    # partition values are text; comparing them as text prunes the other folder
    rows = spark.read.parquet(path).where(F.col("is_valid").cast("string") == verdict)
    return rows.withColumn("is_valid", F.col("is_valid").cast("boolean"))


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return _read_verdict(spark, path, "true").drop("errors")


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    return _read_verdict(spark, path, "false")
