"""Sources of JSON transaction records. Every reader yields one record per row in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def records_of_array(df: DataFrame, value: str = "value", parsed: str = "parsed") -> DataFrame:
    """Split a JSON array into one row per element: the VARIANT ``parsed`` and its text ``value``.

    Pass ``parsed`` on to ``validate``: the text is printed anew, where ``2.0`` reads ``2``.
    An array that cannot be read gives one row without a record, which no validation accepts.
    """
    others = [c for c in df.columns if c != value]
    split = df.select(*others, F.explode_outer(F.from_json(F.col(value), "array<variant>")).alias(parsed))
    return split.withColumn(value, F.to_json(parsed))


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold one JSON array each. A file is one task, so prefer many files or JSON lines."""
    return records_of_array(spark.read.text(path, wholetext=True))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_json_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Directory stream; ``files_per_trigger`` is the batch size of the stream."""
    reader = spark.readStream
    if files_per_trigger is not None:
        if files_per_trigger <= 0:
            raise ValueError("Batch size must be greater than 0.")
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(path)
    return lines.select("value", F.current_timestamp().alias("ingest_ts"))


def stream_kafka(
    spark: SparkSession,
    servers: str = "localhost:9092",
    topic: str = "transactions",
    offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Records of a Kafka topic. Needs the Spark Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return kafka_records(reader.load())


def kafka_records(raw: DataFrame) -> DataFrame:
    """Record text, arrival time and position from rows in the layout of the Kafka source."""
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingest_ts"),
        F.col("partition").alias("partition_id"),
        "offset",
    )
