"""Counts and rates over injected records and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anomaly_breakdown(df: DataFrame) -> DataFrame:
    """Number of corrupted rows per category."""
    corrupted = df.where(F.col("anomaly_category").isNotNull())
    return corrupted.groupBy("anomaly_category").agg(F.count(F.lit(1)).alias("n"))


def anomaly_rate(df: DataFrame) -> DataFrame:
    """Total rows, corrupted rows and the achieved rate in percent (0 for an empty table)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count("anomaly_category").alias("anomalous_transactions"),
    )
    achieved = F.col("anomalous_transactions") / F.col("total_transactions") * F.lit(100.0)
    return counted.withColumn(
        "achieved_rate_pct", F.when(F.col("total_transactions") > 0, achieved).otherwise(F.lit(0.0))
    )


def anomaly_summary(df: DataFrame, anomaly_type: str, seed: int | None) -> DataFrame:
    """One row: totals, rate, target type, seed and a category -> count map."""
    per_category = df.groupBy("anomaly_category").agg(F.count(F.lit(1)).alias("n"))
    entries = F.collect_list(F.when(F.col("anomaly_category").isNotNull(), F.struct("anomaly_category", "n")))
    totals = per_category.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        F.coalesce(F.sum(F.when(F.col("anomaly_category").isNotNull(), F.col("n"))), F.lit(0)).alias(
            "anomalous_transactions"
        ),
        F.map_from_entries(entries).alias("anomaly_breakdown"),
    )
    achieved = F.col("anomalous_transactions") / F.col("total_transactions") * F.lit(100.0)
    return totals.select(
        "total_transactions",
        "anomalous_transactions",
        F.when(F.col("total_transactions") > 0, achieved).otherwise(F.lit(0.0)).alias("achieved_rate_pct"),
        F.lit(anomaly_type).alias("target_anomaly_type"),
        "anomaly_breakdown",
        F.lit(seed).cast("bigint").alias("seed"),
    )


def throughput(df: DataFrame, time: str) -> DataFrame:
    """Rows per second of event time, 0 when no time passes."""
    spanned = df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))).alias("elapsed_micros"),
    )
    per_second = F.col("n") * F.lit(1e6) / F.col("elapsed_micros")
    return spanned.withColumn(
        "rows_per_second", F.when(F.col("elapsed_micros") > 0, per_second).otherwise(F.lit(0.0))
    )


def batch_sizes(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows per batch."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))


def batch_counts(df: DataFrame, batch: str = "batch_id", every: int = 5000) -> DataFrame:
    """Batches, rows and the number of progress marks (one per ``every`` rows)."""
    return batch_sizes(df, batch).agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.floor(F.coalesce(F.sum("n"), F.lit(0)) / F.lit(every)).alias("progress_marks"),
    )
