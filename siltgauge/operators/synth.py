"""Transaction synthesis: one transaction per row key, the same on every run and cluster."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import PRICE_CENTS, REQUIRED_FIELDS, SYNTH_PAYMENT_METHODS, SYNTH_PRODUCTS, TAX_RATE
from ..functions.draws import draw_choice, draw_int, draw_money

#: 2026-01-01T00:00:00Z, the event time of a row before the first one
EPOCH_MICROS = 1_767_225_600_000_000
#: event-time pace of rows synthesised without a target rate
DEFAULT_RATE = 1000.0
ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def check_count(count: int) -> None:
    if count <= 0:
        raise ValueError("Count must be greater than 0.")


def check_batch_size(batch_size: int) -> None:
    if batch_size <= 0:
        raise ValueError("Batch size must be greater than 0.")


def check_rate(rate: float | None) -> None:
    if rate is not None and rate <= 0:
        raise ValueError("Rate must be greater than 0.")


def tax(price: Column, quantity: Column) -> Column:
    """18 % of price x quantity. Decimal operands, so that ties round the same everywhere."""
    exact = price.cast("decimal(12,2)") * quantity.cast("decimal(20,0)") * F.lit(TAX_RATE).cast("decimal(3,2)")
    return F.round(exact, 2).cast("decimal(30,2)")


def due_time(index: Column, rate: float | None, start_micros: int = EPOCH_MICROS) -> Column:
    """Event time of row ``index`` (from 0) at ``rate`` rows per second."""
    elapsed = F.floor((index + F.lit(1)).cast("double") * F.lit(1e6) / F.lit(float(rate or DEFAULT_RATE)))
    return F.timestamp_micros(F.lit(start_micros) + elapsed)


def utc_text(moment: Column) -> Column:
    return F.concat(F.date_format(moment, ISO_TEXT), F.lit("+00:00"))


def with_transaction(
    df: DataFrame, order_id: str, seed: int = 0, rate: float | None = None, start_order_id: int = 10001
) -> DataFrame:
    """Add the transaction fields for an integer ``order_id`` column of a table or stream.

    ``due`` is the event time of the row at the target rate; ``timestamp`` its text.
    """
    check_rate(rate)
    key = F.col(order_id)
    base = df.withColumns(
        {
            "quantity": draw_int(seed, "quantity", key, 1, 5).cast("int"),
            "price": draw_money(seed, "price", key, PRICE_CENTS),
            "due": due_time(key - F.lit(start_order_id), rate),
        }
    )
    return base.withColumns(
        {
            "customer_id": F.concat(F.lit("C"), draw_int(seed, "customer", key, 101, 999).cast("string")),
            "product_id": draw_choice(seed, "product", key, SYNTH_PRODUCTS),
            "tax_amount": tax(F.col("price"), F.col("quantity")),
            "payment_method": draw_choice(seed, "payment", key, SYNTH_PAYMENT_METHODS),
            "timestamp": utc_text(F.col("due")),
        }
    )


def generate_transactions(
    spark: SparkSession, count: int, rate: float | None = None, start_order_id: int = 10001, seed: int = 0
) -> DataFrame:
    """``count`` transactions with gap-free ids from ``start_order_id``."""
    check_count(count)
    ids = spark.range(start_order_id, start_order_id + count).withColumnRenamed("id", "order_id")
    return with_transaction(ids, "order_id", seed, rate, start_order_id).select(*REQUIRED_FIELDS)


def with_batch_id(df: DataFrame, order_id: str, batch_size: int = 1000, start_order_id: int = 10001) -> DataFrame:
    """Number consecutive groups of ``batch_size`` ids; the last batch may be short."""
    check_batch_size(batch_size)
    return df.withColumn("batch_id", F.floor((F.col(order_id) - F.lit(start_order_id)) / F.lit(batch_size)))


def generate_transaction_batches(
    spark: SparkSession,
    count: int,
    batch_size: int = 1000,
    rate: float | None = None,
    start_order_id: int = 10001,
    seed: int = 0,
) -> DataFrame:
    check_count(count)
    check_batch_size(batch_size)
    rows = generate_transactions(spark, count, rate, start_order_id, seed)
    return with_batch_id(rows, "order_id", batch_size, start_order_id)


def generate_continuous_transactions(
    spark: SparkSession, rate: float | None = None, start_order_id: int = 10001, seed: int = 0
) -> DataFrame:
    """An endless stream. The source runs at whole rows per second; ``timestamp`` follows ``rate`` exactly."""
    check_rate(rate)
    source = spark.readStream.format("rate").option("rowsPerSecond", math.ceil(rate or DEFAULT_RATE)).load()
    ids = source.select((F.col("value") + F.lit(start_order_id)).alias("order_id"))
    return with_transaction(ids, "order_id", seed, rate, start_order_id).select(*REQUIRED_FIELDS)
