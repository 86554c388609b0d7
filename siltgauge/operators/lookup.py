"""Equi-join of a large table with a keyed table when some keys are very frequent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import landed

#: rows of one key that one task may get; a more frequent key is spread over as many tasks as that takes
TASK_ROWS = 1_000_000
#: frequent keys there can be at most: in larger tables a task may get more rows of a key instead
HOT_KEYS = 100_000
#: tasks over which rows without a key are spread, at most
NULL_SALTS = 1 << 20


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def left_join_skewed(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    order: list[str],
    counts: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``rows LEFT JOIN lookup`` on ``keys``; ``lookup`` holds each key at most once.

    A key with more rows than one task may get is spread over as many salts as that takes, and its
    lookup row is repeated once for each. The salt is a hash of the unique ``order`` columns, so it
    does not matter in which input partitions the rows of a key lie, and a recomputed task sends
    its rows to the same place again. Rows with a NULL key match nothing and are spread by the same
    hash. What is broadcast is a 64-bit hash and a number per frequent key; there are fewer than
    HOT_KEYS of them, because a task may get total / HOT_KEYS rows of a key in any case. A key that
    shares a hash is spread too, with the same result.

    ``counts`` (keys and ``_n``) may be passed in when the caller has landed them already.
    """
    counts = landed(key_counts(rows, keys), "counts") if counts is None else counts
    total = counts.agg(F.sum("_n")).scalar()
    most = F.greatest(F.lit(task_rows).cast("double"), total / F.lit(float(HOT_KEYS)))
    hashed = F.xxhash64(*keys).alias("_hash")
    hot = counts.where((F.col("_n") > most) & ~_any_null(keys)).select(hashed, F.ceil(F.col("_n") / most).alias("_salts"))
    hot = F.broadcast(hot.groupBy("_hash").agg(F.max("_salts").cast("int").alias("_salts")))

    spread = F.when(_any_null(keys), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    marked = rows.select("*", hashed).join(hot, "_hash", "left")
    salted_rows = marked.withColumn("_salt", F.pmod(F.xxhash64(*order), spread)).drop("_hash", "_salts")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1))
    salted_lookup = lookup.select("*", hashed).join(hot, "_hash", "left").withColumn("_salt", copies)
    return salted_rows.join(salted_lookup.drop("_hash", "_salts"), [*keys, "_salt"], "left").drop("_salt")
