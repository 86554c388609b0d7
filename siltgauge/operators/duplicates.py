"""Repeated keys in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import landed
from .lookup import left_join_skewed


def _place(order: list[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def key_groups(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per non-NULL key: rows and the first place in ``order``. Combines before the shuffle.

    A single number or timestamp as order is combined in a hash table; several columns
    make a struct, which Spark aggregates by sorting.
    """
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    present = present.select(*keys, _place(order).alias("_order"))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_first"))


def duplicate_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keys that occur more than once: occurrences, surplus rows and the first ``order`` values."""
    repeated = key_groups(df, keys, order).where(F.col("_n") > 1)
    if len(order) == 1:
        firsts = [F.col("_first").alias(f"first_{order[0]}")]
    else:
        firsts = [F.col(f"_first.{column}").alias(f"first_{column}") for column in order]
    return repeated.select(*keys, F.col("_n").alias("n"), (F.col("_n") - 1).alias("surplus"), *firsts)


def flag_duplicates(df: DataFrame, keys: list[str], order: list[str], flag: str = "is_duplicate") -> DataFrame:
    """Mark every row but the first of its key, in order of the ``order`` columns.

    ``order`` must end in a unique column. NULL keys are never duplicates. No window over
    the key: a key that holds a third of the table would be one task. The first row per key
    is an aggregate, and the rows meet it in a join that splits frequent keys. The aggregate is
    landed, as three parts of the join read it: the rows themselves are read twice.
    """
    groups = landed(key_groups(df, keys, order), "groups")
    firsts = groups.where(F.col("_n") > 1).select(*keys, "_first")
    joined = left_join_skewed(df, firsts, keys, order, counts=groups)
    return joined.withColumn(flag, F.coalesce(_place(order) > F.col("_first"), F.lit(False))).drop("_first")
