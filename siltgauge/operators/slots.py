"""Dense row positions without ranking the whole table in one task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_slot(df: DataFrame, key: str, slot: str = "slot", buckets: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, ... in order of a unique numeric ``key``. A row without a key has no slot.

    Approximate quantiles cut the key range into even buckets. Rows are ranked
    inside their bucket and shifted by the sizes of the buckets before it. The
    cut points are constants of the plan, so a recomputed task agrees with the first run.
    """
    session = df.sparkSession
    size = buckets or int(session.conf.get("spark.sql.shuffle.partitions"))
    probabilities = [i / size for i in range(1, size)]
    cuts = sorted(set(df.approxQuantile(key, probabilities, 0.25 / size))) if probabilities else []
    if cuts:
        splits = [-math.inf, *cuts, math.inf]
        placed = Bucketizer(splits=splits, inputCol=key, outputCol="_bucket").transform(df.where(F.col(key).isNotNull()))
    else:
        placed = df.where(F.col(key).isNotNull()).withColumn("_bucket", F.lit(0.0))
    ahead = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    numbered = (
        placed.withColumn("_within", within)
        .join(offsets, "_bucket")
        .withColumn(slot, F.col("_ahead") + F.col("_within") - F.lit(1))
        .drop("_bucket", "_ahead", "_within")
    )
    keyless = df.where(F.col(key).isNull()).withColumn(slot, F.lit(None).cast("bigint"))
    return numbered.unionByName(keyless)
