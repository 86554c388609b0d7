"""Tables, scratch tables and rows of text that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, settings

#: Rows of texts that a Python worker of a landed step holds at a time.
BATCH = 256
#: What separates words, as the contracts of this package define them.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished job go at its end; later jobs read landed tables only."""
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        yield


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and outlives lost executors.

    Python workers get BATCH rows at a time, so that long texts and large sets stay few in memory.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    with tidy_shuffles(spark), settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH)):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a landed table that no result reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ordinals(df: DataFrame, *order: str | Column, name: str = "ordinal") -> DataFrame:
    """Number all rows from 0 in the order given, without bringing them into one task.

    The rows are sorted by ranges and landed with their partition and place in it; the rows before
    a partition are a sum over partitions, of which there are as many as the sort has tasks.
    """
    placed = df.sort(*order).withColumn("_slot", F.monotonically_increasing_id())
    placed = landed(placed, "ordinals")
    part = F.shiftright("_slot", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    held = F.collect_list(F.struct("_part", "_size"))
    # One row that holds a number per sort task.
    sizes = sizes.agg(held.alias("_sizes"))
    before = F.aggregate(
        F.filter("_sizes", lambda s: s["_part"] < part),
        F.lit(0).cast("long"),
        lambda total, s: total + s["_size"],
    )
    local = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.crossJoin(F.broadcast(sizes)).withColumn(name, before + local)
    return numbered.drop("_slot", "_sizes")
