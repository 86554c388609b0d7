"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("siltgauge")
    defaults = {
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, setting in {**defaults, **settings}.items():
        builder = builder.config(key, setting)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def check_zone(spark: SparkSession) -> None:
    """Naive timestamps are UTC everywhere in this library; the session's own setting is the caller's."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"Set spark.sql.session.timeZone to UTC; it is {zone}.")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``, the folder the cluster names. Only a
    local session without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        base = tempfile.mkdtemp(prefix="siltgauge-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: worked out once, and there for recomputed tasks."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Set session options (dots written as ``__``) and put the old values back."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
