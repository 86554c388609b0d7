"""Upkeep of the accepted/quarantine table: packing of small files, and replay of repaired records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove

#: What a packed file holds at most.
FILE_BYTES = 512 << 20


def _folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders below ``path`` that begin with ``prefix``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    names = [f.getPath().getName() for f in system.listStatus(target)]
    return sorted(n for n in names if n.startswith(prefix))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def _finished(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _packs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    names = [n for n in _folders(spark, f"{path}/_packs", "batches=") if _finished(spark, f"{path}/_packs/{n}")]
    return sorted(tuple(map(int, n.removeprefix("batches=").split("-"))) for n in names)


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in _folders(spark, path, "batch_id="))


def pack(spark: SparkSession, path: str, arrival: Column | str, upto: int, file_bytes: int = FILE_BYTES) -> None:
    """Pack the micro-batches up to ``upto`` of a ``split_by_verdict`` table into files by arrival date and verdict.

    ``upto`` is a batch that the stream has committed. Rows are dealt by date and verdict into as many files as
    their size asks for, and at least one each, whatever number of batches there were. A pack counts once it is
    finished; the folders of its batches go after that, and ``read_verdicts`` leaves out folders that a pack
    holds, so that a run that is broken off, or repeated, loses and doubles nothing.
    """
    packed = max((high for _, high in _packs(spark, path)), default=-1)
    todo = [b for b in _batches(spark, path) if packed < b <= upto]
    if todo:
        folders = [f"{path}/batch_id={b}" for b in todo]
        rows = spark.read.option("basePath", path).parquet(*folders).drop("batch_id")
        date = F.to_date(F.col(arrival) if isinstance(arrival, str) else arrival)
        files = max(1, -(-sum(size_of(spark, f) for f in folders) // file_bytes))
        dealt = rows.withColumn("arrival_date", date)
        keys = ["arrival_date", "is_valid"]
        if files > 1:
            # a day's rows go to several files by their share of all rows
            share = F.count(F.lit(1)) * files / rows.count()
            sizes = dealt.groupBy(F.col("arrival_date").alias("_date"), F.col("is_valid").alias("_valid"))
            sizes = sizes.agg(F.greatest(F.round(share), F.lit(1)).cast("int").alias("_files"))
            same = F.col("arrival_date").eqNullSafe(F.col("_date")) & (F.col("is_valid") == F.col("_valid"))
            salt = F.pmod(F.xxhash64("value"), F.col("_files"))
            dealt = dealt.join(sizes, same).withColumn("_salt", salt).drop("_date", "_valid", "_files")
            dealt = dealt.repartition(*keys, "_salt").drop("_salt")
        else:
            dealt = dealt.repartition(*keys)
        target = f"{path}/_packs/batches={todo[0]}-{todo[-1]}"
        dealt.write.mode("overwrite").partitionBy(*keys).parquet(target)
        packed = todo[-1]
    for batch in _batches(spark, path):
        if batch <= packed:
            remove(spark, f"{path}/batch_id={batch}")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ``split_by_verdict`` table, packed or not, with ``is_valid``; a date or a verdict prunes packs."""
    packs = _packs(spark, path)
    packed = max((high for _, high in packs), default=-1)
    parts = [spark.read.parquet(f"{path}/_packs/batches={a}-{b}") for a, b in packs]
    loose = [f"{path}/batch_id={b}" for b in _batches(spark, path) if b > packed]
    if loose:
        parts.append(spark.read.option("basePath", path).parquet(*loose).drop("batch_id"))
    if not parts:
        raise ValueError(f"There is no table in {path}.")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.withColumn("is_valid", F.col("is_valid").cast("boolean"))


def replay(spark: SparkSession, repaired: DataFrame, checked, path: str, value: str = "value") -> DataFrame:
    """Append repaired quarantine rows that are valid now, each record once; what is still invalid is returned.

    ``checked`` validates a table (for instance ``validate``). The table in ``path`` is its own ledger: a row
    carries the hash of its record, and a record whose hash is there already is not appended again, so
    replaying the same repairs, or going on after a failure, leaves the same table.
    """
    rows = checked(repaired).withColumn("record_hash", F.sha2(F.col(value), 256))
    good = rows.where("is_valid").dropDuplicates(["record_hash"])
    if _folders(spark, path, "part-"):
        ledger = spark.read.parquet(path).select("record_hash")
        good = good.join(ledger, "record_hash", "left_anti")
    good.drop("is_valid", "errors").write.mode("append").parquet(path)
    return rows.where("not is_valid")
