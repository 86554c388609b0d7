"""An index of the keys that a stream has seen, in files of the shared folder.

Keys lie in parts by ranges of their hash. Every micro-batch adds its new keys as a run; FANOUT runs of a level
are merged into one of the next, so there are some FANOUT runs for every power of FANOUT batches. A run has a
filter: a row of bits per part, a tenth of the size of the keys or less. A batch asks the filters first and
reads only the parts of runs that may hold one of its keys.

A manifest per batch names the runs in force after it. A batch that is repeated starts from the manifest before
it and writes the same runs again; runs that a merge has replaced go when the batch after it begins.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import landed, remove

#: Bits of a filter per key, in words of 64; a key has BITS of them in one word.
BITS_PER_KEY, BITS = 16, 3


@dataclass(frozen=True)
class Run:
    """``n`` keys in folder ``name``; its filter has ``words`` words a part."""

    name: str
    level: int
    n: int
    words: int


def _mask() -> Column:
    # the low bits of the hash choose the word, other bits of it the bits of the word
    places = [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(hash), {6 * k}) & 63 AS INT))") for k in range(BITS)]
    mask = places[0]
    for place in places[1:]:
        mask = mask.bitwiseOR(place)
    return mask


class KeyIndex:
    """See the module. ``key`` is the column name of the keys, ``kind`` their type; ``parts`` is a power of two."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind, parts: int = 16, fanout: int = 4) -> None:
        if parts < 2 or parts & (parts - 1) or fanout < 2:
            raise ValueError("An index needs a power of two parts and a fanout of 2 or more.")
        self.spark, self.path, self.key, self.fanout, self.parts = spark, path, key, fanout, parts
        self.schema = StructType().add(key, kind)

    # --- manifests

    def _manifest(self, batch_id: int) -> str:
        return f"{self.path}/manifest/{batch_id}"

    def _read(self, batch_id: int) -> dict:
        if batch_id < 0:
            return {"runs": [], "replaced": []}
        (line,) = self.spark.read.text(self._manifest(batch_id)).collect()
        return json.loads(line.value)

    def _write(self, batch_id: int, runs: list[Run], replaced: list[str], read: dict) -> None:
        line = json.dumps({"runs": [asdict(r) for r in runs], "replaced": replaced, "read": read})
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(self._manifest(batch_id))

    def runs_before(self, batch_id: int) -> list[Run]:
        """The runs that hold the keys of all batches before this one."""
        return [Run(**r) for r in self._read(batch_id - 1)["runs"]]

    def reads_of(self, batch_id: int) -> dict:
        """What looking up this batch has read: runs and files in force, parts and files read."""
        return self._read(batch_id)["read"]

    # --- keys

    def hashed(self, keys: DataFrame) -> DataFrame:
        """key, hash and part of the distinct ``keys`` that are not NULL."""
        found = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        found = found.select(self.key, F.xxhash64(self.key).alias("hash"))
        return found.withColumn("part", F.shiftrightunsigned("hash", 65 - self.parts.bit_length()).cast("int"))

    def _asked(self, hashed: DataFrame, runs: list[Run]) -> DataFrame:
        """key, run and part where the filters say that a run may hold a key."""
        filters = self.spark.read.schema("run string, part int, word bigint, bits bigint")
        filters = filters.parquet(*[f"{self.path}/filters/{r.name}" for r in runs])
        every = F.explode(F.array(*[F.struct(F.lit(r.name).alias("run"), F.lit(r.words).alias("words")) for r in runs]))
        asked = hashed.select("*", _mask().alias("mask"), every.alias("r")).select(self.key, "part", "hash", "mask", "r.*")
        asked = asked.withColumn("word", F.pmod(F.col("hash"), F.col("words").cast("bigint")))
        held = asked.join(filters, ["run", "part", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return landed(held.select(self.key, "run", "part"), "asked")

    def lookup(self, hashed: DataFrame, runs: list[Run]) -> tuple[DataFrame, dict]:
        """Which of the keys are in the runs, and what has been read for that."""
        read = {"runs": len(runs), "files_held": len(runs) * self.parts, "files_read": 0}
        nothing = self.spark.createDataFrame([], self.schema)
        if not runs:
            return nothing, read
        asked = self._asked(hashed, runs)
        # at most a row per run and part
        parts = asked.select("run", "part").distinct().collect()
        read["files_read"] = len(parts)
        if not parts:
            return nothing, read
        keys = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/keys/{p.run}/part={p.part}" for p in parts])
        return landed(asked.select(self.key).distinct().join(keys, self.key, "left_semi"), "seen"), read

    def _save(self, name: str, level: int, hashed: DataFrame) -> Run | None:
        """Write a run: one file and one row of filter words per part."""
        folder = f"{self.path}/keys/{name}"
        dealt = hashed.select(self.key, "part").repartition(self.parts, "part")
        dealt.write.mode("overwrite").partitionBy("part").parquet(folder)
        saved = self.spark.read.schema(StructType([*self.schema.fields]).add("part", "integer")).parquet(folder)
        n = saved.count()
        if n == 0:
            return None
        words = max(16, 1 << (-(-n * BITS_PER_KEY // (64 * self.parts)) - 1).bit_length())
        marked = saved.select("part", F.xxhash64(self.key).alias("hash"))
        marked = marked.select("part", F.pmod(F.col("hash"), F.lit(words).cast("bigint")).alias("word"), _mask().alias("mask"))
        rows = marked.groupBy("part", "word").agg(F.bit_or("mask").alias("bits"))
        rows.select(F.lit(name).alias("run"), "part", "word", "bits").write.mode("overwrite").parquet(f"{self.path}/filters/{name}")
        return Run(name, level, n, words)

    def _merged(self, name: str, level: int, runs: list[Run]) -> Run:
        schema = StructType([*self.schema.fields]).add("part", "integer")
        keys = [self.spark.read.schema(schema).parquet(f"{self.path}/keys/{r.name}") for r in runs]
        union = keys[0]
        for more in keys[1:]:
            union = union.unionByName(more)
        return self._save(name, level, union)

    def add(self, batch_id: int, hashed: DataFrame, runs: list[Run], read: dict) -> None:
        """Put the new keys of a batch into the index, merge full levels and write the manifest."""
        added = self._save(f"b{batch_id}", 0, hashed)
        runs, replaced, level = [*runs, *([added] if added else [])], [], 0
        while len(full := [r for r in runs if r.level == level]) >= self.fanout:
            level += 1
            runs = [r for r in runs if r not in full] + [self._merged(f"b{batch_id}-{level}", level, full)]
            replaced += [r.name for r in full]
        self._write(batch_id, runs, replaced, read)

    def tidy(self, batch_id: int) -> None:
        """Remove what only batches before the last one needed; call it when ``batch_id`` begins."""
        if batch_id > 0:
            for name in self._read(batch_id - 1)["replaced"]:
                remove(self.spark, f"{self.path}/keys/{name}")
                remove(self.spark, f"{self.path}/filters/{name}")
