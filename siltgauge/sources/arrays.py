"""JSON array files of any size, read by as many tasks as they have splits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import landed

#: a string of one line; possessive, so that long ones need no stack
_STRING = r'"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
_MARK = re.compile(_STRING + r"|[\[\]{},]")
PIECES = "no bigint, place bigint, ends boolean, text string"


class _Cutter:
    """Cuts the lines of one split, given how many brackets are open before it, into pieces of elements."""

    def __init__(self, depth: int) -> None:
        self.depth, self.place = depth, 0
        self._open: list[str] | None = [] if depth > 0 else None

    def cut(self, text: str) -> list[tuple[int, bool, str]]:
        """(place, whether the element ends there, text) of the pieces that end in these lines."""
        found: list[tuple[int, bool, str]] = []
        start = 0
        for mark in _MARK.finditer(text):
            c = mark[0][0]
            if c == '"':
                continue
            ended = False
            if c in "[{":
                self.depth += 1
                if self.depth == 1:
                    self._open, start = [], mark.end()
            elif c in "]}":
                self.depth -= 1
                ended = self.depth == 0
            else:
                ended = self.depth == 1
            if ended and self._open is not None:
                found.append((self.place, True, "\n".join([*self._open, text[start : mark.start()]])))
                self.place += 1
                self._open, start = ([] if c == "," else None), mark.end()
        if self._open is not None:
            self._open.append(text[start:])
        return found

    def rest(self) -> list[tuple[int, bool, str]]:
        """The piece that the split leaves open."""
        return [] if self._open is None else [(self.place, False, "\n".join(self._open))]


def _cut_splits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of all elements; the lines of a split come in order, splits one after another."""
    at, cutter = None, None
    for batch in batches:
        rows: list[tuple] = []
        for _, lines in batch.groupby((batch["no"] != batch["no"].shift()).cumsum(), sort=False):
            here = int(lines["no"].iloc[0])
            if here != at:
                if cutter is not None:
                    rows += [(at, *piece) for piece in cutter.rest()]
                at, cutter = here, _Cutter(int(lines["ahead"].iloc[0]))
            rows += [(at, *piece) for piece in cutter.cut("\n".join(lines["value"]))]
        yield pd.DataFrame(rows, columns=["no", "place", "ends", "text"])
    if cutter is not None:
        yield pd.DataFrame([(at, *piece) for piece in cutter.rest()], columns=["no", "place", "ends", "text"])


def _nesting(line: Column) -> Column:
    """By how much a line changes the number of open brackets. A string cannot hold a line end, so every line
    begins outside of strings."""
    bare = F.regexp_replace(line, _STRING, "")
    opened = F.length(F.regexp_replace(bare, r"[^\[{]++", ""))
    return (opened - F.length(F.regexp_replace(bare, r"[^\]}]++", ""))).cast("bigint")


def _before(splits: DataFrame, name: str, *others: str) -> DataFrame:
    """file, split and the sum of column ``n`` over the splits before it in its file; one row per split."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file", "split", *others, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(name))


def read_json_array_split(spark: SparkSession, path: str) -> DataFrame:
    """file, position, value: the elements of JSON array files as text, each file read by as many tasks as it has splits.

    A line's brackets outside of strings tell how deep the array is after it; sums of that over splits tell where
    a split begins, and the task that reads the split cuts it at the commas between elements. Only the elements
    that a split's ends divide are put together by a shuffle. An element keeps its text, so numbers keep their digits;
    ``position`` counts the elements of a file from 0. An element that is no JSON value is a malformed
    record, the others are not affected (``read_json_array`` takes the whole file as one). Blank elements, of an
    empty array too, are left out; what stands outside of the array is not read. A file without line ends is
    one line, and so one task.
    """
    text = spark.read.text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    depths = lines.groupBy("file", "split").agg(F.sum(_nesting(F.col("value"))).alias("n"))
    splits = landed(_before(depths, "ahead").withColumn("no", F.monotonically_increasing_id()), "splits")
    # one row per split; broadcast, because the lines of a split have to stay in order
    opened = lines.join(F.broadcast(splits), ["file", "split"]).select("no", "ahead", "value")
    pieces = landed(opened.mapInPandas(_cut_splits, PIECES), "pieces")
    ends = splits.join(pieces.groupBy("no").agg(F.count_if("ends").alias("n")), "no")
    numbered = pieces.join(_before(ends, "before", "no"), "no").withColumn("position", F.col("before") + F.col("place"))
    # an element that begins and ends in its split is whole: all pieces of a split but the first and the last
    inner = (F.col("place") > 0) & F.col("ends")
    whole = numbered.where(inner).select("file", "position", F.col("text").alias("value"))
    parts = numbered.where(~inner).groupBy("file", "position").agg(F.array_sort(F.collect_list(F.struct("split", "text"))).alias("parts"))
    joined = parts.select("file", "position", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("value"))
    every = whole.unionByName(joined)
    return every.select("file", "position", F.trim("value").alias("value")).where(F.col("value").rlike(r"\S"))
