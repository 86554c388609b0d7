"""Importance resampling towards a target text collection, with bit-sliced sums.

Words and pairs of words fall into BUCKETS by checksum. A bucket's gain is the logarithm of how much more
often the target holds it than the documents do. A document's bucket counts are cut into bit planes of
BUCKETS bits, the gains into planes in two's complement. A plane of counts and a plane of gains have as many
buckets in common as the population count of their conjunction says, and these numbers, times their powers
of two, add up to the exact sum of the gains over all features of the document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import landed, whole_text
from .words import folded_words

BUCKETS = 10_000
#: Buckets and padding to whole 64-bit words.
_BITS = -(-BUCKETS // 64) * 64


def feature_buckets(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of their features), for a bounded part of the text at a time.

    The checksum of a pair goes on from that of its first word, so no pair is ever put together.
    """
    last: bytes | None = None
    for words in folded_words(text):
        if not words:
            continue
        sums = list(map(crc32, words))
        heads, seconds = (sums, words[1:]) if last is None else ([crc32(last), *sums], words)
        pairs = map(crc32, seconds, map(crc32, repeat(b" "), heads))
        found = np.fromiter((*sums, *pairs), dtype=np.int64)
        last = words[-1]
        yield len(words), found % BUCKETS


def _counted(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                for _, found in feature_buckets(text):
                    total += np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    return texts.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends on BUCKETS numbers at most."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in _counted(texts.select(whole_text(f"`{text_col}`").alias("text"))).collect():  # BUCKETS rows at most
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of the smoothed odds of each bucket, rounded down."""
    s_all, t_all = int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    ratios = [(t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS)) for s, t in pairs]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def planes(values: np.ndarray, depth: int) -> np.ndarray:
    """``depth`` rows of one bit per bucket, lowest bits first; negative values in two's complement."""
    bits = np.zeros((depth, _BITS), dtype=np.uint8)
    bits[:, : len(values)] = (values >> np.arange(depth)[:, None]) & 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class GainPlanes:
    """The bit planes of signed gains, and exact sums of gains by them."""

    def __init__(self, values: np.ndarray) -> None:
        depth = max(int(values.max()).bit_length(), int(~values.min()).bit_length()) + 1
        self.planes = planes(values, depth)
        self.powers = np.array([1 << j for j in range(depth - 1)] + [-(1 << (depth - 1))], dtype=np.int64)

    def total(self, counts: np.ndarray) -> int:
        """The sum over all buckets of count times gain, for counts of any size."""
        held = planes(counts, int(counts.max()).bit_length())
        common = np.bitwise_count(held[:, None, :] & self.planes[None, :, :]).sum(axis=2, dtype=np.int64)
        return sum(int(line) << k for k, line in enumerate(common @ self.powers))


WEIGHED = T.StructType().add("n_words", T.LongType()).add("n_features", T.LongType()).add("weight", T.LongType())


def _weigher(shared):
    @F.pandas_udf(WEIGHED)
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sliced = GainPlanes(shared.value)
        for texts in batches:
            rows = []
            for text in texts:
                n_words, counts = 0, np.zeros(BUCKETS, dtype=np.int64)
                for n, found in feature_buckets(text):
                    n_words += n
                    counts += np.bincount(found, minlength=BUCKETS)
                n_features = 2 * n_words - 1 if n_words else 0
                rows.append((n_words, n_features, sliced.total(counts) // n_features if n_features else 0))
            yield pd.DataFrame(rows, columns=WEIGHED.names)

    return weigh


def noise(id_col: Column, seed: int) -> Column:
    """1000 times a Gumbel draw by the id, rounded down; a NULL id draws like an empty one."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    drawn = (F.conv(F.substring(key, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000) * F.log(-F.log(drawn)))


def _places(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with their place from 0 in the order given: a sort by ranges, and the rows of the ranges before."""
    placed = landed(rows.sort(*order).withColumn("_slot", F.monotonically_increasing_id()), "places")
    part = F.shiftright("_slot", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    # A row per task of the sort.
    found = placed.join(F.broadcast(ahead), part == F.col("_part"))
    within = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return found.withColumn("place", F.col("_ahead") + within).drop("_slot", "_part", "_ahead")


def resample(
    docs: DataFrame,
    targets: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``.

    ``weight`` is the mean gain of the features towards ``targets``, rounded down, ``score`` adds the noise of the
    id, ``rank`` numbers the drawn documents: of those with at least ``least_words`` words, ``percent`` percent
    with the highest scores, of equal scores the smaller id. Others have rank NULL. A NULL or empty text has
    no features and weight 0; a NULL id draws like an empty one and comes last among equal scores; repeated
    rows are documents of their own, of which equal ones take neighbouring ranks. Texts are never cut. Empty
    ``docs`` give an empty table; with empty ``targets`` all gains follow from the documents alone. Other
    columns do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs, text_col), bucket_counts(targets, target_text_col)))
    key = F.col(f"`{id_col}`")
    weighed = docs.select(key.alias("doc_id"), _weigher(shared)(whole_text(f"`{text_col}`")).alias("w"), noise(key, seed).alias("_noise"))
    weighed = landed(weighed.select("doc_id", "w.*", (F.col("w.weight") + F.col("_noise")).alias("score")), "weighed")
    drawable = F.col("n_words") >= least_words
    quota = percent * weighed.where(drawable).count() // 100
    order = (F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"))
    ranked = _places(weighed.where(drawable), *order).withColumn("rank", F.when(F.col("place") < quota, F.col("place") + 1))
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    rest = weighed.where(~drawable).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(rest.select(*columns))
