"""Benchmark passages in documents, also cut up and reordered, by greedy string tiling.

Seeds are runs of LEAST tokens. A fixed-size filter of the benchmark's seeds goes to every task and lets a
document pass only what may be a seed, so a clean document ends where it is read. Documents and items that
share enough seeds are tiled: the longest run of tokens that both have and no tile covers yet becomes a
tile, again and again, until no run of LEAST tokens is left. Runs are found by Karp-Rabin hashes. What
tiles cover of an item is its coverage, in whatever order its parts stand in the document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import landed, whole_text
from .words import runs, word_hashes

LEAST = 5
#: Bits of the seed filter: four megabytes, however many items there are.
FILTER_BITS = 1 << 25


def tokens(text: str) -> np.ndarray:
    """Lower-cased words between white space and ASCII marks, as hashes."""
    return word_hashes(text, folded=True, marks_split=True)


def _free_runs(row: np.ndarray, marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the runs without a marked token, and where they start."""
    covered = np.concatenate(([0], np.cumsum(marked)))
    places = np.flatnonzero(covered[length:] == covered[:-length]) if len(row) >= length else np.empty(0, dtype=np.int64)
    return runs(row, length)[places], places


def tiles(item: np.ndarray, doc: np.ndarray, gaps: np.ndarray | None = None, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place in item, place in doc, length) of the tiles: longest first, equal ones by place.

    ``gaps``: tokens of ``doc`` that match nothing.
    """
    in_item = np.zeros(len(item), dtype=bool)
    in_doc = np.zeros(len(doc), dtype=bool) if gaps is None else gaps.copy()
    found: list[tuple[int, int, int]] = []
    longest = min(len(item), len(doc))
    while True:
        # A common run of some length has common runs of every smaller length.
        low, high = least - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            a, b = (_free_runs(*side, middle)[0] for side in ((item, in_item), (doc, in_doc)))
            low, high = (middle, high) if np.intersect1d(a, b).size else (low, middle - 1)
        if low < least:
            return found
        longest = low
        hashes, places = _free_runs(doc, in_doc, longest)
        at: dict[int, list[int]] = {}
        for value, place in zip(hashes.tolist(), places.tolist(), strict=True):
            at.setdefault(value, []).append(place)
        progress = False
        for value, p in zip(*map(np.ndarray.tolist, _free_runs(item, in_item, longest)), strict=True):
            for t in at.get(value, ()):
                if in_item[p : p + longest].any():
                    break
                if not in_doc[t : t + longest].any() and np.array_equal(item[p : p + longest], doc[t : t + longest]):
                    in_item[p : p + longest] = in_doc[t : t + longest] = True
                    found.append((p, t, longest))
                    progress = True
        if not progress:  # only hashes agreed
            longest -= 1


SEEDED = T.StructType().add("seeds", T.ArrayType(T.LongType())).add("tokens", T.ArrayType(T.LongType()))


@F.pandas_udf(SEEDED)
def _item_seeds(texts: pd.Series) -> pd.DataFrame:
    rows = [tokens(t) for t in texts]
    return pd.DataFrame({"seeds": [runs(r, LEAST).view(np.int64) for r in rows], "tokens": [r.view(np.int64) for r in rows]})


def _bits(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.uint64(FILTER_BITS)
    return (seeds % size).astype(np.int64), ((seeds >> np.uint64(32)) % size).astype(np.int64)


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Two bits per seed in a row of FILTER_BITS bits; its size does not depend on the seeds."""
    unsigned = F.pmod(F.col("seed"), F.lit(FILTER_BITS))
    upper = F.pmod(F.shiftrightunsigned("seed", 32), F.lit(FILTER_BITS))
    bits = seeds.select(F.explode(F.array(unsigned, upper)).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS INT))")).alias("value")
    )
    found = words.toPandas()  # at most FILTER_BITS / 64 rows
    row = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    row[found["word"].to_numpy(dtype=np.int64)] = found["value"].to_numpy(dtype=np.int64)
    return np.unpackbits(row.view(np.uint8), bitorder="little").view(bool)


def _document_seeds(filtered):
    @F.pandas_udf(SEEDED)
    def hits(texts: pd.Series) -> pd.DataFrame:
        bits = filtered.value
        rows = []
        for text in texts:
            row = tokens(text)
            seeds = runs(row, LEAST)
            one, two = _bits(seeds)
            hit = np.flatnonzero(bits[one] & bits[two])
            if not len(hit):
                rows.append((None, None))
                continue
            # Tokens of hit runs; a 0 stands for what lies between them.
            held = np.zeros(len(row) + 1, dtype=np.int64)
            np.add.at(held, hit, 1)
            np.add.at(held, hit + LEAST, -1)
            held = np.cumsum(held)[:-1] > 0
            part = np.where(held, row, np.uint64(0))[held | np.concatenate(([False], held[:-1]))]
            rows.append((np.unique(seeds[hit]).view(np.int64), part.view(np.int64)))
        return pd.DataFrame(rows, columns=["seeds", "tokens"])

    return hits


COVER = T.StructType().add("n_covered", T.LongType()).add("n_tiles", T.LongType())


@F.pandas_udf(COVER)
def _cover(items: pd.Series, docs: pd.Series) -> pd.DataFrame:
    rows = []
    for item, doc in zip(items, docs, strict=True):
        item, doc = (np.asarray(r, dtype=np.int64).view(np.uint64) for r in (item, doc))
        found = tiles(item, doc, doc == 0)
        rows.append((sum(length for *_, length in found), len(found)))
    return pd.DataFrame(rows, columns=COVER.names, dtype="int64")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = 0.5,
) -> DataFrame:
    """doc_id, ref, item_id, n_tokens, n_covered, n_tiles, coverage: a row per document and item of which
    the document covers at least ``threshold``.

    ``ref`` is the hash of the text, so that rows without id and several texts of one id stay apart;
    repeated rows give one result. Items with fewer than LEAST tokens (NULL and empty ones too) cannot be
    found, documents without text hold nothing, empty tables give an empty result. Several items of one id
    count as that id, with its best coverage. Other columns do not matter.
    """
    item_text = whole_text(f"`{item_text_col}`")
    held = items.select(F.col(f"`{item_col}`").alias("item_id"), F.xxhash64(item_text).alias("item_ref"), item_text.alias("t"))
    held = held.select("item_id", "item_ref", _item_seeds("t").alias("s")).select("item_id", "item_ref", "s.*")
    held = landed(held.where(F.size("seeds") > 0).dropDuplicates(["item_id", "item_ref"]), "items")
    counts = held.select("item_id", "item_ref", F.size("tokens").alias("n_tokens"), F.explode("seeds").alias("seed"))
    # How often a seed stands in an item: a tile of n tokens has n - LEAST + 1 of them, so tiles cover at
    # most LEAST times as many tokens as the document shares seeds with the item.
    seeds = landed(counts.groupBy("item_id", "item_ref", "n_tokens", "seed").agg(F.count(F.lit(1)).alias("times")), "seeds")
    filtered = docs.sparkSession.sparkContext.broadcast(seed_filter(seeds))

    text = whole_text(f"`{text_col}`")
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("ref"), _document_seeds(filtered)(text).alias("s"))
    found = landed(found.where("s.seeds IS NOT NULL").select("doc_id", "ref", "s.*").distinct(), "hits")
    shared = found.select("doc_id", "ref", F.explode("seeds").alias("seed")).join(seeds, "seed")
    shared = shared.groupBy("doc_id", "ref", "item_id", "item_ref", "n_tokens").agg(F.sum("times").alias("n_shared"))
    enough = F.col("n_shared") * LEAST >= F.col("n_tokens") * threshold
    pairs = landed(shared.where(enough).drop("n_shared"), "pairs")

    texts = found.select(F.col("doc_id").alias("_id"), F.col("ref").alias("_ref"), F.col("tokens").alias("in_doc"))
    of_doc = (F.col("ref") == F.col("_ref")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    wanted = held.select(F.col("item_id").alias("_item"), F.col("item_ref").alias("_iref"), F.col("tokens").alias("in_item"))
    of_item = (F.col("item_ref") == F.col("_iref")) & F.col("item_id").eqNullSafe(F.col("_item"))
    tiled = pairs.join(texts, of_doc).join(wanted, of_item)
    tiled = tiled.select("doc_id", "ref", "item_id", "n_tokens", _cover("in_item", "in_doc").alias("c")).select(
        "doc_id", "ref", "item_id", F.col("n_tokens").cast("long").alias("n_tokens"), "c.*"
    )
    tiled = tiled.withColumn("coverage", F.col("n_covered") / F.col("n_tokens")).where(F.col("coverage") >= threshold)
    best = F.max(F.struct("coverage", "n_covered", "n_tiles", "n_tokens")).alias("b")
    out = tiled.groupBy("doc_id", "ref", "item_id").agg(best)
    return out.select("doc_id", "ref", "item_id", "b.n_tokens", "b.n_covered", "b.n_tiles", "b.coverage")


def drop_leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns; see :func:`find_leaks`."""
    leaks = find_leaks(docs, items, id_col=id_col, text_col=text_col, **options)
    leaks = landed(leaks.select(F.col("doc_id").alias("_leak_id"), F.col("ref").alias("_leak_ref")).distinct(), "leaks")
    same = (F.xxhash64(whole_text(f"`{text_col}`")) == F.col("_leak_ref")) & F.col(f"`{id_col}`").eqNullSafe(F.col("_leak_id"))
    return docs.join(leaks, same, "left_anti")
