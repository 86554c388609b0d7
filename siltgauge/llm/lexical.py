"""Ranked lexical search in whole numbers, in which equal bags of words are scored once.

Of a document only the terms of the items matter: its bag is the vector of their occurrences and its length
norm m. Documents are dealt by a hash of bag and norm, and those whose vectors are equal, not just their
hashes, make a class. All members of a class have the same score for every item, so a class keeps its
members with the smallest ids, as many as can be ranked, is scored once against all items, and its members
take ranks in the order of their ids. No task holds more of a class than that, however many copies there are.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, landed, ordinals, whole_text
from .words import folded_words

#: Items are searched for in blocks of at most so many items and of about so many terms, which bounds what
#: goes to every task (BLOCK_ITEMS * BLOCK_TERMS numbers, but for a single longer item).
BLOCK_ITEMS, BLOCK_TERMS = 256, 1 << 14
#: Groups that the best rows of all tasks go through before they meet.
SALTS = 64

BAG = T.StructType().add("n", T.LongType()).add("terms", T.ArrayType(T.IntegerType())).add("tfs", T.ArrayType(T.LongType()))
ITEM = T.StructType().add("words", T.ArrayType(T.BinaryType())).add("times", T.ArrayType(T.LongType()))


@F.pandas_udf(ITEM)
def _item_terms(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        counted = Counter(word for words in folded_words(text) for word in words)
        rows.append((list(counted), list(counted.values())))
    return pd.DataFrame(rows, columns=ITEM.names)


def _bags(vocabulary):
    """A column function: occurrences of the vocabulary's terms in a text, by term number, and n of all terms."""

    @F.pandas_udf(BAG)
    def bag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number = vocabulary.value.get
        for texts in batches:
            rows = []
            for text in texts:
                n, counted = 0, Counter()
                for words in folded_words(text):
                    n += len(words)
                    counted.update(map(number, words))
                counted.pop(None, None)
                terms = sorted(counted)
                rows.append((n, terms, [counted[t] for t in terms]))
            yield pd.DataFrame(rows, columns=BAG.names)

    return bag


class _Best:
    """The ``top`` best (score, doc_id) of each item; of equal scores the smaller id, no id last."""

    def __init__(self, items: int, top: int) -> None:
        self.heaps: list[list[tuple]] = [[] for _ in range(items)]
        self.floor = np.ones(items, dtype=np.int64)  # what a score must reach to matter
        self.top = top

    def offer(self, scores: np.ndarray, members: list) -> None:
        for item in np.flatnonzero(scores >= self.floor).tolist():
            heap, score = self.heaps[item], int(scores[item])
            for doc_id in members:
                entry = (score, doc_id is not None, -(doc_id or 0))
                if len(heap) < self.top:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                else:
                    break
            if len(heap) == self.top:
                self.floor[item] = heap[0][0]

    def rows(self) -> pd.DataFrame:
        found = [(n, -i if known else None, s) for n, heap in enumerate(self.heaps) for s, known, i in heap]
        frame = pd.DataFrame(found, columns=["item", "doc_id", "score"])
        return frame.astype({"item": "int64", "doc_id": "Int64", "score": "int64"})


def _scored(classes: DataFrame, weights, top: int) -> DataFrame:
    """item, doc_id, score: the best rows of every task. ``weights`` holds what a term adds to an item's score."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        per_term = weights.value
        found = _Best(per_term.shape[1], top)
        for batch in batches:
            for members, m, terms, tfs in zip(batch["members"], batch["m"], batch["terms"], batch["tfs"], strict=True):
                tf = np.asarray(tfs, dtype=np.int64)
                found.offer((1_000_000_000 * tf // (1000 * tf + 12 * m)) @ per_term[np.asarray(terms)], list(members))
        yield found.rows()

    return classes.mapInPandas(best, "item long, doc_id long, score long")


def bag_classes(bags: DataFrame, top: int) -> DataFrame:
    """members, m, terms, tfs: a row per different bag and norm, with its ``top`` smallest ids in order.

    The hash deals the rows out and is compared first; a class is what agrees in all of the vector. What a
    task of the shuffle sends of a class is cut to ``top`` rows before.
    """
    bag = ("bag", "m", "terms", "tfs")
    hashed = bags.withColumn("bag", F.xxhash64("terms", "tfs", "m")).select("doc_id", *bag)
    by_id = Window.partitionBy(*bag).orderBy(F.col("doc_id").asc_nulls_last())
    first = hashed.withColumn("_place", F.row_number().over(by_id)).where(F.col("_place") <= top)
    members = F.sort_array(F.collect_list(F.struct("_place", "doc_id")))
    return first.groupBy(*bag).agg(members.alias("_m")).select(F.transform("_m", lambda p: p["doc_id"]).alias("members"), *bag[1:])


def _top(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def item_blocks(items: DataFrame) -> DataFrame:
    """``items`` (item_id, words, times) with ``ordinal`` and ``block``."""
    numbered = ordinals(items.where(F.size("words") > 0), "item_id", "words")
    many = F.floor(F.col("ordinal") / BLOCK_ITEMS)
    # BLOCK_ITEMS rows at most are in one window.
    before = Window.partitionBy(many).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    terms = F.coalesce(F.sum(F.size("words")).over(before), F.lit(0))
    return numbered.withColumn("block", F.struct(many.alias("many"), F.floor(terms / BLOCK_TERMS).alias("terms")))


def _search_block(docs: DataFrame, items: list, top: int) -> DataFrame | None:
    """ordinal, doc_id, rank, score for the items of one block (rows with ordinal, words and times)."""
    context = docs.sparkSession.sparkContext
    vocabulary = {word: n for n, word in enumerate(sorted({bytes(w) for i in items for w in i.words}))}
    bags = landed(docs.select("doc_id", _bags(context.broadcast(vocabulary))("text").alias("b")).select("doc_id", "b.*"), "bags")
    n_docs, n_terms = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not n_docs:
        return None
    held = bags.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros((len(vocabulary), len(items)), dtype=np.int64)
    for term, df in held.collect():  # a row per term of the vocabulary at most
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    times = np.zeros_like(weights)
    for n, item in enumerate(items):
        times[[vocabulary[bytes(w)] for w in item.words], n] = item.times
    norm = F.expr(f"100 - 25 + (25 * n * {n_docs}L) div {n_terms}L").alias("m")
    classes = bag_classes(bags.where(F.size("terms") > 0).select("doc_id", norm, "terms", "tfs"), top)
    best = _scored(classes, context.broadcast(weights * times), top)
    best = _top(best.withColumn("_salt", F.spark_partition_id() % SALTS), ["item", "_salt"], top)
    ranked = landed(_top(best.drop("rank", "_salt"), ["item"], top), "ranked")
    discard(bags)
    numbers = F.array(*[F.lit(i.ordinal).cast("long") for i in items])
    return ranked.select(F.element_at(numbers, (F.col("item") + 1).cast("int")).alias("ordinal"), "doc_id", "rank", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 20,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of highest score above 0 for each row of ``items``.

    Terms are runs of ASCII letters and digits and of all code points beyond ASCII, only A-Z lower-cased. Of
    equal scores the smaller id comes first, a NULL id last. A NULL or empty text has no terms: such a
    document is no document of the statistics, such an item has no rows. Repeated rows of ``docs`` are
    documents of their own, repeated items are searched for each. Texts are never cut; empty tables give an
    empty result. Other columns do not matter. Ids are whole numbers.

    Documents are read once per block of items (see BLOCK_ITEMS, BLOCK_TERMS).
    """
    spark = docs.sparkSession
    held = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), _item_terms(whole_text(f"`{item_text_col}`")).alias("t"))
    asked = landed(item_blocks(asked.select("item_id", "t.*")), "items")
    found = []
    for (block,) in asked.select("block").distinct().sort("block").collect():
        of_block = asked.where((F.col("block.many") == block.many) & (F.col("block.terms") == block.terms))
        found.append(_search_block(held, of_block.select("ordinal", "words", "times").collect(), top))
    ranked = [f for f in found if f is not None]
    if not ranked:
        ranked = [spark.createDataFrame([], "ordinal long, doc_id long, rank int, score long")]
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    names = asked.select("ordinal", "item_id")
    return out.join(names, "ordinal").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
