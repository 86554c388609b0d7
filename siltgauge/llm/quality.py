"""Quality rules on documents and the verdict on the hosts they come from."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import landed, whole_text
from .words import runs, word_hashes

_SPACE = re.compile(r"[\x20\x09-\x0D]")
_WORDY = re.compile(r"[^\x20\x09-\x0D]").search

FIELDS = T.StructType()
for _name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"):
    FIELDS.add(_name, T.LongType())


def repeated_words(words: np.ndarray, length: int = 5) -> int:
    """Words that lie in runs of ``length`` words which occur twice or more in the text."""
    windows = runs(words, length)
    if len(windows) < 2:
        return 0
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[place] > 1)
    if not len(again):
        return 0
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + length, -1)
    return int((np.cumsum(change) > 0).sum())


def features(text: str) -> tuple[int, ...]:
    words = word_hashes(text)
    lines = [line for line in text.split("\n") if _WORDY(line)]
    symbols = sum(map(text.count, "#*$%&|<>"))
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


@F.pandas_udf(FIELDS)
def _features(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([features(t) for t in texts], columns=FIELDS.names, dtype="int64")


def base_failed(f: Column) -> Column:
    return (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])


def rule_failures(f: Column) -> dict[str, Column]:
    """The rules whose failures count against a host; every one is a comparison of whole numbers."""
    return {
        "few_words": f["n_words"] < 10,
        "repeated_words": 100 * f["n_repeat_words"] > 20 * f["n_words"],
        "symbols": 10 * f["n_symbols"] > f["n_words"],
        "repeated_lines": 10 * f["n_dup_lines"] > 3 * f["n_lines"],
        "word_length": (f["word_chars"] < 3 * f["n_words"]) | (f["word_chars"] > 10 * f["n_words"]),
    }


def host_verdicts(scored: DataFrame, *, reject_from: float = 0.5) -> DataFrame:
    """host, n_docs, failures per rule, n_failed, rate, shrunk_rate, rejected: one row per host.

    ``scored`` has host and failed_rules (array of rule names). The share of failing documents of a host
    is shrunk towards the mean of all hosts by a beta prior fitted to the hosts by moments; with one host,
    or hosts that do not differ, the prior counts as one document.
    """
    counts = [F.count_if(F.array_contains("failed_rules", rule)).alias(f"n_{rule}") for rule in rule_failures(F.lit(None))]
    hosts = scored.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *counts, F.count_if(F.size("failed_rules") > 0).alias("n_failed")
    )
    hosts = hosts.withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    # One row: mean and variance of the hosts' rates.
    moments = hosts.agg(F.avg("rate").alias("_mean"), F.var_samp("rate").alias("_var"))
    spread = F.col("_mean") * (1 - F.col("_mean"))
    weight = F.when(F.col("_var") > 0, F.greatest(spread / F.col("_var") - 1, F.lit(1.0))).otherwise(1.0)
    moments = moments.select("_mean", weight.alias("_weight"))
    shrunk = (F.col("n_failed") + F.col("_mean") * F.col("_weight")) / (F.col("n_docs") + F.col("_weight"))
    hosts = hosts.crossJoin(F.broadcast(moments)).withColumn("shrunk_rate", shrunk).drop("_mean", "_weight")
    return hosts.withColumn("rejected", F.col("shrunk_rate") >= reject_from)


def judge(docs: DataFrame, row: list[str], *, host_col: str = "source", text_col: str = "text", land: bool = True) -> DataFrame:
    """``row`` (a struct of the columns named), f (features), base_failed, kept per row of ``docs``.

    A document is kept if it passes the base rules and, where its host is rejected, all other rules too.
    A NULL text has no words and so fails; documents without a host are the documents of one host of
    their own; repeated rows are judged alike; an empty table gives an empty one. The columns of the
    caller stay inside ``row``, whatever their names. Without ``land``, features are worked out twice, for the
    hosts and for the result, and nothing of the rows is written in between: for rows with their texts.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in row]).alias("row")
    scored = docs.select(whole, F.col(f"`{host_col}`").alias("host"), _features(whole_text(text_col)).alias("f"))
    failed = F.filter(
        F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rule_failures(F.col("f")).items()]), F.isnotnull
    )
    scored = scored.withColumn("failed_rules", failed).withColumn("base_failed", base_failed(F.col("f")))
    scored = landed(scored, "quality") if land else scored
    bad = host_verdicts(scored).where("rejected").select(F.col("host").alias("_bad"), F.lit(True).alias("_rejected"))
    # Landed, so that its size is known when Spark plans the join.
    joined = scored.join(landed(bad, "hosts"), F.col("host").eqNullSafe(F.col("_bad")), "left")
    against = F.col("_rejected").isNotNull() & (F.size("failed_rules") > 0)
    return joined.select("row", "f", "base_failed", (~F.col("base_failed") & ~against).alias("kept"))


def rate_documents(docs: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, the features, base_failed and kept; see :func:`judge`."""
    counts = [f"f.{name}" for name in FIELDS.names]
    judged = judge(docs, [id_col])
    return judged.select(F.col("row").getField(id_col).alias("doc_id"), *counts, "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that :func:`judge` keeps, with the columns they came with."""
    return judge(docs, docs.columns, land=False).where("kept").select("row.*")
