"""Secrets in text: candidates by pattern, false positives removed by a random forest.

Candidates are the values that follow a key word, of whatever characters, and other long runs of the characters
that keys and tokens are made of. The forest sees their length, how usual their character transitions are in
the corpus, how much of them dictionary entries cover, the path of the document and the neighbouring words. It
is trained from labelled findings.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import landed, whole_text

LEAST_LENGTH = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Words whose assignment marks a sure finding, for labelled findings made by rule.
KEY_WORDS = ("token", "secret", "password", "passwd", "apikey", "api_key", "access_key", "auth")
_KEY = rf"(?:{'|'.join(KEY_WORDS)})[\"']?\s{{0,3}}[=:]\s{{0,3}}"
_ASSIGNED = re.compile(rf"{_KEY}[\"']?\Z", re.IGNORECASE)
#: What follows a key word: quoted, or up to white space or the end of a list or statement.
VALUE = re.compile(rf"{_KEY}(?:\"([^\"\s]{{6,}})\"|'([^'\s]{{6,}})'|(?![\"'])([^\s,;)}}\]]{{6,}}))", re.IGNORECASE)
#: Words before digests and identifiers that are no secrets, for labelled findings made by rule.
PLAIN_WORDS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "guid", "revision", "etag")
_PLAIN = re.compile(rf"\b(?:{'|'.join(PLAIN_WORDS)})[\"']?\s{{0,3}}[=:]?\s{{0,3}}[\"']?\Z", re.IGNORECASE)
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})\Z", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")
#: Characters around a candidate in which neighbouring words are looked for.
NEAR = 48
#: Labelled findings per label that the forest is trained from, at most.
SAMPLE = 10_000
BUCKETS = 16

#: Symbols of the transition table: letters, digits, any other ASCII character, any other byte.
_SYMBOLS = np.array([*[27] * 128, *[28] * 128])
_SYMBOLS[ord("a") : ord("z") + 1] = _SYMBOLS[ord("A") : ord("Z") + 1] = np.arange(26)
_SYMBOLS[ord("0") : ord("9") + 1] = 26
N_SYMBOLS = 29


def _pairs(text: str) -> np.ndarray:
    symbols = _SYMBOLS[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    return symbols[:-1] * N_SYMBOLS + symbols[1:]


def transition_costs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Minus the logarithm of the probability of every transition between symbols, over all texts.

    Every task sums up its own texts in a table of N_SYMBOLS ** 2 numbers.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(N_SYMBOLS**2, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(_pairs(text), minlength=len(total))
        yield pd.DataFrame({"pair": np.arange(len(total)), "n": total})

    counts = docs.select(whole_text(f"`{text_col}`").alias("text")).mapInPandas(count, "pair long, n long")
    rows = counts.groupBy("pair").agg(F.sum("n").alias("n")).collect()  # N_SYMBOLS ** 2 rows
    table = np.ones(N_SYMBOLS**2)
    for row in rows:
        table[row["pair"]] += row["n"]
    table = table.reshape(N_SYMBOLS, N_SYMBOLS)
    return -np.log(table / table.sum(axis=1, keepdims=True)).ravel()


@cache
def dictionary(path: str) -> frozenset[str]:
    """Entries of four letters and more of a public vocabulary file."""
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    return frozenset(e.lstrip("Ġ").lower() for e in entries if len(e.lstrip("Ġ")) >= 4 and e.lstrip("Ġ").isalpha())


def covered(candidate: str, entries: frozenset[str], longest: int = 12) -> float:
    """Share of the characters that dictionary entries cover, longest first from the left."""
    text, at, total = candidate.lower(), 0, 0
    while at < len(text):
        size = next((n for n in range(min(longest, len(text) - at), 3, -1) if text[at : at + n] in entries), 0)
        total += size
        at += size or 1
    return total / len(text)


def _bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word.lower()) % BUCKETS


def candidates_in(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the candidates of a text, in order: values after key words, and long runs beside them."""
    values = [m.span(m.lastindex) for m in VALUE.finditer(text)]
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    at = 0
    for start, end in runs:
        while at < len(values) and values[at][1] <= start:
            yield values[at]
            at += 1
        if at == len(values) or end <= values[at][0]:
            yield start, end
    yield from values[at:]


def features(candidate: str, before: str, after: str, path: str, costs: np.ndarray, entries: frozenset[str]) -> list[float]:
    """What the forest sees. The words that rules make labels from are not among the neighbouring words, nor is the
    mark of an assignment, so that the forest has to learn from the candidate what a secret looks like.
    """
    counts = Counter(candidate)
    entropy = -sum(n / len(candidate) * math.log2(n / len(candidate)) for n in counts.values())
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in candidate]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    steps = costs[_pairs(candidate)]
    out = [len(candidate), entropy, changes / len(candidate), float(steps.mean()), float(steps.max())]
    out += [kinds.count(k) / len(candidate) for k in "duls"]
    out.append(covered(candidate, entries))
    told = {*KEY_WORDS, *PLAIN_WORDS, "key", "access", "api"}
    words = [([w for w in _WORD.findall(before) if w.lower() not in told] or [""])[-1], (_WORD.findall(after) or [""])[0]]
    for word in (*words, path):
        row = [0.0] * BUCKETS
        row[_bucket(word)] = 1.0
        out += row
    return out


FINDING = T.ArrayType(
    T.StructType()
    .add("start", T.LongType())
    .add("end", T.LongType())
    .add("sha256", T.StringType())
    .add("label", T.IntegerType())
    .add("features", T.ArrayType(T.DoubleType()))
)


def sure_label(candidate: str, before: str) -> int | None:
    """1 and 0 where a rule is sure: assigned to a key word; only digits or only letters, or a digest or identifier
    that is called one, and not assigned to a key word."""
    if _ASSIGNED.search(before):
        return 1
    if candidate.isdigit() or candidate.isalpha() or _DIGEST.match(candidate) and _PLAIN.search(before):
        return 0
    return None


def find_candidates(
    docs: DataFrame, vocabulary: str, costs: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """doc_id, start, end, sha256, label (1, 0 or NULL: not sure), features: a row per candidate."""
    import hashlib

    table = docs.sparkSession.sparkContext.broadcast(costs)  # N_SYMBOLS ** 2 numbers

    @F.pandas_udf(FINDING)
    def found(texts: pd.Series, paths: pd.Series) -> pd.Series:
        entries, out = dictionary(vocabulary), []
        for text, path in zip(texts, paths, strict=True):
            rows = []
            for start, end in candidates_in(text):
                found, before, after = text[start:end], text[max(0, start - NEAR) : start], text[end : end + NEAR]
                digest = hashlib.sha256(found.encode()).hexdigest()
                values = features(found, before, after, path, table.value, entries)
                rows.append((start, end, digest, sure_label(found, before), values))
            out.append(rows)
        return pd.Series(out, dtype=object)

    path = F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")) if path_col in docs.columns else F.lit("")
    held = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.explode(found(whole_text(f"`{text_col}`"), path)).alias("f"))
    return held.select("doc_id", "f.*")


def train(labelled: DataFrame, *, sample: int = SAMPLE, trees: int = 30, depth: int = 8, seed: int = 5) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (label, sha256, start, features): of each label at most ``sample``,
    those of the smallest hash. None if a label is missing."""
    order = F.xxhash64(F.lit(seed), "sha256", "doc_id", "start")
    sides = [labelled.where(F.col("label") == n).orderBy(order, "doc_id", "start").limit(sample) for n in (0, 1)]
    # At most 2 * sample rows; in one part and in order, so that the forest is the same each time.
    rows = sides[0].unionByName(sides[1]).coalesce(1).sortWithinPartitions(order, "doc_id", "start")
    rows = landed(rows.select(F.col("label").cast("double"), "features"), "sample")
    if rows.select("label").distinct().count() < 2:
        return None
    vectors = rows.select("label", array_to_vector("features").alias("features"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(vectors)


def score(candidates: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``candidates`` with ``score``, the forest's probability of a secret (1 without a forest)."""
    if model is None:
        return candidates.withColumn("score", F.lit(1.0))
    vectors = candidates.withColumn("features", array_to_vector("features"))
    scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*candidates.columns, "score").withColumn("features", vector_to_array("features"))


def find_secrets(
    docs: DataFrame, vocabulary: str, *, labelled: DataFrame | None = None, threshold: float = 0.5, **columns: str
) -> DataFrame:
    """doc_id, start, end, sha256, score: the candidates the forest takes for secrets.

    ``labelled``: findings with features and label; without it, the candidates that :func:`sure_label` is
    sure of. Offsets count code points; the secret itself is not put out. NULL and empty texts have no
    candidates, a NULL id or path stays NULL or counts as an empty path, repeated rows give one result, an
    empty table gives an empty one. If no labelled finding of one kind exists, all candidates stay.
    """
    costs = transition_costs(docs, columns.get("text_col", "text"))
    candidates = landed(find_candidates(docs, vocabulary, costs, **columns), "candidates")
    model = train(candidates if labelled is None else labelled)
    kept: Column = F.col("score") >= threshold
    return score(candidates, model).where(kept).select("doc_id", "start", "end", "sha256", F.round("score", 6).alias("score")).distinct()
