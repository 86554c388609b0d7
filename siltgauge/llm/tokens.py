"""Token counts with a shortcut for whole tokens."""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import whole_text

#: The split of byte-level BPE into pre-tokens; a fixed value of this kind of vocabulary.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Distinct merged pre-tokens a worker remembers.
MEMORY = 200_000


@cache
def settled() -> frozenset[str]:
    """Code points whose class no Unicode version changes: those that are in Unicode 3.2 already.

    A text with any other one goes through the library as it is, so that its own tables decide.
    """
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.ucd_3_2_0.category(c) != "Cn")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + n) for n, b in enumerate(others)}


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven to be one pre-token that the merges bring to one token.

    A proof is one run of the model on the string by itself. Merges never cross the border of a
    pre-token, so what holds for the string alone holds wherever it is a pre-token.
    """
    tokenizer = Tokenizer.from_file(path)
    byte_of = {letter: b for b, letter in byte_letters().items()}
    proven = set()
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(byte_of[letter] for letter in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if not settled().issuperset(text) or len(PRE_TOKEN.findall(text)) != 1:
            continue
        if len(tokenizer.model.tokenize(entry)) == 1:
            proven.add(text)
    return frozenset(proven)


def added_strings(path: str) -> list[str]:
    """Strings that the library takes out of a text as one token before it splits the rest."""
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


class _Counts(dict):
    """Tokens of a pre-token: one for proven ones, else what the merges leave."""

    def __init__(self, tokenizer: Tokenizer, proven: frozenset[str]) -> None:
        super().__init__(dict.fromkeys(proven, 1))
        self.letters, self.model, self.limit = byte_letters(), tokenizer.model, len(proven) + MEMORY

    def __missing__(self, pre_token: str) -> int:
        mapped = "".join(map(self.letters.__getitem__, pre_token.encode()))
        count = len(self.model.tokenize(mapped))
        if len(self) < self.limit and len(pre_token) < 64:
            self[pre_token] = count
        return count


def token_counter(path: str, proven: frozenset[str]):
    """A function from a text to its number of tokens as the library counts them."""
    tokenizer = Tokenizer.from_file(path)
    counts = _Counts(tokenizer, proven)
    added, known = added_strings(path), settled()
    cut = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

    def count(text: str) -> int:
        if not text.isascii() and not known.issuperset(text):
            return len(tokenizer.encode(text, add_special_tokens=False).ids)
        pieces = cut.split(text) if cut and any(a in text for a in added) else [text]
        return len(pieces) - 1 + sum(sum(map(counts.__getitem__, PRE_TOKEN.findall(p))) for p in pieces)

    return count


def count_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit and n_whole_vocabulary.

    ``path`` is a byte-level BPE file of the tokenizers library, found under the same path on every
    machine. A NULL text counts as empty (0 bytes, 0 tokens), a NULL id stays NULL, repeated rows
    give repeated results, an empty table an empty one. Texts are never cut. Other columns are not
    carried over, so their names do not matter. The proven strings are shipped to the workers;
    there are never more than entries in the vocabulary.
    """
    spark = docs.sparkSession
    proven = spark.sparkContext.broadcast(whole_tokens(path))

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = token_counter(path, proven.value)
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    text = whole_text(text_col)
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
