"""From raw documents to a mix: rules, repeated lines, near copies, benchmark leaks, source weights.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of ``documents``; the last one adds size, source_size, target, taken and draws (the
shards and turns a document goes to; ``siltgauge.llm.mixing.write_shards`` writes them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltgauge.llm import decontaminate, jaccard, lines, mixing, quality
from siltgauge.llm.common import landed, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break the base rules, or any rule on a rejected host, go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines one stays; a document that has none left goes."""
    return lines.drop_repeated_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more, in any order, go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with how many of its words the mix takes, and where they go."""
    keep = tuple(c for c in docs.columns if c != "doc_id")
    return mixing.mix_sources(docs, keep=keep)[0]


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mix),
]

#: MinHash bands and hashed block draws are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
