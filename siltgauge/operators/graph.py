"""Health along the graph of stages: what goes wrong in one stage impairs all that come after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import WARNING

_REACH = """
WITH RECURSIVE reach (stage, cause, path) AS (
    SELECT stage, stage, array(stage) FROM {failing}
    UNION ALL
    SELECT e.target, r.cause, array_append(r.path, e.target)
    FROM reach r JOIN {edges} e ON e.source = r.stage
    WHERE NOT array_contains(r.path, e.target)
)
SELECT DISTINCT stage, cause FROM reach
"""


def failing_stages(alerts: DataFrame, stage: str, time: str | None = None) -> DataFrame:
    """The stages whose newest alert is a warning, or that have one at all where there is no time (consumer lag)."""
    if time is None:
        return alerts.where(F.col("severity") == WARNING).select(F.col(stage).cast("string").alias("stage")).distinct()
    newest = alerts.groupBy(stage).agg(F.max_by("severity", time).alias("severity"))
    return newest.where(F.col("severity") == WARNING).select(F.col(stage).cast("string").alias("stage"))


def graph_health(failing: DataFrame, edges: DataFrame, stages: DataFrame) -> DataFrame:
    """stage, status, causes: ``failing`` for stages that fail themselves, ``impaired`` for those after one, else ``ok``.

    ``edges`` (source, target) is the graph of the stages in ``stages`` (stage). ``causes`` names the failing
    stages at or before a stage, in order. A recursive query follows the edges; a path that comes back to a
    stage ends there, so a cycle does no harm. The graph is a few stages, not data.
    """
    spark = failing.sparkSession
    reach = spark.sql(_REACH, failing=failing, edges=edges.select(F.col("source").cast("string").alias("source"), F.col("target").cast("string").alias("target")))
    causes = reach.groupBy("stage").agg(F.array_sort(F.collect_set("cause")).alias("causes"))
    known = stages.select(F.col("stage").cast("string").alias("stage")).distinct().join(causes, "stage", "left")
    causes = F.coalesce("causes", F.array().cast("array<string>"))
    status = F.when(F.array_contains(causes, F.col("stage")), "failing").when(F.size(causes) > 0, "impaired").otherwise("ok")
    return known.select("stage", status.alias("status"), causes.alias("causes"))
