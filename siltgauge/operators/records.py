"""JSON text of transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import REQUIRED_FIELDS

# Without this option a NULL field would be dropped and read back as a missing one.
KEEP_NULLS = {"ignoreNullFields": "false"}


def json_record(*fields: Column | str) -> Column:
    return F.to_json(F.struct(*fields), KEEP_NULLS)


def emit_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Replace the eight transaction columns by one JSON text column; other columns stay."""
    others = [c for c in df.columns if c not in REQUIRED_FIELDS]
    return df.select(*others, json_record(*REQUIRED_FIELDS).alias(value))
