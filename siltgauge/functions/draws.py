"""Seeded draws that depend on the row key only.

``rand(seed)`` depends on partitioning and task order. A draw here is a hash of
(seed, salt, key): the same row gets the same value on any cluster, in batch and
in a stream, and after a task is recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 2**32


def draw(seed: int, salt: str, key: Column) -> Column:
    """Uniform BIGINT in [0, 2**32) for this seed, purpose and row key."""
    text = F.concat(F.lit(f"{seed}:{salt}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def draw_place(seed: int, salt: str, key: Column, places: Column) -> Column:
    """Uniform BIGINT in [0, places); 60 bits, so that every place of a table can be drawn."""
    text = F.concat(F.lit(f"{seed}:{salt}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % places


def draw_int(seed: int, salt: str, key: Column, low: int, high: int) -> Column:
    """Uniform BIGINT in [low, high]."""
    return F.lit(low) + draw(seed, salt, key) % F.lit(high - low + 1)


def draw_choice(seed: int, salt: str, key: Column, options: Sequence[str]) -> Column:
    """Uniform choice from a fixed list."""
    position = (draw(seed, salt, key) % F.lit(len(options)) + F.lit(1)).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), position)


def draw_money(seed: int, salt: str, key: Column, cents: tuple[int, int], precision: int = 12) -> Column:
    """Uniform DECIMAL(precision, 2) amount between two bounds given in cents."""
    whole = draw_int(seed, salt, key, *cents).cast("decimal(10,0)")
    return (whole * F.lit("0.01").cast("decimal(3,2)")).cast(f"decimal({precision},2)")
