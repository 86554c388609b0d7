"""Text predicates and renderings that follow Python's rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything outside this class is what Python's str.strip() would keep.
_VISIBLE = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_blank(text: Column) -> Column:
    """True for text of which ``str.strip()`` leaves nothing."""
    return ~F.rlike(text, F.lit(_VISIBLE))


def python_float(value: Column) -> Column:
    """Render a DOUBLE the way Python prints it."""
    shown = value.cast("string")  # "12.5" or "1.25E-7"
    mantissa = F.regexp_replace(F.regexp_extract(shown, r"^(-?[\d.]+)", 1), r"\.0$", "")
    exponent = F.regexp_extract(shown, r"E(-?\d+)$", 1).try_cast("int")
    digits = F.abs(exponent).cast("string")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits),
    )
    plain = F.regexp_replace(value.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1")
    size = F.abs(value)
    return (
        F.when(value == 0, F.when(shown.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
