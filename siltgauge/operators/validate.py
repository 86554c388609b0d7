"""Record validation: one JSON text per row in, verdict and ordered error list out."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import MALFORMED, PAYMENT_RULE, PRODUCT_RULE, REQUIRED_FIELDS, TYPED_SCHEMA, RuleSet
from ..functions.iso8601 import iso8601_timestamp, is_iso8601
from ..functions.text import is_blank, python_float

RECORD = "_record"
_TEXTS = ("order_id", "customer_id", "product_id", "payment_method", "timestamp")
_NUMBERS = ("quantity", "price", "tax_amount")


def _kind(name: str) -> Column:
    """Observed JSON type of a field: NULL when absent, ``VOID`` for a JSON null."""
    return F.col(f"_k_{name}")


def _scalar(name: str) -> Column:
    """The field as text or as DOUBLE; only meaningful together with its kind."""
    return F.col(f"_v_{name}")


def parse_record(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse each text once into a VARIANT; NULL for text that is no JSON value."""
    return df.withColumn(RECORD, F.try_parse_json(F.col(value)))


def field_kind(name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.col(RECORD), f"$.{name}", "variant"))


def with_fields(df: DataFrame, typed: tuple[str, ...] = ()) -> DataFrame:
    """Replace the parsed record by one type column and one plain value column per field.

    The lookups and their readings are two projections, so each lookup stays single.
    Only short scalars leave them: every VARIANT carries a copy of the record's keys.
    """
    record = F.col(RECORD)
    found = [F.try_variant_get(record, f"$.{f}", "variant").alias(f"_f_{f}") for f in REQUIRED_FIELDS]
    looked_up = df.select("*", record.isNull().alias("_broken"), *found)
    columns = [F.schema_of_variant(F.col(f"_f_{f}")).alias(f"_k_{f}") for f in REQUIRED_FIELDS]
    columns += [F.try_variant_get(F.col(f"_f_{f}"), "$", "string").alias(f"_v_{f}") for f in _TEXTS]
    columns += [F.try_variant_get(F.col(f"_f_{f}"), "$", "double").alias(f"_v_{f}") for f in _NUMBERS]
    if typed:
        columns.append(F.struct(*typed_columns(typed)).alias("record"))
    return looked_up.select("*", *columns).drop(RECORD, *[f"_f_{f}" for f in REQUIRED_FIELDS])


#: columns that ``with_fields`` adds besides ``record``
_HELPERS = ("_broken", *[f"_k_{f}" for f in REQUIRED_FIELDS], *[f"_v_{f}" for f in (*_TEXTS, *_NUMBERS)])


def without_fields(df: DataFrame) -> DataFrame:
    return df.drop(*_HELPERS)


def kept(df: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``columns``, each worked out once per row.

    They pass through a generator, one row for a row: the optimizer leaves filters on them above it, and takes
    filters on all other columns, and the choice of columns, below.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in drop and c not in columns]
    held = df.select(*others, F.struct(*[c.alias(n) for n, c in columns.items()]).alias(_KEPT))
    return held.select(*others, F.inline(F.array(_KEPT)).alias(*columns))


_KEPT = "_kept"
#: names that stand for something else while records are read
_TAKEN = {RECORD, _KEPT, *_HELPERS, *[f"_f_{f}" for f in REQUIRED_FIELDS]}


def aside(df: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the caller's columns of taken names renamed, and what brings their names back."""
    clashing = [c for c in df.columns if c in _TAKEN and c not in keep]
    away = {c: f"_caller_{n}{'_' * max(map(len, df.columns))}" for n, c in enumerate(clashing)}
    return (df.withColumnsRenamed(away) if away else df), {new: old for old, new in away.items()}


def _is_string(name: str) -> Column:
    return _kind(name) == "STRING"


def _is_number(name: str) -> Column:
    return _kind(name).isin("BIGINT", "DOUBLE", "FLOAT") | _kind(name).startswith("DECIMAL")


def _literal(name: str, value: str) -> Column:
    """The field as it stands in the text. Parses again, so it is kept for rare cases."""
    return F.get_json_object(F.col(value), f"$.{name}")


def _is_integer(name: str, value: str) -> Column:
    # Integers beyond 64 bit arrive as DECIMAL(p,0) or DOUBLE; the literal text tells them from floats.
    wide = F.rlike(_kind(name), F.lit(r"^DECIMAL\((?:19|[23]\d),0\)$")) | (_kind(name) == "DOUBLE")
    return (_kind(name) == "BIGINT") | (wide & ~F.rlike(_literal(name, value), F.lit("[.eE]")))


def _shown(name: str, value: str) -> Column:
    """A JSON value as Python would print it; arrays and objects as JSON."""
    return (
        F.when(_kind(name).isin("STRING", "BIGINT"), _scalar(name))
        .when(_kind(name) == "VOID", F.lit("None"))
        .when(_kind(name) == "BOOLEAN", F.initcap(_scalar(name)))
        .when(_is_integer(name, value), _literal(name, value))
        .when(_is_number(name), python_float(_literal(name, value).try_cast("double")))
        .otherwise(_scalar(name))
    )


def _text_rules(name: str) -> list[tuple[Column, Column]]:
    return [
        (~_is_string(name), F.lit(f"{name} must be a string")),
        (_is_string(name) & is_blank(_scalar(name)), F.lit(f"{name} cannot be empty")),
    ]


def _amount_rules(name: str) -> list[tuple[Column, Column]]:
    return [
        (~_is_number(name), F.lit(f"{name} must be a number")),
        (_is_number(name) & (_scalar(name) < 0), F.lit(f"{name} cannot be negative")),
    ]


def _rules(rules: RuleSet, value: str) -> list[tuple[Column, Column]]:
    """(condition, message) pairs of a record that has all fields, in report order."""
    checks = [(_kind(f) == "VOID", F.lit(f"NULL value is not allowed: {f}")) for f in REQUIRED_FIELDS]
    if rules.order_id_type == "string":
        checks += _text_rules("order_id")
    else:
        checks.append((~_is_integer("order_id", value), F.lit("order_id must be an integer")))
    checks += _text_rules("customer_id")
    checks += _text_rules("product_id")
    if rules.products is not None:
        known = _is_string("product_id") & _scalar("product_id").isin(*rules.products)
        checks.append((~known, F.concat(F.lit(f"{PRODUCT_RULE}: "), _shown("product_id", value))))
    whole = _is_integer("quantity", value)
    checks += [
        (~whole, F.lit("quantity must be an integer")),
        (whole & (_scalar("quantity") <= 0), F.lit("quantity must be greater than 0")),
    ]
    checks += _amount_rules("price")
    checks += _amount_rules("tax_amount")
    accepted = _is_string("payment_method") & _scalar("payment_method").isin(*rules.payment_methods)
    checks.append((~accepted, F.concat(F.lit(f"{PAYMENT_RULE}: "), _shown("payment_method", value))))
    checks += [
        (~_is_string("timestamp"), F.lit("timestamp must be a string")),
        (
            _is_string("timestamp") & ~is_iso8601(_scalar("timestamp")),
            F.lit("timestamp must be a valid ISO 8601 datetime"),
        ),
    ]
    return checks


def _collect(checks: list[tuple[Column, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(condition, message) for condition, message in checks]))


@lru_cache(maxsize=32)
def error_list(rules: RuleSet, value: str = "value") -> Column:
    """Ordered errors of a frame made by ``with_fields``.

    ``array_compact`` is evaluated outside whole-stage code generation, and that is wanted: as
    one generated function these rules exceed what the JVM compiles and ran four times slower.
    """
    missing = [(_kind(f).isNull(), F.lit(f"Missing required field: {f}")) for f in REQUIRED_FIELDS]
    incomplete = missing[0][0]
    for absent, _ in missing[1:]:
        incomplete = incomplete | absent
    return (
        F.when(F.col("_broken"), F.array(F.lit(MALFORMED)))
        .when(incomplete, _collect(missing))
        .otherwise(_collect(_rules(rules, value)))
    )


def typed_columns(names: tuple[str, ...] = REQUIRED_FIELDS) -> list[Column]:
    """Typed transaction columns from the looked-up fields, and ``unfit``.

    A value is never rounded: a number that its type cannot hold exactly is NULL, and ``unfit``
    lists the fields with a number that is not there. Their rows keep their text only.
    """
    columns, unfit = [], []
    for field in (TYPED_SCHEMA[name] for name in names):
        found = F.col(f"_f_{field.name}")
        if field.name == "timestamp":
            columns.append(iso8601_timestamp(F.try_variant_get(found, "$", "string")).alias(field.name))
            continue
        typed = F.try_variant_get(found, "$", field.dataType.simpleString())
        if field.name in _NUMBERS:
            kind = F.schema_of_variant(found)
            number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
            # a DOUBLE is compared as such, any other number by all of its digits
            same = F.when(kind.isin("DOUBLE", "FLOAT"), typed.cast("double") == F.try_variant_get(found, "$", "double"))
            same = same.otherwise(typed == F.try_variant_get(found, "$", "decimal(38,6)"))
            if field.name == "quantity":
                same = F.when(kind.isin("DOUBLE", "FLOAT"), same).otherwise(typed.isNotNull())
            typed = F.when(F.coalesce(same, F.lit(False)), typed)
            unfit.append(F.when(number & typed.isNull(), F.lit(field.name)))
        columns.append(typed.alias(field.name))
    if unfit:
        columns.append(F.array_compact(F.array(*unfit)).alias("unfit"))
    return columns


def validate(
    df: DataFrame,
    rules: RuleSet = RuleSet(),
    value: str = "value",
    typed: tuple[str, ...] = (),
    metrics: str | None = None,
    parsed: str | None = None,
) -> DataFrame:
    """Add ``is_valid`` and ``errors`` to a frame (batch or stream) with one JSON record per row.

    ``typed`` names fields to be returned with their proper types in a struct column ``record``.
    ``parsed`` names a VARIANT column that holds the record already; it is dropped.

    Filters on the caller's columns reach the scan, filters on the new ones stay above the parse. Columns of the
    caller stay, but for ``errors``, ``is_valid`` and, with ``typed``, ``record``, which are replaced. With a
    name for ``metrics`` the run reports rows and valid rows under it; it then counts rows before any filter,
    so none reaches the scan.
    """
    source, back = aside(df, (value, parsed))
    source = source.withColumnRenamed(parsed, RECORD) if parsed is not None else parse_record(source, value)
    found = with_fields(source.drop("errors", "is_valid", *(["record"] if typed else [])), typed)
    columns = {"record": F.col("record")} if typed else {}
    checked = kept(found, {**columns, "errors": error_list(rules, value)}, _HELPERS).withColumnsRenamed(back)
    checked = checked.withColumn("is_valid", F.size("errors") == 0)
    if metrics is None:
        return checked
    return checked.observe(metrics, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_valid")).alias("valid_rows"))


def reject_unfit(checked: DataFrame) -> DataFrame:
    """Rows of ``validate`` with typed fields, of which those with a value outside its type are invalid, too: their
    errors say so, and no typed table loses a value without a trace."""
    said = F.transform("record.unfit", lambda f: F.concat(F.lit("Value does not fit its type: "), f))
    checked = checked.withColumn("errors", F.concat("errors", F.when(F.col("is_valid"), said).otherwise(F.array())))
    return checked.withColumn("is_valid", F.size("errors") == 0)
