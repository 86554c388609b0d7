"""Checks one record cannot show on its own: domains, extra fields, drift, null rates, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import PAYMENT_RULE, PRODUCT_RULE, REQUIRED_FIELDS
from .lookup import left_join_skewed
from .validate import RECORD, aside, field_kind, kept, parse_record


def with_text_fields(df: DataFrame, names: Sequence[str], value: str = "value", integers: Sequence[str] = ()) -> DataFrame:
    """Add string fields of the records as columns; NULL where the field is no string.

    Of the fields in ``integers``, whole numbers are taken instead, as decimal(38,0): ids of the integer kind, of
    which 5 and "5" are not the same. One parse per record; filters on other columns reach the scan. Columns of
    the same names are replaced.
    """
    source, back = aside(df, (value,))
    found = [F.try_variant_get(F.col(RECORD), f"$.{n}", "variant").alias(f"_f_{n}") for n in names]
    looked_up = parse_record(source, value).select("*", *found)

    def read(name: str) -> Column:
        field = F.col(f"_f_{name}")
        kind = F.schema_of_variant(field)
        if name not in integers:
            return F.when(kind == "STRING", F.try_variant_get(field, "$", "string"))
        whole = F.when((kind == "BIGINT") | kind.startswith("DECIMAL"), F.try_variant_get(field, "$", "decimal(38,0)"))
        return F.when(json_class(kind) == "integer", whole)

    helpers = (RECORD, *[f"_f_{n}" for n in names])
    return kept(looked_up, {n: read(n) for n in names}, helpers).withColumnsRenamed(back)


# --- product domain ---------------------------------------------------------


def product_errors(df: DataFrame, allowed: Sequence[str], product: str = "product_id") -> DataFrame:
    """Rows whose product id is not in a short fixed list, with the message."""
    message = F.concat(F.lit(f"{PRODUCT_RULE}: "), F.col(product))
    return df.where(~F.col(product).isin(*allowed)).withColumn("error", message)


def product_errors_by_catalogue(
    df: DataFrame, catalogue: DataFrame, product: str = "product_id", key: str = "event_id"
) -> DataFrame:
    """The same against a catalogue table of any size; ``key`` is a unique column of the rows."""
    known = catalogue.select(product).where(F.col(product).isNotNull()).distinct().withColumn("_known", F.lit(True))
    checked = left_join_skewed(df, known, [product], [key])
    message = F.concat(F.lit(f"{PRODUCT_RULE}: "), F.col(product))
    unknown = F.col("_known").isNull() & F.col(product).isNotNull()
    return checked.where(unknown).drop("_known").withColumn("error", message)


# --- shape of the records ---------------------------------------------------


def unexpected_fields(value: str = "value") -> Column:
    """Field names of a record that the contract does not know; NULL for malformed text."""
    return F.array_except(F.json_object_keys(F.col(value)), F.array(*[F.lit(f) for f in REQUIRED_FIELDS]))


def json_class(kind: Column) -> Column:
    """JSON type class of a variant type name, without precision or inner types."""
    return (
        F.when(kind == "VOID", F.lit("null"))
        .when(kind == "STRING", F.lit("string"))
        .when(kind == "BOOLEAN", F.lit("boolean"))
        .when((kind == "BIGINT") | F.rlike(kind, F.lit(r"^DECIMAL\((?:19|[23]\d),0\)$")), F.lit("integer"))
        .when(kind.startswith("ARRAY"), F.lit("array"))
        .when(kind.startswith("OBJECT"), F.lit("object"))
        .otherwise(F.lit("float"))
    )


def observed_types(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per record and field: ``field``, ``type``. Parses once; batch and stream."""
    fields = F.col(RECORD).try_cast("map<string,variant>")
    others = [F.col(c) for c in df.columns if c != value]
    exploded = parse_record(df, value).select(*others, F.explode(fields).alias("field", "_value"))
    return exploded.select(*others, "field", json_class(F.schema_of_variant("_value")).alias("type"))


def schema_drift(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Records per observed field and type; a new field or a second type is drift."""
    types = observed_types(df.select(value, *by), value)
    return types.groupBy(*by, "field", "type").agg(F.count(F.lit(1)).alias("n"))


def field_gaps(df: DataFrame, *by: Column | str, value: str = "value") -> DataFrame:
    """One row per ``by``: n_records, and missing_ and null_ counts of every required field. One pass over
    the records of a table or stream."""
    source, back = aside(df, (value,))
    parsed = parse_record(source, value)
    away = {old: new for new, old in back.items()}
    keys = parsed.select(*[away.get(b, b) if isinstance(b, str) else b for b in by]).columns
    kinds = F.struct(F.col(RECORD).isNotNull().alias("whole"), *[field_kind(f).alias(f"of_{f}") for f in REQUIRED_FIELDS])
    found = parsed.select(*[away.get(b, b) if isinstance(b, str) else b for b in by], kinds.alias(RECORD))
    kind = {f: F.col(f"{RECORD}.of_{f}") for f in REQUIRED_FIELDS}
    whole = F.col(f"{RECORD}.whole")
    counted = found.groupBy(*[f"`{k}`" for k in keys]).agg(
        F.count_if(whole).alias("n_records"),
        *[F.count_if(whole & kind[f].isNull()).alias(f"missing_{f}") for f in REQUIRED_FIELDS],
        *[F.count_if(kind[f] == "VOID").alias(f"null_{f}") for f in REQUIRED_FIELDS],
    )
    return counted.withColumnsRenamed(back)


def gap_lines(gaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counts of ``field_gaps`` as one row per field with rates in percent; NULL rates for no records."""
    names = [F.struct(F.lit(f).alias("field"), F.col(f"missing_{f}").alias("n_missing"), F.col(f"null_{f}").alias("n_null")) for f in REQUIRED_FIELDS]
    long = gaps.select(*by, "n_records", F.explode(F.array(*names)).alias("line")).select(*by, "line.*", "n_records")
    return long.withColumns(
        {
            "missing_pct": F.try_divide(F.col("n_missing") * F.lit(100.0), F.col("n_records")),
            "null_pct": F.try_divide(F.col("n_null") * F.lit(100.0), F.col("n_records")),
        }
    )


def null_profile(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """NULL and missing counts and rates per required field, and per ``by``."""
    return gap_lines(field_gaps(df.select(value, *by), *by, value=value), by)


# --- errors and scores ------------------------------------------------------


def rule_of(error: Column) -> Column:
    """The rule behind a message: messages that quote a value lose it."""
    quoted = error.startswith(f"{PAYMENT_RULE}: ") | error.startswith(f"{PRODUCT_RULE}: ")
    return F.when(quoted, F.substring_index(error, ": ", 1)).otherwise(error)


def errors_by_rule(validated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    exploded = validated.select(*by, F.explode("errors").alias("error"))
    return exploded.groupBy(*by, rule_of(F.col("error")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def detection_matrix(
    checked: DataFrame, category: str = "anomaly_category", detectors: Sequence[str] = ("by_rules",)
) -> DataFrame:
    """Rows per injected category and how many of them each boolean detector column found."""
    found_any = F.greatest(*[F.col(d).cast("int") for d in detectors]) if len(detectors) > 1 else F.col(
        detectors[0]
    ).cast("int")
    return (
        checked.groupBy(category)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col(d)).alias(d) for d in detectors],
            F.count_if(found_any == 1).alias("detected"),
        )
        .withColumn("detected_pct", F.col("detected") * F.lit(100.0) / F.col("n"))
    )
