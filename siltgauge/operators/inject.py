"""Seeded corruption of a share of a clean transaction table or stream.

The output keeps every row. Rows carry their JSON text, and the corrupted ones
the ground truth: ``anomaly_category`` and ``anomaly_detail``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import (
    ANOMALY_KINDS,
    BAD_PAYMENT_METHODS,
    BAD_PRICE_CENTS,
    BAD_PRODUCT,
    BAD_TAX_CENTS,
    EXTRA_FIELD,
    EXTRA_NUMBER,
    EXTRA_NUMBER_FIELD,
    EXTRA_VALUE,
    NULLABLE_FIELDS,
    REMOVABLE_FIELDS,
    RENAMES,
    REQUIRED_FIELDS,
)
from ..functions.draws import draw, draw_choice, draw_int, draw_money, draw_place
from .aggregates import anomaly_summary
from .records import json_record
from .sampling import check_fraction, picked_by_rate, picked_exactly
from .slots import with_slot
from .synth import check_count, generate_transactions
from .validate import kept

NEGATIVE_PRICE = "negative_price"
NUMERIC_DETAILS = tuple(f"invalid_numeric_negative_{part}" for part in ("price", "quantity", "tax"))
PRODUCT_DETAIL = f"invalid_enum_product_{BAD_PRODUCT}"
ADD_DETAIL = f"schema_add_{EXTRA_FIELD}"
TYPE_DETAILS = {
    "price": "schema_type_price_to_string",
    "quantity": "schema_type_quantity_to_string",
    "extra": "schema_type_extra",
}


def check_kind(kind: str) -> None:
    allowed = [*ANOMALY_KINDS, "all"]
    if kind not in allowed:
        raise ValueError(f"Invalid anomaly type '{kind}'. Allowed: {allowed}")


def _schema_detail(seed: int, key: Column, type_field: str) -> Column:
    renames = [f"schema_rename_{old}_to_{new}" for old, new in RENAMES]
    removals = [f"schema_remove_{field}" for field in REMOVABLE_FIELDS]
    change = draw(seed, "schema", key) % 4
    return (
        F.when(change == 0, draw_choice(seed, "rename", key, renames))
        .when(change == 1, F.lit(ADD_DETAIL))
        .when(change == 2, draw_choice(seed, "remove", key, removals))
        .otherwise(F.lit(TYPE_DETAILS[type_field]))
    )


def _enum_detail(seed: int, key: Column) -> Column:
    payments = [f"invalid_enum_payment_{method}" for method in BAD_PAYMENT_METHODS]
    return F.when(draw(seed, "enum", key) % 2 == 0, draw_choice(seed, "bad_payment", key, payments)).otherwise(
        F.lit(PRODUCT_DETAIL)
    )


def _details(seed: int, key: Column, category: Column, type_field: str) -> Column:
    nulls = [f"null_{field}" for field in NULLABLE_FIELDS]
    reused = F.concat(F.lit("duplicate_order_id_"), F.col("_reused").cast("string"))
    return (
        F.when(category == "null", draw_choice(seed, "null", key, nulls))
        .when(category == "schema", _schema_detail(seed, key, type_field))
        .when(category == "negative-price", F.lit(NEGATIVE_PRICE))
        .when(category == "invalid-numeric", draw_choice(seed, "numeric", key, NUMERIC_DETAILS))
        .when(category == "invalid-enum", _enum_detail(seed, key))
        .when(category == "duplicate-id", reused)
    )


def _corrupted_values(seed: int, key: Column) -> dict[str, Column]:
    """The eight fields after all corruptions that keep the record's shape."""
    category, detail = F.col("anomaly_category"), F.col("anomaly_detail")
    bad_payment = F.substring(detail, len("invalid_enum_payment_") + 1, 64)
    special = {
        "order_id": [(category == "duplicate-id", F.col("_reused"))],
        "product_id": [(detail == PRODUCT_DETAIL, F.lit(BAD_PRODUCT))],
        "payment_method": [(detail.startswith("invalid_enum_payment_"), bad_payment)],
        "price": [
            (detail.isin(NEGATIVE_PRICE, NUMERIC_DETAILS[0]), -draw_money(seed, "amount", key, BAD_PRICE_CENTS)),
        ],
        "quantity": [(detail == NUMERIC_DETAILS[1], -draw_int(seed, "amount", key, 1, 5).cast("int"))],
        "tax_amount": [(detail == NUMERIC_DETAILS[2], -draw_money(seed, "amount", key, BAD_TAX_CENTS, 14))],
    }
    values = {}
    for field in REQUIRED_FIELDS:
        branches = special.get(field, [])
        if field in NULLABLE_FIELDS:
            branches = [*branches, (detail == f"null_{field}", F.lit(None))]
        if not branches:
            continue
        chain = F.when(*branches[0])
        for condition, value in branches[1:]:
            chain = chain.when(condition, value)
        values[field] = chain.otherwise(F.col(field))
    return values


def _shaped_json() -> Column:
    """JSON text of the record in the shape its detail asks for."""
    detail = F.col("anomaly_detail")
    extra = F.lit(EXTRA_VALUE).alias(EXTRA_FIELD)
    number = F.lit(EXTRA_NUMBER).alias(EXTRA_NUMBER_FIELD)
    as_text = {
        name: [F.col(f).cast("string").alias(f) if f == name else F.col(f) for f in REQUIRED_FIELDS]
        for name in ("price", "quantity")
    }
    shapes = {
        ADD_DETAIL: [*REQUIRED_FIELDS, extra],
        TYPE_DETAILS["price"]: as_text["price"],
        TYPE_DETAILS["quantity"]: as_text["quantity"],
        TYPE_DETAILS["extra"]: [*REQUIRED_FIELDS, number],
    }
    for old, new in RENAMES:
        kept = [f for f in REQUIRED_FIELDS if f != old]
        shapes[f"schema_rename_{old}_to_{new}"] = [*kept, F.col(old).alias(new)]
    for field in REMOVABLE_FIELDS:
        shapes[f"schema_remove_{field}"] = [f for f in REQUIRED_FIELDS if f != field]
    plain = json_record(*REQUIRED_FIELDS)
    chain = None
    for name, fields in shapes.items():
        branch = (detail == name, json_record(*fields))
        chain = F.when(*branch) if chain is None else chain.when(*branch)
    # most rows have no shape change: they leave at the first test
    return F.when(F.col("anomaly_category") == "schema", chain).otherwise(plain)


def _reused_from_index(rows: DataFrame, key: str) -> DataFrame:
    """Add the id at the drawn earlier slot for tables whose ids follow no formula."""
    ids = rows.select(F.col("_slot").alias("_target"), F.col("order_id").alias("_found"))
    wanted = rows.where(F.col("_target").isNotNull()).select(F.col(key), "_target").join(ids, "_target", "left")
    numeric = dict(rows.dtypes)["order_id"] in ("int", "bigint")
    before_first = F.col("order_id") - F.lit(1) if numeric else F.concat("order_id", F.lit("-1"))
    found = wanted.select(key, F.struct("_found").alias("_hit"))
    return rows.join(found, key, "left").withColumn(
        "_reused", F.when(F.col("_hit").isNotNull(), F.coalesce("_hit._found", before_first))
    )


def inject(
    df: DataFrame,
    kind: str = "all",
    rate: float = 0.05,
    count: int | None = None,
    seed: int = 0,
    key: str = "event_id",
    slot: Column | None = None,
    id_at: Callable[[Column], Column] | None = None,
    type_field: str = "price",
    value: str = "value",
    metrics: str | None = None,
) -> DataFrame:
    """Corrupt a share of a transaction frame.

    ``kind`` is one of the six categories or ``all``; ``count`` picks exactly that many
    rows and overrides ``rate``. ``key`` is a unique row key.

    A duplicate id repeats the id of a uniformly drawn earlier row. With ``slot`` (dense
    row position) and ``id_at`` (id of a position) that is arithmetic on the row itself,
    in batch and stream. Without them positions are counted and looked up, batch only.

    Filters on the caller's columns reach the scan, filters on the new ones stay above. With a name for
    ``metrics`` the run reports rows and corrupted rows under it; then none reaches the scan.
    """
    check_kind(kind)
    check_fraction(rate)
    if type_field not in TYPE_DETAILS:
        raise ValueError(f"type_field must be one of {list(TYPE_DETAILS)}.")
    others = [c for c in df.columns if c not in REQUIRED_FIELDS]
    row_key = F.col(key)

    picked = picked_by_rate(rate, seed, row_key) if count is None else picked_exactly(df, count, seed, key)
    category = draw_choice(seed, "type", row_key, ANOMALY_KINDS) if kind == "all" else F.lit(kind)
    needs_ids = kind in ("all", "duplicate-id")
    indexed = needs_ids and (slot is None or id_at is None)
    if indexed and df.isStreaming:
        raise ValueError("Duplicate ids on a stream need slot and id_at.")

    rows = with_slot(df, key, "_slot") if indexed else df
    rows = rows.withColumn("anomaly_category", F.when(picked, category))
    if needs_ids:
        place = F.col("_slot") if indexed else slot
        drawn = F.when(place > 0, draw_place(seed, "slot", row_key, F.greatest(place, F.lit(1)))).otherwise(F.lit(-1))
        rows = rows.withColumn("_target", F.when(F.col("anomaly_category") == "duplicate-id", drawn))
        if indexed:
            rows = _reused_from_index(rows, key)
        else:
            rows = rows.withColumn("_reused", F.when(F.col("_target").isNotNull(), id_at(F.col("_target"))))
    else:
        rows = rows.withColumn("_reused", F.lit(None).cast(dict(df.dtypes)["order_id"]))

    rows = rows.withColumn("anomaly_detail", _details(seed, row_key, F.col("anomaly_category"), type_field))
    rows = rows.withColumns(_corrupted_values(seed, row_key))
    made = {value: _shaped_json(), **{c: F.col(c) for c in ("anomaly_category", "anomaly_detail")}}
    shaped = kept(rows, made).select(*[c for c in others if c not in made], *made)
    if metrics is None:
        return shaped
    return shaped.observe(metrics, F.count(F.lit(1)).alias("rows"), F.count("anomaly_category").alias("anomalous_rows"))


def generate_anomalous_transactions(
    spark: SparkSession,
    count: int,
    anomaly_type: str,
    anomaly_rate: float = 0.05,
    anomaly_count: int | None = None,
    seed: int = 0,
    start_order_id: int = 10001,
) -> tuple[DataFrame, DataFrame]:
    """Synthesise ``count`` transactions, corrupt a share, and summarise: (records, one-row summary)."""
    check_count(count)
    check_kind(anomaly_type)
    check_fraction(anomaly_rate)
    if anomaly_count is not None and (anomaly_count < 0 or anomaly_count > count):
        raise ValueError("Anomaly count must be between 0 and total count.")
    clean = generate_transactions(spark, count, start_order_id=start_order_id, seed=seed)
    clean = clean.withColumn("row_key", F.col("order_id"))
    records = inject(
        clean,
        anomaly_type,
        anomaly_rate,
        anomaly_count,
        seed,
        key="row_key",
        slot=F.col("row_key") - F.lit(start_order_id),
        id_at=lambda position: position + F.lit(start_order_id),
    )
    return records, anomaly_summary(records, anomaly_type, seed)
