import json

import pytest
from pyspark.sql import functions as F

from siltgauge.contract import ANOMALY_KINDS
from siltgauge.operators.checks import unexpected_fields
from siltgauge.operators.inject import generate_anomalous_transactions, inject
from siltgauge.operators.sampling import picked_exactly
from siltgauge.operators.slots import with_slot
from siltgauge.operators.synth import (
    generate_transaction_batches,
    generate_transactions,
    with_batch_id,
)
from siltgauge.operators.validate import validate
from siltgauge.plans import fixtures as fx

BAD_TYPE = {
    "customer_id": "must be a string",
    "product_id": "must be a string",
    "quantity": "must be an integer",
    "price": "must be a number",
    "tax_amount": "must be a number",
    "timestamp": "must be a string",
}


def expected(detail):
    """Complete error list that an injected detail must cause."""
    if detail is None or detail.startswith(("duplicate_order_id_", "invalid_enum_product_", "schema_add_")):
        return []
    if detail == "null_payment_method":
        return ["NULL value is not allowed: payment_method", "Invalid payment_method: None"]
    if detail.startswith("null_"):
        field = detail.removeprefix("null_")
        return [f"NULL value is not allowed: {field}", f"{field} {BAD_TYPE[field]}"]
    if detail.startswith("schema_rename_"):
        return [f"Missing required field: {detail.removeprefix('schema_rename_').split('_to_')[0]}"]
    if detail.startswith("schema_remove_"):
        return [f"Missing required field: {detail.removeprefix('schema_remove_')}"]
    if detail.startswith("invalid_enum_payment_"):
        return [f"Invalid payment_method: {detail.removeprefix('invalid_enum_payment_')}"]
    return {
        "schema_type_price_to_string": ["price must be a number"],
        "schema_type_quantity_to_string": ["quantity must be an integer"],
        "schema_type_extra": [],
        "negative_price": ["price cannot be negative"],
        "invalid_numeric_negative_price": ["price cannot be negative"],
        "invalid_numeric_negative_quantity": ["quantity must be greater than 0"],
        "invalid_numeric_negative_tax": ["tax_amount cannot be negative"],
    }[detail]


def test_every_detail_is_detected_as_listed(spark):
    dirty = fx.dirty(spark, "/root/testdata/sf0.01", rate=0.5)
    checked = validate(dirty).select("anomaly_category", "anomaly_detail", "errors", unexpected_fields().alias("extra"))
    details = set()
    for row in checked.collect():
        assert row.errors == expected(row.anomaly_detail), row
        renamed = (row.anomaly_detail or "").startswith("schema_rename_")
        added = row.anomaly_detail == "schema_add_unexpected_field"
        assert bool(row.extra) == (renamed or added)
        if row.anomaly_detail:
            details.add(row.anomaly_detail.split("ORD")[0])
    # 7 nulls, 7 schema changes, 1 + 3 numeric, 4 + 1 enum, 1 duplicate
    assert len(details) == 24


def test_untouched_rows_stay_the_same(spark, sf_dir):
    clean = {r.event_id: r.value for r in fx.dirty(spark, sf_dir, rate=0.0).collect()}
    for row in fx.dirty(spark, sf_dir, rate=0.3).collect():
        if row.anomaly_category is None:
            assert row.value == clean[row.event_id]
        else:
            assert row.value != clean[row.event_id]


@pytest.mark.parametrize("kind", ANOMALY_KINDS)
def test_single_kind(spark, sf_dir, kind):
    categories = fx.dirty(spark, sf_dir, kind, 1.0).select("anomaly_category").distinct().collect()
    assert [r.anomaly_category for r in categories] == [kind]


def test_seed_decides_whatever_the_partitioning(spark, sf_dir):
    clean = fx.clean(spark, sf_dir)
    options = dict(slot=F.col("event_id"), id_at=fx.order_id_at)

    def run(df, seed):
        return {r.event_id: (r.value, r.anomaly_detail) for r in inject(df, seed=seed, **options).collect()}

    assert run(clean, 1) == run(clean.repartition(3, "customer_id"), 1)
    assert run(clean, 1) != run(clean, 2)


@pytest.mark.parametrize("field,error", [("quantity", ["quantity must be an integer"]), ("extra", [])])
def test_type_change_target(spark, sf_dir, field, error):
    dirty = inject(fx.clean(spark, sf_dir), "schema", 1.0, type_field=field)
    changed = validate(dirty).where(F.col("anomaly_detail").startswith("schema_type_")).collect()
    assert changed and all(r.errors == error for r in changed)
    if field == "extra":
        assert all(json.loads(r.value)["unexpected_extra"] == 123 for r in changed)


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_exact_count(spark, sf_dir, n):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    if n > events.count():
        with pytest.raises(ValueError, match="between 0 and total count"):
            picked_exactly(events, n, 7, "event_id")
        return
    picked = events.where(picked_exactly(events, n, 7, "event_id")).count()
    assert picked == n


def test_exact_count_breaks_ties_by_key(spark, monkeypatch):
    import siltgauge.operators.sampling as sampling

    # one draw for everybody: only the key order is left to decide
    monkeypatch.setattr(sampling, "draw", lambda seed, salt, key: key * 0 + 7)
    rows = spark.range(200).repartition(8)
    kept = rows.where(sampling.picked_exactly(rows, 55, 1, "id")).collect()
    assert sorted(r.id for r in kept) == list(range(55))


def test_slots_of_sparse_keys(spark):
    keys = [k * k * 3 - 500 for k in range(700)]
    frame = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    for buckets in (1, 7):
        got = {r.k: r.slot for r in with_slot(frame, "k", buckets=buckets).collect()}
        assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_sparse_duplicates_reuse_an_earlier_id(spark, sf_dir):
    orders = fx.clean_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    rows = inject(orders, "duplicate-id", 1.0, key="o_orderkey").collect()
    for row in rows:
        used = json.loads(row.value)["order_id"]
        own = row.o_orderkey * 4 + 3
        assert used < own and (used % 4 == 3 or row.o_orderkey == 0)
        assert row.anomaly_detail == f"duplicate_order_id_{used}"


def test_generated_anomalies_and_summary(spark):
    records, summary = generate_anomalous_transactions(spark, 1000, "all", anomaly_count=52, seed=42)
    line = summary.collect()[0]
    assert (line.total_transactions, line.anomalous_transactions, line.seed) == (1000, 52, 42)
    assert line.achieved_rate_pct == pytest.approx(5.2)
    assert line.target_anomaly_type == "all" and sum(line.anomaly_breakdown.values()) == 52
    assert set(line.anomaly_breakdown) <= set(ANOMALY_KINDS)
    assert records.count() == 1000
    first = generate_anomalous_transactions(spark, 5, "duplicate-id", 1.0)[0].orderBy("row_key").collect()
    assert json.loads(first[0].value)["order_id"] == 10000
    _, none = generate_anomalous_transactions(spark, 10, "null", 0.0)
    assert none.collect()[0].anomaly_breakdown == {}


@pytest.mark.parametrize(
    "arguments",
    [
        dict(count=0, anomaly_type="all"),
        dict(count=5, anomaly_type="typo"),
        dict(count=5, anomaly_type="all", anomaly_rate=1.5),
        dict(count=5, anomaly_type="all", anomaly_count=6),
        dict(count=5, anomaly_type="all", anomaly_count=-1),
    ],
)
def test_injector_guards(spark, arguments):
    with pytest.raises(ValueError):
        generate_anomalous_transactions(spark, **arguments)


@pytest.mark.parametrize("arguments", [dict(count=0), dict(count=5, rate=0), dict(count=5, rate=-1.0)])
def test_generator_guards(spark, arguments):
    with pytest.raises(ValueError):
        generate_transactions(spark, **arguments)
    with pytest.raises(ValueError):
        generate_transaction_batches(spark, 5, 0)


def test_generated_rows(spark):
    rows = generate_transactions(spark, 2000, rate=4).collect()
    assert [r.order_id for r in sorted(rows)] == list(range(10001, 12001))
    for row in rows:
        assert 1 <= row.quantity <= 5 and 100 <= row.price <= 5000
        assert 101 <= int(row.customer_id[1:]) <= 999 and row.product_id in [f"P{n}" for n in range(501, 511)]
        assert abs(float(row.tax_amount) - float(row.price) * row.quantity * 0.18) <= 0.0051
    first = min(rows)
    assert first.timestamp == "2026-01-01T00:00:00.250000+00:00"
    assert len({r.payment_method for r in rows}) == 4 and len({r.product_id for r in rows}) == 10


def test_short_last_batch(spark):
    sizes = generate_transaction_batches(spark, 25, 10).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in sizes] == [(0, 10), (1, 10), (2, 5)]
    with pytest.raises(ValueError):
        with_batch_id(spark.range(3), "id", -1)
