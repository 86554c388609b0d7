"""Inputs outside the usual: values beyond the types, rows without keys, silent flows."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltgauge.contract import REQUIRED_FIELDS
from siltgauge.functions.draws import draw_place
from siltgauge.functions.quantiles import exact_quantiles, value_counts
from siltgauge.operators import metrics
from siltgauge.operators.sampling import picked_exactly
from siltgauge.operators.slots import with_slot
from siltgauge.operators.synth import tax
from siltgauge.operators.validate import validate

RECORD = {
    "order_id": "A-1",
    "customer_id": "C9",
    "product_id": "P501",
    "quantity": 3,
    "price": 10.25,
    "tax_amount": 5.5,
    "payment_method": "Cash",
    "timestamp": "2024-05-06T07:08:09",
}


def test_user_columns_stay(spark):
    frame = spark.createDataFrame([(json.dumps(RECORD), "x", 1, True)], "value string, _iso_country string, _v_x int, _broken_by boolean")
    out = validate(frame)
    assert out.columns == ["value", "_iso_country", "_v_x", "_broken_by", "errors", "is_valid"]


@pytest.mark.parametrize(
    ("field", "text", "value"),
    [
        ("quantity", "3000000000", 3000000000),
        ("quantity", "1" * 30, int("1" * 30)),
        ("quantity", "1" * 45, None),
        ("price", "2000000000000", None),
        ("price", "4.999", None),
        ("price", "4.50", 4.5),
        ("price", "2e3", 2000),
        ("tax_amount", "0.001", None),
    ],
)
def test_valid_values_are_exact_or_unfit(spark, field, text, value):
    record = json.dumps({**RECORD, field: 0}).replace(f'"{field}": 0', f'"{field}": {text}')
    row = validate(spark.createDataFrame([(record,)], "value string"), typed=REQUIRED_FIELDS).collect()[0]
    assert row.is_valid
    assert row.record.unfit == ([field] if value is None else [])
    assert row.record[field] is None if value is None else row.record[field] == Decimal(str(value))


def test_rows_without_a_key_stay_and_slots_start_at_0(spark):
    frame = spark.createDataFrame([(5, "a"), (None, "b"), (2, "c")], "k long, t string")
    assert {r.t: r.slot for r in with_slot(frame, "k", buckets=2).collect()} == {"a": 1, "b": None, "c": 0}


def test_places_of_large_tables_are_drawn(spark):
    drawn = spark.range(2000).select(draw_place(1, "slot", F.col("id"), F.lit(10**11)).alias("p"))
    low, high = drawn.agg(F.min("p"), F.max("p")).first()
    assert 0 <= low < 10**9 and 99 * 10**9 < high < 10**11


def test_tax_of_large_quantities(spark):
    row = spark.range(1).select(tax(F.lit("9999.99").cast("decimal(12,2)"), F.lit(10**15)).alias("t")).first()
    assert str(row.t) == "1799998200000000000.00"


def test_quantiles_of_the_smallest_number(spark):
    values = [-(2**63), -(2**63) + 1, -1, 0, 2**63 - 1]
    frame = spark.createDataFrame([("g", v) for v in values], "g string, v long")
    found = exact_quantiles(value_counts(frame, ["g"], "v"), ["g"], "v", {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert (found.low, found.mid, found.high) == (values[0], -1, values[-1])


def test_more_rows_than_there_are_cannot_be_picked(spark):
    with pytest.raises(ValueError, match="between 0 and total count"):
        picked_exactly(spark.range(1000), 5000, 1, "id")


def test_silent_flows_warn(spark):
    start = dt.datetime(2024, 3, 1)
    windows = [("a", start + dt.timedelta(hours=h), 10, 10, 100.0) for h in range(10)]
    windows += [("b", start + dt.timedelta(hours=h), 10, 10, 100.0) for h in (0, 1, 5)]
    frame = spark.createDataFrame(windows, "flow string, window_start timestamp, n long, n_valid long, quality_pct double")
    found = metrics.alerts(frame, "flow")
    silent = {(r.flow, r.window_start) for r in found.where("severity = 'warning'").collect()}
    assert silent == {("b", start + dt.timedelta(hours=2)), ("b", start + dt.timedelta(hours=6))}
    assert found.count() == 15
    health = metrics.system_health(found, "flow").first()
    assert (health.operational, health.flows, health.flows_with_warning) == (False, 2, 1)
    status = {r.flow: r.status for r in metrics.flow_status(frame, "flow").collect()}
    assert status == {"a": metrics.RUNNING, "b": metrics.MONITORING}
