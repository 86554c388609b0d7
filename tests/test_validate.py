from datetime import datetime, timezone

import pytest
from hypothesis import strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from cases import CONTRACT, EXTRA, changed
from siltgauge.contract import REQUIRED_FIELDS, RuleSet
from siltgauge.functions.iso8601 import is_iso8601, iso8601_timestamp
from siltgauge.functions.text import is_blank, python_float
from siltgauge.operators.validate import validate


def verdicts(spark, cases, rules=RuleSet()):
    frame = spark.createDataFrame([(name, text) for name, text, _ in cases], "name string, value string")
    return {r.name: (r.is_valid, r.errors) for r in validate(frame, rules).collect()}


@pytest.mark.parametrize("cases,size", [(CONTRACT, 46), (EXTRA, None)])
def test_complete_ordered_errors(spark, cases, size):
    if size:
        assert len(cases) == size
    got = verdicts(spark, cases)
    assert got == {name: (not errors, errors) for name, _, errors in cases}


def test_order_id_type_switch(spark):
    cases = [
        ("int", changed(order_id=10001), []),
        ("text", changed(), ["order_id must be an integer"]),
        ("bool", changed(order_id=True), ["order_id must be an integer"]),
        ("null", changed(order_id=None), ["NULL value is not allowed: order_id", "order_id must be an integer"]),
    ]
    got = verdicts(spark, cases, RuleSet(order_id_type="integer"))
    assert got == {name: (not errors, errors) for name, _, errors in cases}


def test_product_and_payment_parameters(spark):
    rules = RuleSet(products=("lamp/4",), payment_methods=("Cash",))
    cases = [
        ("both", changed(product_id="P9"), ["Invalid product_id: P9", "Invalid payment_method: Wallet"]),
        ("ok", changed(payment_method="Cash"), []),
    ]
    got = verdicts(spark, cases, rules)
    assert got == {name: (not errors, errors) for name, _, errors in cases}


def test_rule_set_guards():
    with pytest.raises(ValueError):
        RuleSet(order_id_type="uuid")
    with pytest.raises(ValueError):
        RuleSet(payment_methods=())


def test_one_parse_under_filters(spark):
    frame = spark.createDataFrame([(changed(),)], "value string")
    for derived in (
        validate(frame).where(F.size("errors") > 0),
        validate(frame).select(F.explode("errors").alias("e")).groupBy("e").count(),
    ):
        plan = derived._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1
        assert plan.count("variant_get") <= 40


def test_typed_record(spark):
    frame = spark.createDataFrame([(changed(timestamp="2026-W34-3T12:30:00+02:00"),)], "value string")
    record = validate(frame, typed=REQUIRED_FIELDS).select("record.*").collect()[0]
    assert record.order_id == "K-88-a" and record.quantity == 6
    assert str(record.price) == "31.25"
    assert record.timestamp.astimezone(timezone.utc).isoformat().startswith("2026-08-19T10:30:00")


ISO_ACCEPTED = """20260819 20260819T103000 2026-W34-3 2026W343 2026-W34 2026-08-19x10:30:00 2026-08-19
2026-08-19T10 2026-08-19T10:30 2026-08-19T10:30:00,5 2026-08-19T10:30:00.123456789Z 2024-02-29 2000-02-29
2020-W53-7 2026-08-19T10:30:00+05:99 2026-08-19T10:30:00-23:59:59.999 9999-W52-5 0001-01-01 2026-W34-1030
2026W34310 2026W343T10 2026-08-19T1030 20260819T10:30+0530 2026-08-19T10:30:00+19:00""".split()
ISO_REJECTED = """2026 2026-08 2026-8-9 0000-01-01 12026-01-01 T10:30:00 2026-02-30 2026-08-19T24:00:00
2026-08-19T25:00 2026-08-19T10:60:00 2026-08-19T10:30:60 2026-231 2026-08-19T10:30:00z now
2026-08-19T10:30:00+24:00 2023-02-29 1900-02-29 2021-W53-1 2026-W54-1 2026-W00-1 2026-W34-8 2026-13-01
2026-00-10 2026-01-00 9999-W52-6 2026-W34-3110 2026-08-19T 2026-08-19T10:3 2026-08-19T10:30:00+5""".split() + [
    "",
    " 2026-08-19",
    "2026-08-19 ",
    "2026-08-19T10:30:00 UTC",
    "2026-08-19\n",
]


def iso_results(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    rows = frame.select("t", is_iso8601(F.col("t")).alias("ok"), F.unix_micros(iso8601_timestamp(F.col("t"))).alias("u"))
    return {r.t: (r.ok, r.u) for r in rows.collect()}


def python_iso(text):
    try:
        moment = datetime.fromisoformat(text)
    except ValueError:
        return False, None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    delta = moment.replace(tzinfo=None) - datetime(1970, 1, 1) - moment.utcoffset()
    return True, (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def test_iso_lists(spark):
    got = iso_results(spark, ISO_ACCEPTED + ISO_REJECTED)
    for text in ISO_ACCEPTED:
        assert got[text] == python_iso(text) and got[text][0], text
    for text in ISO_REJECTED:
        assert got[text] == (False, None), text


def generated_times(n=6000):
    """Dates, clocks and zones near every limit, glued together in every shape."""
    import random

    pick = random.Random(7)
    years = ["0000", "0001", "1900", "2000", "2015", "2020", "2023", "2024", "2026", "9999"]
    two = ["00", "01", "02", "04", "09", "11", "12", "13", "23", "24", "28", "29", "30", "31", "52", "53", "54", "59", "60"]
    out = set()
    for _ in range(n):
        y, a, b = pick.choice(years), pick.choice(two), pick.choice(two)
        d = pick.choice("01378")
        date = pick.choice([f"{y}-{a}-{b}", f"{y}{a}{b}", f"{y}-W{a}-{d}", f"{y}W{a}{d}", f"{y}-W{a}", f"{y}W{a}"])

        def clock():
            h, m, s = (pick.choice(two) for _ in range(3))
            f = pick.choice(["", "", ".5", ",123456", ".1234567"])
            return pick.choice([h, f"{h}:{m}", f"{h}:{m}:{s}{f}", f"{h}{m}", f"{h}{m}{s}{f}"])

        zone = pick.choice(["", "", "Z", "+" + clock(), "-" + clock()])
        out.add(date + pick.choice(["", pick.choice("T x_") + clock() + zone]))
    return sorted(out)


def test_iso_matches_python_on_generated_texts(spark):
    texts = generated_times()
    got = iso_results(spark, texts)
    wrong = [(t, got[t], python_iso(t)) for t in texts if got[t][0] != python_iso(t)[0]]
    assert wrong == []
    # 0001-01-01 with a positive offset lies before year 1, which Python cannot subtract
    values = [(t, got[t], python_iso(t)) for t in texts if got[t][0] and got[t] != python_iso(t)]
    assert values == []
    assert sum(got[t][0] for t in texts) > 300


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(max_codepoint=0x3100, exclude_categories=["Cs"]), max_size=4), min_size=50, max_size=200))
def test_blank_matches_strip(spark, texts):
    texts = texts + [chr(c) for c in range(0x3001) if chr(c).isspace()]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", is_blank(F.col("t")).alias("b")).collect():
        assert row.b == (not row.t.strip()), repr(row.t)


def test_python_float_rendering(spark):
    import random

    pick = random.Random(3)
    numbers = [0.0, -0.0, 1.0, 1e16, 1e15, 123456789.125, 1e-4, 9.99e-5, 1e22, -1.5e300, 2.5e-310, 0.1, 1 / 3, 1e7]
    numbers += [pick.choice([-1, 1]) * round(pick.uniform(0, 5000), 2) for _ in range(500)]
    frame = spark.createDataFrame([(float(n),) for n in numbers], "n double")
    for row in frame.select("n", python_float(F.col("n")).alias("s")).collect():
        assert row.s == repr(row.n)
