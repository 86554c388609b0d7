import datetime as dt
import math
import random

from pyspark.sql.functions import spark_partition_id

from siltgauge.functions.quantiles import exact_quantiles, value_counts
from siltgauge.operators import aggregates, checks, duplicates, metrics
from siltgauge.operators.lookup import left_join_skewed
from siltgauge.operators.validate import validate
from siltgauge.plans import fixtures as fx
from siltgauge.session import settings

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2024, 3, 1)


def test_skewed_join_is_a_left_join(spark):
    pick = random.Random(1)
    rows = [(i, pick.choice(["hot"] * 5 + [None] * 3 + [f"k{n}" for n in range(900)])) for i in range(6000)]
    known = [(f"k{n}", n) for n in range(0, 900, 2)] + [("hot", -1)]
    # all rows lie in one partition: where they come from must not matter
    left = spark.createDataFrame(rows, "i long, k string").coalesce(1)
    right = spark.createDataFrame(known, "k string, v long")
    got = {r.i: (r.k, r.v) for r in left_join_skewed(left, right, ["k"], ["i"], task_rows=2).collect()}
    wanted = dict(known)
    assert len(got) == 6000
    assert got == {i: (k, wanted.get(k)) for i, k in rows}
    # the shuffle join that large tables get: the hot key and the NULLs reach many tasks
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        shuffled = left_join_skewed(left, right, ["k"], ["i"], task_rows=2)
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        tasks = shuffled.select("i", "k", "v", spark_partition_id().alias("task")).collect()
    assert {r.i: (r.k, r.v) for r in tasks} == got and len(tasks) == 6000
    for key in ("hot", None):
        assert len({r.task for r in tasks if r.k == key}) >= 5
    # a key with no more rows than a task may get stays together
    held = sum(k == "k7" for _, k in rows)
    whole = left_join_skewed(left, right, ["k"], ["i"], task_rows=held)
    assert {r.i: (r.k, r.v) for r in whole.collect()} == got


def test_duplicates_with_a_hot_key(spark):
    pick = random.Random(2)
    rows = [(i, pick.choice(["hot"] * 40 + [None] * 10 + [f"k{n}" for n in range(80)]), pick.randint(0, 9)) for i in range(4000)]
    frame = spark.createDataFrame(rows, "i long, k string, t int").repartition(16)
    first = {}
    for i, k, t in rows:
        first[k] = min(first.get(k, (t, i)), (t, i))
    got = {r.i: r.is_duplicate for r in duplicates.flag_duplicates(frame, ["k"], ["t", "i"]).collect()}
    assert got == {i: k is not None and (t, i) != first[k] for i, k, t in rows}
    unique = [(i, k, i) for i, k, _ in rows]
    least = {}
    for i, k, _ in unique:
        least[k] = min(least.get(k, i), i)
    got = {r.i: r.is_duplicate for r in duplicates.flag_duplicates(frame, ["k"], ["i"]).collect()}
    assert got == {i: k is not None and i != least[k] for i, k, _ in unique}
    counts = {r.k: (r.n, r.surplus) for r in duplicates.duplicate_keys(frame, ["k"], ["t", "i"]).collect()}
    for k, (n, surplus) in counts.items():
        assert n == sum(1 for r in rows if r[1] == k) and surplus == n - 1
    assert None not in counts


def test_exact_quantiles(spark):
    pick = random.Random(3)
    groups = {
        "small": [pick.randint(0, 40) for _ in range(900)],
        "wide": [pick.randint(-(2**40), 2**55) for _ in range(501)],
        "one": [5],
        "equal": [2**33] * 77,
        "near": [2**20 + pick.randint(-3000, 3000) for _ in range(800)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None)]
    frame = spark.createDataFrame(rows, "g string, v long").repartition(8)
    points = {"low": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "high": 1.0}
    for row in exact_quantiles(value_counts(frame, ["g"], "v"), ["g"], "v", points).collect():
        values = sorted(groups[row.g])
        for name, p in points.items():
            assert row[name] == values[max(math.ceil(p * len(values)), 1) - 1], (row.g, name)


def windows(spark, counts):
    rows = [(START + HOUR * h, n) for h, n in counts.items()]
    return spark.createDataFrame(rows, "window_start timestamp, n long")


def test_running_total_over_day_borders(spark):
    counts = {0: 5, 1: 2, 23: 1, 24: 4, 80: 3, 81: 0}
    got = {r.window_start: r.total for r in metrics.running_total(windows(spark, counts)).collect()}
    total, wanted = 0, {}
    for h, n in counts.items():
        total += n
        wanted[START + HOUR * h] = total
    assert got == wanted


def test_change_needs_the_hour_before(spark):
    changes = metrics.change_from_previous(windows(spark, {0: 4, 1: 6, 3: 9, 4: 0, 5: 7}))
    got = {(r.window_start - START) // HOUR: r.change_pct for r in changes.collect()}
    assert got == {0: None, 1: 50.0, 3: None, 4: -100.0, 5: None}


def test_idle_consumer_lags_fully(spark):
    produced = spark.createDataFrame([(0, 9), (0, 4), (1, 5)], "partition_id int, offset long")
    consumed = spark.createDataFrame([(0, 7)], "partition_id int, offset long")
    lag = metrics.consumer_lag(produced, consumed)
    assert {r.partition_id: r.lag for r in lag.collect()} == {0: 2, 1: 6}
    assert {r.partition_id: r.severity for r in metrics.lag_alerts(lag, 3).collect()} == {0: "success", 1: "warning"}


def test_throughput_without_elapsed_time(spark):
    frame = spark.createDataFrame([(START,), (START,)], "t timestamp")
    row = aggregates.throughput(frame, "t").collect()[0]
    assert (row.n, row.rows_per_second) == (2, 0.0)
    assert aggregates.throughput(frame.where("false"), "t").collect()[0].rows_per_second == 0.0


def test_rates_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "anomaly_category string, value string, is_valid boolean")
    assert aggregates.anomaly_rate(empty).collect()[0].achieved_rate_pct == 0.0
    assert metrics.quality_pct(empty).collect()[0].quality_pct is None
    assert checks.null_profile(empty).count() == 8


def test_sliding_windows(spark):
    frame = spark.createDataFrame([(START + dt.timedelta(minutes=m),) for m in (1, 4, 6)], "t timestamp")
    got = metrics.events_per_window(frame, "t", "10 minutes", "5 minutes").collect()
    assert {r.window_start: r.n for r in got} == {
        START - dt.timedelta(minutes=5): 2,
        START: 3,
        START + dt.timedelta(minutes=5): 1,
    }
    assert all(r.per_second == r.n / 600 for r in got)


def flow_windows(spark):
    rows = [("a", START, 10, 10, 100.0), ("a", START + HOUR, 4, 4, 100.0), ("b", START, 10, 5, 50.0), ("b", START + HOUR, 20, 19, 95.0)]
    return spark.createDataFrame(rows, "flow string, window_start timestamp, n long, n_valid long, quality_pct double")


def test_alerts_status_and_health(spark):
    found = metrics.alerts(flow_windows(spark), "flow", 90.0, 50.0)
    got = {(r.flow, r.window_start - START): (r.severity, r.message) for r in found.collect()}
    assert got == {
        ("a", 0 * HOUR): ("success", "All records valid"),
        ("a", HOUR): ("warning", "Throughput dropped by more than 50%"),
        ("b", 0 * HOUR): ("warning", "Data quality below 90%"),
        ("b", HOUR): ("info", "Processing normally"),
    }
    health = metrics.system_health(found, "flow").collect()[0]
    assert (health.operational, health.flows, health.flows_with_warning, health.worst_severity) == (False, 2, 1, "warning")
    assert metrics.system_health(found.where("flow = 'b'"), "flow").collect()[0].operational
    status = {r.flow: (r.n, r.status) for r in metrics.flow_status(flow_windows(spark), "flow", 96.0).collect()}
    assert status == {"a": (4, "Running"), "b": (20, "Monitoring")}
    newest = metrics.recent_alerts(found, "flow", 3).collect()
    assert [(r.flow, r.window_start - START) for r in newest] == [("a", HOUR), ("b", HOUR), ("a", 0 * HOUR)]


def test_stage_latency_total(spark):
    row = (START, START + dt.timedelta(milliseconds=8), START + dt.timedelta(milliseconds=24), START + dt.timedelta(milliseconds=47))
    frame = spark.createDataFrame([row], "t0 timestamp, t1 timestamp, t2 timestamp, t3 timestamp")
    got = metrics.stage_latency(frame, "t0", {"in": "t1", "work": "t2", "out": "t3"}).collect()
    assert {r.stage: (r.avg_ms, r.max_ms, r.p50_ms) for r in got} == {
        "in": (8.0, 8, 8),
        "work": (16.0, 16, 16),
        "out": (23.0, 23, 23),
        "total": (47.0, 47, 47),
    }


def test_catalogue_and_list_agree(spark, sf_dir):
    dirty = checks.with_text_fields(fx.dirty(spark, sf_dir, "invalid-enum", 0.5), ["product_id"]).select("event_id", "product_id")
    allowed = [f"P{n}" for n in range(501, 511)]
    catalogue = spark.createDataFrame([(p,) for p in allowed * 2] + [(None,)], "product_id string")
    by_list = checks.product_errors(dirty, allowed)
    by_table = checks.product_errors_by_catalogue(dirty, catalogue)
    assert by_list.count() > 0
    assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_table.select(*by_list.columns).collect()))


def test_errors_by_rule_drops_the_value(spark):
    frame = spark.createDataFrame([(["Invalid payment_method: a: b", "price must be a number"],), (["Invalid product_id: P"],)], "errors array<string>")
    got = {r.rule: r.n for r in checks.errors_by_rule(frame).collect()}
    assert got == {"Invalid payment_method": 1, "price must be a number": 1, "Invalid product_id": 1}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plans_parse_once(spark, sf_dir):
    dirty = fx.dirty(spark, sf_dir)
    for frame in (
        checks.schema_drift(dirty),
        checks.null_profile(dirty),
        validate(dirty).where("not is_valid"),
        checks.with_text_fields(dirty, ["order_id"]).where("order_id is not null"),
    ):
        plan = plan_of(frame).lower()
        assert plan.count("parsejson") + plan.count("parse_json") == 1


def test_scans_read_only_what_they_need(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = duplicates.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema.count(":") == 3
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_linenumber)]" in plan
