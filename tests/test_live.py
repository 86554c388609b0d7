"""Key index, live figures, silence, stage joins, versions, split arrays, sketches, stage graph, upkeep."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cases import changed
from siltgauge.operators import graph, sketches, versions
from siltgauge.operators.validate import reject_unfit, validate
from siltgauge.contract import REQUIRED_FIELDS
from siltgauge.session import ROCKSDB, settings
from siltgauge.sources import arrays, readers, upkeep, writers
from siltgauge.streaming import duplicates, latency, progress, silence
from siltgauge.streaming.keyindex import KeyIndex

START = dt.datetime(2024, 5, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def batches(spark, folder, groups, schema):
    """A stream of one micro-batch per group of rows."""
    for group in groups:
        spark.createDataFrame(group, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


# --- key index


def test_index_over_many_batches(spark, tmp_path):
    draw = random.Random(1)
    rows, groups = [], []
    for b in range(9):
        group = []
        for n in range(60):
            key = draw.choice(["hot", None, f"old{draw.randrange(40)}", f"new{b}-{n}", f"new{b}-{n}"])
            group.append((b * 1000 + n, key))
        groups.append(group)
        rows += group
    stream = batches(spark, tmp_path / "in", groups, "i long, k string")
    out = str(tmp_path / "out")
    for run in ("cp1", "cp2"):  # the second run repeats all batches
        duplicates.write_flagged_duplicates(stream, "k", "i", out, str(tmp_path / run), parts=4, fanout=3).awaitTermination()
        first = {}
        for i, k in rows:
            first.setdefault(k, i)
        got = {r.i: r.is_duplicate for r in spark.read.parquet(out).collect()}
        assert got == {i: k is not None and first[k] != i for i, k in rows}
    index = KeyIndex(spark, f"{out}/_index", "k", T.StringType(), 4, 3)
    reads = [index.reads_of(b) for b in range(9)]
    # runs stay few: two at most of each level when a batch begins
    assert max(r["runs"] for r in reads) <= 4 and all(r["files_read"] <= r["files_held"] for r in reads)
    runs = index.runs_before(9)
    assert sum(r.n for r in runs) == len({k for _, k in rows if k is not None})


def test_new_keys_read_no_file(spark, tmp_path):
    groups = [[(b * 100 + n, f"b{b}-{n}") for n in range(5)] for b in range(6)]
    stream = batches(spark, tmp_path / "in", groups, "i long, k string")
    out = str(tmp_path / "out")
    duplicates.write_flagged_duplicates(stream, "k", "i", out, str(tmp_path / "cp")).awaitTermination()
    index = KeyIndex(spark, f"{out}/_index", "k", T.StringType())
    reads = [index.reads_of(b) for b in range(6)]
    assert reads[-1]["files_held"] >= 16
    assert sum(r["files_read"] for r in reads) <= 2  # a filter may err, seldom
    assert spark.read.parquet(out).where("is_duplicate").count() == 0


def test_integer_and_null_keys(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", [[(1, 5), (2, None)], [(3, 5), (4, None), (5, 6)]], "i long, k long")
    out = str(tmp_path / "out")
    duplicates.write_flagged_duplicates(stream, "k", "i", out, str(tmp_path / "cp"), index=str(tmp_path / "keys")).awaitTermination()
    assert {r.i for r in spark.read.parquet(out).where("is_duplicate").collect()} == {3}
    with pytest.raises(ValueError):
        KeyIndex(spark, out, "k", T.LongType(), parts=3)


# --- progress


def test_reports_become_a_table(spark, tmp_path):
    groups = [[(changed(order_id=f"A{b}{n}", quantity=n % 3),) for n in range(9)] for b in range(3)]
    stream = batches(spark, tmp_path / "in", groups, "value string")
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        query = writers.append_table(validate(stream, metrics="seen").select("value"), str(tmp_path / "t"), str(tmp_path / "cp"))
        query.awaitTermination()
        log.wait_for(query.runId)
    finally:
        spark.streams.removeListener(log)
    reports = progress.read_progress(spark, str(tmp_path / "log"))
    assert sorted((r.batch_id, r.n) for r in reports.collect()) == [(0, 9), (1, 9), (2, 9)]
    total = progress.live_totals(reports).first()
    assert (total.n, total.n_checked, total.n_valid, total.n_dropped) == (27, 27, 18, 0)
    assert sum(r.n for r in progress.live_rates(reports).collect()) == 27
    assert progress.source_lag(reports).count() == 0


def test_lag_from_offsets(spark, tmp_path):
    source = {"endOffset": {"t": {"0": 7, "1": 3}}, "latestOffset": {"t": {"0": 9, "1": 3, "2": 4}}}
    for batch, end in ((1, source), (0, {**source, "endOffset": {"t": {"0": 1}}})):
        (tmp_path / f"{batch}.json").write_text(json.dumps({"id": "q", "batchId": batch, "numInputRows": 1, "sources": [{k: json.dumps(v) for k, v in end.items()}]}))
    lag = progress.source_lag(progress.read_progress(spark, str(tmp_path)))
    assert {(r.topic, r.partition_id, r.lag) for r in lag.collect()} == {("t", 0, 2), ("t", 1, 0), ("t", 2, 4)}


# --- silence


def silent(spark, tmp_path, groups, gap="30 minutes"):
    stream = batches(spark, tmp_path / "in", groups, "f string, t timestamp")
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        found = silence.silences(stream, "f", "t", gap, delay="10 minutes")
        writers.append_table(found, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.schema(silence.EVENTS).parquet(str(tmp_path / "out")).collect()
    return sorted((r.flow, r.at, r.severity) for r in rows)


def test_a_paused_flow_alerts_and_recovers_once(spark, tmp_path):
    steady = [("a", at(m)) for m in range(0, 300, 5)]
    paused = [("b", at(m)) for m in (*range(0, 60, 5), *range(130, 200, 5))] + [("b", at(57)), (None, at(20)), ("b", None)]
    every = sorted(steady + paused, key=lambda r: (r[1] or at(10), str(r[0])))
    wanted = [("b", at(87), "warning"), ("b", at(130), "success"), ("b", at(225), "warning")]
    assert silent(spark, tmp_path / "one", [every]) == wanted
    many = [[r for r in every if lo <= (r[1] or at(10)) < lo + dt.timedelta(minutes=50)] for lo in (at(k) for k in range(0, 300, 50))]
    assert silent(spark, tmp_path / "many", many) == wanted


# --- stages


def test_records_lost_between_stages(spark, tmp_path):
    logs = {
        "in": [[(1, at(0)), (2, at(1)), (3, at(2))], [(4, at(100)), (None, at(1000))]],
        "mid": [[(1, at(5)), (3, at(90))], [(4, at(101)), (4, at(102)), (9, at(100)), (None, at(1000))]],
        "out": [[(1, at(9)), (2, at(10))], [(None, at(1000))]],
    }
    streams = {name: batches(spark, tmp_path / name, groups, "id long, t timestamp") for name, groups in logs.items()}
    joined = latency.join_stages(streams, "id", "t")
    writers.append_table(joined, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.schema(joined.schema).parquet(str(tmp_path / "t"))
    got = sorted((r.id, r.mid_time, r.out_time, r.last_stage) for r in rows.collect())
    assert got == [(1, at(5), at(9), "out"), (2, None, at(10), "out"), (3, None, None, "in"), (4, at(101), None, "mid"), (4, at(102), None, "mid")]
    spans = {(r.stage, r.ms) for r in latency.stage_spans(rows, ["in", "mid", "out"]).collect()}
    assert spans == {("mid", 300_000), ("out", 240_000), ("total", 540_000), ("mid", None), ("out", None)}


# --- versions


def test_versions_and_what_changed(spark):
    plain, more = {"a": 1, "b": "x"}, {"a": 1, "b": "x", "c": None}
    retyped = {"a": "1", "c": None}
    rows = [("f", at(m), json.dumps(plain)) for m in range(0, 240, 20)]
    rows += [("f", at(m), json.dumps(more)) for m in (70, 130)]
    rows += [("f", at(m), json.dumps(retyped)) for m in (185, 370)]
    rows += [("g", at(0), "{broken"), ("g", at(1), "7"), ("g", at(2), "{}"), (None, at(0), json.dumps(plain))]
    frame = spark.createDataFrame(rows, "flow string, t timestamp, value string")
    got = versions.schema_versions(frame, "t", "1 hour", ["flow"]).orderBy("flow", "first_seen").collect()
    f = [(r.first_seen, r.last_seen, r.n, r.added, r.removed, r.retyped) for r in got if r.flow == "f"]
    assert f == [
        (at(0), at(220), 12, None, None, None),
        (at(70), at(130), 2, ["c"], [], []),
        (at(185), at(185), 1, [], ["b"], ["a"]),
        (at(370), at(370), 1, [], [], []),
    ]
    assert [(r.flow, r.n) for r in got if r.flow != "f"] == [(None, 1), ("g", 1)]
    assert len({r.version for r in got}) == 4


# --- arrays


def pretty(records, **options):
    return json.dumps(records, **options)


@pytest.mark.parametrize("options", [{"indent": 2}, {"indent": None}, {"indent": 0, "ensure_ascii": False}])
def test_split_arrays_equal_whole_ones(spark, tmp_path, options):
    draw = random.Random(3)
    marks = ['"', "\\", "[", "]", "{", "}", ",", ": ", "é", "\n", "x"]
    records = [{"n": n, "t": "".join(draw.choice(marks) for _ in range(12)), "deep": [{"k": [n]}, []]} for n in range(300)]
    records += [5, "a, b", None, [], {}, 12345678901234567890.0]
    (tmp_path / "a.json").write_text(pretty(records, **options))
    (tmp_path / "b.json").write_text("  [  ]\n")
    with settings(spark, spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="0"):
        if options["indent"] is not None:
            assert spark.read.text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 5
        out = arrays.read_json_array_split(spark, str(tmp_path)).collect()
    got = [r.value for r in sorted(out, key=lambda r: r.position)]
    assert [json.loads(v) for v in got] == records
    assert [r.position for r in sorted(out, key=lambda r: r.position)] == list(range(len(records)))


def test_a_broken_element_harms_no_other(spark, tmp_path):
    good = changed()
    (tmp_path / "a.json").write_text(f"[\n{good},\n{{nonsense}},\n{good}\n]")
    errors = sorted(r.errors for r in validate(arrays.read_json_array_split(spark, str(tmp_path))).collect())
    assert errors == [[], [], ["Malformed record"]]


@pytest.mark.parametrize("size", ["300", "1000000"])
def test_long_strings_and_elements_over_splits(spark, tmp_path, size):
    records = [{"t": ", [" * 30_000}, [{"n": n, "s": "\\\"]"} for n in range(400)], "x", {}, {"a": [1, {}]}]
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps(records, indent=1) + "\nno, record")
    (tmp_path / "c.json").write_text("[1,\n2,,\n {}\n")
    with settings(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0"):
        rows = arrays.read_json_array_split(spark, str(tmp_path)).orderBy("file", "position").collect()
    got = [(r.file[-6:], r.position, json.loads(r.value)) for r in rows]
    assert got == [(f"{f}.json", n, v) for f in "ab" for n, v in enumerate(records)] + [("c.json", 0, 1), ("c.json", 1, 2), ("c.json", 3, {})]


# --- sketches


def test_sketches_merge_within_their_bound(spark):
    rows = spark.range(50_000).select(F.timestamp_seconds(F.col("id") * 10).alias("t"), (F.col("id") * 7919 % 100_003).alias("ms"))
    hours = sketches.latency_sketches(rows.union(spark.createDataFrame([(START, None)], "t timestamp, ms long")), "ms", "t", "1 hour")
    found = sketches.sketch_quantiles(sketches.merged_sketches(hours, "1000 days"), {"p50": 0.5, "p99": 0.99}).first()
    values = sorted(r.ms for r in rows.collect())
    assert found.n == 50_000 and found.largest == values[-1] and abs(found["mean"] - sum(values) / 50_000) < 1e-6
    for name, p in (("p50", 0.5), ("p99", 0.99)):
        rank = sum(v <= found[name] for v in values) / len(values)
        assert abs(rank - p) <= sketches.RANK_ERROR


# --- graph


def test_health_follows_branches_and_cycles(spark):
    edges = [("a", "b"), ("b", "c"), ("b", "d"), ("d", "b"), ("e", "f"), ("x", "x")]
    frame = spark.createDataFrame(edges, "source string, target string")
    stages = spark.createDataFrame([(s,) for s in "abcdefx"], "stage string")
    lag = spark.createDataFrame([("a", "warning"), ("e", "success"), ("x", "warning")], "part string, severity string")
    alerts = spark.createDataFrame([("d", 1, "warning"), ("d", 2, "warning"), ("f", 1, "warning"), ("f", 2, "info")], "s string, t long, severity string")
    failing = graph.failing_stages(lag, "part").unionByName(graph.failing_stages(alerts, "s", "t"))
    got = {r.stage: (r.status, r.causes) for r in graph.graph_health(failing, frame, stages).collect()}
    assert got == {
        "a": ("failing", ["a"]),
        "b": ("impaired", ["a", "d"]),
        "c": ("impaired", ["a", "d"]),
        "d": ("failing", ["a", "d"]),
        "e": ("ok", []),
        "f": ("ok", []),
        "x": ("failing", ["x"]),
    }
    calm = graph.graph_health(failing.limit(0), frame, stages).collect()
    assert {r.status for r in calm} == {"ok"}


# --- upkeep


def verdict_table(spark, tmp_path, n=6):
    groups = [[(b * 10 + k, at(600 * b + k), changed(order_id=f"A{b}{k}", quantity=k)) for k in range(4)] + [(b * 10 + 9, None, "{")] for b in range(n)]
    stream = batches(spark, tmp_path / "in", groups, "i long, t timestamp, value string")
    writers.split_by_verdict(validate(stream), str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    return str(tmp_path / "t")


def rows_of(frame):
    return sorted((r.i, r.value, r.is_valid, tuple(r.errors)) for r in frame.collect())


def test_packing_changes_no_row(spark, tmp_path):
    path = verdict_table(spark, tmp_path)
    before = rows_of(upkeep.read_verdicts(spark, path))
    assert len(before) == 30
    for upto in (2, 2, 4):
        upkeep.pack(spark, path, "t", upto)
        assert rows_of(upkeep.read_verdicts(spark, path)) == before
    assert len(list((tmp_path / "t").glob("batch_id=*"))) == 1
    files = list((tmp_path / "t" / "_packs").glob("batches=*/arrival_date=*/is_valid=*/*.parquet"))
    folders = {f.parent for f in files}
    assert len(files) == len(folders)
    dated = upkeep.read_verdicts(spark, path).where("is_valid and arrival_date = '2024-05-01'")
    assert dated.count() > 0


def test_packing_by_size(spark, tmp_path):
    path = verdict_table(spark, tmp_path, 3)
    before = rows_of(upkeep.read_verdicts(spark, path))
    upkeep.pack(spark, path, "t", 9, file_bytes=1500)
    assert rows_of(upkeep.read_verdicts(spark, path)) == before


def test_broken_off_packing_is_repeated(spark, tmp_path):
    path = verdict_table(spark, tmp_path, 3)
    before = rows_of(upkeep.read_verdicts(spark, path))
    pack = tmp_path / "t" / "_packs" / "batches=0-1"
    upkeep.pack(spark, path, "t", 1)
    (pack / "_SUCCESS").rename(pack / "_LOST")  # as if the job had ended before, with folders left
    assert rows_of(upkeep.read_verdicts(spark, path)) != before
    (pack / "_LOST").rename(pack / "_SUCCESS")
    assert rows_of(upkeep.read_verdicts(spark, path)) == before


def test_replay_appends_once(spark, tmp_path):
    bad = [changed(order_id=f"R{n}", quantity=0) for n in range(6)]
    good = [changed(order_id=f"R{n}") for n in range(4)]
    repaired = spark.createDataFrame([(v,) for v in [*good, good[0], *bad[4:]]], "value string")
    path = str(tmp_path / "accepted")
    for _ in range(2):
        left = upkeep.replay(spark, repaired, validate, path)
        assert sorted(r.value for r in left.collect()) == sorted(bad[4:])
    assert sorted(r.value for r in spark.read.parquet(path).collect()) == sorted(good)
    upkeep.replay(spark, spark.createDataFrame([(changed(order_id="R5"),), (good[1],)], "value string"), validate, path)
    assert spark.read.parquet(path).count() == 5


# --- validation beside other columns


def test_clashing_columns_stay(spark):
    frame = spark.createDataFrame([(changed(), "r", "b", 5, 6, 7, "k")], "value string, _record string, _broken string, _k_price int, _v_price int, _f_price int, _kept string")
    row = validate(frame, typed=REQUIRED_FIELDS).first()
    assert (row._record, row._broken, row._k_price, row._v_price, row._f_price, row._kept, row.is_valid) == ("r", "b", 5, 6, 7, "k", True)
    from siltgauge.operators.checks import null_profile, with_text_fields

    assert with_text_fields(frame, ["order_id"]).first()._record == "r"
    out = null_profile(frame.withColumn("_kind_x", F.lit(1)), by=["_kind_x", "_record"])
    assert out.columns[:2] == ["_kind_x", "_record"] and out.count() == len(REQUIRED_FIELDS)


def test_errors_of_the_caller_are_replaced(spark):
    frame = spark.createDataFrame([(changed(), "mine", "too")], "value string, errors string, record string")
    assert validate(frame).first().errors == [] and validate(frame).first().record == "too"
    assert validate(frame, typed=("price",)).first().record.price is not None


def test_filters_on_input_columns_reach_the_scan(spark, tmp_path):
    rows = [(changed(order_id=f"A{n}"), n % 3, n) for n in range(30)]
    spark.createDataFrame(rows, "value string, day int, n int").write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    checked = plan(validate(table, typed=("price",)).where("day = 1 and n > 4 and is_valid"))
    assert "PartitionFilters: [isnotnull(day" in checked and "GreaterThan(n,4)" in checked
    assert checked.count("try_parse_json") + checked.count("parse_json(") <= 1
    narrow = plan(validate(table).where("is_valid").select("n"))
    assert "ReadSchema: struct<value:string,n:int>" in narrow


def test_unfit_values_are_told(spark):
    good, cents = changed(), changed(price=4.999)
    checked = reject_unfit(validate(spark.createDataFrame([(good,), (cents,), ("{",)], "value string"), typed=REQUIRED_FIELDS))
    got = {r.value: (r.is_valid, r.errors) for r in checked.collect()}
    assert got == {good: (True, []), cents: (False, ["Value does not fit its type: price"]), "{": (False, ["Malformed record"])}


def test_integer_ids_are_keys(spark):
    from siltgauge.operators.checks import with_text_fields

    texts = [changed(order_id=5), changed(order_id="5"), changed(order_id=None), changed(order_id="@").replace('"@"', "5.0"), changed(order_id="@").replace('"@"', "1" * 30)]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string")
    got = {r.n: r.order_id for r in with_text_fields(frame, ["order_id"], integers=["order_id"]).collect()}
    assert {n: None if v is None else int(v) for n, v in got.items()} == {0: 5, 1: None, 2: None, 3: None, 4: int("1" * 30)}


def test_array_reader_of_whole_files_still_reads(spark, tmp_path):
    (tmp_path / "a.json").write_text(f"[{changed()}]")
    assert readers.read_json_array(spark, str(tmp_path)).count() == 1


def test_records_are_parsed_once_for_a_result(spark, sf_dir):
    from siltgauge.plans.queries import QUERIES

    def parses(name):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("parseJson")

    # windows and key counts are landed, so status, alerts and marks go over the records once
    assert [parses(n) for n in ("alerts", "flow_status", "system_health", "recent_alerts")] == [0, 0, 0, 0]
    assert [parses(n) for n in ("quality_per_window", "dq_duplicate_rows", "dq_product_catalogue", "validate")] == [1, 1, 1, 1]
