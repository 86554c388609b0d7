import json

import pytest
from pyspark.sql import functions as F

from cases import CONTRACT, EXTRA, changed, without
from siltgauge.operators.metrics import quality_per_window
from siltgauge.operators.synth import generate_continuous_transactions
from siltgauge.operators.validate import validate
from siltgauge.plans import fixtures as fx
from siltgauge.session import scratch_dir
from siltgauge.sources import readers, writers
from siltgauge.streaming import duplicates, quality


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def land(spark, stream, base):
    writers.append_table(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def test_validator_cases_as_a_stream(spark, tmp_path):
    cases = [c for c in CONTRACT + EXTRA if "\n" not in c[1]]
    for i in range(3):
        write_lines(tmp_path / "in", f"{i}.jsonl", [text for _, text, _ in cases[i::3]])
    stream = validate(readers.stream_json_lines(spark, str(tmp_path / "in"), files_per_trigger=1))
    rows = land(spark, stream.select("value", "errors"), tmp_path).collect()
    wanted = sorted((text, errors) for _, text, errors in cases)
    assert sorted((r.value, r.errors) for r in rows) == wanted


def test_restart_writes_no_row_twice(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"

    def run():
        stream = validate(readers.stream_json_lines(spark, str(source))).select("value", "is_valid", "errors")
        writers.append_table(stream.select("value", "is_valid"), f"{out}/table", f"{out}/cp").awaitTermination()
        writers.split_by_verdict(stream, f"{out}/split", f"{out}/cp2").awaitTermination()

    write_lines(source, "a", [changed(order_id=f"A{i}") for i in range(20)])
    run()
    run()
    write_lines(source, "b", [changed(order_id=f"B{i}", quantity=-1) for i in range(10)])
    run()
    assert spark.read.parquet(f"{out}/table").count() == 30
    assert writers.read_accepted(spark, f"{out}/split").count() == 20
    bad = writers.read_quarantined(spark, f"{out}/split")
    assert bad.count() == 10 and bad.select("errors").distinct().collect()[0].errors == ["quantity must be greater than 0"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    write_lines(source, "a", [changed(order_id=f"A{i}", quantity=i % 2) for i in range(20)])

    def run(checkpoint):
        stream = validate(readers.stream_json_lines(spark, str(source))).select("value", "is_valid", "errors")
        writers.split_by_verdict(stream, f"{out}/split", f"{out}/{checkpoint}").awaitTermination()

    run("cp1")
    run("cp2")  # a lost checkpoint makes batch 0 run again
    assert spark.read.parquet(f"{out}/split").count() == 20


def test_windows_with_late_and_untimed_rows(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1", [changed(timestamp=f"2024-01-01T{h:02d}:10:00") for h in range(6)])
    write_lines(source, "2", [changed(timestamp="2024-01-01T12:00:00"), changed(timestamp="2024-01-01T13:30:00", price=-1)])
    late = [changed(timestamp="2024-01-01T00:20:00")]
    untimed = [without("timestamp"), changed(timestamp="nonsense")]
    write_lines(source, "3", [*late, *untimed, changed(timestamp="2024-01-01T18:00:00")])
    for i, name in enumerate("123"):  # the source takes files in order of modification time
        import os

        os.utime(source / name, (1_700_000_000 + i, 1_700_000_000 + i))
    lines = readers.stream_json_lines(spark, str(source), files_per_trigger=1)
    lines = lines.withColumn("ingest_ts", F.lit("2024-01-01 18:05:00").cast("timestamp"))
    timed = quality.validate_stream(lines, delay="1 hour", metrics="late_test")
    base = tmp_path / "out"
    query = writers.append_table(quality.stream_quality(timed), f"{base}/table", f"{base}/cp")
    query.awaitTermination()
    got = {r.window_start.hour: (r.n, r.n_valid) for r in spark.read.parquet(f"{base}/table").collect()}
    # the late row is not in hour 0; hour 18 is still open; the untimed rows are in no window
    assert got == {**{h: (1, 1) for h in range(6)}, 12: (1, 1), 13: (1, 0)}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    seen = sum(p["observedMetrics"]["late_test"]["rows"] for p in query.recentProgress if p["observedMetrics"])
    assert seen == 12
    # per-record lateness, counted on the table
    batch = validate(spark.read.text(str(source)), typed=("timestamp",))
    batch = batch.withColumns({"event_time": F.col("record.timestamp"), "ingest_ts": F.lit("2024-01-01 18:05:00").cast("timestamp")})
    assert quality.late_rows(batch, "17 hours").count() == 2


def test_one_record_cannot_end_a_stream(spark, tmp_path):
    """A record of the far future in the first file: the hours after it are all there."""
    source = tmp_path / "in"
    write_lines(source, "0", [changed(timestamp="9998-01-01T00:00:00"), changed(timestamp="2024-01-01T00:10:00")])
    for h in range(1, 5):
        write_lines(source, str(h), [changed(timestamp=f"2024-01-01T{h:02d}:10:00"), without("timestamp")])
    for i in range(5):
        import os

        os.utime(source / str(i), (1_700_000_000 + i, 1_700_000_000 + i))
    lines = readers.stream_json_lines(spark, str(source), files_per_trigger=1)
    lines = lines.withColumn("ingest_ts", F.lit("2024-01-01 04:30:00").cast("timestamp"))
    timed = quality.stream_quality(quality.validate_stream(lines, metrics="future_test"))
    writers.write_totals(timed, f"{tmp_path}/t", f"{tmp_path}/cp").awaitTermination()
    got = writers.read_totals(spark, timed.schema, f"{tmp_path}/t", ["window_start"]).collect()
    assert {r.window_start.hour: r.n for r in got} == dict.fromkeys(range(5), 1)
    off = quality.off_time_rows(lines)
    writers.write_totals(off, f"{tmp_path}/o", f"{tmp_path}/cp2").awaitTermination()
    got = writers.read_totals(spark, off.schema, f"{tmp_path}/o", ["window_start", "time_status"]).collect()
    assert {r.time_status: r.n for r in got} == {"future": 1, "untimed": 4}


def test_rows_without_a_key_are_no_repeats(spark, tmp_path):
    write_lines(tmp_path / "in", "a", [changed(order_id=None if i % 2 else f"K{i % 6}", quantity=i + 1) for i in range(200)])
    rows = readers.stream_json_lines(spark, str(tmp_path / "in")).withWatermark("ingest_ts", "1 hour")
    keyed = rows.select("ingest_ts", F.get_json_object("value", "$.order_id").alias("k"), F.get_json_object("value", "$.quantity").alias("q"))
    out = land(spark, duplicates.drop_stream_duplicates(keyed, "k", "q").select("k", "q"), tmp_path).collect()
    assert sum(r.k is None for r in out) == 100 and sorted(r.k for r in out if r.k) == ["K0", "K2", "K4"]


def test_stream_equals_batch_on_closed_windows(spark, sf_dir, tmp_path):
    dirty = fx.dirty_from_events(fx.event_stream(spark, sf_dir))
    streamed = land(spark, quality.stream_quality(quality.validate_stream(dirty, metrics="eq")), tmp_path)
    checked = validate(fx.dirty(spark, sf_dir), typed=("timestamp",))
    checked = checked.withColumn("t", F.col("record.timestamp")).where("t is not null")
    batch = quality_per_window(checked, "t", "1 hour")
    got = {r.window_start: (r.n, r.n_valid) for r in streamed.collect()}
    wanted = {r.window_start: (r.n, r.n_valid) for r in batch.collect()}
    open_windows = set(wanted) - set(got)
    assert len(open_windows) <= 2 and all(w > max(got) for w in open_windows)
    assert all(wanted[w] == got[w] for w in got)


def test_running_count_in_complete_mode(spark, sf_dir):
    clean = fx.clean_from_events(fx.event_stream(spark, sf_dir))
    counted = clean.groupBy().count()
    query = counted.writeStream.format("memory").queryName("stored").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("stored").collect()[0][0] == 1000


@pytest.fixture()
def repeated_ids(spark, tmp_path):
    """Two micro-batches: a hot id, repeats across batches, NULL ids."""
    folder = tmp_path / "ids"
    first = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 50}") for i in range(90)]
    second = [(i, "hot" if i % 3 == 0 else f"k{i % 80}") for i in range(90, 150)]
    schema = "i long, k string, t timestamp"
    for name, rows in (("a", first), ("b", second)):
        frame = spark.createDataFrame(rows, "i long, k string").withColumn("t", F.timestamp_seconds(F.col("i") + 1_700_000_000))
        frame.coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return stream, first + second


def test_duplicates_marked_in_the_table(spark, tmp_path, repeated_ids):
    stream, rows = repeated_ids
    first = {}
    for i, k in rows:
        first.setdefault(k, i)
    wanted = {i: k is not None and first[k] != i for i, k in rows}
    for checkpoint in ("cp1", "cp2"):  # the second run repeats both batches
        query = duplicates.write_flagged_duplicates(
            stream.select("i", "k"), "k", "i", str(tmp_path / "flagged"), str(tmp_path / checkpoint)
        )
        query.awaitTermination()
        rows_written = spark.read.parquet(str(tmp_path / "flagged")).collect()
        assert len(rows_written) == len(rows)
        assert {r.i: str(r.is_duplicate).lower() == "true" for r in rows_written} == wanted
        assert {r.batch_id for r in rows_written} == {0, 1}


def test_dropped_and_counted_stream_duplicates(spark, tmp_path, repeated_ids):
    stream, rows = repeated_ids
    timed = stream.withWatermark("t", "1 hour")
    kept = land(spark, duplicates.drop_stream_duplicates(timed.where("k is not null"), "k", "i"), tmp_path / "d")
    keys = [r.k for r in kept.collect()]
    assert sorted(keys) == sorted({k for _, k in rows if k is not None})


def test_rate_source(spark):
    stream = generate_continuous_transactions(spark, rate=50.0)
    assert stream.isStreaming
    query = stream.writeStream.format("memory").queryName("endless").start()
    try:
        for _ in range(60):
            query.processAllAvailable()
            if spark.table("endless").count() >= 20:
                break
    finally:
        query.stop()
    ids = sorted(r.order_id for r in spark.table("endless").collect())
    assert ids == list(range(10001, 10001 + len(ids))) and len(ids) >= 20
    with pytest.raises(ValueError):
        generate_continuous_transactions(spark, rate=0)


def test_kafka_layout(spark):
    raw = spark.createDataFrame(
        [(bytearray(changed().encode()), 2, 17)], "value binary, partition int, offset long"
    ).withColumn("timestamp", F.current_timestamp())
    row = validate(readers.kafka_records(raw)).collect()[0]
    assert row.is_valid and (row.partition_id, row.offset) == (2, 17)


def test_json_files(spark, tmp_path):
    records = [changed(order_id=i) for i in range(10001, 10011)]
    broken = changed(quantity="@@").replace('"@@"', "2.0")
    (tmp_path / "array.json").write_text("[\n  " + ",\n  ".join([*records, broken]) + "\n]")
    frame = readers.read_json_array(spark, str(tmp_path / "array.json"))
    errors = [r.errors for r in validate(frame, parsed="parsed").collect()]
    assert errors[:10] == [["order_id must be a string"]] * 10
    assert errors[10] == ["quantity must be an integer"]
    (tmp_path / "cut.json").write_text("[" + records[0] + ", {")
    cut = validate(readers.read_json_array(spark, str(tmp_path / "cut.json")), parsed="parsed")
    assert [r.errors for r in cut.collect()] == [["Malformed record"]]

    lines = spark.createDataFrame([(r,) for r in records], "value string")
    writers.write_json_lines(lines, str(tmp_path / "lines"))
    back = readers.read_json_lines(spark, str(tmp_path / "lines"))
    assert sorted(json.loads(r.value)["order_id"] for r in back.collect()) == list(range(10001, 10011))
    with pytest.raises(ValueError):
        readers.stream_json_lines(spark, str(tmp_path / "lines"), files_per_trigger=0)


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
