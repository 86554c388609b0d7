"""Streams and files that the registered queries derive from the given tables."""

import pytest
from pyspark.sql import functions as F

from siltgauge.plans import fixtures as fx
from siltgauge.plans.queries import QUERIES
from siltgauge.sources.arrays import read_json_array_split


@pytest.mark.parametrize(("make", "batches"), [(fx.dirty_stream, 6), (fx.edge_stream, 5)])
def test_a_micro_batch_is_several_files(spark, sf_dir, tmp_path, monkeypatch, make, batches):
    monkeypatch.setattr(fx, "FILE_ROWS", 60, raising=False)
    seen = []

    def note(batch, _):
        at = F.col("ingest_ts")
        rows = batch.select(at, F.input_file_name().alias("file"))
        seen.append(rows.agg(F.count(at), F.min(at), F.max(at), F.count_distinct("file")).first())

    stream = make(spark, sf_dir).writeStream.foreachBatch(note).trigger(availableNow=True)
    stream.option("checkpointLocation", str(tmp_path)).start().awaitTermination()
    assert len(seen) == batches and all(files > 1 for *_, files in seen)
    assert sum(n for n, *_ in seen) == fx.table(spark, sf_dir, "events").count()
    assert all(before[2] <= after[1] for before, after in zip(seen, seen[1:], strict=False))


def test_detections_parse_records_once(spark, sf_dir):
    plan = QUERIES["detection_matrix"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan


def test_arrays_of_a_flow_are_several_files(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "ARRAY_IDS", 200, raising=False)
    fx.write_arrays(spark, sf_dir, str(tmp_path / "arrays"))
    found = read_json_array_split(spark, str(tmp_path / "arrays"))
    files = {r.file: r.n for r in found.groupBy("file").agg(F.count("value").alias("n")).collect()}
    assert len(files) > 5 and max(files.values()) <= 200
    assert sum(files.values()) == fx.table(spark, sf_dir, "events").count()
