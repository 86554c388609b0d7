import hashlib

import pytest
import zstandard
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltgauge.llm import warc


@given(st.lists(st.binary(max_size=300), min_size=1, max_size=12))
def test_archive_round_trip(payloads):
    records = [warc.record(n, f"http://x/{n}\r\n", p, hashlib.sha256(p).hexdigest(), None, "2020-01-01T00:00:00Z") for n, p in enumerate(payloads)]
    data = warc.archive(records)
    assert list(warc.read_archive(data)) == records
    assert [warc.parse_record(r)[1] for r in records] == payloads


def test_first_frame_is_skippable_and_records_stand_alone():
    records = [warc.record(n, "u", b"<p>the same template</p>" * 40 + str(n).encode(), "d", None, "t") for n in range(200)]
    data = warc.archive(records)
    assert data[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(data[4:8], "little")
    plain = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert len(data) - 8 - size < plain / 2
    shared = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    frames, rest = [], data[8 + size :]
    while rest:
        reader = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        reader.decompress(rest)
        frames.append(rest[: len(rest) - len(reader.unused_data)])
        rest = reader.unused_data
    assert zstandard.ZstdDecompressor(dict_data=shared).decompress(frames[77]) == records[77]


PAGES = (
    [(n, f"http://h/{n}", "<p>" + "long enough " * 20 + str(n % 7)) for n in range(10, 60)]
    + [(5, None, "<p>" + "long enough " * 20 + "3"), (70, "a\nb", None), (71, "", ""), (72, "x", "tiny"), (73, "x", "tiny"), (74, "é", "ü" * 50), (75, "é", "ü" * 50), (76, "z", "ü" * 49 + "a")]
    + [(None, "n", "ü" * 50), (80, "q", "w" * 3_000_000), (10, "http://again", "<p>" + "long enough " * 20 + "3")]
    + [(2**60 + 1, "big", "B" * 200), (2**60 + 2, "big", "B" * 200)]
)


@pytest.mark.parametrize("limit", [warc.ARCHIVE_BYTES, 2000])
def test_pages(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", limit)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    out = warc.archive_and_read(pages, f"file://{tmp_path}/archives").collect()
    want = []
    for i, url, html in PAGES:
        payload = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "").encode() == payload and j is not None]
        again = len(payload) >= 100 and i != min(same)
        target = None if url is None else url.replace("\n", "%0A")
        want.append((i, target, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", min(same) if again else None, not again))
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert len(list((tmp_path / "archives").glob("*.warc.zst"))) == len(list((tmp_path / "archives").glob("*.zst*")))


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_and_read(pages, f"file://{tmp_path}/none").collect() == []
