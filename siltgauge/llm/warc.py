"""Dictionary-compressed WARC archives of pages.

An archive begins with a skippable frame that holds a Zstandard dictionary built from a sample of its
records; every record is a Zstandard frame of its own, compressed with that dictionary. A reader takes the
dictionary from the first frame and can start at any record. A page whose payload is that of another page
is a revisit record without a body, which names the page it repeats.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH, landed, whole_text
from ..session import settings

# ---------------------------------------------------------------------------
# Fixed values of the format.
# ---------------------------------------------------------------------------
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ---------------------------------------------------------------------------

#: Payloads below this size are stored as they are.
LEAST_PAYLOAD = 100
#: The dictionary is built from the first records of an archive, so many bytes of them at most; no record
#: is left out of the archive itself.
SAMPLE_BYTES, DICTIONARY_BYTES = 2 << 20, 64 << 10
#: An archive is closed once it holds so many bytes before compression.
ARCHIVE_BYTES = 16 << 20


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    revisit = refers_to is not None
    body = b"" if revisit else payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}')}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": len(payload),
        "X-Page-ID": page_id,
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "X-Refers-To-Page-ID": refers_to,
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": len(body),
    }
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return VERSION + head.encode("utf-8", "surrogatepass") + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(VERSION.rstrip()):
        raise ValueError("not a WARC record")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where it says")
    return fields, rest[:length]


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the records, or what they begin with where there are too few to train."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


def archive(records: list[bytes]) -> bytes:
    sample, held = [], 0
    for data in records:
        if held >= SAMPLE_BYTES:
            break
        sample.append(data[: SAMPLE_BYTES - held])
        held += len(sample[-1])
    dictionary = build_dictionary(sample)
    shared = zstandard.ZstdCompressionDict(dictionary)
    compressor = zstandard.ZstdCompressor(dict_data=shared, write_content_size=True, write_checksum=True)
    frames = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)), dictionary]
    return b"".join(frames + [compressor.compress(data) for data in records])


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, frame by frame."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with its dictionary")
    shared = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    rest = memoryview(data)[8 + size :]
    while len(rest):
        decompressor = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        yield decompressor.decompress(rest)
        rest = rest[len(rest) - len(decompressor.unused_data) :]


def with_references(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest, refers_to: the smallest page_id of an equal payload of LEAST_PAYLOAD
    bytes or more, NULL for that page itself and for small payloads."""
    payload = F.encode(whole_text(f"`{html_col}`"), "UTF-8")
    held = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    held = held.withColumn("digest", F.sha2("payload", 256))
    large = held.where(F.octet_length("payload") >= LEAST_PAYLOAD)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only payloads that repeat; landed, so that its size is known when Spark plans the join.
    first = landed(first.select(F.col("digest").alias("_digest"), "first"), "repeated")
    joined = held.join(first, F.col("digest") == F.col("_digest"), "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


ARCHIVES = T.StructType().add("path", T.StringType()).add("n_records", T.LongType()).add("n_bytes", T.LongType())


def write_archives(pages: DataFrame, folder: str, *, date: str = "1970-01-01T00:00:00Z", **columns: str) -> DataFrame:
    """Write ``pages`` as archives below ``folder`` (a URI that all executors reach); path, n_records and
    n_bytes of each.

    A task writes its archives under names of its partition and moves each into place when it is whole,
    so a repeated task replaces what a lost one left. A task holds one archive at a time. A NULL html is
    an empty payload, a NULL url has no target field, rows without page_id are kept and are never referred
    to; rows that repeat the smallest page_id of a payload are responses too. No pages, no archives.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        number, held, size = 0, [], 0

        def close() -> pd.DataFrame:
            nonlocal number, held, size
            name = f"{base}/part-{part:05d}-{number:05d}.warc.zst"
            data = archive(held)
            with store.open_output_stream(f"{name}.{attempt}") as file:
                file.write(data)
            store.move(f"{name}.{attempt}", name)
            row = pd.DataFrame({"path": [name], "n_records": [len(held)], "n_bytes": [len(data)]})
            number, held, size = number + 1, [], 0
            return row

        for batch in batches:
            for row in batch.itertuples(index=False):
                number_of = [None if pd.isna(x) else int(x) for x in (row.page_id, row.refers_to)]
                held.append(record(number_of[0], row.url, bytes(row.payload), row.digest, number_of[1], date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
        if held:
            yield close()

    # Text keeps ids exact on their way through pandas.
    rows = with_references(pages, **columns)
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    return landed(rows.mapInPandas(write, ARCHIVES), "archives")


RECORDS = T.StructType()
for _name, _type in (("page_id", T.LongType()), ("url", T.StringType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.LongType()), ("stored", T.BooleanType())):
    RECORDS.add(_name, _type)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record below ``folder``: page_id, url, payload_bytes, payload_digest, record_type, refers_to
    and whether the record itself holds a payload of that length and digest (``stored``)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for data in read_archive(content):
                    fields, payload = parse_record(data)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    length = int(fields["X-Payload-Length"])
                    stored = fields["WARC-Type"] == "response"
                    if stored and (len(payload), hashlib.sha256(payload).hexdigest()) != (length, digest):
                        raise ValueError(f"the payload of page {fields.get('X-Page-ID')} is damaged")
                    ids = [fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")]
                    ids = [None if i is None else int(i) for i in ids]
                    rows.append((ids[0], fields.get("WARC-Target-URI"), length, digest, fields["WARC-Type"], ids[1], stored))
                # Column by column: ids next to a missing one must not become floats.
                columns = dict(zip(RECORDS.names, zip(*rows, strict=True), strict=True))
                ids = {name: pd.array(columns[name], dtype="Int64") for name in ("page_id", "refers_to")}
                yield pd.DataFrame(columns | ids)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInPandas(read, RECORDS)


def archive_and_read(pages: DataFrame, folder: str) -> DataFrame:
    """What :func:`read_archives` finds of the archives :func:`write_archives` makes of ``pages``."""
    spark = pages.sparkSession
    write_archives(pages, folder)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH)):
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
            return spark.createDataFrame([], RECORDS)
        return landed(read_archives(spark, folder), "records")
