"""Tables derived from the given ones, used by the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.draws import draw
from ..operators.inject import inject
from ..operators.synth import ISO_TEXT, tax
from ..session import check_zone, scratch_dir

SEED = 42
CLEAN_PAYMENTS = (("click", "UPI"), ("view", "Credit Card"), ("signup", "Debit Card"), ("purchase", "Net Banking"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    check_zone(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a file stream."""
    check_zone(spark)
    reader = spark.readStream.schema(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    )
    # a pattern, because the table is one file here and a folder of files on a cluster
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def clean_from_events(events: DataFrame) -> DataFrame:
    """One valid transaction per event; works on the table and on the stream.

    Keeps ``event_id`` as row key, ``event_type`` as the flow it belongs to, and the
    arrival time ``ingest_ts`` as TIMESTAMP, because event time refuses TIMESTAMP_NTZ.
    """
    price = F.col("value").cast("decimal(12,2)")
    quantity = (F.col("event_id") % 5 + 1).cast("int")
    method = F.lit("Wallet")
    for event_type, payment in reversed(CLEAN_PAYMENTS):
        method = F.when(F.col("event_type") == event_type, F.lit(payment)).otherwise(method)
    return events.select(
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("ingest_ts"),
        order_id_at(F.col("event_id")).alias("order_id"),
        F.concat(F.lit("C"), (F.col("user_id") + 101).cast("string")).alias("customer_id"),
        F.concat(F.lit("P"), (F.col("event_id") % 10 + 501).cast("string")).alias("product_id"),
        quantity.alias("quantity"),
        price.alias("price"),
        tax(price, quantity).alias("tax_amount"),
        method.alias("payment_method"),
        F.date_format("ts", ISO_TEXT).alias("timestamp"),
    )


def order_id_at(slot: Column) -> Column:
    return F.concat(F.lit("ORD"), slot.cast("string"))


def dirty_from_events(events: DataFrame, kind: str = "all", rate: float = 0.05, count: int | None = None) -> DataFrame:
    """Corrupted records; event ids are dense from 0, so a row's slot is its event id."""
    return inject(
        clean_from_events(events), kind, rate, count, SEED, key="event_id", slot=F.col("event_id"), id_at=order_id_at
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_from_events(table(spark, sf_dir, "events"))


def dirty(spark: SparkSession, sf_dir: str, kind: str = "all", rate: float = 0.05, count: int | None = None) -> DataFrame:
    return dirty_from_events(table(spark, sf_dir, "events"), kind, rate, count)


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of an order: placed, first and last shipping of its lines. A line may ship before the order."""
    shipped = F.col("l_shipdate").cast("timestamp")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(shipped).alias("t_first"), F.max(shipped).alias("t_last"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("placed"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


def offsets(spark: SparkSession, sf_dir: str, consumed_until: str) -> tuple[DataFrame, DataFrame]:
    """Produced and consumed offsets of a topic with three partitions; nobody reads partition 2."""
    events = table(spark, sf_dir, "events").select(
        (F.col("event_id") % 3).cast("int").alias("partition_id"), F.floor(F.col("event_id") / 3).alias("offset"), "ts"
    )
    consumed = events.where((F.col("ts") <= F.lit(consumed_until).cast("timestamp_ntz")) & (F.col("partition_id") != 2))
    return events.select("partition_id", "offset"), consumed.select("partition_id", "offset")


EDGE_KINDS = 50
#: JSON literals of timestamps around the limits of ISO 8601
EDGE_TIMES = (
    "on a tuesday",
    "20240115",
    "2024-W03-4",
    "2024W034",
    "2024-02-30T10:00:00",
    "2023-02-29",
    "2024-02-29",
    "2020-W53-7",
    "2021-W53",
    "2024-01-15T24:00:00",
    "2024-01-15T10:30:00+24:00",
    "2024-01-15T10:30:00+05:30",
    "2024-01-15T10:30:00Z",
    "2024-01-15 10:30",
    "2024-01-15T10:30:00,123456789Z",
    "2024",
    "2024-1-5",
    "T10:30:00",
    "0000-01-01",
    "9999-W52-6",
    "2024-01-15T103000+0530",
    "2024-01-15x10:30",
    " 2024-01-15",
    "20240115T103000",
)


def _edge_field(name: str, plain: str, literals: dict[int, str | None]) -> str:
    """SQL for one JSON member: a fixed literal for some kinds, nothing for None, else the plain value."""
    branches = "".join(
        f" WHEN {kind} THEN " + ("NULL" if text is None else f"concat('\"{name}\":', {text})")
        for kind, text in literals.items()
    )
    return f"CASE kind{branches} ELSE concat('\"{name}\":', {plain}) END"


def edge_value(quoted_timestamp: str) -> str:
    """JSON text of a record that breaks the rule of its ``kind``, as SQL that Spark and other engines read alike."""
    text = "concat('\"', {}, '\"')".format
    backslash = "chr(92)"
    times = " ".join(f"WHEN {i} THEN '\"{t}\"'" for i, t in enumerate(EDGE_TIMES))
    time = f"CASE time_index {times} END"
    members = [
        _edge_field(
            "order_id", text("order_id"), {10: "'\"   \"'", 11: "'77'", 12: "'null'", 13: "'\"\"'", 14: None}
        ),
        _edge_field(
            "customer_id",
            text("customer_id"),
            {15: f"concat('\"', {backslash}, 't', {backslash}, 'u00a0\"')", 16: "'true'", 17: "'null'", 18: None}
            | {44: "'null'", 46: None},
        ),
        _edge_field(
            "product_id", text("product_id"), {19: "'\"\"'", 20: "'{\"a\":1}'", 21: "'null'", 22: "'\"shelf 9\"'"}
        ),
        _edge_field(
            "quantity",
            "cast(quantity AS string)",
            {23: "'2.0'", 24: "'true'", 25: "'\"2\"'", 26: f"'{'1' * 30}'", 27: "'0'", 28: "'-9'", 29: "'null'"}
            | {44: "'-9'", 46: "'-9'"},
        ),
        _edge_field(
            "price",
            "cast(price AS string)",
            {30: "'-3.5'", 31: "'true'", 32: "'\"17.20\"'", 33: "'2e3'", 44: "'-3.5'", 48: "'4.999'", 49: "'2000000000000'"},
        ),
        _edge_field(
            "tax_amount",
            "cast(tax_amount AS string)",
            {33: "'0'", 34: "'-1'", 35: "'\"1.10\"'", 36: "'null'", 44: "'-6'"},
        ),
        _edge_field(
            "payment_method",
            text("payment_method"),
            {37: "'4'", 38: "'true'", 39: "'null'", 40: "'\"Barter\"'", 44: "'\"Barter\"'"},
        ),
        _edge_field(
            "timestamp",
            text(quoted_timestamp),
            {44: "'\"some day\"'", 45: "'1700000000'", 46: None} | {k: time for k in (9, 41, 42, 43)},
        ),
    ]
    extra = "CASE kind WHEN 8 THEN '\"unexpected_field\":\"x\"' END"
    body = f"concat('{{', concat_ws(',', {', '.join([*members, extra])}), '}}')"
    return f"CASE kind WHEN 47 THEN '{{\"order_id\":\"broken' ELSE {body} END"


def edge_from_events(events: DataFrame) -> DataFrame:
    """One record per event, about half of them faulty in one of many ways, with its arrival time."""
    drawn = clean_from_events(events).withColumns(
        {
            "kind": draw(SEED, "edge", F.col("event_id")) % EDGE_KINDS,
            "time_index": draw(SEED, "edge_time", F.col("event_id")) % len(EDGE_TIMES),
        }
    )
    return drawn.select("event_id", F.expr(edge_value("`timestamp`")).alias("value"), "ingest_ts")


def edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_from_events(table(spark, sf_dir, "events")).drop("ingest_ts")


#: rows of a file of a stream, about
FILE_ROWS = 25_000


def _stream_of(events: DataFrame, batches: list[Column], make: Callable[[DataFrame], DataFrame], purpose: str) -> DataFrame:
    """What ``make`` makes of the events as a stream of a micro-batch per condition, in this order.

    A micro-batch is as many files as the largest one asks for, so that as many tasks make and read it.
    """
    spark = events.sparkSession
    path = scratch_dir(spark, purpose)
    files = max(1, -(-max(events.agg(*[F.count_if(b) for b in batches]).first()) // FILE_ROWS))
    for batch in batches:
        # a source takes files by their time, so micro-batches are written one after another
        part = events.where(batch)
        rows = make(part.coalesce(1) if files == 1 else part.repartition(files, "event_id"))
        rows.write.mode("append").parquet(path)
    # counted, as a session may deal rows to other numbers of tasks than it is asked for
    per_batch = -(-len(spark.read.parquet(path).inputFiles()) // len(batches))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def edge_stream(spark: SparkSession, sf_dir: str, batches: int = 5) -> DataFrame:
    """The ``edge`` records with their arrival times as a stream of several micro-batches, in order of arrival."""
    events = table(spark, sf_dir, "events")
    places = F.percentile_approx("ts", [n / batches for n in range(1, batches)]).cast("array<string>")
    limits = [F.lit(t).cast("timestamp_ntz") for t in events.agg(places).first()[0] or [None] * (batches - 1)]
    ts = F.col("ts")
    parts = [ts.isNull() | (ts < limits[0]), *[(ts >= a) & (ts < b) for a, b in pairwise(limits)], ts >= limits[-1]]
    return _stream_of(events, parts, edge_from_events, "edge")


def dirty_stream(spark: SparkSession, sf_dir: str, batches: int = 6) -> DataFrame:
    """The corrupted records as a stream of several micro-batches, in order of arrival."""
    events = table(spark, sf_dir, "events")
    ids = events.agg(F.max("event_id")).first()[0] + 1
    limits = [-(-n * ids // batches) for n in range(batches + 1)]
    key = F.col("event_id")
    return _stream_of(events, [(key >= a) & (key < b) for a, b in pairwise(limits)], dirty_from_events, "dirty")


#: a stage loses the records with these ids, and is late by two hours with those: (modulus, rest) of each
LOST = {"process": (17, 3), "store": (23, 7)}
DELAYED = {"process": (41, 5), "store": (53, 11)}


def stage_logs(spark: SparkSession, sf_dir: str, files: int = 2) -> dict[str, DataFrame]:
    """Logs (event_id, at) of three stages as streams of several files and a heartbeat without id at the end."""
    key = F.col("event_id")
    at = {"ingest": F.col("ts").cast("timestamp")}
    took = {"process": key * 7919 % 90_000 + 1, "store": key * 104_729 % 30_000 + 1}
    for before, stage in (("ingest", "process"), ("process", "store")):
        rest, delayed = LOST[stage], DELAYED[stage]
        hours = F.when(key % delayed[0] == delayed[1], 7_200_000).otherwise(0)
        at[stage] = F.timestamp_millis(F.unix_millis(at[before]) + took[stage] + hours)
    events = table(spark, sf_dir, "events").where(F.col("ts").isNotNull())
    last, newest = events.agg(F.max("event_id"), F.max(F.col("ts").cast("timestamp"))).first()
    logs, kept = {}, events
    for stage in at:
        path = scratch_dir(spark, f"log-{stage}")
        if stage in LOST:
            kept = kept.where(key % LOST[stage][0] != LOST[stage][1])
        rows = kept.select("event_id", at[stage].alias("at"))
        for n in range(files):
            rows.where(F.floor(key * files / (last + 1)) == n).coalesce(1).write.mode("append").parquet(path)
        beat = spark.range(1).select(F.lit(None).cast("bigint").alias("event_id"), (F.lit(newest) + F.expr("interval 2 days")).alias("at"))
        beat.coalesce(1).write.mode("append").parquet(path)
        logs[stage] = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return logs


#: ids of the records that may share an array file
ARRAY_IDS = 500_000


def write_arrays(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The corrupted records as JSON array files of one flow each, with a line per field."""
    keys = ["event_type", "chunk"]
    flow = Window.partitionBy(*keys).orderBy("event_id")
    rows = dirty(spark, sf_dir).withColumn("chunk", F.floor(F.col("event_id") / ARRAY_IDS))
    rows = rows.select(
        *keys, "event_id", "value", F.row_number().over(flow).alias("n"), F.lead("event_id").over(flow).isNull().alias("last")
    )
    pretty = F.replace("value", F.lit(',"'), F.lit(',\n  "'))
    text = F.concat(F.when(F.col("n") == 1, F.lit("[\n")).otherwise(F.lit("")), pretty, F.when(F.col("last"), F.lit("\n]")).otherwise(F.lit(",")))
    lines = rows.select(*keys, "event_id", text.alias("line")).repartition(*keys).sortWithinPartitions(*keys, "event_id")
    lines.select(*keys, "line").write.partitionBy(*keys).text(path)


def clean_from_orders(orders: DataFrame) -> DataFrame:
    """Transactions with integer ids that have gaps; ``o_orderkey`` is the row key."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    quantity = (F.col("o_orderkey") % 5 + 1).cast("int")
    return orders.select(
        "o_orderkey",
        (F.col("o_orderkey") * 4 + 3).alias("order_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("P"), (F.col("o_orderkey") % 10 + 501).cast("string")).alias("product_id"),
        quantity.alias("quantity"),
        price.alias("price"),
        tax(price, quantity).alias("tax_amount"),
        F.lit("Cash").alias("payment_method"),
        F.date_format("o_orderdate", ISO_TEXT).alias("timestamp"),
    )
