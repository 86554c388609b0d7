"""Flows that fall silent on a stream, by event-time timers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SILENT, RECOVERED = "No records received", "Records received again"

EVENTS = T.StructType().add("flow", T.StringType()).add("at", T.TimestampType()).add("severity", T.StringType()).add("message", T.StringType())
_EPOCH = dt.datetime(1970, 1, 1)


def _stamp(micros: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=micros)


class _Silence(StatefulProcessor):
    """Keeps the newest time of a flow and whether its silence has been told. A timer stands where silence would
    begin; the watermark passes it only when other flows have gone on."""

    def __init__(self, gap_micros: int) -> None:
        self._gap = gap_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        fields = [T.StructField("newest", T.LongType()), T.StructField("told", T.BooleanType())]
        self._state = handle.getValueState("newest", T.StructType(fields))

    def _timer(self, newest: int) -> int:
        # timers count milliseconds; one that is late by less than one is not early
        return -(-(newest + self._gap) // 1000)

    def _rows(self, flow: str, found: list[tuple[int, str, str]]) -> pd.DataFrame:
        return pd.DataFrame([(flow, _stamp(t), s, m) for t, s, m in found], columns=EVENTS.names)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = self._state.get() if self._state.exists() else None
        newest, told = held if held else (None, False)
        before, found = newest, []
        times = sorted(t for chunk in rows for t in chunk["micros"].tolist())
        for t in times:
            if newest is None:
                newest = t
                continue
            if t <= newest:
                continue
            if t - newest > self._gap:
                if not told:
                    found.append((newest + self._gap, "warning", SILENT))
                found.append((t, "success", RECOVERED))
            newest, told = t, False
        if newest != before:
            if before is not None and not (held and held[1]):
                self._handle.deleteTimer(self._timer(before))
            self._handle.registerTimer(self._timer(newest))
        self._state.update((newest, told))
        yield self._rows(key[0], found)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        newest, told = self._state.get()
        found = []
        if not told and self._timer(newest) <= expiredTimerInfo.getExpiryTimeInMs():
            found.append((newest + self._gap, "warning", SILENT))
            self._state.update((newest, True))
        yield self._rows(key[0], found)

    def close(self) -> None:
        pass


def silences(stream: DataFrame, flow: str, time: str, gap: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """flow, at, severity, message: an alert where a flow has had no record for ``gap``, and a recovery at its next one.

    Every gap gives one alert, at its beginning plus ``gap``, and one recovery if the flow comes back, however
    the stream is cut into micro-batches: what a batch holds is told from its rows, what is still silent when it
    ends from a timer, once the watermark (the newest time of all flows, less ``delay``) has passed it. Rows
    later than ``delay`` are dropped; rows without flow or time are no records of a flow. Meant for few flows: a
    call into Python per flow and micro-batch, a number and a mark of state. Needs the RocksDB state store.
    """
    seconds = F.expr(f"interval {gap}")
    (row,) = stream.sparkSession.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + seconds).alias("m")).collect()
    timed = stream.where(F.col(flow).isNotNull()).select(F.col(flow).alias("flow"), F.col(time).alias("at")).withWatermark("at", delay)
    timed = timed.where(F.col("at").isNotNull()).select("flow", "at", F.unix_micros("at").alias("micros"))
    return timed.groupBy("flow").transformWithStateInPandas(_Silence(row.m), outputStructType=EVENTS, outputMode="append", timeMode="eventTime")
