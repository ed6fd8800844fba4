"""Observations as streams: duplicates within a watermark, the latest status, rename history, windowed counts."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from itertools import islice, takewhile

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues


def deduplicated(stream: DataFrame, at: str = "retrieved_at", key: str = "payload_sha256", window: str = "30 days") -> DataFrame:
    """One row of each payload within the refresh window."""
    return stream.withWatermark(at, window).dropDuplicatesWithinWatermark([key])


def latest_status(stream: DataFrame, key: str = "observation_id", at: str = "effective_at", status: str = "status") -> DataFrame:
    """The newest status of each key; for complete or update mode."""
    return stream.groupBy(key).agg(F.max_by(status, at).alias(status), F.max(at).alias(at))


def counts(stream: DataFrame, at: str, kind: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Numbers and sums of observations by window and kind, with late data up to a limit."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


#: Events in one value of the state.
CHUNK = 10_000
EPOCH, MICRO = datetime(1970, 1, 1, tzinfo=UTC), timedelta(microseconds=1)


class AliasHistory(StatefulProcessor):
    """Renames of one account: events wait in a list until the watermark has passed them, then they are settled in order of time and
    alias; the alias that holds is a value. An account that is silent for `idle` microseconds leaves: its open interval is put out
    with no end, and nothing of it is kept.

    The state costs a call for each value, so events wait in arrays, at most CHUNK in one. Rows, not frames, go in and out, since a
    frame for each account costs more than all else. Times are microseconds."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "observed_at array<bigint>, alias array<string>")
        self.held = handle.getValueState("held", "alias string, since bigint, last bigint")

    def _ring(self, at: int) -> None:
        self.handle.registerTimer(at // 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        events = (((at - EPOCH) // MICRO, alias) for alias, at in ((r["alias"], r["observed_at"]) for r in rows) if alias is not None and at is not None)
        first = None
        while some := list(islice(events, CHUNK)):
            at, names = map(list, zip(*some, strict=True))
            self.waiting.appendValue((at, names))
            first = min(at) if first is None else min(first, *at)
        if first is not None:
            self._ring(first)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(x for at, names in self.waiting.get() for x in zip(at, names, strict=True))
        ready = list(takewhile(lambda x: x[0] <= mark, waiting))
        later = waiting[len(ready) :]
        alias, since, last = self.held.get() or (None, None, None)
        out = []
        for at, name in ready:
            if last is not None and at - last > self.idle:
                out.append((alias, since, None))
                alias = None
            if name != alias:
                if alias is not None:
                    out.append((alias, since, at))
                alias, since = name, at
            last = at
        if ready:
            self.waiting.clear()
            for i in range(0, len(later), CHUNK):
                at, names = map(list, zip(*later[i : i + CHUNK], strict=True))
                self.waiting.appendValue((at, names))
        if later:
            self._ring(later[0][0])
        if last is not None:
            leaves = last + self.idle
            if leaves < mark:
                out.append((alias, since, None))
                self.held.clear()
            else:
                if ready:
                    self.held.update((alias, since, last))
                self._ring(leaves + 1000)
        return (Row(account=key[0], alias=name, valid_from=begin, valid_to=end) for name, begin, end in out)


def alias_intervals(stream: DataFrame, late: str = "2 hours", idle: str = "3650 days") -> DataFrame:
    """Intervals of mutable aliases (account, alias, observed_at) as renames are settled, in append mode: whatever the order that
    events arrive in, those within the watermark give the intervals that `sources.records.alias_history` gives of all of them; a
    later one is dropped and counted by the stream. An interval is put out when the next alias begins, or without an end when the
    account has been silent for `idle`, which is when its state goes. Null aliases and times are no events.

    Timers need the RocksDB state store, which is set for streams that start from now on."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = stream.select(F.col("account").cast("string").alias("account"), F.col("alias").cast("string").alias("alias"), F.col("observed_at").cast("timestamp").alias("observed_at"))
    processor = AliasHistory(int(pd.Timedelta(idle).total_seconds() * 1_000_000))
    found = rows.withWatermark("observed_at", late).groupBy("account").transformWithState(processor, "account string, alias string, valid_from bigint, valid_to bigint", "Append", "EventTime")
    return found.select("account", "alias", F.timestamp_micros("valid_from").alias("valid_from"), F.timestamp_micros("valid_to").alias("valid_to"))


def append_sink(stream: DataFrame, path: str, checkpoint: str):
    """Appends to a table of files, each row once, whatever is retried."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
