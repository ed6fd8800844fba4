"""Streams with state: rename histories whatever the order of arrival."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import Row

from evgraph.sources import records
from evgraph.streaming import observations as streams

START = datetime(2024, 1, 1)
SCHEMA = "account string, alias string, observed_at timestamp"


def drained(frame, tmp_path, name):
    query = frame.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination(240)
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p.get("stateOperators", []))
    return frame.sparkSession.table(name).collect(), dropped


def written(spark, tmp_path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/batch={i:02d}")
    return spark.readStream.schema(SCHEMA + ", batch int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_within_the_watermark_gives_the_history(spark, tmp_path, seed):
    dice = random.Random(seed)
    events = [(dice.choice("uvw"), dice.choice(["a", "b", "c"]), START + timedelta(minutes=10 * i + dice.randrange(3))) for i in range(40)]
    events += [("u", "a", START + timedelta(minutes=400)), ("u", "b", START + timedelta(minutes=400)), ("v", None, START)]
    arriving = sorted(events, key=lambda e: e[2] + timedelta(minutes=dice.randrange(0, 100)))
    end = [("end", "x", START + timedelta(days=3))]
    stream = written(spark, tmp_path, [arriving[i : i + 11] for i in range(0, len(arriving), 11)] + [end])
    got, dropped = drained(streams.alias_intervals(stream, late="2 hours"), tmp_path, f"order{seed}")
    want = records.alias_history(spark.createDataFrame([e for e in events if e[1]], SCHEMA)).filter("valid_to IS NOT NULL").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and dropped == 0


def test_silent_accounts_leave(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    batches = [[("u", "a", at(0)), ("u", "b", at(1)), ("v", "x", at(2))], [("w", "z", at(90))], [("w", "z", at(90))], [("u", "old", at(3)), ("u", "c", at(91))], [("w", "z", at(300))]]
    got, dropped = drained(streams.alias_intervals(written(spark, tmp_path, batches), late="1 hours", idle="1 days"), tmp_path, "silent")
    assert sorted(map(tuple, got), key=repr) == sorted([("u", "a", at(0), at(1)), ("u", "b", at(1), None), ("v", "x", at(2), None), ("u", "c", at(91), None), ("w", "z", at(90), None)], key=repr)
    assert dropped == 1


def test_waiting_events_are_few_values_of_the_state(spark, tmp_path, monkeypatch):
    """The state costs a call for each value: an account's events of a batch wait in one, in several beyond CHUNK."""
    from evgraph.streaming.observations import AliasHistory

    class Values(list):
        appendValue = list.append
        appendList = list.extend

    class Handle:
        def getListState(self, name, schema):
            return Values()

        def getValueState(self, name, schema):
            return None

        def registerTimer(self, at):
            self.at = at

    monkeypatch.setattr(streams, "CHUNK", 100, raising=False)
    history, handle = AliasHistory(10**15), Handle()
    history.init(handle)
    rows = [Row(account="u", alias=None if i == 7 else f"a{i}", observed_at=None if i == 8 else datetime(2024, 1, 1, 0, 0, 0, i, tzinfo=UTC)) for i in range(252)]
    assert list(history.handleInputRows(("u",), iter(rows), None)) == []
    start = int(datetime(2024, 1, 1, tzinfo=UTC).timestamp())
    assert [len(at) for at, _ in history.waiting] == [100, 100, 50] and handle.at == start * 1000
    assert history.waiting[0][0][:9] == [start * 10**6 + i for i in (*range(7), 9, 10)] and history.waiting[2][1][-1] == "a251"
