"""Stateful streams: rows in any order and many batches give the batch result, closed behind the last row, read once."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest

from annoframe.streaming import state

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def write_batches(spark, folder, rows, parts):
    """One file per micro-batch."""
    for i in range(parts):
        spark.createDataFrame(rows[i::parts] if parts > 1 else rows, "session long, time timestamp, identity long").coalesce(1).write.parquet(f"{folder}/{i}")


def read(spark, folder):
    reader = spark.readStream.schema("session long, time timestamp, identity long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return reader.parquet(str(folder))


def throttled(rows, step):
    out = []
    for session in {r[0] for r in rows}:
        last = None
        for _, time, identity in sorted((r for r in rows if r[0] == session), key=lambda r: (r[1], r[2])):
            if last is None or (time - last).total_seconds() >= step:
                last = time
                out.append((session, identity))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 4])
def test_late_rows_in_many_batches_equal_the_batch_result(spark, tmp_path, parts):
    rng = random.Random(parts)
    # One session has a third of all rows; rows come at most half an hour late.
    rows = [(rng.choice([0, 0, 1, 2, 3, 4]), START + timedelta(seconds=60 * i + rng.randrange(-1500, 1500)), i) for i in range(400)]
    write_batches(spark, tmp_path, rows, parts)
    closing = state.Closing(read(spark, tmp_path), ["session"], delay_s=86400)
    out = state.run_stream(state.apply_rule(closing.stream, state.Throttle(900), ["session"]), closing=closing)
    assert sorted((r.session, r.identity) for r in out.collect()) == throttled(rows, 900)


def test_without_closing_the_last_row_waits(spark, tmp_path):
    rows = [(1, START, 1), (1, START + timedelta(hours=1), 2)]
    write_batches(spark, tmp_path, rows, 1)
    rule = lambda s: state.apply_rule(s, state.Throttle(1), ["session"])
    assert [r.identity for r in state.run_stream(rule(read(spark, tmp_path))).collect()] == [1]
    closing = state.Closing(read(spark, tmp_path), ["session"])
    assert sorted(r.identity for r in state.run_stream(rule(closing.stream), closing=closing).collect()) == [1, 2]


class FakeHandle:
    """A key's state kept in a dict, counting the rows that are read from it."""

    def __init__(self):
        self.map, self.value, self.timer, self.read = {}, None, None, 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        outer = self

        class Value:
            exists = lambda _: outer.value is not None
            get = lambda _: outer.value

            def update(_, v):
                outer.value = v

        return Value()

    def containsKey(self, k):
        return k in self.map

    def getValue(self, k):
        self.read += len(json.loads(self.map[k][0]))
        return self.map[k]

    def updateValue(self, k, v):
        self.map[k] = v

    def removeKey(self, k):
        del self.map[k]

    def registerTimer(self, at):
        self.timer = at


class Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_hot_key_reads_each_waiting_row_about_once():
    """500 batches of 20 rows with an hour of rows waiting all the time: a pending list would be read 500 times."""
    handle, out = FakeHandle(), []
    processor = state.InOrder(state.Throttle(60), ["session"], ["identity", "us"], "identity")
    processor.init(handle)
    for batch in range(500):
        times = [(batch * 20 + i) * 3_000_000 for i in range(20)]
        pdf = pd.DataFrame({"identity": range(batch * 20, batch * 20 + 20), "us": times})
        list(processor.handleInputRows((1,), iter([pdf]), None))
        mark = times[-1] // 1000 - 3_600_000
        if handle.timer is not None and handle.timer <= mark:
            handle.timer = None
            out += list(processor.handleExpiredTimer((1,), Mark(mark), None))
    assert handle.read < 3 * 10_000
    last = times[-1] // 1000 + 1
    out += list(processor.handleExpiredTimer((1,), Mark(last), None))
    assert [i for pdf in out for i in pdf["identity"].tolist()] == list(range(0, 10_000, 20))
    assert not handle.map


class CountedHandle(FakeHandle):
    """Also counts the calls to the state store."""

    def __init__(self):
        super().__init__()
        self.calls = 0

    def __getattribute__(self, name):
        if name in ("containsKey", "getValue", "updateValue", "removeKey", "registerTimer"):
            self.calls += 1
        return super().__getattribute__(name)


@pytest.mark.parametrize("rows", [20, 5_000])
def test_rows_of_far_apart_minutes_take_few_state_calls(rows):
    """Rows an hour apart: an entry for each minute would be several calls for each row."""
    handle = CountedHandle()
    processor = state.InOrder(state.Throttle(60), ["session"], ["identity", "us"], "identity")
    processor.init(handle)
    order = list(range(rows))
    random.Random(rows).shuffle(order)
    for half in (order[::2], order[1::2]):
        pdf = pd.DataFrame({"identity": half, "us": [i * 3_600_000_000 for i in half]})
        list(processor.handleInputRows((1,), iter([pdf]), None))
    out = list(processor.handleExpiredTimer((1,), Mark(rows * 3_600_000), None))
    assert [i for pdf in out for i in pdf["identity"].tolist()] == list(range(rows))
    assert handle.calls <= 4 + rows / 50 and not handle.map
