"""Stateful stream operators on event time (ST2, ST5, ST7-ST9, ST11-ST13, ST15) and running streams.

Rows of a key are held until the watermark has passed them and are then taken in time order, so the
result equals the batch form whatever the arrival order. A key's memory is a small JSON text; only
rows the watermark has not passed are kept beside it.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from annoframe.session import scratch_dir
from annoframe.streaming.logs import LOST_S, STALLED_S

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEVER = None
#: Rows of a key that wait beside its memory, and the most in one entry of the map that holds more.
FEW, RUN = 32, 256
#: Outputs that are given at a time.
OUTPUTS = 10_000
#: Key of the record that closes a stream: the least 32-bit number, which is a value of every key type (as text for strings).
CLOSED = -(1 << 31)

# A rule has ``row(memory, row) -> outputs``, called in time order, and ``quiet(memory, now_us) ->
# (outputs, next time to look)``, called before each row and when the watermark has moved. Both change
# the memory in place. Outputs are tuples of the output schema without the key columns.


class Throttle:
    """Keep the first row, then each first one at least ``interval_s`` after the last kept."""

    output = "identity bigint, us bigint"

    def __init__(self, interval_s: float) -> None:
        if not interval_s > 0:
            raise ValueError(f"interval_s must be positive, got {interval_s}")
        self.step = int(round(interval_s * 1e6))

    def row(self, memory: dict, row: dict) -> list[tuple]:
        if "last" in memory and row["us"] < memory["last"] + self.step:
            return []
        memory["last"] = row["us"]
        return [(row["identity"], row["us"])]

    def quiet(self, memory: dict, now: int) -> tuple[list[tuple], int | None]:
        return [], NEVER


class LineCrossing:
    """A point of a track moves over a line: ``in`` from its left to its right side, else ``out``."""

    output = "us bigint, frame bigint, direction string"

    def __init__(self, line: tuple[float, float, float, float]) -> None:
        self.line = tuple(map(float, line))

    @staticmethod
    def _cross(ax, ay, bx, by, px, py) -> float:
        return (bx - ax) * (py - ay) - (by - ay) * (px - ax)

    def row(self, memory: dict, row: dict) -> list[tuple]:
        ax, ay, bx, by = self.line
        x, y, before = row["x"], row["y"], memory.get("at")
        memory["at"] = [x, y]
        if before is None:
            return []
        was, now = self._cross(ax, ay, bx, by, *before) > 0, self._cross(ax, ay, bx, by, x, y) > 0
        meets = self._cross(*before, x, y, ax, ay) * self._cross(*before, x, y, bx, by) <= 0
        return [(row["us"], row["frame"], "in" if now else "out")] if was != now and meets else []

    def quiet(self, memory: dict, now: int) -> tuple[list[tuple], int | None]:
        return [], NEVER


def _in_ring(x: float, y: float, ring: Sequence[tuple[float, float]]) -> bool:
    odd = False
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


class ZoneMoves:
    """Entries and exits of a track per zone; ``zones`` maps a zone to its ring."""

    output = "zone string, us bigint, frame bigint, event string"

    def __init__(self, zones: dict[str, Sequence[tuple[float, float]]]) -> None:
        self.zones = zones

    def row(self, memory: dict, row: dict) -> list[tuple]:
        out = []
        for zone, ring in self.zones.items():
            inside = _in_ring(row["x"], row["y"], ring)
            if inside != memory.get(zone, False):
                out.append((zone, row["us"], row["frame"], "entry" if inside else "exit"))
            memory[zone] = inside
        return out

    def quiet(self, memory: dict, now: int) -> tuple[list[tuple], int | None]:
        return [], NEVER


class Dwell:
    """One event at entry + limit for each stay in a zone that lasts so long."""

    output = "zone string, entered bigint, due bigint"

    def __init__(self, zones: dict[str, Sequence[tuple[float, float]]], limit_s: float) -> None:
        self.zones, self.limit = zones, int(limit_s * 1e6)

    def row(self, memory: dict, row: dict) -> list[tuple]:
        for zone, ring in self.zones.items():
            if not _in_ring(row["x"], row["y"], ring):
                memory.pop(zone, None)
            elif zone not in memory:
                memory[zone] = [row["us"], False]
        return []

    def quiet(self, memory: dict, now: int) -> tuple[list[tuple], int | None]:
        out, waiting = [], []
        for zone, stay in memory.items():
            due = stay[0] + self.limit
            if not stay[1] and due <= now:
                out.append((zone, stay[0], due))
                stay[1] = True
            elif not stay[1]:
                waiting.append(due)
        return out, min(waiting, default=None)


class Appearance:
    """The first frame of each class of a track."""

    output = "name string, us bigint, frame bigint"

    def row(self, memory: dict, row: dict) -> list[tuple]:
        seen = memory.setdefault("seen", [])
        if row["name"] in seen:
            return []
        seen.append(row["name"])
        return [(row["name"], row["us"], row["frame"])]

    def quiet(self, memory: dict, now: int) -> tuple[list[tuple], int | None]:
        return [], NEVER


class StreamState:
    """Running, paused, stalled after 30 s of nothing, lost after 10 minutes."""

    output = "us bigint, state string"

    def row(self, memory: dict, row: dict) -> list[tuple]:
        said = "paused" if row["kind"] == "status" else "running"
        fresh = memory.get("said") != said or memory.get("told", 0) > 0
        memory.update(said=said, last=row["us"], told=0)
        return [(row["us"], said)] if fresh else []

    def quiet(self, memory: dict, now: int) -> tuple[list[tuple], int | None]:
        out = []
        for level, (seconds, state) in enumerate(((STALLED_S, "stalled"), (LOST_S, "lost"))):
            if "last" not in memory or memory["told"] > level:
                continue
            at = memory["last"] + seconds * 1_000_000
            if at >= now:
                return out, at + 1000
            out.append((at, state))
            memory["told"] = level + 1
        return out, NEVER


class InOrder(StatefulProcessor):
    """Holds a key's rows until the watermark has passed them, then applies a rule in time order.

    A call to the state store costs far more than a row, so few waiting rows stay beside the key's memory; more of them
    go, sorted by time, into runs in a map. Only the runs that the watermark has reached are read, and only one it stands
    in is written back, so the work on a key is linear in its rows however many of them wait.
    """

    def __init__(self, rule, keys: Sequence[str], fields: Sequence[str], order: str) -> None:
        self.rule, self.keys, self.fields = rule, list(keys), list(fields)
        self.us, self.order = self.fields.index("us"), self.fields.index(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "run bigint", "rows string")
        self.memory = handle.getValueState("memory", "m string, few string, runs string")

    def _frame(self, key, outputs: list[tuple]) -> pd.DataFrame:
        names = [part.split()[0] for part in self.rule.output.split(", ")]
        return pd.DataFrame([(*key, *o) for o in outputs], columns=[*self.keys, *names])

    def _recall(self) -> tuple[dict, list[list], dict[int, int]]:
        """What the rule remembers, the few rows beside it, and the waiting runs with the earliest time (ms) in each."""
        kept = self.memory.get()
        if kept is None:
            return {}, [], {}
        return json.loads(kept[0]), json.loads(kept[1]), {int(n): first for n, first in json.loads(kept[2]).items()}

    def _remember(self, memory: dict, few: list[list], runs: dict[int, int]) -> None:
        self.memory.update((json.dumps(memory), json.dumps(few), json.dumps(runs)))

    def _place(self, row: list) -> tuple:
        return row[self.us], row[self.order]

    def _first(self, few: list[list], runs: dict[int, int]) -> int | None:
        """The earliest time (ms) of a waiting row."""
        return min([row[self.us] // 1000 for row in few] + list(runs.values()), default=None)

    def _hold(self, run: int, rows: list[list], runs: dict[int, int]) -> None:
        self.pending.updateValue((run,), (json.dumps(rows),))
        runs[run] = min(row[self.us] for row in rows) // 1000

    def _due(self, few: list[list], runs: dict[int, int], mark: int) -> Iterator[list]:
        """The rows the watermark has passed, in order, taken out of what waits. Runs are opened when their time comes."""
        heap: list[tuple] = []
        count = 0

        def add(rows: list[list]) -> list[list]:
            nonlocal count
            for row in rows:
                if row[self.us] // 1000 < mark:
                    heapq.heappush(heap, (*self._place(row), count, row))
                    count += 1
            return [row for row in rows if row[self.us] // 1000 >= mark]

        few[:] = add(few)
        for run in sorted((n for n, first in runs.items() if first < mark), key=lambda n: (runs[n], n)):
            while heap and heap[0][0] // 1000 < runs[run]:
                yield heapq.heappop(heap)[-1]
            later = add(json.loads(self.pending.getValue((run,))[0]))
            if later:
                self._hold(run, later, runs)
            else:
                self.pending.removeKey((run,))
                del runs[run]
        while heap:
            yield heapq.heappop(heap)[-1]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = [row for pdf in rows for row in map(list, zip(*[pdf[f].tolist() for f in self.fields]))]
        if fresh:
            for row in fresh:
                row[self.us] = int(row[self.us])
            memory, few, runs = self._recall()
            few += fresh
            if len(few) > FEW:
                few.sort(key=self._place)
                last = max(runs, default=-1)
                for n, at in enumerate(range(0, len(few), RUN), 1):
                    self._hold(last + n, few[at : at + RUN], runs)
                few = []
            self._remember(memory, few, runs)
            self.handle.registerTimer(self._first(few, runs) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        memory, few, runs = self._recall()
        outputs: list[tuple] = []
        for values in self._due(few, runs, mark):
            row = dict(zip(self.fields, values))
            outputs += self.rule.quiet(memory, row["us"])[0]
            outputs += self.rule.row(memory, row)
            if len(outputs) >= OUTPUTS:
                yield self._frame(key, outputs)
                outputs = []
        told, look = self.rule.quiet(memory, mark * 1000)
        outputs += told
        self._remember(memory, few, runs)
        first = self._first(few, runs)
        waits = ([] if first is None else [first + 1]) + ([] if look is None else [look // 1000])
        if waits:
            self.handle.registerTimer(max(min(waits), mark + 1))
        if outputs:
            yield self._frame(key, outputs)

    def close(self) -> None:
        pass


def apply_rule(stream: DataFrame, rule, keys: Sequence[str], delay: str = "0 seconds", order: str = "identity") -> DataFrame:
    """Run a rule per key over a stream with a ``time`` column; output is appended once settled."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream.withColumn("us", F.unix_micros("time"))
    if not _has_watermark(stream):
        rows = rows.withWatermark("time", delay)
    fields = [f for f in rows.columns if f not in keys and f != "time"]
    output = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys) + ", " + rule.output
    processor = InOrder(rule, keys, fields, order)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )


def _has_watermark(stream: DataFrame) -> bool:
    return "spark.watermarkDelayMs" in (stream.schema["time"].metadata or {})


def with_time(df: DataFrame, us: str = "us", name: str = "time") -> DataFrame:
    return df.withColumn(name, F.timestamp_micros(us)).drop(us)


class Closing:
    """A second source beside a bounded stream, whose only record moves the watermark past all of its rows.

    The record is written when everything has been read, so it can never make a row late; it has ``CLOSED`` for its keys
    and null elsewhere, and what a query makes of it is left out of its result.
    """

    def __init__(self, stream: DataFrame, keys: Sequence[str], delay_s: float = 0.0, after_s: float = 0.0) -> None:
        """``after_s``: how long after the last row the stream is to end (a window's length lets all windows close)."""
        self.spark, self.schema, self.keys = stream.sparkSession, stream.schema, list(keys)
        self.delay_s, self.after_s = delay_s, after_s
        self.folder = f"{scratch_dir(self.spark).rstrip('/')}/closing-{uuid.uuid4().hex}"
        self._rows().limit(0).write.parquet(self.folder)
        end = self.spark.readStream.schema(self.schema).parquet(self.folder)
        self.stream = stream.unionByName(end).withWatermark("time", f"{int(delay_s * 1000)} milliseconds")

    def _rows(self, us: int = 0) -> DataFrame:
        value = lambda f: F.timestamp_micros(F.lit(us)) if f.name == "time" else F.lit(CLOSED if f.name in self.keys else None)
        return self.spark.range(1).select(*[value(f).cast(f.dataType).alias(f.name) for f in self.schema])

    def write(self, watermark_ms: int) -> None:
        ends_ms = watermark_ms + 1 + int((2 * self.delay_s + self.after_s) * 1000)
        self._rows(ends_ms * 1000).write.mode("append").parquet(self.folder)

    def without(self, result: DataFrame) -> DataFrame:
        for key in self.keys:
            result = result.where(F.col(key).isNull() | (F.col(key) != F.lit(CLOSED).cast(result.schema[key].dataType))) if key in result.columns else result
        return result


def run_stream(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None] | None = None,
    closing: Closing | None = None,
    then: Callable[[], None] | None = None,
) -> DataFrame | None:
    """Run a stream over all it can read now and return what it appended as a table.

    Output and checkpoint lie in the shared scratch folder. With ``write`` each micro-batch goes to the caller's function
    instead (ST15). With ``closing`` the query is then resumed from its checkpoint for the record that closes the stream,
    and with ``then`` it is stopped, the function called, and the query resumed for what has come since.
    """
    spark = stream.sparkSession
    base = f"{scratch_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"

    def run() -> int | None:
        """Read all there is; the last watermark in milliseconds."""
        writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        query = writer.foreachBatch(write).start() if write else writer.format("parquet").option("path", f"{base}/out").start()
        query.awaitTermination()
        marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
        return int(datetime.fromisoformat(max(marks)).timestamp() * 1000) if marks else None

    mark = run()
    if then is not None:
        then()
        mark = run() or mark
    if closing is not None and mark is not None:
        closing.write(mark)
        run()
    if write is not None:
        return None
    result = spark.read.schema(stream.schema).parquet(f"{base}/out")
    return result if closing is None else closing.without(result)
