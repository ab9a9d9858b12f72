"""One huge COCO document, read by byte ranges.

A JSON document has no record borders that a range could find alone: a bracket may stand inside a string. So the file is
looked at twice. First every range counts its brackets and quotes for both cases, starting inside a string and outside,
and names the arrays it may open. Those few numbers a range are chained on the driver, which gives each range its true
start: in a string or not, how deep, in which array. Then every range gives the records that start in it, reading on past
its end for the last one, as JSON text that Spark parses. No task holds more than a range and one record; a task reads many short ranges in turn, and an array's
records are looked for only in the ranges that it reaches into. A document in gzip members that tell their sizes (``.gz``) is read
in the same way: its places are those of its text.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from annoframe.members import Members
from annoframe.schemas import COCO_ANNOTATION, COCO_CATEGORIES, COCO_IMAGES

RANGE_BYTES = 64 << 20
#: A task reads ranges one after the other, up to so many bytes, once there are this many tasks.
TASK_BYTES, MANY_TASKS = 64 << 20, 64
#: Bytes before a place in which the name of an array that opens there is looked for.
LOOK_BACK = 4096
BATCH = 4096
QUOTE, BACKSLASH = 34, 92
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_MARK = _STEP != 0
_MARK[QUOTE] = True
_NAME = re.compile(rb'"([^"\\]*)"\s*:\s*$')


@dataclass(frozen=True)
class Range(InputPartition):
    """Bytes ``lo .. hi - 1`` of a document, the state before them, and the arrays that may have records in them."""

    path: str
    lo: int
    hi: int
    quoted: bool = False
    depth: int = 0
    array: str = ""
    holds: tuple[str, ...] = ()
    #: A packed document's member before the range, by its place in the text and in the file.
    member: tuple[int, int] = (0, 0)


@dataclass(frozen=True)
class Ranges(InputPartition):
    """Ranges of one task."""

    parts: tuple[Range, ...]


class _File:
    def __init__(self, path: str, member: tuple[int, int] = (0, 0)):
        self.system, self.name = fs.FileSystem.from_uri(path)
        self.stream = self.system.open_input_file(self.name)
        if path.endswith(".gz"):
            self.stream = Members(self.stream, member)

    def read(self, lo: int, hi: int) -> bytes:
        return self.stream.read_at(max(0, hi - lo), lo)

    def with_look_back(self, lo: int, hi: int) -> tuple[bytes, int]:
        """The bytes up to ``hi`` from some place before ``lo`` that is not among backslashes, and that place."""
        back = LOOK_BACK
        while True:
            at = max(0, lo - back)
            data = self.read(at, hi)
            if at == 0 or data[:1] != b"\\":
                return data, at
            back *= 2


def _marks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of brackets and of quotes that no backslash escapes, and +1, -1 or 0 for them."""
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(_MARK[raw])
    quotes = at[raw[at] == QUOTE]
    escaped = quotes[(quotes > 0) & (raw[np.maximum(quotes - 1, 0)] == BACKSLASH)]
    if len(escaped):
        slash = np.flatnonzero(raw == BACKSLASH)
        # The first of each run of backslashes, and so how many stand before a quote.
        head = slash[np.append(True, np.diff(slash) > 1)]
        run = escaped - head[np.searchsorted(head, escaped, side="right") - 1]
        at = np.setdiff1d(at, escaped[run % 2 == 1], assume_unique=True)
    return at, _STEP[raw[at]]


def _opened(data: bytes, at: int) -> str | None:
    """The name of the member whose value opens at ``at``."""
    found = _NAME.search(data[max(0, at - LOOK_BACK) : at])
    return found[1].decode("utf-8", "replace") if found else None


class _Walk:
    """The marks of a stretch, with what is quoted and how deep it is, from a given state."""

    def __init__(self, data: bytes, skip: int, quoted: bool, depth: int):
        at, step = _marks(data)
        self.at, step = at[at >= skip], step[at >= skip]
        self.quoted = (np.cumsum(step == 0) + quoted) % 2 == 1
        self.step = np.where(self.quoted, 0, step)
        self.after = depth + np.cumsum(self.step, dtype=np.int64)
        self.before = self.after - self.step
        self.ends_quoted = bool(self.quoted[-1]) if len(at := self.at) else quoted
        self.square = np.frombuffer(data, np.uint8)[at] == ord("[")

    def arrays(self, data: bytes, depth: int) -> list[tuple[int, str]]:
        """(place, name) of the members that open an array at ``depth``."""
        places = self.at[(self.step == 1) & self.square & (self.before == depth)].tolist()
        return [(p, name) for p in places if (name := _opened(data, p)) is not None]


def _summary(part: Range) -> list[dict]:
    """For a start outside and inside a string: depth gained, state after, and the arrays opened at the least depth."""
    file = _File(part.path, part.member)
    data, at = file.with_look_back(part.lo, part.hi)
    out = []
    for quoted in (False, True):
        walk = _Walk(data, part.lo - at, quoted, 0)
        moves = np.flatnonzero(walk.step)
        opened: list[tuple[int, str]] = []
        if len(moves):
            lows = np.where(walk.step == 1, walk.before, walk.after)[moves]
            # What closes last may be the document itself; nothing opens after it.
            lows = lows[:-1] if walk.step[moves[-1]] < 0 else lows
            # An array of the document opens where nothing shallower than the document's members is.
            depth = 1 if part.lo == 0 or not len(lows) else int(lows.min())
            opened = [(depth, name) for _, name in walk.arrays(data, depth)]
        out.append({"gain": int(walk.after[-1]) if len(walk.after) else 0, "quoted": walk.ends_quoted, "opened": opened})
    return out


def _records(part: Range, wanted: str) -> Iterator[tuple[int, bytes]]:
    file = _File(part.path, part.member)
    data, at = file.with_look_back(part.lo, part.hi)
    walk = _Walk(data, part.lo - at, part.quoted, part.depth)
    opened = walk.arrays(data, 1)
    places = np.array([p for p, _ in opened], np.int64)
    names = [part.array] + [n for _, n in opened]
    starts = walk.at[(walk.step == 1) & ~walk.square & (walk.before == 2)]
    ends = walk.at[(walk.step == -1) & (walk.after == 2)]
    upto = np.searchsorted(ends, starts)
    own = np.searchsorted(places, starts)
    for start, e, o in zip(starts.tolist(), upto.tolist(), own.tolist()):
        if names[o] != wanted:
            continue
        yield at + start, data[start : ends[e] + 1] if e < len(ends) else _beyond(file, at + start)


def _beyond(file: _File, start: int) -> bytes:
    """A record that ends after its range."""
    more = 1 << 20
    while True:
        data = file.read(start, start + more)
        walk = _Walk(data, 0, False, 0)
        closed = np.flatnonzero((walk.step == -1) & (walk.after == 0))
        if len(closed):
            return data[: walk.at[closed[0]] + 1]
        if len(data) < more:
            raise ValueError(f"a record at byte {start} has no end")
        more *= 2


class _Reader(DataSourceReader):
    def __init__(self, parts: list[Range], wanted: str):
        self.parts, self.wanted = parts, wanted

    def partitions(self) -> list[Ranges]:
        most = max((p.hi - p.lo for p in self.parts), default=1)
        n = max(1, min(TASK_BYTES // most, len(self.parts) // MANY_TASKS))
        # Without a range there is one empty task.
        return [Ranges(tuple(self.parts[i : i + n])) for i in range(0, max(1, len(self.parts)), n)]

    def read(self, task: Ranges) -> Iterator[pa.RecordBatch]:
        for part in task.parts:
            yield from self._range(part)

    def _range(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not self.wanted:
            text = json.dumps(_summary(part))
            yield pa.RecordBatch.from_pydict({"pos": pa.array([part.lo], pa.int64()), "value": pa.array([text])})
            return
        held: list[tuple[int, bytes]] = []
        for record in _records(part, self.wanted):
            held.append(record)
            if len(held) == BATCH:
                yield self._batch(held)
                held = []
        yield self._batch(held)

    @staticmethod
    def _batch(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        values = pa.array([v for _, v in held], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in held], pa.int64()), values], ["pos", "value"])


class CocoDocument(DataSource):
    """``pos, value``: the records of one array (option ``array``) by the ranges of option ``ranges``; without an array, the
    summary of each range."""

    @classmethod
    def name(cls) -> str:
        return "coco_document"

    def schema(self) -> str:
        return "pos bigint, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader([Range(**r) for r in json.loads(self.options["ranges"])], self.options.get("array", ""))


def _read(spark: SparkSession, parts: list[Range], array: str = "") -> DataFrame:
    return spark.read.format("coco_document").option("ranges", json.dumps([asdict(p) for p in parts])).option("array", array).load()


def ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> list[Range]:
    """The ranges of a file with their true start states. A document that does not close is refused."""
    spark.dataSource.register(CocoDocument)
    system, name = fs.FileSystem.from_uri(path)
    size = system.get_file_info(name).size
    if not size:
        raise ValueError(f"no COCO document at {path}")
    places = _File(path).stream.places() if path.endswith(".gz") else [(0, 0)]
    size = places[-1][0] or size
    parts = [
        Range(path, lo, min(size, lo + range_bytes), member=places[max(0, bisect_right(places, (lo - LOOK_BACK, 0)) - 1)])
        for lo in range(0, size, range_bytes)
    ]
    seen = {r["pos"]: json.loads(r["value"]) for r in _read(spark, parts).collect()}
    out, quoted, depth, array = [], False, 0, ""
    for part in parts:
        found = seen[part.lo][quoted]
        opened = [name for at, name in found["opened"] if depth + at == 1]
        out.append(Range(path, part.lo, part.hi, quoted, depth, array, (array, *opened), part.member))
        array = opened[-1] if opened else array
        depth, quoted = depth + found["gain"], found["quoted"]
    if quoted or depth:
        raise ValueError(f"{path} is no whole JSON document")
    return out


def read_coco_document(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(images, categories, annotations)`` of one COCO document of any size, as ``coco.read_coco`` gives them; ``pos`` is
    the byte place of an annotation, which orders like its place in the list."""
    parts = ranges(spark, path, range_bytes)

    def records(array: str, kind: str) -> DataFrame:
        element = kind.removeprefix("array<").removesuffix(">") if kind.startswith("array<") else kind
        rows = _read(spark, [p for p in parts if array in p.holds], array)
        # The generator parses a text once; a filter on its members would parse it again for each of them.
        return rows.select("pos", F.inline(F.array(F.from_json("value", element))))

    return records("images", COCO_IMAGES).drop("pos"), records("categories", COCO_CATEGORIES).drop("pos"), records("annotations", COCO_ANNOTATION)
