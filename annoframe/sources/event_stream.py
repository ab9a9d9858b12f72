"""Live logs as event-stream text, read as a stream with offsets of its own.

A folder holds text files that grow: blocks of ``id``, ``event`` and ``data`` lines, each ended by a blank line. An offset
is a byte place after a whole block in every file, so a block that is still being written waits, a stopped query goes on
after the last block it took, and no block comes twice. A batch of a file is cut into ranges that find their own first
block, so one long file is read by many tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

RANGE_BYTES = 16 << 20
CHUNK = 1 << 20
#: The end of a block: its last line's end and a blank line.
_END = re.compile(rb"(?:\r\n|\n)(?:\r\n|\n)")
_FIELD = re.compile(r"(id|event|data)(?:: ?(.*))?")


@dataclass(frozen=True)
class Blocks(InputPartition):
    """The blocks of a file that begin in ``lo .. hi - 1``; ``first`` says that one begins at ``lo``."""

    path: str
    lo: int
    hi: int
    end: int
    first: bool


def parse_block(text: str) -> tuple[str | None, str | None, str | None]:
    """(id, event, data) of a block. Lines of other fields and comments count for nothing; data lines are joined."""
    found: dict[str, list[str]] = {"id": [], "event": [], "data": []}
    for line in text.splitlines():
        field = _FIELD.fullmatch(line)
        if field:
            found[field[1]].append(field[2] or "")
    return (found["id"] or [None])[-1], (found["event"] or [None])[-1], "\n".join(found["data"]) if found["data"] else None


def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def last_end(path: str, size: int) -> int:
    """The place after the last whole block."""
    with _open(path) as stream:
        more = CHUNK
        while True:
            lo = max(0, size - more)
            ends = [m.end() for m in _END.finditer(stream.read_at(size - lo, lo))]
            if ends or lo == 0:
                return lo + ends[-1] if ends else 0
            more *= 2


def read_blocks(part: Blocks) -> Iterator[tuple[int, str]]:
    """(place, text) of each block."""
    with _open(part.path) as stream:
        # A range looks a little back, for a blank line may lie across its border.
        at = part.lo if part.first else max(0, part.lo - 4)
        held, skipping = b"", not part.first
        base = at  # place of ``held``
        while at < part.end or held:
            data = stream.read_at(min(CHUNK, part.end - at), at) if at < part.end else b""
            at += len(data)
            held += data
            done = 0
            for m in _END.finditer(held):
                # Two line ends may still grow to a third; a block's end is taken as it stands.
                start = base + done
                if skipping:
                    skipping = base + m.end() < part.lo
                elif start < part.hi:
                    yield start, held[done : m.start()].decode("utf-8", "replace")
                done = m.end()
                if not skipping and base + done >= part.hi:
                    return
            base, held = base + done, held[done:]
            if not data:
                return


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.after = options["path"], options.get("after")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def _files(self) -> dict[str, int]:
        system, home = fs.FileSystem.from_uri(self.folder)
        found = system.get_file_info(fs.FileSelector(home, allow_not_found=True))
        return {f.path: f.size for f in found if f.type == fs.FileType.File and f.size and f.base_name[0] not in "._"}

    def initialOffset(self) -> dict:
        """Nothing read; with option ``after`` each file is taken up behind the block of that id."""
        if self.after is None:
            return {}
        places = {}
        for path, size in self._files().items():
            end = last_end(path, size)
            for place, text in read_blocks(Blocks(path, 0, end, end, True)):
                if parse_block(text)[0] == self.after:
                    places[path] = place + 1
        if not places:
            raise ValueError(f"no record has the id {self.after}")
        return places

    def latestOffset(self) -> dict:
        return {path: last_end(path, size) for path, size in self._files().items()}

    def partitions(self, start: dict, end: dict) -> list[Blocks]:
        parts = []
        for path, stop in sorted(end.items()):
            begin = start.get(path, 0)
            for lo in range(begin, stop, self.range_bytes):
                # ``after`` points into the block it stands behind; every other start is the end of a block.
                parts.append(Blocks(path, lo, min(stop, lo + self.range_bytes), stop, lo == begin and (lo == 0 or not self._inside(path, lo))))
        return parts

    @staticmethod
    def _inside(path: str, place: int) -> bool:
        with _open(path) as stream:
            before = stream.read_at(min(4, place), max(0, place - 4))
        return not re.search(rb"(?:\r\n|\n)(?:\r\n|\n)$", before)

    def read(self, part: Blocks) -> Iterator[tuple]:
        for place, text in read_blocks(part):
            name, event, data = parse_block(text)
            if data is not None:
                yield part.path, place, name, event, data

    def commit(self, end: dict) -> None:
        pass


class EventStream(DataSource):
    """``file, place, id, event, data`` of the blocks with data under a folder."""

    @classmethod
    def name(cls) -> str:
        return "event_stream"

    def schema(self) -> str:
        return "file string, place bigint, id string, event string, data string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def read_event_stream(spark: SparkSession, folder: str, schema: str, after: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Log records of a folder of event-stream text as a stream: ``id`` and the fields of ``schema``. Events without a kind
    (pings) are left out, an error event ends the query. ``after`` starts behind the record of that id."""
    spark.dataSource.register(EventStream)
    reader = spark.readStream.format("event_stream").option("path", folder).option("rangeBytes", str(range_bytes))
    rows = (reader if after is None else reader.option("after", after)).load()
    failed = F.raise_error(F.concat(F.lit("the live log ended with an error: "), F.col("data"))).cast("string")
    record = F.from_json(F.when(F.col("event") == "error", failed).otherwise(F.col("data")), schema)
    return rows.select("id", record.alias("r")).where("r.kind IS NOT NULL").select("id", "r.*")


def to_event_stream(records: DataFrame, key: str = "identity", kind: str = "kind") -> DataFrame:
    """``value``: a block per record, for Spark's text writer, whose line end is the blank line."""
    data = F.to_json(F.struct(*[c for c in records.columns]))
    return records.select(
        F.concat(F.lit("id: "), F.col(key).cast("string"), F.lit("\nevent: "), F.col(kind), F.lit("\ndata: "), data, F.lit("\n")).alias("value")
    )
