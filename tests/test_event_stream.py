"""Event-stream text with offsets: every block once, wherever ranges and stops fall."""

from __future__ import annotations

import random

import pytest

from annoframe.sources import event_stream
from annoframe.streaming import state

SCHEMA = "kind string, n int"


def block(n, kind="frame", end="\n"):
    return f"id: {n}{end}event: {kind}{end}data: {{\"kind\":\"{kind}\",{end}data: \"n\":{n}}}{end}{end}"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_ranges_give_each_block_once(tmp_path, end, size):
    rng = random.Random(size)
    text = f": comment{end}retry: 5{end}{end}" + "".join(block(i, rng.choice(["frame", "é" * 9]), end) for i in range(40))
    path = tmp_path / "log.txt"
    path.write_bytes(text.encode())
    reader = event_stream._Reader({"path": str(tmp_path), "rangeBytes": str(size)})
    stop = reader.latestOffset()
    assert stop == {str(path): len(text.encode())}
    rows = [r for part in reader.partitions({}, stop) for r in reader.read(part)]
    assert [r[2] for r in rows] == [str(i) for i in range(40)]
    assert all(r[4].count("\n") == 1 for r in rows)


def test_an_unfinished_block_waits(tmp_path):
    path = tmp_path / "log.txt"
    whole = block(1) + block(2)
    path.write_text(whole + "id: 3\nevent: frame\ndata: {")
    reader = event_stream._Reader({"path": str(tmp_path)})
    first = reader.latestOffset()
    assert first == {str(path): len(whole)}
    path.write_text(whole + block(3))
    rows = [r[2] for part in reader.partitions(first, reader.latestOffset()) for r in reader.read(part)]
    assert rows == ["3"]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_start_behind_an_id(tmp_path, size):
    (tmp_path / "log.txt").write_text("".join(block(i) for i in range(9)))
    reader = event_stream._Reader({"path": str(tmp_path), "after": "4", "rangeBytes": str(size)})
    rows = [r[2] for part in reader.partitions(reader.initialOffset(), reader.latestOffset()) for r in reader.read(part)]
    assert rows == ["5", "6", "7", "8"]
    with pytest.raises(ValueError, match="no record"):
        event_stream._Reader({"path": str(tmp_path), "after": "x"}).initialOffset()


def test_stopped_query_resumes_behind_its_last_record(spark, tmp_path):
    log = tmp_path / "log.txt"
    log.write_text("".join(block(i) for i in range(20)) + ": ping\n\n" + "id: 20\nevent: fr")
    stream = event_stream.read_event_stream(spark, str(tmp_path), SCHEMA, range_bytes=100)

    def more():
        log.write_text("".join(block(i) for i in range(20)) + ": ping\n\n" + "".join(block(i) for i in range(20, 30)))
        (tmp_path / "other.txt").write_text(block(100))

    rows = state.run_stream(stream, then=more).collect()
    assert sorted(r.n for r in rows) == [*range(30), 100]


def test_an_error_event_ends_the_query(spark, tmp_path):
    (tmp_path / "log.txt").write_text(block(1) + "event: error\ndata: {\"message\":\"gone\"}\n\n")
    with pytest.raises(Exception, match="gone"):
        state.run_stream(event_stream.read_event_stream(spark, str(tmp_path), SCHEMA))
