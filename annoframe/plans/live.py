"""The stream forms of the log queries, run over the events as a file stream until it is read up.

Each runs a real streaming query, which is closed behind its last record; its twin is the batch result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.plans.datasets import ntz
from annoframe.plans.registry import query
from annoframe.plans.streams import ANNOTATED, CROSS, FITS, INSIDE, KEPT, LINE, STATES, annotated, shown_stats
from annoframe.plans.tables import Tables, sql
from annoframe.session import scratch_dir
from annoframe.streaming import logs, state

ZONES = {"box": [(10, 10), (60, 10), (60, 70), (10, 70)], "wedge": [(50, 0), (100, 50), (50, 100)]}


class LiveTables(Tables):
    """The same derived tables with the events read as a stream."""

    def raw(self, name: str) -> DataFrame:
        table = super().raw(name)
        if name != "events":
            return table
        return logs.read_log_stream(self.spark, self.dir, table.schema, names="events.parquet")


def live(t: Tables) -> LiveTables:
    return LiveTables(t.spark, t.dir)


#: The last watermark: just past the latest record.
MARK = "mark AS (SELECT epoch_ms(max(ts)) + 1 AS ms FROM events)"
HOUR = 3600.0


@query(
    "ST1_stream_filtered",
    sql(
        f"""SELECT identity, kind, len({FITS})::INT AS kept FROM ann WHERE kind IN ('frame', 'event')
        AND (kind <> 'frame' OR (frame % 2 = 0 AND len({FITS}) > 0))""",
        "log",
        more=ANNOTATED,
    ),
)
def stream_filtered(t: Tables) -> DataFrame:
    out = logs.filter_log(
        annotated(live(t).log), kinds=["frame", "event"], classes=["class_1", "class_2"], min_confidence=0.3, every=2
    )
    return state.run_stream(out.select("identity", "kind", F.size("annotations").alias("kept")))


@query("ST2_stream_each_record_once", sql("SELECT identity FROM log", "log"))
def stream_each_record_once(t: Tables) -> DataFrame:
    """Every record arrives twice, from two reads."""
    columns = ["identity", "time"]
    twice = live(t).log.select(columns).union(live(t).log.select(columns))
    return state.run_stream(logs.once(twice, "40 days").select("identity"))


@query(
    "ST4_stream_window_stats",
    sql(
        """SELECT session, time_bucket(INTERVAL 12 HOUR, time) AS start, count(*) FILTER (kind = 'frame') AS frames,
        count(*) FILTER (kind = 'event') AS events, max(latency_ms) FILTER (kind = 'frame') AS max_ms FROM log GROUP BY 1, 2""",
        "log",
    ),
)
def stream_window_stats(t: Tables) -> DataFrame:
    closing = state.Closing(live(t).log, ["session"], HOUR, 12 * HOUR)
    out = state.run_stream(logs.window_stats(closing.stream, "12 hours"), closing=closing)
    return shown_stats(out).select("session", "start", "frames", "events", "max_ms")


@query(
    "ST17_stream_late_data",
    sql(
        """SELECT time_bucket(INTERVAL 1 DAY, time) AS start, count(*) FILTER (confidence > 0.4) AS passed,
        count(*) FILTER (confidence <= 0.4) AS failed FROM log GROUP BY 1""",
        "log",
    ),
)
def stream_late_data(t: Tables) -> DataFrame:
    """Append mode holds a window back until the watermark, two days behind, has passed its end."""
    closing = state.Closing(live(t).log, ["session"], 48 * HOUR, 24 * HOUR)
    out = state.run_stream(logs.branch_counts(closing.stream, F.col("confidence") > 0.4, "1 day"), closing=closing)
    return ntz(out, "start")


@query(
    "ST6_stream_sessions_live",
    sql(
        """SELECT session, min(time) AS start, max(time) + INTERVAL 6 HOUR AS "end", count(*) AS records FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY session ORDER BY time) AS run FROM (SELECT *, CASE WHEN time >=
          lag(time) OVER (PARTITION BY session ORDER BY time) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM log))
        GROUP BY session, run""",
        "log",
    ),
)
def stream_sessions_live(t: Tables) -> DataFrame:
    closing = state.Closing(live(t).log, ["session"], HOUR, 6 * HOUR)
    return ntz(state.run_stream(logs.stream_sessions(closing.stream, "6 hours"), closing=closing), "start", "end")


@query(
    "J13_stream_events_with_captures",
    sql(
        """SELECT e.identity AS event_id, c.identity AS capture_id FROM log e JOIN log c ON c.kind = 'capture'
        AND c.identity - 7 - c.identity % 7 = e.identity AND c.time BETWEEN e.time AND e.time + INTERVAL 40 MINUTE WHERE e.kind = 'event'""",
        "log",
    ),
)
def stream_events_with_captures(t: Tables) -> DataFrame:
    from annoframe.plans.streams import events_and_captures

    events, captures = events_and_captures(live(t).log)[0], events_and_captures(live(t).log)[1]
    pairs = logs.with_captures(
        events.withWatermark("time", "1 hour"), captures.withWatermark("capture_time", "1 hour"), "40 minutes", how="inner"
    )
    return state.run_stream(pairs.select("event_id", "capture_id"))


def _kept(condition: str, seconds: int) -> str:
    return sql(
        "SELECT session, identity FROM kept", "log", recursive=True,
        more=f"src AS MATERIALIZED (SELECT * FROM log WHERE {condition}), " + KEPT.format(src="src", s=seconds),
    )


def throttled(t: Tables, condition, seconds: float, write=None) -> DataFrame | None:
    """Only chosen records move the watermark (a filter is pushed below it anyway)."""
    closing = state.Closing(live(t).log.where(condition).select("session", "time", "identity"), ["session"])
    return state.run_stream(state.apply_rule(closing.stream, state.Throttle(seconds), ["session"]), write, closing)


@query("ST7_stream_passive_capture", _kept("kind = 'frame'", 86400))
def stream_passive_capture(t: Tables) -> DataFrame:
    return throttled(t, "kind = 'frame'", 86400).select("session", "identity")


@query("ST8_stream_event_capture", _kept("kind = 'event' AND name IN ('class_1', 'class_2', 'class_3')", 43200))
def stream_event_capture(t: Tables) -> DataFrame:
    chosen = "kind = 'event' and name in ('class_1', 'class_2', 'class_3')"
    return throttled(t, chosen, 43200).select("session", "identity")


@query("ST15_stream_written_annotations", _kept("kind = 'frame' AND confidence >= 0.5", 43200))
def stream_written_annotations(t: Tables) -> DataFrame:
    """Each micro-batch is written to a folder of its own number, so a repeated batch overwrites itself."""
    base = f"{scratch_dir(t.spark).rstrip('/')}/written-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.where(F.col("session") != state.CLOSED).write.mode("overwrite").parquet(f"{base}/batch={number}")

    throttled(t, "kind = 'frame' and confidence >= 0.5", 43200, write)
    return t.spark.read.parquet(base).select("session", "identity")


@query("ST5_stream_states_live", sql("SELECT session, time, state FROM states", "log", more=STATES))
def stream_states_live(t: Tables) -> DataFrame:
    """Closed so late that every session is lost in the end, as in the batch form."""
    closing = state.Closing(live(t).log.select("session", "time", "identity", "kind"), ["session"], after_s=logs.LOST_S + 1)
    out = state.run_stream(state.apply_rule(closing.stream, state.StreamState(), ["session"]), closing=closing)
    return ntz(state.with_time(out), "time")


def track_rule(t: Tables, rule) -> DataFrame:
    closing = state.Closing(live(t).tracks, ["session", "track"])
    return state.run_stream(state.apply_rule(closing.stream, rule, ["session", "track"], order="frame"), closing=closing)


@query("ST9_stream_line_crossings", sql("SELECT * FROM crossed", "tracks", more=CROSS))
def stream_line_crossings(t: Tables) -> DataFrame:
    return ntz(state.with_time(track_rule(t, state.LineCrossing(LINE))), "time")


@query("ST11_stream_zone_moves", sql("SELECT * FROM moves", "tracks", more=INSIDE))
def stream_zone_moves(t: Tables) -> DataFrame:
    return ntz(state.with_time(track_rule(t, state.ZoneMoves(ZONES))), "time")


@query(
    "ST12_stream_dwell_events",
    sql(
        """SELECT session, track, zone, time AS entered, time + INTERVAL 2 DAY AS due FROM (SELECT *, lead(time) OVER
        (PARTITION BY session, track, zone ORDER BY time, frame) AS gone FROM moves) WHERE event = 'entry'
        AND coalesce(gone, make_timestamp((SELECT ms FROM mark) * 1000)) >= time + INTERVAL 2 DAY""",
        "tracks",
        more=f"{MARK}, {INSIDE}",
    ),
)
def stream_dwell_events(t: Tables) -> DataFrame:
    out = track_rule(t, state.Dwell(ZONES, 2 * 86400))
    return ntz(state.with_time(state.with_time(out, "entered", "entered_at"), "due", "due_at"), "entered_at", "due_at").select(
        "session", "track", "zone", F.col("entered_at").alias("entered"), F.col("due_at").alias("due")
    )


@query(
    "ST13_stream_appearances",
    sql(
        "SELECT session, track, name, min(time) AS time, arg_min(frame, time) AS frame FROM tracks GROUP BY 1, 2, 3",
        "tracks",
    ),
)
def stream_appearances(t: Tables) -> DataFrame:
    return ntz(state.with_time(track_rule(t, state.Appearance())), "time")
