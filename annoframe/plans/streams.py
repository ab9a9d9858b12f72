"""Queries on log records and tracks: the batch forms of F11, F12, J13, E3, S16, W7, W11 and the ST rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.plans.datasets import ntz
from annoframe.plans.detection import rounded
from annoframe.plans.registry import query
from annoframe.plans.tables import Tables, sql
from annoframe.streaming import logs

ANNOTATED = """ann AS (SELECT *, [{'name': name, 'confidence': confidence},
    {'name': 'class_' || ((k + 1) % 6), 'confidence': (100 - k) / 100}] AS annotations FROM log)"""


def annotated(log: DataFrame) -> DataFrame:
    """Two annotations a record."""
    second = F.struct(
        F.concat(F.lit("class_"), ((F.col("k") + 1) % 6).cast("string")).alias("name"), ((100 - F.col("k")) / 100).alias("confidence")
    )
    return log.withColumn("annotations", F.array(F.struct("name", "confidence"), second))


FITS = "list_filter(annotations, lambda a: a.name IN ('class_1', 'class_2') AND a.confidence >= 0.3::DOUBLE)"


@query(
    "F11_filtered_log",
    sql(
        f"""SELECT identity, kind, len({FITS})::INT AS kept FROM ann WHERE kind IN ('frame', 'event')
        AND (kind <> 'frame' OR (frame % 2 = 0 AND len({FITS}) > 0))""",
        "log",
        more=ANNOTATED,
    ),
)
def filtered_log(t: Tables) -> DataFrame:
    out = logs.filter_log(
        annotated(t.log), kinds=["frame", "event"], classes=["class_1", "class_2"], min_confidence=0.3, every=2
    )
    return out.select("identity", "kind", F.size("annotations").alias("kept"))


@query(
    "F12_filtered_run_log",
    sql(
        """SELECT identity FROM log WHERE name = 'class_3' AND k % 5 = 2 AND NOT k > 60 AND confidence >= 0.2 AND kind = 'event'""",
        "log",
    ),
)
def filtered_run_log(t: Tables) -> DataFrame:
    rows = t.log.select(
        "identity",
        F.array("name").alias("classes"),
        F.array((F.col("k") % 5).cast("string")).alias("track_ids"),
        (F.col("k") > 60).alias("condition"),
        F.col("confidence").alias("max_confidence"),
        F.col("kind").alias("type"),
    )
    return logs.filter_run_log(
        rows, class_name="class_3", track_id="2", branch=False, min_confidence=0.2, event_type="event"
    ).select("identity")


@query(
    "S16_log_history",
    sql("SELECT identity, time FROM log WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-07 12:00:00'", "log"),
)
def history(t: Tables) -> DataFrame:
    span = [F.lit(v).cast("timestamp") for v in ("2024-01-05", "2024-01-07 12:00:00")]
    return ntz(logs.log_history(t.log, *span).select("identity", "time"), "time")


@query(
    "E3_history_and_live",
    sql("SELECT DISTINCT identity, kind FROM log WHERE identity % 2 = 0 OR identity % 3 = 0", "log"),
)
def history_and_live(t: Tables) -> DataFrame:
    return logs.history_and_live(t.log.where("identity % 2 = 0"), t.log.where("identity % 3 = 0")).select("identity", "kind")


@query(
    "ST3_filled_gap",
    sql(
        """SELECT identity FROM log WHERE identity % 2 = 0 OR (time >= TIMESTAMP '2024-01-10' AND time < TIMESTAMP '2024-01-12')""",
        "log",
    ),
)
def filled_gap(t: Tables) -> DataFrame:
    span = [F.lit(v).cast("timestamp") for v in ("2024-01-10", "2024-01-12")]
    return logs.fill_gap(t.log.where("identity % 2 = 0"), t.log, *span).select("identity")


def events_and_captures(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every capture names the record seven to thirteen places before it."""
    events = log.where("kind = 'event'").select(F.col("identity").alias("event_id"), "time", "session")
    captures = log.where("kind = 'capture'").select(
        F.col("identity").alias("capture_id"), (F.col("identity") - 7 - F.col("identity") % 7).alias("event"), F.col("time").alias("capture_time")
    )
    return events, captures


@query(
    "J13_events_with_captures",
    sql(
        """SELECT e.identity AS event_id, c.identity AS capture_id FROM log e LEFT JOIN (SELECT * FROM log WHERE kind = 'capture') c
        ON c.identity - 7 - c.identity % 7 = e.identity AND c.time BETWEEN e.time AND e.time + INTERVAL 40 MINUTE WHERE e.kind = 'event'""",
        "log",
    ),
)
def events_with_captures(t: Tables) -> DataFrame:
    return logs.with_captures(*events_and_captures(t.log), within="40 minutes").select("event_id", "capture_id")


KEPT = """kept AS (SELECT session, identity, time FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY time, identity) AS r
      FROM {src}) WHERE r = 1
    UNION ALL SELECT n.session, n.identity, n.time FROM kept k, LATERAL (SELECT session, identity, time FROM {src} l
      WHERE l.session = k.session AND l.time >= k.time + INTERVAL {s} SECOND ORDER BY time, identity LIMIT 1) n)"""


def kept_sql(source: str, seconds: int) -> str:
    return sql(
        "SELECT session, identity FROM kept", "log", recursive=True, more=f"src AS MATERIALIZED ({source}), " + KEPT.format(src="src", s=seconds)
    )


@query("W7_throttled_records", kept_sql("SELECT * FROM log", 36000))
def throttled_records(t: Tables) -> DataFrame:
    return logs.throttle(t.log, 36000).select("session", "identity")


@query("ST7_passive_capture", kept_sql("SELECT * FROM log WHERE kind = 'frame'", 86400))
def passive_capture(t: Tables) -> DataFrame:
    return logs.throttle(t.log.where("kind = 'frame'"), 86400).select("session", "identity")


@query(
    "ST8_event_capture",
    kept_sql("SELECT * FROM log WHERE kind = 'event' AND name IN ('class_1', 'class_2', 'class_3')", 43200),
)
def event_capture(t: Tables) -> DataFrame:
    return logs.event_capture(t.log, ["class_1", "class_2", "class_3"], 43200).select("session", "identity")


@query("ST15_annotated_frames", kept_sql("SELECT * FROM log WHERE kind = 'frame' AND confidence >= 0.5", 43200))
def annotated_frames(t: Tables) -> DataFrame:
    return logs.annotated_frames(t.log, 43200).select("session", "identity")


@query(
    "W11_track_lifetimes",
    sql(
        """SELECT session, track, min(frame) AS first_frame, max(frame) AS last_frame, count(*) AS points, max(gap) AS longest_gap
        FROM (SELECT *, frame - lag(frame) OVER (PARTITION BY session, track ORDER BY frame) AS gap FROM tracks) GROUP BY 1, 2""",
        "tracks",
    ),
)
def track_lifetimes(t: Tables) -> DataFrame:
    return logs.track_lifetimes(t.tracks)


STATS = """SELECT session, time_bucket(INTERVAL 12 HOUR, time) AS start, count(*) FILTER (kind = 'frame') AS frames,
    count(*) FILTER (kind = 'event') AS events, count(*) FILTER (kind = 'frame' AND confidence >= 0.5) AS detections,
    round(count(*) FILTER (kind = 'frame') / 43200, 9) AS fps, round(quantile_cont(latency_ms, 0.5) FILTER (kind = 'frame'), 6) AS p50,
    round(quantile_cont(latency_ms, 0.9) FILTER (kind = 'frame'), 6) AS p90, round(quantile_cont(latency_ms, 0.99) FILTER (kind = 'frame'), 6) AS p99,
    max(latency_ms) FILTER (kind = 'frame') AS max_ms FROM log GROUP BY 1, 2"""


def shown_stats(stats: DataFrame) -> DataFrame:
    return rounded(rounded(ntz(stats, "start"), "p50", "p90", "p99", digits=6), "fps")


@query("ST4_window_stats", sql(STATS, "log"))
def window_stats(t: Tables) -> DataFrame:
    return shown_stats(logs.window_stats(t.log, "12 hours"))


RUNS = """SELECT session, min(time) AS start, max(time) + INTERVAL 6 HOUR AS "end", count(*) AS records FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY session ORDER BY time) AS run FROM (SELECT *, CASE WHEN time >=
      lag(time) OVER (PARTITION BY session ORDER BY time) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS fresh FROM log)) GROUP BY session, run"""


@query("ST6_stream_sessions", sql(RUNS, "log"))
def stream_sessions(t: Tables) -> DataFrame:
    return ntz(logs.stream_sessions(t.log, "6 hours"), "start", "end")


STATES = """line AS (SELECT session, time, identity, CASE kind WHEN 'status' THEN 'paused' ELSE 'running' END AS said FROM log),
  near AS (SELECT *, lag(said) OVER w AS before, lag(time) OVER w AS last_time, coalesce(lead(time) OVER w, TIMESTAMP '2024-02-01') AS next_time
    FROM line WINDOW w AS (PARTITION BY session ORDER BY time, identity)),
  states AS (SELECT session, time, said AS state FROM near WHERE before IS NULL OR before <> said OR time > last_time + INTERVAL 30 SECOND
    UNION ALL SELECT session, time + INTERVAL 30 SECOND, 'stalled' FROM near WHERE next_time > time + INTERVAL 30 SECOND
    UNION ALL SELECT session, time + INTERVAL 10 MINUTE, 'lost' FROM near WHERE next_time > time + INTERVAL 10 MINUTE)"""


@query("ST5_stream_states", sql("SELECT session, time, state FROM states", "log", more=STATES))
def stream_states(t: Tables) -> DataFrame:
    return ntz(logs.stream_states(t.log, F.lit("2024-02-01").cast("timestamp")), "time")


LINE = (30.0, 10.0, 70.0, 90.0)
CROSS = """step AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM tracks WINDOW w AS (PARTITION BY session, track ORDER BY time, frame)),
  side AS (SELECT *, 40 * (py - 10) - 80 * (px - 30) > 0 AS was, 40 * (y - 10) - 80 * (x - 30) > 0 AS now,
    (x - px) * (10 - py) - (y - py) * (30 - px) AS o1, (x - px) * (90 - py) - (y - py) * (70 - px) AS o2 FROM step WHERE px IS NOT NULL),
  crossed AS (SELECT session, track, time, frame, CASE WHEN now THEN 'in' ELSE 'out' END AS direction FROM side WHERE was <> now AND o1 * o2 <= 0)"""


@query("ST9_line_crossings", sql("SELECT * FROM crossed", "tracks", more=CROSS))
def line_crossings(t: Tables) -> DataFrame:
    return ntz(logs.line_crossings(t.tracks, LINE), "time")


@query(
    "ST9_line_counts",
    sql(
        """SELECT session, count(*) FILTER (direction = 'in') AS "in", count(*) FILTER (direction = 'out') AS "out", count(*) AS total
        FROM crossed GROUP BY 1""",
        "tracks",
        more=CROSS,
    ),
)
def line_counts(t: Tables) -> DataFrame:
    return logs.line_counts(logs.line_crossings(t.tracks, LINE))


def zones(t: Tables) -> DataFrame:
    """A box and a triangle, as a user would pass them."""
    ring = "array<struct<x:double,y:double>>"
    return t.spark.createDataFrame(
        [("box", [(10.0, 10.0), (60.0, 10.0), (60.0, 70.0), (10.0, 70.0)]), ("wedge", [(50.0, 0.0), (100.0, 50.0), (50.0, 100.0)])],
        f"zone string, ring {ring}",
    )


def _edge(ax: int, ay: int, bx: int, by: int) -> str:
    return f"(({ay} > y) <> ({by} > y) AND x < {ax} + (y - {ay}) * ({bx} - {ax}) / nullif({by} - {ay}, 0))::INT"


INSIDE = f"""inz AS MATERIALIZED (SELECT *, 'box' AS zone, (coalesce({_edge(10, 10, 60, 10)}, 0) + coalesce({_edge(60, 10, 60, 70)}, 0) +
      coalesce({_edge(60, 70, 10, 70)}, 0) + coalesce({_edge(10, 70, 10, 10)}, 0)) % 2 = 1 AS inside FROM tracks
    UNION ALL SELECT *, 'wedge', (coalesce({_edge(50, 0, 100, 50)}, 0) + coalesce({_edge(100, 50, 50, 100)}, 0) + coalesce({_edge(50, 100, 50, 0)}, 0)) % 2 = 1
    FROM tracks),
  moves AS MATERIALIZED (SELECT session, track, zone, time, frame, CASE WHEN inside THEN 'entry' ELSE 'exit' END AS event FROM (SELECT *,
    coalesce(lag(inside) OVER (PARTITION BY session, track, zone ORDER BY time, frame), false) AS was FROM inz) WHERE inside <> was)"""


@query(
    "ST10_zone_occupancy",
    sql("SELECT session, frame, zone, name, count(*) AS objects FROM inz WHERE inside GROUP BY ALL", "tracks", more=INSIDE),
)
def zone_occupancy(t: Tables) -> DataFrame:
    return logs.zone_occupancy(t.tracks, zones(t))


@query(
    "ST10_zone_means",
    sql(
        """SELECT zone, time_bucket(INTERVAL 6 HOUR, time) - s * INTERVAL 6 HOUR AS start, count(*) FILTER (inside) AS inside, count(*) AS points
        FROM inz, range(2) r(s) GROUP BY 1, 2""",
        "tracks",
        more=INSIDE,
    ),
)
def zone_means(t: Tables) -> DataFrame:
    return ntz(logs.zone_means(t.tracks, zones(t), "12 hours", "6 hours"), "start")


@query("ST11_zone_entries_and_exits", sql("SELECT * FROM moves", "tracks", more=INSIDE))
def zone_entries_and_exits(t: Tables) -> DataFrame:
    return ntz(logs.zone_moves(t.tracks, zones(t)), "time")


@query(
    "ST12_dwell_events",
    sql(
        """SELECT session, track, zone, time AS entered, time + INTERVAL 2 DAY AS due FROM (SELECT *, lead(time) OVER
        (PARTITION BY session, track, zone ORDER BY time, frame) AS gone FROM moves) WHERE event = 'entry'
        AND coalesce(gone, TIMESTAMP '2024-02-01') >= time + INTERVAL 2 DAY""",
        "tracks",
        more=INSIDE,
    ),
)
def dwell_events(t: Tables) -> DataFrame:
    out = logs.dwell_events(t.tracks, zones(t), 2 * 86400, F.lit("2024-02-01").cast("timestamp"))
    return ntz(out, "entered", "due")


@query(
    "ST13_appearances",
    sql("SELECT session, track, name, min(time) AS time, arg_min(frame, time) AS frame FROM tracks GROUP BY 1, 2, 3", "tracks"),
)
def appearances(t: Tables) -> DataFrame:
    return ntz(logs.appearances(t.tracks), "time")


@query(
    "ST14_branch_counts",
    sql(
        """SELECT time_bucket(INTERVAL 12 HOUR, time) AS start, count(*) FILTER (confidence > 0.4) AS passed,
        count(*) FILTER (confidence <= 0.4) AS failed FROM log GROUP BY 1""",
        "log",
    ),
)
def branch_counts(t: Tables) -> DataFrame:
    return ntz(logs.branch_counts(t.log, F.col("confidence") > 0.4, "12 hours"), "start")


@query(
    "ST16_event_batches",
    sql(
        """SELECT session, time_bucket(INTERVAL 12 HOUR, time) AS start, count(*)::INT AS events, min(identity) AS first_identity
        FROM log WHERE kind = 'event' GROUP BY 1, 2""",
        "log",
    ),
)
def event_batches(t: Tables) -> DataFrame:
    out = logs.event_batches(t.log, "12 hours")
    return ntz(out, "start").select(
        "session", "start", F.size("events").alias("events"), F.element_at("events", 1)["identity"].alias("first_identity")
    )
