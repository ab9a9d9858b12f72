"""Log records: filters, de-duplication, joins, windows and throttles that serve batch and stream alike
(F11, F12, J13, E3, S15, S16, ST1-ST4, ST6, ST10, ST14, ST16, W7, W11).

A record row has ``session, time, identity, kind`` and what its kind carries; ``time`` is a timestamp.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from annoframe.scale import hot_groups, hot_percentiles, last_known, neighbours, split_hot
from annoframe.session import cut

# Kinds a log history holds.
LOG_KINDS = ("frame", "event", "capture", "stats", "status")


def read_log_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", names: str | None = None
) -> DataFrame:
    """S15 / ST1: records as a stream of a folder's files, those named ``names`` if given; the
    checkpoint of the query keeps the position."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("pathGlobFilter", names) if names else reader).load(path)


def log_history(log: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Records from ``since`` up to, not including, ``until``: plain comparisons that reach the scan."""
    if since is not None:
        log = log.where(F.col("time") >= since)
    return log.where(F.col("time") < until) if until is not None else log


def _refuse(**faults: bool) -> None:
    """Raise if a named argument check failed."""
    named = [name.replace("_", " ") for name, wrong in faults.items() if wrong]
    if named:
        raise ValueError(f"log filter: bad {', '.join(named)}")


def filter_log(
    log: DataFrame,
    *,
    kinds: Sequence[str] | None = None,
    classes: Sequence[str] | None = None,
    min_confidence: float | None = None,
    session=None,
    every: int | None = None,
) -> DataFrame:
    """F11 / ST1: a record keeps its matching ``annotations``; a frame left without any is dropped."""
    _refuse(
        foreign_kinds=bool(set(kinds or ()) - set(LOG_KINDS)),
        frame_step=every is not None and every < 1,
        confidence_bound=min_confidence is not None and not 0 <= min_confidence <= 1,
    )
    frame = F.col("kind") == "frame"
    conditions = [
        kinds is not None and F.col("kind").isin(*kinds),
        session is not None and F.col("session") == session,
        every is not None and (~frame | (F.col("frame") % (every or 1) == 0)),
    ]
    for condition in conditions:
        if condition is not False:
            log = log.where(condition)
    if classes is None and min_confidence is None:
        return log

    def fits(a: Column) -> Column:
        good = F.lit(True) if classes is None else a["name"].isin(*classes)
        return good if min_confidence is None else good & (a["confidence"] >= min_confidence)

    kept = log.withColumn("annotations", F.filter("annotations", fits))
    return kept.where(~frame | (F.size("annotations") > 0))


def filter_run_log(
    log: DataFrame,
    *,
    class_name: str | None = None,
    track_id: str | None = None,
    branch: bool | None = None,
    min_confidence: float | None = None,
    source: str | None = None,
    event_type: str | None = None,
    trigger: str | None = None,
) -> DataFrame:
    """run-log records; ``branch=False`` asks for the failed branch, it is not "no filter"."""
    if class_name is not None:
        log = log.where(F.array_contains("classes", class_name))
    if track_id is not None:
        log = log.where(F.array_contains("track_ids", str(track_id)))
    if branch is not None:
        log = log.where(F.col("condition") == F.lit(branch))
    if min_confidence is not None:
        log = log.where(F.col("max_confidence") >= min_confidence)
    for column, value in (("source", source), ("type", event_type), ("trigger", trigger)):
        if value is not None:
            log = log.where(F.col(column) == value)
    return log


def once(log: DataFrame, delay: str | None = None) -> DataFrame:
    """E3 / ST2: each record once by its identity; a stream forgets an identity after ``delay``."""
    if log.isStreaming:
        return log.withWatermark("time", delay or "10 minutes").dropDuplicatesWithinWatermark(["identity"])
    return log.dropDuplicates(["identity"])


def history_and_live(history: DataFrame, live: DataFrame) -> DataFrame:
    """Both reads as one, each record once."""
    return once(history.unionByName(live))


def fill_gap(live: DataFrame, history: DataFrame, backfill: Column, gap_time: Column) -> DataFrame:
    """ST3: the history between a gap's backfill and its own time, joined to what was carried live."""
    return history_and_live(log_history(history, backfill, gap_time), live)


def with_captures(events: DataFrame, captures: DataFrame, within: str = "10 minutes", how: str = "left") -> DataFrame:
    """Events with the capture that names them, at most ``within`` later. Streams need watermarks."""
    e, c = events.alias("e"), captures.alias("c")
    match = (
        (F.col("e.event_id") == F.col("c.event"))
        & (F.col("c.capture_time") >= F.col("e.time"))
        & (F.col("c.capture_time") <= F.col("e.time") + F.expr(f"interval {within}"))
    )
    return e.join(c, match, how)


# --- windows --------------------------------------------------------------------------------------


#: Rows of a group that one task may sort or keep values of.
SESSION_ROWS_IN_ONE_TASK = 1_000_000
SHARES = (0.5, 0.9, 0.99)


def window_stats(log: DataFrame, width: str = "1 second", max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """ST4: per session and window: frames, events, detections, fps and latency percentiles of frames.

    A window over ``max_rows`` rows takes its percentiles from a sketch and a second pass, to the same values; a stream
    has no second pass and keeps a window's distinct latencies until it closes.
    """
    frame = F.col("kind") == "frame"
    latency = F.when(frame, F.col("latency_ms"))
    rows = log.select(
        "session", F.window("time", width).alias("w"), "kind", "confidence", latency.alias("latency")
    )
    counted = [
        F.count_if(frame).alias("frames"),
        F.count_if(F.col("kind") == "event").alias("events"),
        F.count_if(frame & (F.col("confidence") >= 0.5)).alias("detections"),
        F.max("latency").alias("max_ms"),
    ]
    exact = F.percentile("latency", F.array(*map(F.lit, SHARES))).alias("p")
    keys = ["session", "w"]
    hot = None if log.isStreaming else hot_groups([rows.where("latency IS NOT NULL")], keys, max_rows)
    small, large = split_hot(rows, hot, keys)
    stats = small.groupBy(*keys).agg(*counted, exact)
    if hot is not None:
        stats = stats.unionByName(large.groupBy(*keys).agg(*counted).join(hot_percentiles(large, keys, "latency", SHARES), keys))
    seconds = (F.unix_micros(F.col("w.end")) - F.unix_micros(F.col("w.start"))) / 1e6
    return stats.select(
        "session",
        F.col("w.start").alias("start"),
        "frames",
        "events",
        "detections",
        (F.col("frames") / seconds).alias("fps"),
        *[F.col("p")[i].alias(name) for i, name in enumerate(("p50", "p90", "p99"))],
        "max_ms",
    )


def stream_sessions(log: DataFrame, gap: str = "10 minutes") -> DataFrame:
    """ST6: runs of records no more than ``gap`` apart."""
    runs = log.groupBy("session", F.session_window("time", gap).alias("w")).agg(F.count(F.lit(1)).alias("records"))
    return runs.select("session", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "records")


def branch_counts(log: DataFrame, rule: Column, width: str) -> DataFrame:
    """ST14: records each branch of a rule took, per window; a null rule takes neither."""
    counts = log.groupBy(F.window("time", width).alias("w")).agg(
        F.count_if(rule).alias("passed"), F.count_if(~rule).alias("failed")
    )
    return counts.select(F.col("w.start").alias("start"), "passed", "failed")


def event_batches(log: DataFrame, width: str = "1 second") -> DataFrame:
    """ST16: at most one delivery per session and window: its events in time order."""
    row = F.struct("time", "identity", "name")
    out = log.where("kind = 'event'").groupBy("session", F.window("time", width).alias("w")).agg(
        F.array_sort(F.collect_list(row)).alias("events")
    )
    return out.select("session", F.col("w.start").alias("start"), "events")


def inside_zones(tracks: DataFrame, zones: DataFrame) -> DataFrame:
    """Track points with every zone and whether they are in it; zones are a short list of the user's."""
    from annoframe.functions.geometry import point_in_ring

    listed = F.array(*[_zone_literal(z) for z in zones.collect()])
    rows = tracks.withColumn("z", F.explode(listed))
    return rows.withColumns(
        {"zone": F.col("z.zone"), "inside": point_in_ring(F.col("x"), F.col("y"), F.col("z.ring"))}
    ).drop("z")


def _zone_literal(row) -> Column:
    ring = F.array(*[F.struct(F.lit(float(p["x"])).alias("x"), F.lit(float(p["y"])).alias("y")) for p in row["ring"]])
    return F.struct(F.lit(row["zone"]).alias("zone"), ring.alias("ring"))


def zone_occupancy(tracks: DataFrame, zones: DataFrame) -> DataFrame:
    """ST10: objects inside each zone per frame and class."""
    inside = inside_zones(tracks, zones).where("inside")
    return inside.groupBy("session", "frame", "zone", "name").agg(F.count(F.lit(1)).alias("objects"))


def zone_means(tracks: DataFrame, zones: DataFrame, width: str, slide: str) -> DataFrame:
    """ST10: share of track points inside a zone over a sliding window."""
    points = inside_zones(tracks, zones)
    means = points.groupBy("zone", F.window("time", width, slide).alias("w")).agg(
        F.count_if("inside").alias("inside"), F.count(F.lit(1)).alias("points")
    )
    return means.select("zone", F.col("w.start").alias("start"), "inside", "points")


# --- throttles ------------------------------------------------------------------------------------


def throttle(log: DataFrame, interval_s: float, max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """W7 / ST7 (batch): per session the first record, then each first one at least ``interval_s`` later.

    Ordinary sessions stream through sorted partitions with one remembered time, in constant memory.
    A session over ``max_rows`` is not walked by one task: every row gets a pointer to its successor,
    found per interval bucket, and the chain from the first row is marked by pointer doubling.
    """
    if not interval_s > 0:
        raise ValueError(f"interval_s must be positive, got {interval_s}")
    hot = hot_groups([log], ["session"], max_rows)
    small, large = split_hot(log, hot, ["session"])
    out = _walk(small, interval_s)
    return out if hot is None else out.unionByName(_doubling(large, interval_s, max_rows))


def _walk(log: DataFrame, interval_s: float) -> DataFrame:
    step = int(round(interval_s * 1e6))
    ready = log.withColumn("_us", F.unix_micros("time")).repartition("session").sortWithinPartitions("session", "_us", "identity")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = None, 0
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            sessions, times = pdf["session"].to_numpy(), pdf["_us"].to_numpy()
            edges = np.flatnonzero(np.r_[True, sessions[1:] != sessions[:-1]]).tolist() + [len(pdf)] if len(pdf) else [0]
            for lo, hi in zip(edges[:-1], edges[1:]):
                at = lo
                if sessions[lo] == held:
                    at = lo + int(np.searchsorted(times[lo:hi], last + step))
                while at < hi:
                    keep[at], held, last = True, sessions[lo], times[at]
                    at = lo + int(np.searchsorted(times[lo:hi], last + step))
            yield pdf[keep]

    return ready.mapInPandas(run, ready.schema).drop("_us")


def _doubling(log: DataFrame, interval_s: float, max_rows: int) -> DataFrame:
    step = int(round(interval_s * 1e6))
    rows = cut(log.select("session", "identity", F.unix_micros("time").alias("us")))
    key = F.struct(F.col("us").alias("us"), F.col("identity").alias("identity"))
    # The first row at or after us + step is in the next bucket, or is the first of a later one.
    own = rows.select("session", F.floor(F.col("us") / step).alias("b"), "us", key.alias("row"), F.lit(None).cast(_KEY).alias("asks"))
    asks = rows.select(
        "session", F.floor((F.col("us") + step) / step).alias("b"), (F.col("us") + step).alias("us"),
        F.lit(None).cast(_KEY), key,
    )
    ahead = Window.partitionBy("session", "b").orderBy(F.desc("us"), F.col("asks").isNotNull())
    found = own.unionAll(asks).withColumn("hit", F.last("row", True).over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    # Among rows of one time the first identity is the one to point at.
    firsts = rows.groupBy("session", "us").agg(F.min("identity").alias("identity"))
    buckets = own.groupBy("session", "b").agg(F.min("row").alias("first"))
    nxt = found.where("asks is not null").join(
        _next_bucket(found.where("asks is not null").select("session", "b").distinct(), buckets, max_rows), ["session", "b"], "left"
    )
    jump = nxt.select(
        "session", F.col("asks").alias("src"), F.coalesce(F.col("hit.us"), F.col("follow.us")).alias("us")
    ).where("us is not null").join(firsts, ["session", "us"]).select("session", "src", key.alias("dst"))
    jump = cut(jump)
    marked = cut(rows.groupBy("session").agg(F.min(key).alias("row")))
    while True:
        reached = marked.join(jump.withColumnRenamed("src", "row"), ["session", "row"]).select("session", F.col("dst").alias("row"))
        grown = cut(marked.unionByName(reached).distinct())
        if grown.count() == marked.count():
            break
        marked = grown
        onward = jump.select("session", F.col("src").alias("dst"), F.col("dst").alias("far"))
        jump = cut(jump.join(onward, ["session", "dst"]).select("session", "src", F.col("far").alias("dst")))
    ids = marked.select("session", F.col("row.identity").alias("identity"))
    return log.join(ids, ["session", "identity"], "left_semi").select(log.columns)


_KEY = "struct<us:bigint,identity:bigint>"


def _next_bucket(asked: DataFrame, buckets: DataFrame, max_rows: int) -> DataFrame:
    """For each asked bucket the first row of the first later bucket that holds rows."""
    merged = asked.select("session", "b", F.lit(None).cast(_KEY).alias("first")).unionAll(buckets.select("session", "b", "first"))
    each = merged.groupBy("session", "b").agg(F.min("first").alias("first")).withColumn("down", -F.col("b"))
    return last_known(each, ["session"], ["down"], "first", "follow", max_rows).select("session", "b", "follow")


def event_capture(log: DataFrame, names: Sequence[str], interval_s: float, max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """ST8 (batch): chosen events, throttled per session."""
    return throttle(log.where((F.col("kind") == "event") & F.col("name").isin(*names)), interval_s, max_rows)


def annotated_frames(log: DataFrame, interval_s: float, max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """ST15 (batch): frames with a detection, throttled per session."""
    return throttle(log.where((F.col("kind") == "frame") & (F.col("confidence") >= 0.5)), interval_s, max_rows)


def track_lifetimes(tracks: DataFrame, max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """First and last frame, points and longest gap of each track."""
    rows = neighbours(
        tracks.select("session", "track", "frame"), ["session", "track"], ["frame"], F.struct("frame"), back="before", max_rows=max_rows
    )
    return rows.groupBy("session", "track").agg(
        F.min("frame").alias("first_frame"),
        F.max("frame").alias("last_frame"),
        F.count(F.lit(1)).alias("points"),
        F.max(F.col("frame") - F.col("before.frame")).alias("longest_gap"),
    )


# --- track events in batch ------------------------------------------------------------------------


def _cross(ax, ay, bx, by, px, py) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def line_crossings(
    tracks: DataFrame, line: tuple[float, float, float, float], max_rows: int = SESSION_ROWS_IN_ONE_TASK
) -> DataFrame:
    """ST9 (batch): each crossing of a line, ``in`` from left to right of start to end, else ``out``."""
    ax, ay, bx, by = (F.lit(float(v)) for v in line)
    px, py, x, y = F.col("from.x"), F.col("from.y"), F.col("x"), F.col("y")
    steps = neighbours(
        tracks, ["session", "track"], ["time", "frame"], F.struct("x", "y"), back="from", max_rows=max_rows
    )
    moves = steps.where(px.isNotNull())
    was, now = _cross(ax, ay, bx, by, px, py) > 0, _cross(ax, ay, bx, by, x, y) > 0
    meets = _cross(px, py, x, y, ax, ay) * _cross(px, py, x, y, bx, by) <= 0
    return moves.where((was != now) & meets).select(
        "session", "track", "time", "frame", F.when(now, F.lit("in")).otherwise(F.lit("out")).alias("direction")
    )


def line_counts(crossings: DataFrame) -> DataFrame:
    """ST9: in, out and total per session."""
    return crossings.groupBy("session").agg(
        F.count_if(F.col("direction") == "in").alias("in"),
        F.count_if(F.col("direction") == "out").alias("out"),
        F.count(F.lit(1)).alias("total"),
    )


def _per_zone(tracks: DataFrame) -> DataFrame:
    """Groups as large as those of one zone, without looking into zones."""
    return tracks.select("session", "track", F.lit(None).alias("zone"))


def zone_moves(tracks: DataFrame, zones: DataFrame, max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """ST11 (batch): entries and exits per track and zone; a track that starts inside enters."""
    points = inside_zones(tracks, zones).select("session", "track", "zone", "time", "frame", "inside")
    rows = neighbours(
        points, ["session", "track", "zone"], ["time", "frame"], F.struct("inside"), back="from", sizes=_per_zone(tracks), max_rows=max_rows
    )
    return rows.where(F.col("inside") != F.coalesce("from.inside", F.lit(False))).select(
        "session", "track", "zone", "time", "frame", F.when(F.col("inside"), F.lit("entry")).otherwise(F.lit("exit")).alias("event")
    )


def dwell_events(
    tracks: DataFrame, zones: DataFrame, limit_s: float, until: Column, max_rows: int = SESSION_ROWS_IN_ONE_TASK
) -> DataFrame:
    """ST12 (batch): one event at entry + limit for each stay that lasts so long by ``until``."""
    moves = neighbours(
        zone_moves(tracks, zones, max_rows),
        ["session", "track", "zone"], ["time", "frame"], F.struct("time"), ahead="next", sizes=_per_zone(tracks), max_rows=max_rows,
    )
    due = F.timestamp_micros(F.unix_micros("time") + F.lit(int(limit_s * 1e6)))
    rows = moves.where("event = 'entry'").withColumn("due", due)
    return rows.where(F.coalesce("next.time", until) >= F.col("due")).select("session", "track", "zone", F.col("time").alias("entered"), "due")


def appearances(tracks: DataFrame) -> DataFrame:
    """ST13 (batch): the first frame of each class of each track."""
    return tracks.groupBy("session", "track", "name").agg(F.min(F.struct("time", "frame")).alias("f")).select(
        "session", "track", "name", F.col("f.time").alias("time"), F.col("f.frame").alias("frame")
    )


# Quiet seconds until a stream counts as stalled, and as lost.
STALLED_S = 30
LOST_S = 600


def stream_states(log: DataFrame, until: Column, max_rows: int = SESSION_ROWS_IN_ONE_TASK) -> DataFrame:
    """ST5 (batch): state changes of each session: running, paused, stalled after 30 s of nothing, lost
    (ended) after 10 minutes. A status record saying paused pauses until the next other record."""
    said = F.when(F.col("kind") == "status", F.lit("paused")).otherwise(F.lit("running"))
    rows = neighbours(
        log.select("session", "time", "identity", said.alias("said")),
        ["session"], ["time", "identity"], F.struct("time", "said"), back="last", ahead="next", sizes=log, max_rows=max_rows,
    ).select("session", "time", "said", F.col("last.said").alias("before"), F.col("last.time").alias("last_time"), F.col("next.time").alias("next_time"))

    def after(seconds: int) -> Column:
        return F.timestamp_micros(F.unix_micros("time") + seconds * 1_000_000)

    # A state is new on the first record, when it differs, or when the quiet before it had stalled.
    quiet = F.unix_micros("time") - F.unix_micros("last_time") > STALLED_S * 1_000_000
    spoken = rows.where(F.col("before").isNull() | (F.col("before") != F.col("said")) | quiet).select("session", "time", F.col("said").alias("state"))
    end = F.coalesce("next_time", until)
    silent = [
        rows.where(end > after(s)).select("session", after(s).alias("time"), F.lit(name).alias("state"))
        for s, name in ((STALLED_S, "stalled"), (LOST_S, "lost"))
    ]
    return spoken.unionAll(silent[0]).unionAll(silent[1])
