"""Log operators on a session with most rows give the same whether a task may hold it or not."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.scale import hot_percentiles, last_known, neighbours
from annoframe.streaming import logs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
RING = "array<struct<x:double,y:double>>"


def records(spark, n=1500):
    rnd = random.Random(5)
    rows = [
        (
            rnd.choice([1, 1, 1, 1, 2, 3, None]), START + timedelta(seconds=rnd.randrange(9000)), i,
            rnd.choice(["frame", "frame", "frame", "event", "status"]), rnd.random(), rnd.choice([None, 5.0, rnd.random() * 100]),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "session long, time timestamp, identity long, kind string, confidence double, latency_ms double")


def points(spark, n=800):
    rnd = random.Random(6)
    rows = [
        (rnd.choice([1, 2]), rnd.choice([1, 1, 1, 2]), i, START + timedelta(seconds=i // 2), rnd.choice([None, rnd.random() * 100, rnd.random() * 100]), rnd.random() * 100)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "session long, track long, frame long, time timestamp, x double, y double")


def same(plain, cut):
    got = sorted(map(str, cut.collect()))
    assert got == sorted(map(str, plain.collect()))
    return got


def test_neighbours_cross_the_borders_of_ranges(spark):
    df = records(spark).select("session", "time", "identity", "latency_ms")
    args = (["session"], ["time", "identity"], F.struct("identity", "latency_ms"))
    rows = same(neighbours(df, *args, back="b", ahead="a"), neighbours(df, *args, back="b", ahead="a", max_rows=40))
    assert len(rows) == 1500
    # Against a walk over each session.
    out = neighbours(df, *args, back="b", ahead="a", max_rows=25).collect()
    for session in (None, 1, 2, 3):
        mine = sorted((r for r in out if r.session == session), key=lambda r: (r.time, r.identity))
        assert [r.b and r.b.identity for r in mine] == [None] + [r.identity for r in mine[:-1]]
        assert [r.a and r.a.identity for r in mine] == [r.identity for r in mine[1:]] + [None]


def test_the_last_known_value_passes_empty_ranges(spark):
    rows = [(i % 2 if i < 40 else 0, i, i if i in (3, 8, 150) else None) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, i long, v long")
    got = same(last_known(df, ["g"], ["i"], "v", "k"), last_known(df, ["g"], ["i"], "v", "k", max_rows=10))
    assert sum("k=150" in r for r in got) == 249


def test_operators_on_hot_sessions(spark):
    log, tracks = records(spark), points(spark)
    zones = spark.createDataFrame([("z", [(10.0, 10.0), (70.0, 10.0), (70.0, 80.0), (10.0, 80.0)])], f"zone string, ring {RING}")
    until = F.lit("2024-01-03").cast("timestamp")
    line = (30.0, 10.0, 70.0, 90.0)
    assert same(logs.stream_states(log, until), logs.stream_states(log, until, max_rows=50))
    assert same(logs.line_crossings(tracks, line), logs.line_crossings(tracks, line, max_rows=50))
    assert same(logs.zone_moves(tracks, zones), logs.zone_moves(tracks, zones, max_rows=50))
    assert same(logs.dwell_events(tracks, zones, 2, until), logs.dwell_events(tracks, zones, 2, until, max_rows=50))
    assert same(logs.track_lifetimes(tracks), logs.track_lifetimes(tracks, max_rows=50))
    some = log.where("session is not null")
    assert same(logs.throttle(some, 60), logs.throttle(some, 60, max_rows=50))


def test_operators_on_no_rows(spark):
    log, tracks = records(spark).limit(0), points(spark).limit(0)
    assert logs.window_stats(log, "1 hour", max_rows=0).count() == 0
    assert logs.stream_states(log, F.lit("2024-01-03").cast("timestamp"), max_rows=0).count() == 0
    assert logs.line_crossings(tracks, (0, 0, 1, 1), max_rows=0).count() == 0


@pytest.mark.parametrize("kind", ["few", "ties", "spread", "nan"])
def test_percentiles_of_hot_groups_are_exact(spark, kind):
    rnd = np.random.default_rng(3)
    values = {
        "few": [3.0, 1.0, 2.0],
        "ties": rnd.integers(0, 4, 5000).astype(float).tolist(),
        "spread": rnd.lognormal(0, 3, 60_000).tolist(),
        "nan": rnd.random(2000).tolist() + [float("nan")] * 3 + [float("-inf"), float("inf")],
    }[kind]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("b", 7.0), ("c", None)], "g string, v double").repartition(7)
    shares = [0.0, 0.001, 0.5, 0.9, 0.99]
    got = {r.g: r.p for r in hot_percentiles(df, ["g"], "v", shares).collect()}
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("p")).collect() if r.p}
    assert got.keys() == want.keys() == {"a", "b"}
    assert got["b"] == [7.0] * 5
    assert got["a"] == pytest.approx(want["a"], rel=1e-12)


def test_window_stats_of_hot_windows(spark):
    log = records(spark).where("session is not null")
    shown = lambda df: df.select(*[F.round(c, 9).alias(c) if c[0] == "p" else c for c in df.columns])
    assert same(shown(logs.window_stats(log, "30 minutes")), shown(logs.window_stats(log, "30 minutes", max_rows=60)))
