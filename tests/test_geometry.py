"""Clips, flat rings and tile spans: results at the borders, and expressions that stay cheap for each row."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from annoframe.functions import geometry as g
from annoframe.functions import keypoints as k
from annoframe.operators import masks
from annoframe.operators.transforms import _span
from annoframe.plans.registry import PLANS
from annoframe.plans.tables import Tables

RINGS = "r array<struct<x:double,y:double>>"


def test_clip_keeps_rings_inside_and_builds_no_slices(spark):
    inside = [(0.0, 0.0), (40.0, 0.0), (40.0, 30.0), (5.0, 30.0)]
    outside = [(50.0, 1.0), (60.0, 1.0), (60.0, 9.0)]
    half = [(-10.0, 0.0), (10.0, 0.0), (10.0, 10.0), (-10.0, 10.0)]
    rows = [(inside,), (outside,), ([],), (None,), (half,)]
    df = spark.createDataFrame(rows, RINGS)
    cut = df.select(g.clip_ring(F.col("r"), F.lit(40.0), F.lit(30.0)).alias("c"), g.ring_area(F.col("r")).alias("a"))
    got = [(None if r.c is None else [tuple(p) for p in r.c], r.a) for r in cut.collect()]
    assert got[0] == (inside, 1125.0) and got[1] == ([], 40.0) and got[2] == ([], 0.0) and got[3][0] is None
    assert got[4] == ([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], 200.0)
    # Inside a lambda these are many times slower than access by index.
    text = cut._jdf.queryExecution().analyzed().toString()
    assert "concat(" not in text and "slice(" not in text


def test_tile_spans_round_half_to_even_without_decimals(spark):
    df = spark.createDataFrame([(w, i) for w in (5, 7, 640, 1601, 1) for i in range(2)], "w int, i int")
    lo, hi = _span(F.col("i"), F.col("w"), 2, 0.1)
    rows = df.select("w", "i", lo.alias("lo"), hi.alias("hi"))
    for r in rows.collect():
        a, b = round(r.i * r.w / 2), round((r.i + 1) * r.w / 2)
        pad = round((b - a) * 0.1)
        assert (r.lo, r.hi) == (max(0, a - pad), min(r.w, b + pad)) and math.copysign(1, r.lo) == 1
    assert "bround" not in rows._jdf.queryExecution().analyzed().toString()


def test_flat_rings_are_counted_once_a_ring(spark):
    import annoframe.plans  # noqa: F401

    df = PLANS["X6_flat_ring_round_trip"](Tables(spark, "/root/testdata/sf0.001"))
    above = df._jdf.queryExecution().optimizedPlan().toString().split("Generate ")[0]
    assert "transform(" not in above


def test_counts_are_judged_once_a_mask(spark):
    rows = [(1, [2, 3, 4]), (2, [1, 1]), (3, None), (4, [3, -1, 7]), (5, [0, 9])]
    df = spark.createDataFrame(rows, "ann_id int, c array<long>").selectExpr("ann_id", "3 as h", "3 as w", "transform(c, v -> v + 0) as counts")
    good, bad = masks.check_counts(df)
    assert {(r.ann_id, r.start, r.len) for r in masks.runs_of(good).collect()} == {(1, 2, 3), (5, 0, 9)}
    assert {r.ann_id: r.reason for r in bad.collect()} == {2: "runs do not cover the mask", 3: "counts end inside a run length", 4: "negative run"}
    assert good._jdf.queryExecution().optimizedPlan().toString().count("transform(c") == 1


def test_triplets_are_placed_once_an_entry(spark):
    rows = [(1, [1.0, 2.0, 2.0, 3.0, 4.0, 0.0], []), (2, [1.0, 2.0, 1.0, 3.0, 4.0, 2.0, 9.0], []), (3, [1.0, 2.0, 2.0], ["a", "b"]), (4, None, []), (5, [1.0, 2.0], []), (6, [0.0, 0.0, 0.5], [])]
    df = spark.createDataFrame(rows, "i int, k array<double>, j array<string>")
    kps, joints = F.col("k"), F.col("j")
    lone = df.select("i", k.any_placed(kps).alias("any"), k.lone_entry(kps, joints).alias("lone"))
    assert {r.i: (r.any, r.lone) for r in lone.collect() if r.i != 4} == {1: (True, True), 2: (True, False), 3: (True, False), 5: (False, False), 6: (True, False)}
    assert {r.i: r.any for r in lone.collect()}[4] is False
    out = df.select("i", k.expand_triplets(kps, joints, F.lit("n"), F.create_map(F.lit("s"), F.lit("l"))).alias("t"))
    got = {r.i: [(t.idx, t.slot, t.name, t.point.x, t.lone, t.attributes.get("occluded")) for t in r.t] for r in out.where("i < 4").collect()}
    assert got == {1: [(0, 0, "n", 1.0, True, None)], 2: [(0, 0, "n", 1.0, False, "true"), (1, 1, "n", 3.0, False, None)], 3: [(0, 0, "a", 1.0, False, None)]}
    assert out._jdf.queryExecution().analyzed().toString().count("sequence(") == 1
