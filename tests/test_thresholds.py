"""Mean AP at several thresholds from one pass: equal to one pass for each, chunked and with hot groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from annoframe.operators import matching, metrics

BOXES = "image_id long, name string, ann_id long, x double, y double, w double, h double, confidence double"


def boxes(seed, n, first):
    rnd = random.Random(seed)
    return [
        (rnd.randrange(6), rnd.choice("abc"), first + i, rnd.uniform(0, 30), rnd.uniform(0, 30), 30.0, 30.0, rnd.choice((0.2, 0.5, None, 0.9)))
        for i in range(n)
    ]


@pytest.mark.parametrize("max_rows", [2_000_000, 15])
def test_map_of_one_pass_equals_a_pass_per_threshold(spark, max_rows):
    pred = spark.createDataFrame(boxes(1, 120, 0) + [(9, "p", 900, 0.0, 0.0, 5.0, 5.0, 0.4)], BOXES)
    gt = spark.createDataFrame(boxes(2, 90, 1000) + [(9, "g", 1900, 0.0, 0.0, 5.0, 5.0, 0.4)], BOXES)
    steps = (0.3, 0.5, 0.8)
    got = {r.iou_threshold: r.map for r in metrics.mean_average_precision(pred, gt, steps, max_rows).collect()}
    for t in steps:
        want = metrics.average_precision(pred, gt, t).agg(F.avg("ap")).first()[0]
        assert abs(got[t] - want) < 1e-12


@pytest.mark.parametrize("hot", [None, 4096, 10])
def test_hits_equal_matches_at_each_threshold(spark, hot):
    pred, gt = spark.createDataFrame(boxes(3, 90, 0), BOXES), spark.createDataFrame(boxes(4, 80, 1000), BOXES)
    steps = (0.3, 0.6)
    rows = matching.greedy_hits(pred, gt, steps, hot).collect()
    assert len(rows) == len({r.pred_id for r in rows})
    for i, t in enumerate(steps):
        want = {r.pred_id for r in matching.greedy_matches(pred, gt, t).collect()}
        assert {r.pred_id for r in rows if r.hits[i]} == want


def test_boxes_are_joined_once_for_all_thresholds(spark):
    pred, gt = spark.createDataFrame(boxes(5, 20, 0), BOXES), spark.createDataFrame(boxes(6, 20, 100), BOXES)
    plan = metrics.mean_average_precision(pred, gt, (0.5, 0.75, 0.9))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1
