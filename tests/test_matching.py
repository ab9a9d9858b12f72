"""Greedy matching, suppression and scores: hand values, and the skew-safe paths against the fold."""

from __future__ import annotations

import random

import pytest

from annoframe.operators import matching, metrics

BOXES = "image_id long, name string, ann_id long, x double, y double, w double, h double"
PREDS = BOXES + ", confidence double"


def preds(spark, rows):
    return spark.createDataFrame(rows, PREDS)


def truths(spark, rows):
    return spark.createDataFrame(rows, BOXES)


def pile(seed: int, n: int, copies: bool):
    """Many overlapping boxes on one image, with repeated geometry when ``copies``."""
    rnd = random.Random(seed)
    step = 8 if copies else 1
    gt = [
        (1, f"c{rnd.randrange(2)}", i, rnd.randrange(0, 60, step), rnd.randrange(0, 60, step),
         rnd.choice((16, 24, 300)), rnd.choice((16, 24, 300)))
        for i in range(n)
    ]
    pr = [
        (1, f"c{rnd.randrange(2)}", 1000 + i, rnd.randrange(0, 60, step), rnd.randrange(0, 60, step),
         rnd.choice((16, 24, 300)), rnd.choice((16, 24, 300)), rnd.randrange(10) / 10)
        for i in range(n)
    ]
    return [tuple(float(v) if i > 2 else v for i, v in enumerate(r)) for r in pr], [
        tuple(float(v) if i > 2 else v for i, v in enumerate(r)) for r in gt
    ]


def brute_matches(pr, gt, t, by_class):
    def iou(a, b):
        iw = min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3])
        ih = min(a[4] + a[6], b[4] + b[6]) - max(a[4], b[4])
        if iw <= 0 or ih <= 0:
            return 0.0
        return iw * ih / (a[5] * a[6] + b[5] * b[6] - iw * ih)

    out, taken = set(), set()
    for p in sorted(pr, key=lambda r: (-r[7], r[2])):
        best, at = t, None
        for g in sorted(gt, key=lambda r: r[2]):
            if g[2] in taken or (by_class and g[1] != p[1]) or g[0] != p[0]:
                continue
            if iou(p, g) >= best:
                best, at = iou(p, g), g[2]
        if at is not None:
            taken.add(at)
            out.add((p[2], at))
    return out


@pytest.mark.parametrize("by_class", [True, False])
@pytest.mark.parametrize("copies", [True, False])
def test_rounds_equal_fold_and_brute_force(spark, by_class, copies):
    pr, gt = pile(7 + copies, 60, copies)
    want = brute_matches(pr, gt, 0.3, by_class)
    for limit in (None, 10):
        got = matching.greedy_matches(preds(spark, pr), truths(spark, gt), 0.3, by_class, hot_group_rows=limit)
        assert {(r.pred_id, r.gt_id) for r in got.collect()} == want


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.5])
def test_suppression_rounds_equal_fold(spark, threshold):
    pr, _ = pile(3, 80, True)
    small = matching.nms(preds(spark, pr), threshold, hot_group_rows=None).collect()
    large = matching.nms(preds(spark, pr), threshold, hot_group_rows=5).collect()
    assert sorted(small) == sorted(large)


def test_draft_check_same_on_hot_groups(spark):
    pr, gt = pile(5, 60, True)
    small = matching.new_drafts(preds(spark, pr), truths(spark, gt), 0.4, hot_group_rows=None).collect()
    large = matching.new_drafts(preds(spark, pr), truths(spark, gt), 0.4, hot_group_rows=5).collect()
    assert sorted(small) == sorted(large)


def test_later_truth_wins_ties_and_threshold_is_inclusive(spark):
    gt = truths(spark, [(1, "a", 1, 0.0, 0.0, 10.0, 10.0), (1, "a", 2, 0.0, 0.0, 10.0, 10.0)])
    pr = preds(spark, [(1, "a", 9, 0.0, 0.0, 10.0, 5.0, 0.9)])
    assert [r.gt_id for r in matching.greedy_matches(pr, gt, 0.5).collect()] == [2]


def test_half_overlap_is_one_third_and_wrong_class_costs_twice(spark):
    gt = truths(spark, [(1, "a", 1, 0.0, 0.0, 10.0, 10.0)])
    shifted = preds(spark, [(1, "a", 9, 5.0, 0.0, 10.0, 10.0, 0.9)])
    assert matching.greedy_matches(shifted, gt, 1 / 3).count() == 1
    assert matching.greedy_matches(shifted, gt, 0.34).count() == 0
    other = preds(spark, [(1, "b", 9, 0.0, 0.0, 10.0, 10.0, 0.9)])
    rows = {r.name: (r.tp, r.fp, r.fn) for r in metrics.class_metrics(other, gt).collect()}
    assert rows == {"a": (0, 0, 1), "b": (0, 1, 0)}


def test_average_precision_hand_value_in_one_and_many_chunks(spark):
    gt = truths(spark, [(i, "a", i, 0.0, 0.0, 10.0, 10.0) for i in (1, 2)])
    pr = preds(
        spark,
        [
            (1, "a", 11, 0.0, 0.0, 10.0, 10.0, 0.9),
            (1, "a", 12, 50.0, 50.0, 10.0, 10.0, 0.8),
            (2, "a", 13, 0.0, 0.0, 10.0, 10.0, 0.7),
        ],
    )
    for rows in (100, 1):
        ap = metrics.average_precision(pr, gt, max_rows=rows).first().ap
        assert ap == pytest.approx(0.5 + 0.5 * 2 / 3)


def test_curve_is_the_same_in_chunks(spark):
    pr, gt = pile(11, 60, False)
    p, g = preds(spark, pr), truths(spark, gt)
    found = matching.greedy_matches(p, g, 0.3)
    whole = metrics.precision_curve(p, found).collect()
    parts = metrics.precision_curve(p, found, max_rows=5).collect()
    assert sorted(whole) == sorted(parts)


def test_threshold_outside_range_is_refused(spark):
    pr, gt = pile(1, 2, False)
    with pytest.raises(ValueError):
        matching.greedy_matches(preds(spark, pr), truths(spark, gt), 0.0)


def test_empty_sides(spark):
    pr, gt = preds(spark, []), truths(spark, [(1, "a", 1, 0.0, 0.0, 1.0, 1.0)])
    row = metrics.class_metrics(pr, gt).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.f1) == (0, 0, 1, 0.0, 0.0)
    assert metrics.average_precision(pr, gt).first().ap == 0.0
    over = metrics.overall_metrics(metrics.class_metrics(pr, gt.limit(0))).first()
    assert (over.tp, over.macro_f1) == (0, 0.0)


def test_bad_numbers_are_no_detection_on_either_path(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, "a", 0, 0.0, 0.0, 10.0, 10.0, 0.5),
        (1, "a", 1, 0.0, 0.0, None, 10.0, 0.9),
        (1, "a", 2, 0.0, 0.0, nan, 10.0, 0.8),
        (1, "a", 3, 0.0, 0.0, inf, 10.0, 0.7),
        (1, "a", 4, 1.0, 0.0, 10.0, 10.0, 0.4),
        (1, "a", 5, 50.0, 0.0, 0.0, 10.0, 0.3),
    ]
    for limit in (None, 2):
        kept = matching.nms(preds(spark, rows), 0.5, hot_group_rows=limit)
        assert sorted(r.ann_id for r in kept.collect()) == [0, 5]
    with pytest.raises(ValueError):
        matching.nms(preds(spark, rows), -0.1)


def unsure(seed):
    """Overlapping boxes with null, NaN and tied confidences."""
    rnd = random.Random(seed)
    conf = [None, float("nan"), 0.5, 0.4, 0.5]
    return [(1, "c", i, float(rnd.randrange(0, 30, 3)), 0.0, 20.0, 20.0, rnd.choice(conf)) for i in range(25)]


@pytest.mark.parametrize("seed", range(3))
def test_unsure_boxes_come_last_whatever_the_size_of_the_group(spark, seed):
    rows = unsure(seed)
    ids = lambda df, c: sorted(r[c] for r in df.select(c).collect())
    small, large = (matching.nms(preds(spark, rows), 0.4, hot_group_rows=n) for n in (None, 1))
    assert ids(small, "ann_id") == ids(large, "ann_id")
    gt = truths(spark, [r[:7] for r in unsure(seed + 10)[:12]])
    small, large = (matching.greedy_matches(preds(spark, rows), gt, 0.4, hot_group_rows=n) for n in (None, 1))
    pairs = lambda df: sorted((r.pred_id, r.gt_id) for r in df.collect())
    ranked = [r[:7] + (-1.0 if r[7] is None or r[7] != r[7] else r[7],) for r in rows]
    assert pairs(small) == pairs(large) == sorted(brute_matches(ranked, [tuple(r) for r in gt.collect()], 0.4, True))


def test_null_and_nan_confidence_suppress_nothing_sure(spark):
    for bad in (None, float("nan")):
        rows = [(1, "c", 0, 0.0, 0.0, 20.0, 20.0, bad), (1, "c", 1, 1.0, 0.0, 20.0, 20.0, 0.5), (1, "c", 2, 2.0, 0.0, 20.0, 20.0, 0.4)]
        for limit in (None, 1):
            assert [r.ann_id for r in matching.nms(preds(spark, rows), 0.5, hot_group_rows=limit).collect()] == [1]
