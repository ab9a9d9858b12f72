"""Overlaps by a sweep: equal to counting pixels, whatever is cut, split or empty."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from annoframe.operators import masks, sweep

MASKS = "image_id string, ann_id long, starts array<long>, lens array<long>"


def some_masks(rng, images, each, first):
    rows, ann = [], first
    for image in images:
        for _ in range(each):
            at, starts, lens = rng.randrange(30), [], []
            for _ in range(rng.randrange(0, 6)):
                starts.append(at)
                lens.append(rng.choice([0, 1, 2, 5, 40]))
                at += lens[-1] + rng.randrange(0, 9)
            rows.append((image, ann, starts, lens))
            ann += 1
    return rows


def pixels(rows):
    return {(i, a): {p for s, n in zip(starts, lens) for p in range(s, s + n)} for i, a, starts, lens in rows}


def brute(left, right):
    out, lp, rp = {}, pixels(left), pixels(right)
    for (i, a), p in lp.items():
        for (j, b), q in rp.items():
            if i == j and p & q:
                out[i, a, b] = (len(p & q), round(len(p & q) / len(p | q), 9), round(2 * len(p & q) / (len(p) + len(q)), 9))
    return out


def result(df):
    return {(r.image_id, r.left_id, r.right_id): (r.pixels, round(r.iou, 9), round(r.dice, 9)) for r in df.collect()}


@pytest.mark.parametrize("hot_runs", [1 << 21, 40, 3])
def test_overlaps_equal_pixel_counts(spark, hot_runs):
    rng = random.Random(hot_runs)
    left, right = some_masks(rng, ["a", "b", "c"] * 2, 8, 0), some_masks(rng, ["a", "b", "d"], 12, 1000)
    left += [("a", 500, [0], [200]), (None, 501, [0], [9]), ("b", 502, [], [])]
    got = masks.mask_overlaps(spark.createDataFrame(left, MASKS), spark.createDataFrame(right, MASKS), hot_runs)
    rows = got.collect()
    assert len(rows) == len({(r.image_id, r.left_id, r.right_id) for r in rows})
    assert result(got) == brute([m for m in left if m[0]], right)


def test_run_tables_and_packed_masks_agree(spark):
    rng = random.Random(9)
    left, right = some_masks(rng, ["x", "y"], 9, 0), some_masks(rng, ["x", "y"], 9, 100)
    packed = [spark.createDataFrame(m, MASKS) for m in (left, right)]
    runs = [df.select("image_id", "ann_id", F.inline(F.arrays_zip(F.col("starts").alias("start"), F.col("lens").alias("len")))) for df in packed]
    assert result(masks.mask_overlaps(*packed)) == result(masks.mask_overlaps(*runs)) == brute(left, right)


def test_batches_of_one_image_are_held_together(spark, monkeypatch):
    rng = random.Random(1)
    left, right = some_masks(rng, ["x", "y", "z"], 15, 0), some_masks(rng, ["x", "y", "z"], 15, 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        monkeypatch.setattr(sweep, "HELD_RUNS", 3)
        assert result(masks.mask_overlaps(spark.createDataFrame(left, MASKS), spark.createDataFrame(right, MASKS))) == brute(left, right)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_hot_image_fills_many_chunks(spark):
    # A third of all runs are one image's.
    hot = spark.range(20_000).selectExpr("'hot' AS image_id", "id AS key", "false AS right", "0 AS chunk", "array(id * 10) AS starts", "array(15L) AS lens")
    rows = hot.selectExpr("image_id", "key AS ann_id", "starts", "lens")
    sizes = hot.groupBy("image_id").agg(F.sum(F.size("starts")).alias("n"))
    chunks = sweep._chunked(hot, sizes, 1000).groupBy("chunk").count().collect()
    assert len(chunks) >= 15 and max(r["count"] for r in chunks) < 3000
    got = masks.mask_overlaps(rows, rows, 1000)
    assert got.count() == 20_000 + 2 * 19_999
    assert got.where("left_id = right_id").agg(F.sum("pixels")).first()[0] == 300_000


def test_empty_sides(spark):
    rows = spark.createDataFrame([("a", 1, [0], [5])], MASKS)
    assert masks.mask_overlaps(rows, rows.limit(0)).count() == 0
    assert masks.mask_overlaps(rows.limit(0), rows.limit(0)).count() == 0


def test_a_task_holds_few_runs_before_it_sweeps():
    import pyarrow as pa

    taken, n = [], 10_000

    def batches():
        for b in range(40):
            taken.append(b)
            lists = lambda v: pa.array([[v]] * n, pa.list_(pa.int64()))
            columns = [pa.array([b * n + i // 2 for i in range(n)]), pa.array(["a"] * n), pa.array([bool(i % 2) for i in range(n)]), pa.array([0] * n, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, lists(5), lists(3)], ["image_id", "key", "right", "chunk", "starts", "lens"])

    out = sweep._sweep(batches())
    first = next(out)
    assert len(taken) < 20
    assert first.num_rows + sum(b.num_rows for b in out) == 40 * n // 2


def test_starts_are_shuffled_as_steps(spark):
    df = spark.createDataFrame([("a", 1, [7, 1007, 2007], [5, 5, 5]), ("a", 2, [9], [1])], MASKS)
    assert [r.starts for r in sweep._stepped(df).orderBy("ann_id").collect()] == [[7, 1000, 1000], [9]]
