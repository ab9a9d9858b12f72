"""The skew-safe paths give the rows of the plain ones, whatever the chunk or partition count."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from annoframe.operators import similarity
from annoframe.operators.names import place_images
from annoframe.operators.similarity import components, similar_pairs
from annoframe.operators.splits import assign_splits
from annoframe.scale import global_rank, grid_pairs, running_sums
from annoframe.streaming.logs import throttle


def rows(spark, n=300):
    rnd = random.Random(1)
    data = [(i, "hot" if i % 3 else f"g{i % 5}", rnd.randrange(40)) for i in range(n)]
    return spark.createDataFrame(data, "id long, g string, v long")


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_rank_and_sums_in_chunks(spark, parts):
    df = rows(spark).repartition(parts)
    order = [F.col("v"), F.col("id")]
    for group in ([], ["g"]):
        plain = global_rank(df, order, group=group).collect()
        assert sorted(global_rank(df, order, group=group, max_rows=20).collect()) == sorted(plain)
    plain = running_sums(df, ["g"], order, {"s": F.col("v")}).collect()
    assert sorted(running_sums(df, ["g"], order, {"s": F.col("v")}, max_rows=20).collect()) == sorted(plain)


def test_grid_pairs_equal_all_overlaps(spark):
    rnd = random.Random(2)
    size = lambda: rnd.choice((3.0, 40.0, 700.0, 3000.0))
    make = lambda n: [(1, i, rnd.uniform(-50, 900), rnd.uniform(-50, 900), size(), size()) for i in range(n)]
    left, right = make(60), make(60)
    l_df = spark.createDataFrame(left, "k int, l long, lx double, ly double, lw double, lh double")
    r_df = spark.createDataFrame(right, "k int, r long, rx double, ry double, rw double, rh double")
    want = {
        (a[1], b[1])
        for a in left
        for b in right
        if min(a[2] + a[4], b[2] + b[4]) > max(a[2], b[2]) and min(a[3] + a[5], b[3] + b[5]) > max(a[3], b[3])
    }
    got = grid_pairs(l_df, r_df, ["k"], 0.0, cell=64.0).select("l", "r").collect()
    assert len(got) == len(want) and {(x.l, x.r) for x in got} == want


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_split_is_exact_and_stable(spark, parts):
    df = spark.range(997).select(F.col("id").alias("image_id"), (F.col("id") % 3).alias("c")).repartition(parts)
    counts = dict(assign_splits(df).groupBy("split").count().collect())
    assert counts == {"train": 997 - 199 - 99, "val": 199, "test": 99}
    by = assign_splits(df, by="c").join(df, "image_id").groupBy("c", "split").count().collect()
    assert {(r.c, r.split): r["count"] for r in by if r.split == "val"} == {(0, "val"): 66, (1, "val"): 66, (2, "val"): 66}
    assert {r.split for r in assign_splits(df, 100, 0, 0).collect()} == {"train"}


def test_throttle_walk_equals_doubling_and_brute_force(spark):
    rnd = random.Random(3)
    data = [(i, i % 2, rnd.randrange(0, 4000) / 4) for i in range(250)]
    df = spark.createDataFrame(data, "identity long, session long, s double").select(
        "identity", "session", F.timestamp_micros((F.col("s") * 1e6).cast("bigint")).alias("time")
    )
    want = set()
    for session in (0, 1):
        last = None
        for i, _, s in sorted((r for r in data if r[1] == session), key=lambda r: (r[2], r[0])):
            if last is None or s >= last + 7:
                want.add(i)
                last = s
    for limit in (1000, 10):
        assert {r.identity for r in throttle(df, 7, limit).collect()} == want


def test_components_and_pairs_equal_brute_force(spark):
    rnd = random.Random(4)
    vecs = [(i, [rnd.gauss(0, 1) + (3 if i % 4 == 0 else 0) for _ in range(6)]) for i in range(120)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = {
        (a, b)
        for a, u in vecs
        for b, v in vecs
        if a < b and sum(x * y for x, y in zip(u, v)) / (norm(u) * norm(v)) >= 0.8
    }
    for pivots, block in ((64, 2048), (5, 7), (1, 16)):
        got = similar_pairs(df, 0.8, pivots, block).collect()
        assert len(got) == len(want) and {(r.a, r.b) for r in got} == want
    label = {i: i for i, _ in vecs}
    for _ in vecs:
        for a, b in want:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for p in want for x in p}
    edges = spark.createDataFrame(sorted(want), "a long, b long")
    assert {(r.id, r.label) for r in components(edges).collect()} == {(i, label[i]) for i in linked}


def test_pairs_of_a_cluster_are_compared_once_and_in_slices(spark, monkeypatch):
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(60)], "vec_id long, embedding array<float>")
    want = sorted((r.a, r.b) for r in similar_pairs(df, 0.9).collect())
    monkeypatch.setattr(similarity, "PRODUCT_ROWS", 7)
    pairs = similar_pairs(df, 0.9, 5, 32)
    assert want and sorted((r.a, r.b) for r in pairs.collect()) == want
    groups = similarity.duplicate_groups(pairs)
    assert "CoGroup" not in groups._jdf.queryExecution().optimizedPlan().toString()
    assert groups.agg(F.sum("size")).first()[0] == len({i for p in want for i in p})


def test_place_images_modes(spark):
    moving = spark.createDataFrame([(1, "a.png", 1), (2, "a.png", 2), (3, "b.png", 3), (4, "a-2.png", 4)], "image_id long, filename string, pos long")
    target = spark.createDataFrame([("a.png",), ("a-1.png",)], "filename string")
    got = {r.image_id: (r.new_name, r.status) for r in place_images(moving, target).collect()}
    assert got == {1: ("a-3.png", "renamed"), 2: ("a-4.png", "renamed"), 3: ("b.png", "kept"), 4: ("a-2.png", "kept")}
    copied = {r.image_id: r.new_name for r in place_images(moving.where("image_id <> 4"), target, start=2).collect()}
    assert copied == {1: "a-2.png", 2: "a-3.png", 3: "b.png"}
    skipped = {r.image_id: r.status for r in place_images(moving, target, "skip").collect()}
    assert skipped == {1: "failed", 2: "failed", 3: "kept", 4: "kept"}
