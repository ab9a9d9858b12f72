"""Near pairs by signatures: recall near the threshold, growth of the candidates, copies and odd vectors, cap flags."""

from __future__ import annotations

import numpy as np
import pytest

from annoframe.operators import signatures
from annoframe.plans import models
from annoframe.plans.tables import Tables


def table(spark, rows):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def at_cosine(rng, v, c):
    """A unit vector at cosine ``c`` with ``v``."""
    v = v / np.linalg.norm(v)
    other = rng.standard_normal(len(v))
    other -= other @ v * v
    return c * v + np.sqrt(1 - c * c) * other / np.linalg.norm(other)


def test_recall_just_over_the_threshold(spark):
    rng, rows = np.random.default_rng(1), []
    for i in range(400):
        v = rng.standard_normal(64)
        rows += [(2 * i, v), (2 * i + 1, at_cosine(rng, v, 0.9201 + 0.0001 * (i % 100)))]
    got = {(r.a, r.b) for r in signatures.near_pairs(table(spark, rows), 0.92, recall=0.95).collect()}
    found = sum((2 * i, 2 * i + 1) in got for i in range(400)) / 400
    assert found >= 0.9
    assert all(b == a + 1 and a % 2 == 0 for a, b in got)  # random vectors are far apart


def test_no_pair_is_lost_at_high_recall_and_none_is_wrong(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 32))
    rows = [(i, base[i % 40] + rng.standard_normal(32) * 0.25) for i in range(300)]
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    want = {(i, j): c for i, j in zip(*np.triu_indices(300, 1)) if (c := float(unit[i] @ unit[j])) >= 0.9}
    got = {(r.a, r.b): r.similarity for r in signatures.near_pairs(table(spark, rows), 0.9, recall=1 - 1e-9).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_candidates_grow_nearly_linearly(spark):
    rng, counts = np.random.default_rng(3), []
    for n in (1000, 8000):
        firsts, _ = signatures.distinct_vectors(table(spark, enumerate(rng.standard_normal((n, 64)))))
        counts.append(signatures.candidates(firsts, signatures.Plan.of(n, 0.92, 0.99)).count() + n)
    assert counts[1] <= counts[0] * 8**1.3


def test_copies_meet_their_first_vector_only(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal(16)
    rows = [(i, v) for i in range(500)] + [(500, at_cosine(rng, v, 0.99))] + [(501 + i, rng.standard_normal(16)) for i in range(100)]
    pairs = sorted((r.a, r.b) for r in signatures.near_pairs(table(spark, rows), 0.95).collect())
    assert pairs == [(0, i) for i in range(1, 501)]


def test_vectors_without_direction_have_no_partner(spark):
    rows = [(1, None), (2, []), (3, [0, 0]), (4, [float("nan"), 1]), (5, [1, 1]), (6, [2, 2.001]), (7, [float("inf"), 0])]
    assert [(r.a, r.b) for r in signatures.near_pairs(table(spark, rows), 0.9).collect()] == [(5, 6)]
    assert signatures.near_pairs(table(spark, rows).limit(0), 0.9).count() == 0


def test_caps_are_flagged(spark):
    rng, rows = np.random.default_rng(5), []
    for i in range(20):
        v = rng.standard_normal(32)
        rows += [(3 * i + j, at_cosine(rng, v, 0.995)) for j in range(3)]
    flags = lambda **k: signatures.duplicate_report(table(spark, rows), 0.9, 10, recall=1 - 1e-9, **k)[2].first()
    free = flags()
    assert (free.total_images, free.analyzed, free.sample_capped, free.pairs_capped) == (60, 60, False, False)
    assert (free.group_count, free.duplicate_image_count, free.redundant_count, free.pairs) == (20, 60, 40, 60)
    capped = flags(sample=6, max_pairs=4)
    assert (capped.analyzed, capped.sample_capped, capped.pairs, capped.pairs_capped) == (6, True, 6, True)


def test_bad_arguments(spark):
    for threshold, recall in ((0.0, 0.9), (1.5, 0.9), (0.9, 1.0)):
        with pytest.raises(ValueError):
            signatures.near_pairs(table(spark, [(1, [1.0])]), threshold, recall)


def test_a_key_carries_a_short_sketch_and_a_pair_meets_once(spark):
    # At the recall of the queries, whole signatures made rows of 360 bytes a band.
    plan = signatures.Plan.of(150_000, 0.92, 1 - 1e-9)
    assert plan.words <= 4 and plan.sketched * plan.bits >= signatures.SKETCH_BITS
    rng = np.random.default_rng(6)
    base = rng.standard_normal((10, 64))
    rows = [(i, base[i % 10] + rng.standard_normal(64) * 0.05) for i in range(100)]
    firsts, _ = signatures.distinct_vectors(table(spark, rows))
    met = signatures.candidates(firsts, signatures.Plan.of(100, 0.92, 1 - 1e-9))
    assert sorted((r.a, r.b) for r in met.collect()) == [(a, b) for a in range(100) for b in range(a + 1, 100) if (b - a) % 10 == 0]


def test_clusters_cover_the_whole_table(spark, tmp_path):
    # Only pairs of the first 600 frames were clustered before.
    rng = np.random.default_rng(7)
    rows = [(i, rng.standard_normal(64).tolist(), 0) for i in range(300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    report = models.clusters_by_signatures(Tables(spark, str(tmp_path)))
    assert sorted(r.label // 3 for r in report.where("size > 1").collect()) == list(range(300))
