"""Remapped and augmented geometry: plain boxes by columns, rings inside the frame without a clip, ops one after the other."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from annoframe.functions import geometry as g
from annoframe.operators import transforms
from annoframe.session import SETTINGS, prepare

INF, NAN = float("inf"), float("nan")
BOXES = [
    (0.0, 0.0, 10.0, 10.0), (-5.0, 3.0, 10.0, 4.0), (38.0, 28.0, 30.0, 30.0), (41.0, 1.0, 5.0, 5.0), (3.0, 3.0, 0.0, 4.0),
    (3.0, 3.0, -2.0, 4.0), (NAN, 1.0, 2.0, 2.0), (1.0, INF, 2.0, 2.0), (1.0, 1.0, INF, 2.0), (None, 1.0, 2.0, 2.0), (-100.0, -100.0, 400.0, 400.0),
]


def frame(spark):
    empty = {c: F.lit(None).cast(kind) for c, kind in transforms.PARTS.items() if c != "bbox"}
    rows = spark.createDataFrame([(i, *b) for i, b in enumerate(BOXES)], "ann_id int, x double, y double, w double, h double")
    return rows.select("ann_id", F.lit("bbox").alias("type"), F.struct("x", "y", "w", "h").alias("bbox")).withColumns(empty)


@pytest.mark.parametrize("clip", [True, False])
def test_plain_boxes_are_remapped_by_columns_alone(spark, clip):
    fn, size = g.affine(1, 0.25, -1, 0, -1, 20), (F.lit(40.0), F.lit(30.0))
    out = transforms.remap(frame(spark), fn, *size, clip, 0.1)
    want = frame(spark).withColumn("m", g.remap_box(F.col("bbox"), fn, *size, clip, 0.1)).where("m is not null").select("ann_id", "m.*")
    assert sorted(map(str, out.select("ann_id", "bbox.*").collect())) == sorted(map(str, want.collect()))
    assert out.columns == frame(spark).columns
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan


def test_generated_methods_stay_below_what_the_jvm_compiles(spark):
    assert int(SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000
    assert prepare(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == SETTINGS["spark.sql.codegen.hugeMethodLimit"]


def test_no_draw_is_made_for_what_is_certain(spark):
    images = spark.range(3).select(F.col("id").alias("image_id"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    certain = transforms.plan_variants(images, transforms.build_ops([{"op": "vflip", "p": 1.0}, {"op": "rotate90", "k": 1}]), 2, 1)
    assert "md5" not in certain._jdf.queryExecution().optimizedPlan().toString()
    steps = certain.select("_step0.on", "_step0.amount", "_step1.a", "_step1.b", "width", "height").distinct().collect()
    assert [tuple(r) for r in steps] == [(True, 0.0, 0.0, 1.0, 480, 640)]


def test_rings_at_and_over_the_border_keep_their_share(spark):
    """On the border a ring is whole, even at a floor of all of it; a step outside it is measured."""
    ring = lambda x: F.array(*[g.point(F.lit(a + x), F.lit(b)) for a, b in ((0.0, 0.0), (40.0, 0.0), (40.0, 30.0), (0.0, 30.0))])
    same, size = g.affine(1, 0, 0, 0, 1, 0), (F.lit(40.0), F.lit(30.0))
    row = spark.range(1).select(
        *[g.remap_rings(F.array(ring(x)), same, *size, True, floor)["bbox"]["w"] for x in (0.0, 10.0) for floor in (1.0, 0.75, 0.7)]
    ).first()
    assert list(row) == [40.0, 40.0, 40.0, None, 30.0, 30.0]
