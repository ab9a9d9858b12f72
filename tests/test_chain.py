"""geometry moved in batches equals the column expressions, which take what is null, not finite or of no known kind."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from annoframe.operators import chain, transforms

SPECS = [
    {"op": "flip"}, {"op": "crop", "scale": 0.5, "p": 0.8}, {"op": "rotate90"}, {"op": "rotate", "degrees": 40, "p": 0.5},
    {"op": "brightness"}, {"op": "vflip", "p": 0.3}, {"op": "resize", "width": 90, "height": 70}, {"op": "shear", "degrees": 30},
]
SCHEMA = (
    "image_id long, ann_id long, type string, bbox struct<x:double,y:double,w:double,h:double>, "
    "obb struct<cx:double,cy:double,w:double,h:double,angle:double>, rings array<array<struct<x:double,y:double>>>, "
    "path array<struct<x:double,y:double>>, point struct<x:double,y:double>"
)


def shapes(rng, n):
    odd = [None, math.nan, math.inf, 0.0, -0.0, 1e308]
    number = lambda lo, hi, share: rng.choice(odd) if rng.random() < share else rng.choice([float(rng.randint(lo, hi)), rng.uniform(lo, hi)])
    for i in range(n):
        share = 0.05 if i % 4 == 0 else 0.0
        at = lambda: (number(-20, 140, share), number(-20, 120, share))  # noqa: E731, B023
        line = lambda most: [None if rng.random() < share else at() for _ in range(rng.randint(0, most))]  # noqa: E731, B023
        kind = rng.choice(["bbox", "bbox", "turned", "polygon", "polyline", "keypoint", *([None, "mask"] if share else [])])
        bbox = (*at(), number(0, 90, share), number(0, 70, share)) if kind in ("bbox", "turned", "mask") else None
        obb = (*at(), number(1, 60, share), number(1, 50, share), number(-400, 400, share)) if kind == "turned" else None
        rings = [None if rng.random() < share else line(6) for _ in range(rng.randint(0, 3))] if kind == "polygon" else None
        path, point = line(5) if kind == "polyline" else None, at() if kind == "keypoint" else None
        if rng.random() < share:
            bbox = rings = path = point = None
        if path and rng.random() < 0.3:
            path = [p for p in path for _ in range(2)]
        yield i % 40, i, "bbox" if kind == "turned" else kind, bbox, obb, rings, path, point


def close(a, b):
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(map(close, a, b))
    if isinstance(a, float) and isinstance(b, float):
        # An angle near a whole turn may fall on either side of it.
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7) or abs(abs(a - b) - 360) < 1e-7
    return a == b


def test_batches_equal_the_column_expressions(spark, monkeypatch):
    rows = spark.createDataFrame(list(shapes(random.Random(4), 1600)), SCHEMA)
    images = spark.createDataFrame([(i, 100 + i, 80 + i % 7) for i in range(39)], "image_id long, width int, height int")
    ops = transforms.build_ops(SPECS)
    variants = transforms.plan_variants(images, ops, 2, 5, include_original=True)

    def moved():
        out = transforms.augment_annotations(rows, variants, ops).select("ann_id", "variant", *transforms.PARTS)
        return out, {(r.ann_id, r.variant): tuple(r)[2:] for r in out.collect()}

    frame, batched = moved()
    assert "ArrowEvalPython" in frame._jdf.queryExecution().executedPlan().toString()
    own = F.struct(F.lit(False).alias("done"), transforms._shape().alias("shape"))
    monkeypatch.setattr(chain, "chained", lambda *_: own)
    _, expressed = moved()
    assert batched.keys() == expressed.keys()
    assert [(k, batched[k], v) for k, v in expressed.items() if not close(batched[k], v)] == []


def test_most_rows_are_moved_in_batches(spark):
    rows = spark.createDataFrame([r for r in shapes(random.Random(6), 400) if r[1] % 4], SCHEMA)
    images = spark.createDataFrame([(i, 100, 80) for i in range(40)], "image_id long, width int, height int")
    ops = transforms.build_ops(SPECS)
    both = rows.join(transforms.plan_variants(images, ops, 1, 5), "image_id")
    steps = [F.col(f"_step{i}") for i in range(len(ops)) if ops[i].name in transforms.GEOMETRIC]
    done = chain.chained(F.col("type"), transforms._own_geometry(), F.lit(True), steps, [False] * len(steps), transforms.PARTS, 0.1)["done"]
    assert both.where(done).count() == rows.count()
