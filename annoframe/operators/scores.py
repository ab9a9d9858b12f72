"""Raw model rows to detections, classes and poses.

Each step is a table step: scores per row in columns, top-k by rank, gates by filter and
suppression by the group operator of ``matching``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions.geometry import clamp, cxcywh_to_xyxy, let
from annoframe.operators.images import class_threshold, confidence_floor, has_extent, keep_classes
from annoframe.operators.matching import nms

# Queries kept per image before the gate, slack of the probability test, anchor strides.
TOP_QUERIES = 300
PROBABILITY_SLACK = 1e-6
STRIDES = (8, 16, 32)
TASKS = ("object_detection", "instance_segmentation", "semantic_segmentation", "keypoint_detection")


def softmax(logits: Column) -> Column:
    """Class probabilities, shifted by the largest logit."""

    def shares(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
        return let(total, lambda s: F.transform(e, lambda v: v / s))

    return let(logits, lambda x: let(F.array_max(x), lambda top: let(F.transform(x, lambda v: F.exp(v - top)), shares)))


def sigmoid(v: Column) -> Column:
    return 1 / (1 + F.exp(-v))


def top_classes(
    rows: DataFrame, classes: Sequence[str], k: int = 1, default: float = 0.5,
    per_class: dict[str, float] | None = None, class_filter: Sequence[str] = (),
) -> DataFrame:
    """T4: ``image_id, rank, name, confidence``: rank 0 always, ranks under ``k`` at their threshold.

    The class filter and a missing name drop a rank; ties go to the lower class number.
    """
    k = max(1, int(k))
    pairs = F.transform(softmax(F.col("logits")), lambda p, i: F.struct((-p).alias("s"), i.alias("i")))
    ranked = rows.select("image_id", F.posexplode(F.slice(F.array_sort(pairs), 1, k)).alias("rank", "c"))
    names = F.array(*map(F.lit, classes))
    named = ranked.select(
        "image_id", "rank", F.get(names, F.col("c.i")).alias("name"), (-F.col("c.s")).alias("confidence")
    ).where("name is not null")
    kept = named.where((F.col("rank") == 0) | (F.col("confidence") >= class_threshold(F.col("name"), default, per_class)))
    return keep_classes(kept, class_filter)


def foreground_columns(width: int, classes: int) -> int:
    """Leading logit columns that are classes: the named ones, else all but the last."""
    if width <= 1:
        return max(width, 0)
    return classes if 0 < classes < width else width - 1


def best_class(scores: Column) -> Column:
    """``struct<score, class_id>`` of the largest score, the first on a tie."""
    return let(scores, lambda s: let(F.array_max(s), lambda m: F.struct(m.alias("score"), (F.array_position(s, m) - 1).alias("class_id"))))


def top_queries(rows: DataFrame, k: int = TOP_QUERIES) -> DataFrame:
    """T5: the ``k`` best queries of each image, by score then query number."""
    order = Window.partitionBy("image_id").orderBy(F.desc("score"), "query")
    return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def decode_detections(
    rows: DataFrame, classes: Sequence[str], width: int, confidence: float = 0.5, iou_threshold: float = 0.5
) -> DataFrame:
    """``image_id, query, logits, cx, cy, w, h`` (shares of the image) to kept boxes in pixels.

    ``width`` is the logit width; the image size comes as ``image_width, image_height``.
    """
    return nms(gated_boxes(rows, classes, width, confidence), iou_threshold)


def gated_boxes(rows: DataFrame, classes: Sequence[str], width: int, confidence: float) -> DataFrame:
    """Score, best class, top queries and gate, then X31 boxes in pixels cut to the image."""
    front = F.transform(F.slice("logits", 1, foreground_columns(width, len(classes))), sigmoid)
    scored = rows.withColumn("_b", best_class(front)).withColumns({"score": F.col("_b.score"), "class_id": F.col("_b.class_id")})
    top = top_queries(scored.drop("logits", "_b")).where(F.col("score") >= confidence)
    x1, y1, x2, y2 = cxcywh_to_xyxy(*[F.col(c) for c in ("cx", "cy", "w", "h")])
    zero, iw, ih = F.lit(0.0), F.col("image_width").cast("double"), F.col("image_height").cast("double")
    ends = top.withColumns(
        {
            "_x1": clamp(x1 * iw, zero, iw), "_y1": clamp(y1 * ih, zero, ih),
            "_x2": clamp(x2 * iw, zero, iw), "_y2": clamp(y2 * ih, zero, ih),
        }
    )
    extra = [c for c in ends.columns if c in ("keypoints", "image_width", "image_height")]
    return ends.select(
        "image_id", F.col("class_id").cast("string").alias("name"), F.col("query").alias("ann_id"),
        F.col("_x1").alias("x"), F.col("_y1").alias("y"), (F.col("_x2") - F.col("_x1")).alias("w"),
        (F.col("_y2") - F.col("_y1")).alias("h"), F.col("score").alias("confidence"), *extra,
    )


def anchor_grid(dims: tuple[int, int], strides: Sequence[int] = STRIDES) -> Column:
    """Every anchor as ``struct<gx, gy, stride>`` in model order: stride by stride, row by row."""

    def level(stride: int) -> Column:
        rows, cols = (F.sequence(F.lit(0), F.lit(d // stride - 1)) for d in dims)
        cell = lambda x, y: F.struct(x.alias("gx"), y.alias("gy"), F.lit(stride).alias("stride"))
        return F.flatten(F.transform(rows, lambda y: F.transform(cols, lambda x: cell(x, y))))

    return F.concat(*[level(s) for s in strides])


def decode_anchors(rows: DataFrame, dims: tuple[int, int], ratio: float = 1.0, strides: Sequence[int] = STRIDES) -> tuple[DataFrame, DataFrame]:
    """Dense rows ``image_id, anchor, raw`` to corner boxes and class scores, and the images refused.

    ``raw`` is dx, dy, dw, dh, objectness, then class scores. An image whose anchor count differs
    from the grid is refused whole. The grid is a small table joined on the anchor number.
    """
    size = sum((dims[0] // s) * (dims[1] // s) for s in strides)
    grid = rows.sparkSession.range(1).select(F.posexplode(anchor_grid(dims, strides)).alias("anchor", "g"))
    counts = rows.groupBy("image_id").agg(F.count(F.lit(1)).alias("anchors"))
    refused = counts.where(F.col("anchors") != size)
    good = rows.join(refused, "image_id", "left_anti").join(grid.select("anchor", "g.*"), "anchor")
    v = [F.get("raw", F.lit(i)) for i in range(5)]
    cx, cy = (v[0] + F.col("gx")) * F.col("stride"), (v[1] + F.col("gy")) * F.col("stride")
    w, h = F.exp(v[2]) * F.col("stride"), F.exp(v[3]) * F.col("stride")
    x1, y1, x2, y2 = (c / ratio for c in cxcywh_to_xyxy(cx, cy, w, h))
    scores = F.transform(F.slice("raw", 6, F.size("raw") - 5), lambda s: s * v[4])
    return good.select(
        "image_id", "anchor", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), scores.alias("scores")
    ), refused


def to_annotations(
    detections: DataFrame, classes: Sequence[str], confidence: float = 0.5, per_class: dict[str, float] | None = None,
    class_filter: Sequence[str] = (), box_classes: Sequence[str] = (),
) -> DataFrame:
    """Named annotation rows from ``class_id`` boxes; unknown class numbers are dropped.

    A detection that carries ``rings`` becomes a polygon unless its class is to be boxes.
    """
    names = F.array(*map(F.lit, classes))
    named = detections.withColumn("name", F.when(F.col("class_id") >= 0, F.get(names, F.col("class_id").cast("int"))))
    gated = named.where("name is not null").where(F.col("confidence") >= class_threshold(F.col("name"), confidence, per_class))
    as_box = F.lit(True)
    if "rings" in detections.columns:
        as_box = F.col("rings").isNull() | (F.col("name").isin(*box_classes) if box_classes else F.lit(False))
    return keep_classes(gated, class_filter).withColumn("type", F.when(as_box, F.lit("bbox")).otherwise(F.lit("polygon")))


def anchors_to_annotations(
    decoded: DataFrame, classes: Sequence[str], confidence: float, per_class: dict[str, float] | None = None, iou_threshold: float = 0.45
) -> DataFrame:
    """X33 + X35: best class, the loosest gate, suppression, then each class's own gate."""
    best = decoded.withColumn("_b", best_class(F.col("scores"))).where(
        F.col("_b.score") >= confidence_floor(confidence, per_class)
    )
    boxes = best.select(
        "image_id", F.col("_b.class_id").cast("string").alias("name"), F.col("anchor").cast("long").alias("ann_id"),
        F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("w"),
        (F.col("y2") - F.col("y1")).alias("h"), F.col("_b.score").alias("confidence"),
    )
    kept = nms(boxes, iou_threshold).withColumn("class_id", F.col("name").cast("int"))
    return to_annotations(kept, classes, confidence, per_class)


def decode_poses(
    rows: DataFrame, classes: Sequence[str], width: int, joints: Sequence[int], node_names: dict[str, Sequence[str]],
    confidence: float = 0.5, iou_threshold: float = 0.5, joint_threshold: float = 0.5,
) -> DataFrame:
    """Pose rows to keypoints ``image_id, instance_id, ann_id, joint, x, y, confidence``.

    ``keypoints`` holds ``max(joints)`` slots of x, y and a raw score per class. A detection keeps its
    own class's slots over the joint threshold, or its single best one; a one-joint class falls back
    to the box centre. Objects are numbered per image in query order.
    """
    slots = max(joints)
    kept = nms(gated_boxes(rows, classes, width, confidence), iou_threshold)
    cls = F.col("name").cast("int")
    known = kept.where(cls < len(classes)).withColumn("class_id", cls)
    arity = F.get(F.array(*[F.lit(int(j)) for j in joints]), F.col("class_id"))
    block = F.slice("keypoints", F.col("class_id") * slots * 3 + 1, arity * 3)
    triple = F.transform(
        F.sequence(F.lit(0), arity - 1),
        lambda j: F.struct(
            sigmoid(F.get(block, j * 3 + 2)).alias("c"),
            (-j).alias("n"),
            (F.get(block, j * 3) * F.col("image_width")).alias("x"),
            (F.get(block, j * 3 + 1) * F.col("image_height")).alias("y"),
        ),
    )
    found = known.withColumn("_all", F.when(arity > 0, triple)).where("_all is not null")
    good = F.filter("_all", lambda j: j["c"] >= joint_threshold)
    centre = F.struct(
        F.lit(0.0).alias("c"), F.lit(0).alias("n"), (F.col("x") + F.col("w") / 2).alias("x"), (F.col("y") + F.col("h") / 2).alias("y")
    )
    placed = (
        F.when(F.size(good) > 0, good).when(arity == 1, F.array(centre)).otherwise(F.array(F.array_max("_all")))
    )
    numbered = found.withColumn("_p", placed).withColumn(
        "instance_id", F.row_number().over(Window.partitionBy("image_id").orderBy("ann_id"))
    )
    rows = numbered.select(
        "image_id", "instance_id", "ann_id", "class_id", "confidence", arity.alias("arity"), F.explode("_p").alias("j")
    )
    names = F.array(*[F.array(*[F.lit(n) for n in node_names.get(c, [])]).cast("array<string>") for c in classes])
    own = F.get(F.get(names, F.col("class_id")), -F.col("j.n"))
    joint = F.when(F.col("arity") == 1, F.get(F.array(*map(F.lit, classes)), F.col("class_id"))).otherwise(
        F.coalesce(own, F.concat(F.lit("point_"), (-F.col("j.n")).cast("string")))
    )
    return rows.select(
        "image_id", "instance_id", "ann_id", joint.alias("joint"), F.col("j.x").alias("x"), F.col("j.y").alias("y"), "confidence"
    )


def pixel_probabilities(pixels: DataFrame) -> DataFrame:
    """``image_id, pixel, logits`` to probabilities.

    An image whose values all lie in [0, 1] is taken as it is (cut to the interval); others get a
    softmax over channels, or a sigmoid for one channel. The test is one aggregate per image.
    """
    low, high = F.array_min("logits"), F.array_max("logits")
    scaled = pixels.groupBy("image_id").agg(
        ((F.min(low) >= -PROBABILITY_SLACK) & (F.max(high) <= 1 + PROBABILITY_SLACK)).alias("scaled")
    )
    x = F.col("logits")
    cut = F.transform(x, lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))
    active = F.when(F.size(x) == 1, F.transform(x, sigmoid)).otherwise(softmax(x))
    return pixels.join(scaled, "image_id").withColumn("p", F.when(F.col("scaled"), cut).otherwise(active)).drop("scaled", "logits")


def pixel_classes(probabilities: DataFrame, confidence: float, per_class: dict[int, float] | None = None) -> DataFrame:
    """``class_id`` per pixel: the best channel over its gate; channel 0 of several is background.

    Class numbers count from 0 at the first channel that is not background; null is background.
    """
    p = F.col("p")
    gates = F.create_map(*[F.lit(v) for k, t in (per_class or {-1: 0.0}).items() for v in (int(k), float(t))])

    def gate(c: Column) -> Column:
        return F.coalesce(F.element_at(gates, c), F.lit(float(confidence)))

    single = F.when(p[0] >= gate(F.lit(0)), F.lit(0))
    top = best_class(p)
    cls = (top["class_id"] - 1).cast("int")
    many = F.when((cls >= 0) & (top["score"] >= gate(cls)), cls)
    return probabilities.withColumn("class_id", F.when(F.size(p) == 1, single).otherwise(many))


def region_confidence(classified: DataFrame) -> DataFrame:
    """Pixels and mean probability per image and class."""
    own = F.when(F.size("p") == 1, F.col("p")[0]).otherwise(F.get("p", F.col("class_id") + 1))
    return classified.where("class_id is not null").groupBy("image_id", "class_id").agg(
        F.count(F.lit(1)).alias("pixels"), F.avg(own).alias("confidence")
    )


def score_batches(rows: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """U4: a user's model on every row in Arrow batches, loaded once per task.

    ``load`` gives ``predict(batch) -> rows of schema``. Thresholds, top-k and suppression stay in the plan.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for pdf in batches:
            yield predict(pdf)

    return rows.mapInPandas(run, schema)


def typed_predictions(rows: DataFrame, task: str) -> DataFrame:
    """Prediction rows of a geometry task: zero-extent shapes dropped, missing ids filled, task named."""
    if task not in TASKS:
        raise ValueError(f"task is one of {', '.join(TASKS)}")
    kept = rows.where(has_extent(F.col("bbox"), F.col("obb"), F.col("rings")))
    return kept.withColumn("id", F.coalesce("id", F.uuid())).withColumn("task", F.lit(task))
