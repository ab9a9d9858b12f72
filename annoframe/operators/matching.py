"""Greedy IoU matching of predictions to truth boxes (J2, J3), non-maximum suppression (J8) and
draft de-duplication (J9).

Box tables are long: ``image_id, name, ann_id, x, y, w, h`` and, for predictions, ``confidence``.
``ann_id`` is the position of a box in its image where order matters.

Images of ordinary size are folded: their overlapping pairs become one sorted array per group and a
SQL fold walks it. Images with more than ``hot_group_rows`` boxes never become one array: their
pairs are made per grid cell over distinct geometries and settled in rounds, each of which fixes
every pair that no earlier prediction could change.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions.geometry import finite, iou
from annoframe.scale import grid_pairs, hot_groups, split_hot
from annoframe.session import cut

HOT_GROUP_ROWS = 4096


def _keys(by_class: bool) -> list[str]:
    return ["image_id", "name"] if by_class else ["image_id"]


def _check_threshold(value: float) -> None:
    if not 0.0 < value <= 1.0:
        raise ValueError(f"iou_threshold must be in (0, 1], got {value}")


def _pair_iou() -> Column:
    return iou("lx", "ly", "lw", "lh", "rx", "ry", "rw", "rh")


def _real(df: DataFrame) -> DataFrame:
    """Boxes of which every number is there and finite."""
    return df.where(finite(F.col("x")) & finite(F.col("y")) & finite(F.col("w")) & finite(F.col("h")))


def _usable(df: DataFrame) -> DataFrame:
    return _real(df).where((F.col("w") > 0) & (F.col("h") > 0))


def _ranked_confidence() -> Column:
    """Confidence for ordering: null and NaN say nothing and come last, with each other by id."""
    c = F.col("confidence").cast("double")
    return F.when(c.isNull() | F.isnan(c), F.lit(float("-inf"))).otherwise(c)


def greedy_matches(
    pred: DataFrame,
    gt: DataFrame,
    iou_threshold: float = 0.5,
    by_class: bool = True,
    hot_group_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """``image_id, pred_id, gt_id`` and the class for every claimed pair: ``name``, or
    ``pred_name`` and ``gt_name`` when classes are not compared.

    Predictions go by confidence (ties by id; null and NaN last); each claims the free truth box with the largest IoU
    at or above the threshold, the later one on equal IoU.
    """
    _check_threshold(iou_threshold)
    keys, pred = _keys(by_class), pred.withColumn("confidence", _ranked_confidence())
    hot = hot_groups([pred, gt], keys, hot_group_rows) if hot_group_rows else None
    preds, hot_preds = split_hot(_usable(pred), hot, keys)
    gts, hot_gts = split_hot(_usable(gt), hot, keys)
    out = _fold_matches(preds, gts, keys, iou_threshold)
    if hot is not None:
        rounds = _round_matches(hot_preds, hot_gts, keys, iou_threshold)
        if not by_class:
            rounds = rounds.join(
                hot_preds.select("image_id", F.col("ann_id").alias("pred_id"), F.col("name").alias("pred_name")),
                ["image_id", "pred_id"],
            ).join(
                hot_gts.select("image_id", F.col("ann_id").alias("gt_id"), F.col("name").alias("gt_name")),
                ["image_id", "gt_id"],
            )
        out = out.unionByName(rounds)
    return out


def _left(pred: DataFrame, keys: list[str]) -> DataFrame:
    return pred.select(
        *keys,
        F.col("ann_id").alias("pred_id"),
        "confidence",
        *[F.col(c).alias(f"l{c}") for c in "xywh"],
    )


def greedy_hits(
    pred: DataFrame, gt: DataFrame, thresholds: Sequence[float], hot_group_rows: int | None = HOT_GROUP_ROWS
) -> DataFrame:
    """J2 at several thresholds from one join: ``image_id, pred_id, hits`` of every prediction that claims a box at one of
    them; ``hits`` has 1 or 0 for each threshold."""
    for t in thresholds:
        _check_threshold(t)
    keys, pred = _keys(True), pred.withColumn("confidence", _ranked_confidence())
    hot = hot_groups([pred, gt], keys, hot_group_rows) if hot_group_rows else None
    preds, hot_preds = split_hot(_usable(pred), hot, keys)
    gts, hot_gts = split_hot(_usable(gt), hot, keys)
    edges = _edges(preds, gts, keys, min(thresholds), [])
    names = [f"_c{i}" for i in range(len(thresholds))]
    over = lambda t: F.filter("edges", lambda e: e["i"] <= -t)
    reach = [over(float(t)) for t in thresholds]
    claimed = edges.withColumns({n: _claimed(r, []) for n, r in zip(names, reach)})
    ids = F.array_distinct(F.flatten(F.array(*[F.col(f"{n}.pred_id") for n in names])))
    took = lambda p: F.array(*[F.array_contains(F.col(f"{n}.pred_id"), p).cast("int") for n in names])
    rows = F.transform(ids, lambda p: F.struct(p.alias("pred_id"), took(p).alias("hits")))
    out = claimed.select("image_id", F.inline(rows))
    if hot is not None:
        flags = [F.array(*[F.lit(int(j == i)) for j in range(len(thresholds))]) for i in range(len(thresholds))]
        parts = [
            _round_matches(hot_preds, hot_gts, keys, t).select("image_id", "pred_id", flag.alias("hits"))
            for t, flag in zip(thresholds, flags)
        ]
        rounds = reduce(DataFrame.unionAll, parts).groupBy("image_id", "pred_id")
        out = out.unionByName(rounds.agg(F.array(*[F.max(F.get("hits", F.lit(i))) for i in range(len(flags))]).alias("hits")))
    return out


def _edges(pred: DataFrame, gt: DataFrame, keys: list[str], threshold: float, labels: list[str]) -> DataFrame:
    """The sorted array of a group's pairs at or above the threshold."""
    left = pred.select(
        *keys, F.col("ann_id").alias("pred_id"), "confidence", *[F.col(c).alias(f"l{c}") for c in "xywh"],
        *[F.col("name").alias(n) for n in labels[:1]],
    )
    right = gt.select(
        *keys, F.col("ann_id").alias("gt_id"), *[F.col(c).alias(f"r{c}") for c in "xywh"],
        *[F.col("name").alias(n) for n in labels[1:]],
    )
    pairs = left.join(right, keys).withColumn("iou", _pair_iou()).where(F.col("iou") >= threshold)
    edge = F.struct(
        (-F.col("confidence")).alias("o"), "pred_id", (-F.col("iou")).alias("i"), (-F.col("gt_id")).alias("g"), *labels
    )
    return pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def _claimed(edges: Column, labels: list[str]) -> Column:
    """The pairs claimed by a walk over a group's sorted pairs."""
    kinds = "".join(f",{n}:string" for n in labels)
    return F.aggregate(
        edges,
        F.array().cast(f"array<struct<pred_id:bigint,gt_id:bigint{kinds}>>"),
        lambda acc, e: F.when(
            F.exists(acc, lambda m: (m["pred_id"] == e["pred_id"]) | (m["gt_id"] == -e["g"])), acc
        ).otherwise(
            F.concat(
                acc,
                F.array(
                    F.struct(e["pred_id"].alias("pred_id"), (-e["g"]).alias("gt_id"), *[e[n].alias(n) for n in labels])
                ),
            )
        ),
    )


def _fold_matches(pred: DataFrame, gt: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    labels = [] if "name" in keys else ["pred_name", "gt_name"]
    return _edges(pred, gt, keys, threshold, labels).select(*keys, F.inline(_claimed(F.col("edges"), labels)))


def _round_matches(pred: DataFrame, gt: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Matching without any per-group array.

    Truth boxes of equal geometry are one site with a capacity, so n copies never give n pairs per
    prediction. In each round a prediction is settled when its best open site is also one where it
    is among the first ``capacity`` open predictions: nobody before it can still change that. Sites
    that tie with another site on IoU settle one prediction a round, so that the order of their
    copies stays exact.
    """
    geometry = [*keys, "x", "y", "w", "h"]
    copies = cut(
        gt.select(
            *keys,
            F.max("ann_id").over(Window.partitionBy(*geometry)).alias("site"),
            F.row_number().over(Window.partitionBy(*geometry).orderBy(F.desc("ann_id"))).alias("nth"),
            F.col("ann_id").alias("gt_id"),
        )
    )
    sites = gt.groupBy(*geometry).agg(F.count(F.lit(1)).alias("capacity"), F.max("ann_id").alias("site"))
    right = sites.select(*keys, "site", *[F.col(c).alias(f"r{c}") for c in "xywh"])
    equal = Window.partitionBy(*keys, "pred_id", "iou")
    open_pairs = cut(
        grid_pairs(_left(pred, keys), right, keys, threshold)
        .withColumn("iou", _pair_iou())
        .where(F.col("iou") >= threshold)
        .select(*keys, "pred_id", "confidence", "site", "iou", (F.count(F.lit(1)).over(equal) > 1).alias("tie"))
    )
    tied = open_pairs.where("tie").select(*keys, "site", F.lit(True).alias("tied")).distinct()
    room = cut(
        sites.select(*keys, "site", "capacity", F.lit(0).cast("long").alias("used"))
        .join(tied, [*keys, "site"], "left")
        .withColumn("tied", F.coalesce("tied", F.lit(False)))
    )
    taken = None
    while open_pairs.limit(1).count():
        state = room.join(copies.withColumn("used", F.col("nth") - 1), [*keys, "site", "used"])
        best = Window.partitionBy(*keys, "pred_id").orderBy(F.desc("iou"), F.desc("gt_id"))
        line = Window.partitionBy(*keys, "site").orderBy(F.desc("confidence"), "pred_id")
        fixed = cut(
            open_pairs.join(state, [*keys, "site"])
            .withColumn("wish", F.row_number().over(best))
            .withColumn("place", F.row_number().over(line))
            .where("wish = 1 and (place = 1 or (not tied and place <= capacity - used))")
            .select(*keys, "pred_id", "confidence", "site")
        )
        taken = fixed if taken is None else taken.unionByName(fixed)
        more = fixed.groupBy(*keys, "site").agg(F.count(F.lit(1)).alias("more"))
        room = cut(
            room.join(more, [*keys, "site"], "left")
            .select(
                *keys, "site", "capacity", (F.col("used") + F.coalesce("more", F.lit(0))).alias("used"), "tied"
            )
            .where("used < capacity")
        )
        open_pairs = cut(
            open_pairs.join(fixed.select(*keys, "pred_id"), [*keys, "pred_id"], "left_anti").join(
                room.select(*keys, "site"), [*keys, "site"], "left_semi"
            )
        )
    if taken is None:
        return pred.select(*keys, F.col("ann_id").alias("pred_id"), F.col("ann_id").alias("gt_id")).limit(0)
    order = Window.partitionBy(*keys, "site").orderBy(F.desc("confidence"), "pred_id")
    return (
        taken.withColumn("nth", F.row_number().over(order))
        .join(copies, [*keys, "site", "nth"])
        .select(*keys, "pred_id", "gt_id")
    )


# --- suppression ---------------------------------------------------------------------------------

SUPPRESSION_EPS = 1e-9


def _soft_iou(a: Column, b: Column) -> Column:
    """IoU of two boxes as suppression measures it: a small constant keeps the divisor above zero."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"]))
    h = F.greatest(zero, F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"]))
    area = F.greatest(zero, a["w"]) * F.greatest(zero, a["h"]) + F.greatest(zero, b["w"]) * F.greatest(zero, b["h"])
    return w * h / (area - w * h + SUPPRESSION_EPS)


def nms(
    boxes: DataFrame,
    iou_threshold: float = 0.5,
    by_class: bool = True,
    hot_group_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """The boxes no kept, higher-scoring box of the group overlaps by more than the threshold.

    Order inside a group: confidence descending (null and NaN last), then ``ann_id``. A box with a null, NaN or infinite
    place or size is no detection: it is left out and suppresses nothing, whatever the size of its group.
    """
    if not 0.0 <= iou_threshold <= 1.0:
        raise ValueError(f"iou_threshold must be in [0, 1], got {iou_threshold}")
    boxes, keys = _real(boxes).withColumn("_rank", _ranked_confidence()), _keys(by_class)
    hot = hot_groups([boxes], keys, hot_group_rows) if hot_group_rows else None
    small, large = split_hot(boxes, hot, keys)
    kept = _fold_nms(small, keys, iou_threshold)
    if hot is not None:
        kept = kept.unionByName(_round_nms(large, keys, iou_threshold))
    return kept.drop("_rank")


def _fold_nms(boxes: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    fields = [c for c in boxes.columns if c not in keys]
    row = F.struct((-F.col("_rank")).alias("_o"), F.col("ann_id").alias("_i"), *fields)
    groups = boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    empty = F.filter("rows", lambda r: F.lit(False))
    kept = F.aggregate(
        "rows",
        empty,
        lambda acc, r: F.when(F.exists(acc, lambda k: _soft_iou(k, r) > threshold), acc).otherwise(
            F.concat(acc, F.array(r))
        ),
    )
    return groups.select(*keys, F.inline(kept)).select(*boxes.columns)


def _round_nms(boxes: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Suppression in rounds over grid pairs, for groups too large for one array.

    A copy of a box is dropped at once by its first copy. A box with no open earlier neighbour is
    kept and drops its later neighbours; each round settles all such boxes together.
    """
    area = F.col("w") * F.col("h")
    solid = (F.col("w") > 0) & (F.col("h") > 0)
    copies = Window.partitionBy(*keys, "x", "y", "w", "h").orderBy(F.desc("_rank"), "ann_id")
    absorbs = solid & (area / (area + SUPPRESSION_EPS) > threshold)
    open_boxes = cut(
        boxes.withColumn("_copy", F.row_number().over(copies)).where((F.col("_copy") == 1) | ~absorbs).drop("_copy")
    )
    flat = open_boxes.where(~solid)
    solid_boxes = open_boxes.where(solid)

    def side(p: str) -> DataFrame:
        return solid_boxes.select(
            *keys, F.col("ann_id").alias(f"{p}id"), F.col("_rank").alias(f"{p}c"), *[F.col(c).alias(f"{p}{c}") for c in "xywh"]
        )

    def shape(p: str) -> Column:
        return F.struct(*[F.col(f"{p}{c}").alias(c) for c in "xywh"])

    earlier = (F.col("rc") > F.col("lc")) | ((F.col("rc") == F.col("lc")) & (F.col("rid") < F.col("lid")))
    edges = cut(
        grid_pairs(side("l"), side("r"), keys, max(threshold, 0.0))
        .where(earlier & (_soft_iou(shape("l"), shape("r")) > threshold))
        .select(*keys, "lid", "rid")
    )
    open_ids = solid_boxes.select(*keys, F.col("ann_id").alias("id"))
    kept = None
    while True:
        waiting = edges.select(*keys, F.col("lid").alias("id")).distinct()
        fixed = cut(open_ids.join(waiting, [*keys, "id"], "left_anti"))
        kept = fixed if kept is None else kept.unionByName(fixed)
        if not edges.limit(1).count():
            break
        dropped = edges.join(fixed.withColumnRenamed("id", "rid"), [*keys, "rid"], "left_semi").select(
            *keys, F.col("lid").alias("id")
        ).distinct()
        open_ids = cut(
            open_ids.join(fixed, [*keys, "id"], "left_anti").join(dropped, [*keys, "id"], "left_anti")
        )
        live = open_ids
        edges = cut(
            edges.join(live.withColumnRenamed("id", "lid"), [*keys, "lid"], "left_semi").join(
                live.withColumnRenamed("id", "rid"), [*keys, "rid"], "left_semi"
            )
        )
    survivors = solid_boxes.join(kept.withColumnRenamed("id", "ann_id"), [*keys, "ann_id"], "left_semi")
    return survivors.select(*boxes.columns).unionByName(flat.select(*boxes.columns))


def new_drafts(
    drafts: DataFrame, existing: DataFrame, iou_threshold: float = 0.9, hot_group_rows: int | None = HOT_GROUP_ROWS
) -> DataFrame:
    """Drafts that repeat no annotation of their image and class."""
    _check_threshold(iou_threshold)
    keys = _keys(True)
    hot = hot_groups([drafts, existing], keys, hot_group_rows) if hot_group_rows else None
    small, large = split_hot(drafts, hot, keys)
    old, old_large = split_hot(existing, hot, keys)
    cols = [F.col(f"o.{k}") == F.col(f"d.{k}") for k in keys]
    overlap = iou(*[F.col(f"d.{c}") for c in "xywh"], *[F.col(f"o.{c}") for c in "xywh"]) >= iou_threshold
    out = small.alias("d").join(old.alias("o"), [*cols, overlap], "left_anti")
    if hot is not None:
        left = _usable(large).select(*keys, "ann_id", *[F.col(c).alias(f"l{c}") for c in "xywh"])
        right = _usable(old_large).select(*keys, *[F.col(c).alias(f"r{c}") for c in "xywh"]).distinct()
        repeats = grid_pairs(left, right, keys, iou_threshold).where(_pair_iou() >= iou_threshold)
        out = out.unionByName(large.join(repeats.select(*keys, "ann_id").distinct(), [*keys, "ann_id"], "left_anti"))
    return out
