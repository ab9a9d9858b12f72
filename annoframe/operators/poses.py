"""Keypoints grouped to objects, boxed, matched to templates and slotted.

A keypoint row is ``image_id, ann_id, pos, joint, px, py, instance_id, attributes``. Templates are
``class, place, joints, edges``; both the template list and its joints are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions.geometry import box
from annoframe.functions.keypoints import MIN_SIDE, coco_triplets, floor_sides, has_finite_point, visibility
from annoframe.scale import running_sums

OBJECT = ["image_id", "object_id"]


def with_objects(keypoints: DataFrame) -> DataFrame:
    """Finite points with ``object_id``; a point without an instance is an object of its own."""
    own = F.concat(F.lit("p"), F.col("ann_id").cast("string"))
    shared = F.concat(F.lit("i"), F.col("instance_id").cast("string"))
    return keypoints.where(has_finite_point(F.col("px"), F.col("py"))).withColumn("object_id", F.coalesce(shared, own))


def ordered_objects(keypoints: DataFrame, joints: list[str] | None = None) -> DataFrame:
    """Every point with its 1-based place in its object: template order, then position."""
    rank = F.coalesce(
        *[F.when(F.col("joint") == j, F.lit(i)) for i, j in enumerate(joints or [])], F.lit(len(joints or []))
    )
    order = Window.partitionBy(*OBJECT).orderBy(rank, "pos")
    return with_objects(keypoints).withColumn("place", F.row_number().over(order))


def object_boxes(keypoints: DataFrame) -> DataFrame:
    """The enclosure of each object's points, sides at least one pixel."""
    hull = with_objects(keypoints).groupBy(*OBJECT).agg(
        *[f(c).alias(f"{n}{c}") for c in ("px", "py") for n, f in (("lo_", F.min), ("hi_", F.max))],
        F.count(F.lit(1)).alias("points"),
    )
    raw = box(
        F.col("lo_px"), F.col("lo_py"), F.col("hi_px") - F.col("lo_px"), F.col("hi_py") - F.col("lo_py")
    )
    return hull.select(*OBJECT, "points", floor_sides(raw, F.lit(MIN_SIDE)).alias("bbox"))


def template_slots(templates: DataFrame) -> DataFrame:
    return templates.select("class", F.col("place").alias("class_place"), F.posexplode("joints").alias("slot", "joint"))


def match_templates(keypoints: DataFrame, templates: DataFrame) -> DataFrame:
    """The class covering most joint names of each object; the earlier class on a tie.

    The templates become one row beside every point: a join on the joint would deal all points to a task per name. Only
    names of a template are collected, so a set never exceeds the list.
    """
    slots = template_slots(templates).select("class", "class_place", "joint").distinct()
    by_class = slots.groupBy("class").agg(F.min("class_place").alias("p"), F.collect_list("joint").alias("joints"))
    listed = by_class.agg(
        F.collect_list(F.struct("class", "p", "joints")).alias("_t"), F.array_distinct(F.flatten(F.collect_list("joints"))).alias("_known")
    )
    named = with_objects(keypoints).select(*OBJECT, "joint").join(F.broadcast(listed.select("_known")))
    seen = named.where(F.array_contains("_known", F.col("joint"))).groupBy(*OBJECT).agg(F.collect_set("joint").alias("_seen"))

    def covered(t: Column) -> Column:
        hits = F.size(F.filter(t["joints"], lambda j: F.array_contains("_seen", j)))
        return F.struct(hits.alias("hits"), (-t["p"]).alias("p"), t["class"].alias("class"))

    best = F.array_max(F.transform("_t", covered))
    return seen.join(F.broadcast(listed.select("_t"))).select(*OBJECT, best["class"].alias("class"))


def slotted(keypoints: DataFrame, templates: DataFrame) -> DataFrame:
    """Every point with its object's class and ``slot``; null slot = spilled.

    A point spills when its name is not in the template or an earlier point holds the slot.
    """
    points = with_objects(keypoints).join(match_templates(keypoints, templates), OBJECT, "left")
    slots = template_slots(templates).groupBy("class", "joint").agg(F.max("slot").alias("slot"))
    first = Window.partitionBy(*OBJECT, "joint").orderBy("pos")
    return (
        points.withColumn("_n", F.row_number().over(first))
        .join(F.broadcast(slots), ["class", "joint"], "left")
        .withColumn("slot", F.when(F.col("_n") == 1, F.col("slot")))
        .drop("_n")
    )


def limbs(keypoints: DataFrame, templates: DataFrame) -> DataFrame:
    """Template edges whose two joints are both placed in the same object."""
    placed = slotted(keypoints, templates).where("slot is not null").select(*OBJECT, "class", "slot", "px", "py")
    edges = templates.select("class", F.inline("edges"))
    start = placed.select(*OBJECT, "class", F.col("slot").alias("i"), F.col("px").alias("x1"), F.col("py").alias("y1"))
    end = placed.select(*OBJECT, "class", F.col("slot").alias("j"), F.col("px").alias("x2"), F.col("py").alias("y2"))
    return start.join(F.broadcast(edges), ["class", "i"]).join(end, [*OBJECT, "class", "j"]).select(
        *OBJECT, "class", "i", "j", "x1", "y1", "x2", "y2"
    )


def pose_entries(keypoints: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per matched object with its ``[x, y, v]`` array over the template's slots.

    Only slot winners are collected, so an array never exceeds the template's size.
    """
    won = slotted(keypoints, templates).where("slot is not null")
    entry = F.struct("slot", F.struct(F.col("px").alias("x"), F.col("py").alias("y"), visibility(F.col("attributes")).alias("v")))
    held = won.groupBy(*OBJECT, "class").agg(F.map_from_entries(F.collect_list(entry)).alias("slots"))
    sizes = templates.select("class", F.size("joints").alias("size"))
    return held.join(F.broadcast(sizes), "class").select(
        *OBJECT, "class", coco_triplets(F.col("slots"), F.col("size")).alias("keypoints")
    )


def number_objects(entries: DataFrame) -> DataFrame:
    """Image-scoped ids in annotation order for rows with ``lone``; a lone landmark takes none."""
    counted = running_sums(
        entries, ["file_name"], [F.col("pos")], {"instance_id": (~F.col("lone")).cast("int")}
    )
    return counted.withColumn("instance_id", F.when(~F.col("lone"), F.col("instance_id")))
