"""Column expressions on keypoints, triplets and pose templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from annoframe.functions.geometry import box, clamp, finite, let, points_from_flat

# The attribute that marks an occluded joint and the spellings read as true.
OCCLUDED = "occluded"
TRUE_SPELLINGS = ("true", "1", "yes", "y", "t", "occluded")

# Smallest side of an instance box in pixels, and as a share of the short image side.
MIN_SIDE = 1.0
MIN_SIDE_SHARE = 0.05


def has_finite_point(x: Column, y: Column) -> Column:
    """F8: both coordinates are real numbers."""
    return finite(x) & finite(y)


def visibility(attributes: Column) -> Column:
    """1 for a joint marked occluded, else 2."""
    said = F.lower(F.trim(F.element_at(attributes, OCCLUDED)))
    return F.when(said.isin(*TRUE_SPELLINGS), F.lit(1)).otherwise(F.lit(2))


def other_attributes(attributes: Column) -> Column:
    """The attributes without the one the visibility already tells."""
    return F.map_filter(attributes, lambda k, v: k != OCCLUDED)


def floor_sides(b: Column, floor: Column) -> Column:
    """A box whose sides are at least ``floor``, padded about its centre."""
    grow_w, grow_h = F.greatest(F.lit(0.0), floor - b["w"]), F.greatest(F.lit(0.0), floor - b["h"])
    return box(b["x"] - grow_w / 2, b["y"] - grow_h / 2, F.greatest(b["w"], floor), F.greatest(b["h"], floor))


def trainable_box(b: Column, width: Column, height: Column) -> Column:
    """Sides at least 5 % of the short image side, cut to the image; as given without a size."""
    floor = F.greatest(F.lit(MIN_SIDE), F.least(width, height) * MIN_SIDE_SHARE)
    wide = floor_sides(b, floor)
    zero = F.lit(0.0)
    x0, x1 = clamp(wide["x"], zero, width), clamp(wide["x"] + wide["w"], zero, width)
    y0, y1 = clamp(wide["y"], zero, height), clamp(wide["y"] + wide["h"], zero, height)
    return F.when((width > 0) & (height > 0), box(x0, y0, x1 - x0, y1 - y0)).otherwise(b)


def coco_triplets(slots: Column, size: Column) -> Column:
    """``[x, y, v, ...]`` over ``size`` slots; ``slots`` maps a slot to ``struct<x,y,v>``."""

    def triplet(i: Column) -> Column:
        s = F.element_at(slots, i)
        zero = F.lit(0.0)
        return F.when(s.isNull(), F.array(zero, zero, zero)).otherwise(
            F.array(s["x"].cast("double"), s["y"].cast("double"), s["v"].cast("double"))
        )

    return F.flatten(F.transform(F.sequence(F.lit(0), size - 1), triplet))


def labelled(flat: Column) -> Column:
    """How many triplets have a positive visibility."""
    return F.size(F.filter(flat, lambda v, i: (i % 3 == 2) & (v > 0)))


def template_joints(nodes: Column) -> Column:
    """Joint names of a template, blanks left out."""
    return F.filter(F.transform(nodes, lambda n: n["name"]), lambda name: name.isNotNull() & (name != ""))


def template_edges(edges: Column, joints: Column, base: int = 0) -> Column:
    """0-indexed edges ``struct<i,j>`` inside the template, no self edges."""
    pairs = F.filter(edges, lambda e: F.size(e) == 2)
    named = F.transform(pairs, lambda e: F.struct((F.get(e, F.lit(0)) - base).alias("i"), (F.get(e, F.lit(1)) - base).alias("j")))
    size = F.size(joints)
    return F.filter(named, lambda e: (e["i"] != e["j"]) & e["i"].between(0, size - 1) & e["j"].between(0, size - 1))


def _slots(keypoints: Column) -> Column:
    """The numbers of the full triplets."""
    count = F.floor(F.size(keypoints) / 3).cast("int")
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def any_placed(keypoints: Column) -> Column:
    """True when a raw visibility of a full triplet is above zero (tested before it is clamped)."""
    return F.coalesce(F.exists(_slots(keypoints), lambda s: F.get(keypoints, s * 3 + 2) > 0), F.lit(False))


def _clamped(keypoints: Column, slot: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(2), F.get(keypoints, slot * 3 + 2).cast("int")))


def _placed_slots(keypoints: Column) -> Column:
    return F.filter(_slots(keypoints), lambda s: _clamped(keypoints, s) > 0)


def _many(joints: Column) -> Column:
    return F.coalesce(F.size(joints) > 1, F.lit(False))


def lone_entry(keypoints: Column, joints: Column) -> Column:
    """A single placed point of a category without a joint list."""
    return (F.size(_placed_slots(keypoints)) == 1) & ~_many(joints)


def expand_triplets(keypoints: Column, joints: Column, name: Column, attributes: Column) -> Column:
    """The placed joints of one COCO entry as ``struct<idx, slot, name, point, attributes, lone>``.

    Visibility is cut to a whole number and clamped to 0..2; 0 means not placed, 1 adds the occluded
    attribute. Joints are named by the category's joint list when it has more than one. A single
    point of a category without such a list is ``lone``.
    """
    many = _many(joints)

    def joint(slot: Column) -> Column:
        v = _clamped(keypoints, slot)
        own = F.coalesce(attributes, F.create_map().cast("map<string,string>"))
        marked = F.map_concat(
            F.map_filter(own, lambda k, _: k != OCCLUDED), F.create_map(F.lit(OCCLUDED), F.lit("true"))
        )
        return F.struct(
            slot.alias("slot"),
            F.coalesce(F.when(many, F.get(joints, slot)), name).alias("name"),
            F.struct(F.get(keypoints, slot * 3).alias("x"), F.get(keypoints, slot * 3 + 1).alias("y")).alias("point"),
            F.when(v == 1, marked).otherwise(own).alias("attributes"),
            v.alias("v"),
        )

    def numbered(placed: Column) -> Column:
        lone = (F.size(placed) == 1) & ~many
        return F.transform(
            placed,
            lambda j, i: F.struct(
                i.alias("idx"),
                j["slot"].alias("slot"),
                j["name"].alias("name"),
                j["point"].alias("point"),
                j["attributes"].alias("attributes"),
                lone.alias("lone"),
            ),
        )

    return let(F.transform(_placed_slots(keypoints), joint), numbered)


def rings_from_flat(segmentation: Column) -> Column:
    """Rings of at least six numbers, each paired into points; null when none is left."""
    rings = F.transform(F.filter(segmentation, lambda r: F.size(r) >= 6), points_from_flat)
    return F.when(F.size(rings) > 0, rings)
