"""Column expressions on points, boxes, rings and rotated boxes.

A point is ``struct<x,y>``, a box ``struct<x,y,w,h>``, a ring ``array<point>``, a rotated box
``struct<cx,cy,w,h,angle>``. Every function takes and returns columns and stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PointMap = Callable[[Column, Column], tuple[Column, Column]]

BOX = "struct<x:double,y:double,w:double,h:double>"
RING = "array<struct<x:double,y:double>>"


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(
        x.cast("double").alias("x"), y.cast("double").alias("y"), w.cast("double").alias("w"), h.cast("double").alias("h")
    )


def enclosing_box(points: Column) -> Column:
    """The box of a list of points; null when the list is empty or flat."""

    def sized(e: Column) -> Column:
        w, h = e["x1"] - e["x0"], e["y1"] - e["y0"]
        return F.when((w > 0) & (h > 0), box(e["x0"], e["y0"], w, h))

    ends = let(
        points,
        lambda p: F.struct(
            F.array_min(p["x"]).alias("x0"),
            F.array_max(p["x"]).alias("x1"),
            F.array_min(p["y"]).alias("y0"),
            F.array_max(p["y"]).alias("y1"),
        ),
    )
    return let(ends, sized)


def _next_points(ring: Column) -> Column:
    # By index: inside a lambda, concat and slice cost many times as much.
    return F.transform(ring, lambda _, i: F.get(ring, F.when(i + 1 < F.size(ring), i + 1).otherwise(F.lit(0))))


def _previous_points(ring: Column) -> Column:
    return F.transform(ring, lambda _, i: F.get(ring, F.when(i > 0, i - 1).otherwise(F.size(ring) - 1)))


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring, 0 for fewer than three points."""

    def area(r: Column) -> Column:
        def term(a: Column, i: Column) -> Column:
            b = F.get(r, F.when(i + 1 < F.size(r), i + 1).otherwise(F.lit(0)))
            return a["x"] * b["y"] - b["x"] * a["y"]

        total = F.aggregate(F.transform(r, term), F.lit(0.0), lambda acc, v: acc + v)
        return F.when(F.size(r) < 3, F.lit(0.0)).otherwise(F.abs(total) / 2)

    return let(ring, area)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test, true where a ray from the point crosses the ring an odd number of times."""

    def crosses(a: Column, b: Column) -> Column:
        straddles = (a["y"] > y) != (b["y"] > y)
        meets = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return F.coalesce(straddles & (x < meets), F.lit(False))

    def odd(r: Column) -> Column:
        crossings = F.filter(F.zip_with(r, _next_points(r), crosses), lambda c: c)
        return F.when(F.size(r) == 0, F.lit(False)).otherwise(F.size(crossings) % 2 == 1)

    return let(ring, odd)


def rings_area(rings: Column) -> Column:
    """Even-odd area. A ring whose first point lies in an odd number of the others is a hole."""

    def total(real: Column) -> Column:
        def signed(ring: Column, i: Column) -> Column:
            start = F.element_at(ring, 1)
            around = F.filter(
                F.transform(real, lambda other, j: (j != i) & point_in_ring(start["x"], start["y"], other)), lambda c: c
            )
            return F.when(F.size(around) % 2 == 1, -ring_area(ring)).otherwise(ring_area(ring))

        return F.greatest(F.aggregate(F.transform(real, signed), F.lit(0.0), lambda acc, v: acc + v), F.lit(0.0))

    return let(F.filter(rings, lambda r: F.size(r) >= 3), total)


def annotation_box(kind: Column, bbox: Column, rings: Column, path: Column) -> Column:
    """The stored box, else the enclosure of every ring or of the path; null for a keypoint."""
    return F.coalesce(
        bbox,
        F.when(kind == "polygon", enclosing_box(F.flatten(rings))).when(kind == "polyline", enclosing_box(path)),
    )


def flatten_ring(ring: Column) -> Column:
    """``[x0, y0, x1, y1, ...]``."""
    return F.flatten(F.transform(ring, lambda p: F.array(p["x"], p["y"])))


def points_from_flat(coords: Column) -> Column:
    """Pairs of a flat list; an odd last number is dropped."""

    def paired(c: Column) -> Column:
        pairs = F.floor(F.size(c) / 2).cast("int")
        steps = F.when(pairs > 0, F.sequence(F.lit(1), pairs)).otherwise(F.array().cast("array<int>"))
        return F.transform(steps, lambda i: point(F.get(c, i * 2 - 2), F.get(c, i * 2 - 1)))

    return let(coords, paired)


def iou(ax, ay, aw, ah, bx, by, bw, bh) -> Column:
    """Intersection over union of two boxes, 0 where they do not overlap."""
    ax, ay, aw, ah, bx, by, bw, bh = (F.col(c) if isinstance(c, str) else c for c in (ax, ay, aw, ah, bx, by, bw, bh))
    iw = F.least(ax + aw, bx + bw) - F.greatest(ax, bx)
    ih = F.least(ay + ah, by + bh) - F.greatest(ay, by)
    inter = iw * ih
    union = aw * ah + bw * bh - inter
    return F.when((iw > 0) & (ih > 0) & (union > 0), inter / union).otherwise(F.lit(0.0))


def normalize_angle(degrees: Column) -> Column:
    """An angle in [0, 360)."""
    turn = F.lit(360.0)
    rest = degrees % turn
    return F.when(rest < 0, rest + turn).otherwise(rest)


def rotated_corners(obb: Column) -> Column:
    """Top-left, top-right, bottom-right, bottom-left in the box's own frame."""
    rad = F.radians(obb["angle"])
    turn = F.struct(
        obb["cx"].alias("cx"), obb["cy"].alias("cy"), F.cos(rad).alias("cos"), F.sin(rad).alias("sin"),
        (obb["w"] / 2).alias("hw"), (obb["h"] / 2).alias("hh"),
    )

    def corners(t: Column) -> Column:
        cos, sin, hw, hh = t["cos"], t["sin"], t["hw"], t["hh"]

        def corner(lx: Column, ly: Column) -> Column:
            return point(t["cx"] + lx * cos - ly * sin, t["cy"] + lx * sin + ly * cos)

        return F.array(corner(-hw, -hh), corner(hw, -hh), corner(hw, hh), corner(-hw, hh))

    return let(turn, corners)


def rotated_from_corners(corners: Column) -> Column:
    """The rotated box nearest to four corners; null unless there are four finite points."""

    def side(a: Column, b: Column) -> Column:
        return F.hypot(b["x"] - a["x"], b["y"] - a["y"])

    def fit(c: Column) -> Column:
        p = [F.get(c, F.lit(i)) for i in range(4)]
        fitted = F.struct(
            ((p[0]["x"] + p[1]["x"] + p[2]["x"] + p[3]["x"]) / 4).alias("cx"),
            ((p[0]["y"] + p[1]["y"] + p[2]["y"] + p[3]["y"]) / 4).alias("cy"),
            F.greatest(F.lit(1.0), (side(p[0], p[1]) + side(p[3], p[2])) / 2).alias("w"),
            F.greatest(F.lit(1.0), (side(p[1], p[2]) + side(p[0], p[3])) / 2).alias("h"),
            normalize_angle(F.degrees(F.atan2(p[1]["y"] - p[0]["y"], p[1]["x"] - p[0]["x"]))).alias("angle"),
        )
        usable = (F.size(c) == 4) & F.forall(c, lambda q: finite(q["x"]) & finite(q["y"]))
        return F.when(usable, fitted)

    return let(corners, fit)


def rotated_enclosure(obb: Column) -> Column:
    """X11: the box around the rotated corners (not around the own sides)."""
    return enclosing_box(let(obb, rotated_corners))


def finite(value: Column) -> Column:
    """True for a real number: not null, NaN or infinite."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


# --- maps and clipping -----------------------------------------------------------------------


def affine(a, b, c, d, e, f) -> PointMap:
    """``(x, y) -> (a x + b y + c, d x + e y + f)``; the six numbers may be columns."""
    a, b, c, d, e, f = (v if isinstance(v, Column) else F.lit(float(v)) for v in (a, b, c, d, e, f))
    return lambda x, y: (a * x + b * y + c, d * x + e * y + f)


def map_ring(ring: Column, fn: PointMap) -> Column:
    return F.transform(ring, lambda p: point(*fn(p["x"], p["y"])))


def clamp(v: Column, lo: Column, hi: Column) -> Column:
    return F.greatest(lo, F.least(v, hi))


def clip_box(b: Column, width: Column, height: Column) -> Column:
    """The part of a box inside the frame, null when nothing is left."""
    zero = F.lit(0.0)

    def part(e: Column) -> Column:
        w, h = e["x1"] - e["x0"], e["y1"] - e["y0"]
        return F.when((w > 0) & (h > 0), box(e["x0"], e["y0"], w, h))

    ends = let(
        b,
        lambda v: F.struct(
            clamp(v["x"], zero, width).alias("x0"),
            clamp(v["y"], zero, height).alias("y0"),
            clamp(v["x"] + v["w"], zero, width).alias("x1"),
            clamp(v["y"] + v["h"], zero, height).alias("y1"),
        ),
    )
    return let(ends, part)


def _clip_half(ring: Column, axis: str, bound: Column, keep_above: bool) -> Column:
    """One half-plane of the polygon clip: each edge gives the crossing point and its kept end. A ring on the kept side
    stays as it is."""
    none = F.array().cast(RING)

    def inside(p: Column) -> Column:
        return p[axis] >= bound if keep_above else p[axis] <= bound

    def edge(prev: Column, cur: Column) -> Column:
        cross = let(
            (bound - prev[axis]) / F.nullif(cur[axis] - prev[axis], F.lit(0.0)),
            lambda t: F.when(
                t.isNotNull(),
                point(prev["x"] + (cur["x"] - prev["x"]) * t, prev["y"] + (cur["y"] - prev["y"]) * t),
            ).otherwise(point(prev["x"], prev["y"])),
        )
        crossed = F.when(inside(cur), F.array(cross, cur)).otherwise(F.array(cross))
        return F.when(inside(prev) != inside(cur), crossed).when(inside(cur), F.array(cur)).otherwise(none)

    def clip(r: Column) -> Column:
        return F.when(F.forall(r, inside), r).otherwise(F.flatten(F.zip_with(_previous_points(r), r, edge)))

    return let(ring, clip)


def clip_ring(ring: Column, width: Column, height: Column) -> Column:
    """Sutherland-Hodgman clip of a ring to the frame, one pass per side. A ring inside the frame stays as it is."""
    zero = F.lit(0.0)

    def clip(whole: Column) -> Column:
        part = whole
        for axis, bound, above in (("x", zero, True), ("x", width, False), ("y", zero, True), ("y", height, False)):
            part = _clip_half(part, axis, bound, above)
        return F.when(_within(whole, width, height), whole).otherwise(part)

    return let(ring, clip)


def _within(ring: Column, width: Column, height: Column) -> Column:
    """True where every point of a ring lies in the frame, so that a clip leaves it whole."""
    zero = F.lit(0.0)
    inside = lambda p: (p["x"] >= zero) & (p["x"] <= width) & (p["y"] >= zero) & (p["y"] <= height)
    return F.coalesce(F.forall(ring, inside), F.lit(False))


def _visible_enough(part: Column, whole: Column, floor) -> Column:
    # Bound, as the whole is an area worked out from a ring and is used three times.
    seen = lambda a: (a > 0) & (part / F.nullif(a, F.lit(0.0)) < floor)
    return ~F.coalesce(let(whole, seen), F.lit(False))


def _ring_visible(whole: Column, part: Column, width: Column, height: Column, floor) -> Column:
    """The floor on the share of a ring that is left. A ring inside the frame keeps all, so nothing is measured."""
    enough = _visible_enough(ring_area(part), ring_area(whole), floor)
    return (_within(whole, width, height) | enough) if floor <= 1 else enough


def _box_area(b: Column) -> Column:
    return b["w"] * b["h"]


def _moved_box(b: Column, fn: PointMap) -> Column:
    """The enclosure of a box's four mapped corners, by plain arithmetic."""

    def corners(v: Column) -> Column:
        left, top, right, bottom = v["x"], v["y"], v["x"] + v["w"], v["y"] + v["h"]
        moved = [fn(x, y) for x, y in ((left, top), (right, top), (right, bottom), (left, bottom))]
        return F.struct(*[c.alias(f"{axis}{i}") for i, p in enumerate(moved) for axis, c in zip("xy", p)])

    def ends(m: Column) -> Column:
        xs, ys = [m[f"x{i}"] for i in range(4)], [m[f"y{i}"] for i in range(4)]
        return F.struct(
            F.least(*xs).alias("x0"), F.greatest(*xs).alias("x1"), F.least(*ys).alias("y0"), F.greatest(*ys).alias("y1")
        )

    def sized(e: Column) -> Column:
        w, h = e["x1"] - e["x0"], e["y1"] - e["y0"]
        return F.when((w > 0) & (h > 0), box(e["x0"], e["y0"], w, h))

    return let(let(let(b, corners), ends), sized)


def remap_box(b: Column, fn: PointMap, width: Column, height: Column, clip: bool, min_visibility=0.1) -> Column:
    """Corners mapped and enclosed; with ``clip`` cut to the frame and dropped under the floor."""
    moved = _moved_box(b, fn)
    if not clip:
        return moved
    return let(
        moved,
        lambda m: let(
            clip_box(m, width, height),
            lambda c: F.when(_visible_enough(_box_area(c), _box_area(m), min_visibility), c),
        ),
    )


def remap_rotated(obb: Column, fn: PointMap, width: Column, height: Column, clip: bool, min_visibility=0.1) -> Column:
    """``struct<obb, bbox>`` refitted from the mapped corners. Never cut, only dropped."""

    def refit(moved: Column) -> Column:
        out = let(
            enclosing_box(moved),
            lambda e: F.when(e.isNotNull(), F.struct(rotated_from_corners(moved).alias("obb"), e.alias("bbox"))),
        )
        if not clip:
            return out
        return F.when(_ring_visible(moved, clip_ring(moved, width, height), width, height, min_visibility), out)

    return let(map_ring(let(obb, rotated_corners), fn), refit)


def remap_rings(rings: Column, fn: PointMap, width: Column, height: Column, clip: bool, min_visibility=0.1) -> Column:
    """``struct<rings, bbox>``. The first ring decides; a hole that vanishes is left out."""

    def judge(moved: Column, cut: Column) -> Column:
        first = F.get(cut, F.lit(0))
        alive = F.coalesce(F.size(first) >= 3, F.lit(False))
        if clip:
            alive = alive & _ring_visible(F.get(moved, F.lit(0)), first, width, height, min_visibility)
        kept = F.filter(cut, lambda r: F.size(r) >= 3)
        return F.when(alive, F.struct(kept.alias("rings"), enclosing_box(first).alias("bbox")))

    def cut(moved: Column) -> Column:
        if not clip:
            return judge(moved, moved)
        return let(F.transform(moved, lambda r: clip_ring(r, width, height)), lambda c: judge(moved, c))

    return let(F.transform(rings, lambda r: map_ring(r, fn)), cut)


def remap_path(path: Column, fn: PointMap, width: Column, height: Column, clip: bool) -> Column:
    """``struct<path, bbox>``. Clamped to the frame, repeats dropped, two points needed."""

    def built(p: Column) -> Column:
        out = F.struct(p.alias("path"), enclosing_box(p).alias("bbox"))
        return F.when(F.size(p) >= 2, out) if clip else out

    moved = map_ring(path, fn)
    if not clip:
        return let(moved, built)
    zero = F.lit(0.0)
    inside = F.transform(moved, lambda p: point(clamp(p["x"], zero, width), clamp(p["y"], zero, height)))
    fresh = let(
        inside,
        lambda line: F.filter(line, lambda p, i: (i == 0) | (p != F.get(line, F.greatest(i - 1, F.lit(0))))),
    )
    return let(fresh, built)


def remap_point(p: Column, fn: PointMap, width: Column, height: Column, clip: bool) -> Column:
    """A mapped point, dropped when it leaves the frame."""
    moved = let(p, lambda q: point(*fn(q["x"], q["y"])))
    if not clip:
        return moved
    return let(
        moved, lambda m: F.when(m["x"].between(0, width) & m["y"].between(0, height), m)
    )


def cxcywh_to_xyxy(cx: Column, cy: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    """Centre and size to two corners."""
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2
