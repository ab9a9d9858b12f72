"""A chain of augmentation ops over Arrow batches of annotations (G14, G15), by the arithmetic of ``functions.geometry``.

A batch is sorted by kind and each op moves all rows of a kind at once. Rows are left to the column expressions of
``transforms`` when no op moves them, when their kind is not known, or when a number is missing or not finite.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBERS = "abcdefwh"
#: Numbers of a row before those of the steps: whether its box is turned, the box, the turned box, the point.
PLAIN = 1 + 4 + 5 + 2
CORNERS = np.array([[-1.0, -1.0], [1.0, -1.0], [1.0, 1.0], [-1.0, 1.0]])


@dataclass
class Step:
    """One op for each row: whether it moves the row, six affine numbers and the new size."""

    on: np.ndarray
    numbers: dict[str, np.ndarray]
    clip: bool

    def of(self, rows: np.ndarray) -> Step:
        return Step(self.on[rows], {k: v[rows] for k, v in self.numbers.items()}, self.clip)

    def move(self, x: np.ndarray, y: np.ndarray, rows) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d, e, f = (self.numbers[k][rows] for k in "abcdef")
        return a * x + b * y + c, d * x + e * y + f

    def only(self, go: np.ndarray) -> Step:
        """The same where ``go``; elsewhere a map that changes nothing and a frame without bounds."""
        still = dict(zip(NUMBERS, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, np.inf, np.inf)))
        return Step(go, {k: np.where(go, v, still[k]) for k, v in self.numbers.items()}, self.clip)


def _least(first: np.ndarray, *others: np.ndarray) -> np.ndarray:
    for v in others:
        first = np.where(v < first, v, first)
    return first


def _greatest(first: np.ndarray, *others: np.ndarray) -> np.ndarray:
    for v in others:
        first = np.where(v > first, v, first)
    return first


def _clamp(v: np.ndarray, lo, hi) -> np.ndarray:
    return _greatest(lo + np.zeros_like(v), _least(v, hi))


def _few(part: np.ndarray, whole: np.ndarray, floor: float) -> np.ndarray:
    return (whole > 0) & (part / whole < floor)


def _starts(ring: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(ring, minlength=n)
    return size, np.cumsum(size) - size


def _area(x: np.ndarray, y: np.ndarray, ring: np.ndarray, n: int) -> np.ndarray:
    size, first = _starts(ring, n)
    after = np.arange(1, len(ring) + 1)
    after[(first + size - 1)[size > 0]] = first[size > 0]
    total = np.bincount(ring, weights=x * y[after] - x[after] * y, minlength=n)
    return np.where(size < 3, 0.0, np.abs(total) / 2)


def _enclosed(x: np.ndarray, y: np.ndarray, ring: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes of rings, and which of them have sides."""
    size, first = _starts(ring, n)
    ends = np.zeros((n, 4))
    if len(ring):
        at = first[size > 0]
        for i, (f, v) in enumerate(((np.minimum, x), (np.minimum, y), (np.maximum, x), (np.maximum, y))):
            ends[size > 0, i] = f.reduceat(v, at)
    ends[:, 2:] -= ends[:, :2]
    return ends, (ends[:, 2] > 0) & (ends[:, 3] > 0) & (size > 0)


def _within(x: np.ndarray, y: np.ndarray, ring: np.ndarray, n: int, w: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = ~((x >= 0) & (x <= w[ring]) & (y >= 0) & (y <= h[ring]))
    return np.bincount(ring, weights=out, minlength=n) == 0


def _clipped(x: np.ndarray, y: np.ndarray, ring: np.ndarray, n: int, w: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sutherland-Hodgman, one pass per side. A frame without an upper bound has no lower one either."""
    zero = np.where(np.isinf(w), -np.inf, 0.0)
    for axis, bound, above in ((0, zero, True), (0, w, False), (1, zero, True), (1, h, False)):
        v, bound = (x, y)[axis], bound[ring]
        inside = v >= bound if above else v <= bound
        if inside.all():
            continue
        size, first = _starts(ring, n)
        before = np.arange(-1, len(ring) - 1)
        before[first[size > 0]] = (first + size - 1)[size > 0]
        cross = inside[before] != inside
        count = cross.astype(np.int64) + inside
        at = np.cumsum(count) - count
        p = before[cross]
        t = (bound[cross] - v[p]) / (v[cross] - v[p])
        new = []
        for c in (x, y):
            out = np.empty(int(count.sum()))
            out[at[cross]] = c[p] + (c[cross] - c[p]) * t
            out[(at + cross)[inside]] = c[inside]
            new.append(out)
        x, y, ring = *new, np.repeat(ring, count)
    return x, y, ring


def _boxes(box: np.ndarray, steps: Sequence[Step], floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boxes after the steps, which are left, and which met a number that is not finite."""
    box, alive, bad = box.copy(), np.ones(len(box), bool), ~np.isfinite(box).all(1)
    for s in steps:
        rows = np.flatnonzero(s.on & alive)
        x, y, w, h = box[rows].T
        moved = [s.move(px, py, rows) for px, py in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]
        xs, ys = [p[0] for p in moved], [p[1] for p in moved]
        x, y = _least(*xs), _least(*ys)
        w, h = _greatest(*xs) - x, _greatest(*ys) - y
        bad[rows] |= ~np.isfinite(w + h)
        good = (w > 0) & (h > 0)
        if s.clip:
            width, height, whole = s.numbers["w"][rows], s.numbers["h"][rows], w * h
            right, low = _clamp(x + w, 0.0, width), _clamp(y + h, 0.0, height)
            x, y = _clamp(x, 0.0, width), _clamp(y, 0.0, height)
            w, h = right - x, low - y
            good &= (w > 0) & (h > 0) & ~_few(w * h, whole, floor)
        box[rows], alive[rows] = np.stack([x, y, w, h], 1), good
    return box, alive, bad


def _rotated(obb: np.ndarray, steps: Sequence[Step], floor: float) -> tuple[np.ndarray, ...]:
    """Rotated boxes and their bounds after the steps, which are left, and which met a number that is not finite."""
    obb, alive, bad = obb.copy(), np.ones(len(obb), bool), ~np.isfinite(obb).all(1)
    bounds = np.zeros((len(obb), 4))
    for s in steps:
        rows = np.flatnonzero(s.on & alive)
        n, of = len(rows), np.repeat(rows, 4)
        cx, cy, w, h, angle = obb[rows].T
        turn = np.radians(angle)
        cos, sin = np.cos(turn)[:, None], np.sin(turn)[:, None]
        lx, ly = (w / 2)[:, None] * CORNERS[:, 0], (h / 2)[:, None] * CORNERS[:, 1]
        x, y = cx[:, None] + lx * cos - ly * sin, cy[:, None] + lx * sin + ly * cos
        x, y = s.move(x.ravel(), y.ravel(), of)
        ring = np.repeat(np.arange(n), 4)
        bad[rows] |= ~np.isfinite((x + y).reshape(n, 4)).all(1)
        box, good = _enclosed(x, y, ring, n)
        if s.clip:
            width, height = s.numbers["w"][rows], s.numbers["h"][rows]
            part = _area(*_clipped(x, y, ring, n, width, height), n)
            good &= _within(x, y, ring, n, width, height) | ~_few(part, _area(x, y, ring, n), floor)
        x, y = x.reshape(n, 4).T, y.reshape(n, 4).T
        side = lambda i, j: np.hypot(x[j] - x[i], y[j] - y[i])
        one = np.ones(n)
        rest = np.fmod(np.degrees(np.arctan2(y[1] - y[0] + 0.0, x[1] - x[0] + 0.0)), 360.0)
        fitted = [
            (x[0] + x[1] + x[2] + x[3]) / 4, (y[0] + y[1] + y[2] + y[3]) / 4, _greatest(one, (side(0, 1) + side(3, 2)) / 2),
            _greatest(one, (side(1, 2) + side(0, 3)) / 2), np.where(rest < 0, rest + 360.0, rest),
        ]
        obb[rows], bounds[rows], alive[rows] = np.stack(fitted, 1), box, good
    return obb, bounds, alive, bad


def _rings(x, y, ring, owner, n: int, steps: Sequence[Step], floor: float) -> tuple[np.ndarray, ...]:
    """Points, their rings, whose the rings are, bounds and which have some, who is left, and who met a number that is not finite.
    The first ring of a polygon decides; others that vanish are left out."""
    alive, bounds, boxed, bad = np.ones(n, bool), np.zeros((n, 4)), np.zeros(n, bool), np.zeros(n, bool)
    for s in steps:
        go = s.on & alive
        s = s.only(go)
        of = owner[ring]
        mx, my = s.move(x, y, of)
        bad[of[~np.isfinite(mx + my)]] = True
        m = len(owner)
        width, height = s.numbers["w"][owner], s.numbers["h"][owner]
        x, y, cut = _clipped(mx, my, ring, m, width, height) if s.clip else (mx, my, ring)
        size = np.bincount(cut, minlength=m)
        mine, first = _starts(owner, n)
        some = np.flatnonzero(go & (mine > 0))
        at, good = first[some], np.zeros(n, bool)
        good[some] = size[at] >= 3
        if s.clip:
            enough = ~_few(_area(x, y, cut, m), _area(mx, my, ring, m), floor) | _within(mx, my, ring, m, width, height)
            good[some] &= enough[at]
        box, sides = _enclosed(x, y, cut, m)
        bounds[some], boxed[some] = box[at], sides[at]
        alive = np.where(go, good, alive)
        keep = alive[owner] & ((size >= 3) | ~go[owner])
        points = keep[cut]
        x, y, ring, owner = x[points], y[points], (np.cumsum(keep) - 1)[cut[points]], owner[keep]
    return x, y, ring, owner, bounds, boxed, alive, bad


def _paths(x, y, line, n: int, steps: Sequence[Step]) -> tuple[np.ndarray, ...]:
    """Points, their lines, bounds and which have some, which lines are left, and which met a number that is not finite."""
    alive, bounds, boxed, bad = np.ones(n, bool), np.zeros((n, 4)), np.zeros(n, bool), np.zeros(n, bool)
    for s in steps:
        go = s.on & alive
        s = s.only(go)
        x, y = s.move(x, y, line)
        bad[line[~np.isfinite(x + y)]] = True
        if s.clip:
            lo = np.where(go, 0.0, -np.inf)[line]
            x, y = _clamp(x, lo, s.numbers["w"][line]), _clamp(y, lo, s.numbers["h"][line])
            same = np.zeros(len(line), bool)
            same[1:] = (line[1:] == line[:-1]) & (x[1:] == x[:-1]) & (y[1:] == y[:-1])
            keep = ~(same & go[line])
            x, y, line = x[keep], y[keep], line[keep]
            alive &= ~go | (np.bincount(line, minlength=n) >= 2)
        box, sides = _enclosed(x, y, line, n)
        bounds[go], boxed[go] = box[go], sides[go]
    return x, y, line, bounds, boxed, alive, bad


def _points(xy: np.ndarray, steps: Sequence[Step]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, y = xy.T
    alive, bad = np.ones(len(x), bool), ~np.isfinite(xy).all(1)
    for s in steps:
        go = s.on & alive
        s = s.only(go)
        x, y = s.move(x, y, slice(None))
        bad |= ~np.isfinite(x + y)
        if s.clip:
            alive &= ~go | ((x >= 0) & (x <= s.numbers["w"]) & (y >= 0) & (y <= s.numbers["h"]))
    return np.stack([x, y], 1), alive, bad


# --- to and from Arrow ----------------------------------------------------------------------------


def _fields(column: pa.StructArray) -> np.ndarray:
    """The numbers of structs, NaN for null."""
    return np.stack([np.asarray(c.cast(pa.float64()).fill_null(np.nan)) for c in column.flatten()], 1)


def _listed(column: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The elements of lists, the list of each, and which lists are null."""
    size = np.asarray(pc.list_value_length(column).fill_null(0))
    return column.flatten(), np.repeat(np.arange(len(column)), size), np.asarray(column.is_null())


def _structs(values: np.ndarray, names: str, valid: np.ndarray | None = None) -> pa.StructArray:
    columns = [pa.array(np.ascontiguousarray(values[:, i])) for i in range(values.shape[1])]
    return pa.StructArray.from_arrays(columns, names.split(), mask=None if valid is None else pa.array(~valid))


def _lists(owner: np.ndarray, n: int, values: pa.Array, valid: np.ndarray | None = None) -> pa.ListArray:
    ends = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=None if valid is None else pa.array(~valid))


def run(kind: pa.Array, numbers: np.ndarray, rings: pa.Array, path: pa.Array, clips: Sequence[bool], floor: float) -> pa.StructArray:
    """``done, shape`` of each row: the geometry after the steps (null: dropped) of the rows that are done here. ``numbers`` are
    those that ``chained`` lists."""
    n, width = len(kind), 1 + len(NUMBERS)
    steps = []
    for i, clip in enumerate(clips):
        own = numbers[:, PLAIN + i * width : PLAIN + (i + 1) * width]
        steps.append(Step(own[:, 0] == 1.0, dict(zip(NUMBERS, np.ascontiguousarray(own[:, 1:].T))), clip))
    moved, usable = np.zeros(n, bool), np.ones(n, bool)
    for s in steps:
        moved |= s.on
        usable &= ~s.on | np.isfinite(np.stack(list(s.numbers.values()))).all(0)
    parts = {"bbox": numbers[:, 1:5], "obb": numbers[:, 5:10], "rings": rings, "path": path, "point": numbers[:, 10:12]}
    turned = numbers[:, 0] == 1.0
    is_kind = lambda name: np.asarray(pc.equal(kind, name).fill_null(False))
    asked = {
        "obb": is_kind("bbox") & turned, "bbox": is_kind("bbox") & ~turned, "point": is_kind("keypoint"),
        "rings": is_kind("polygon") & np.asarray(rings.is_valid()), "path": is_kind("polyline") & np.asarray(path.is_valid()),
    }
    done, kept = np.zeros(n, bool), {c: np.zeros(n, bool) for c in parts}
    flat = {"bbox": np.zeros((n, 4)), "obb": np.zeros((n, 5)), "point": np.zeros((n, 2))}
    none = np.zeros(0, np.int64)
    ring_xy, ring_of, ring_owner, path_xy, path_of = np.zeros((0, 2)), none, none, np.zeros((0, 2)), none
    for part, mask in asked.items():
        rows = np.flatnonzero(mask & moved & usable)
        if not len(rows):
            continue
        m, own = len(rows), [s.of(rows) for s in steps]
        column = parts[part][rows] if part in flat else parts[part].take(pa.array(rows))
        bounds = boxed = None
        if part == "bbox":
            value, alive, bad = _boxes(column, own, floor)
        elif part == "obb":
            value, bounds, alive, bad = _rotated(column, own, floor)
            boxed = alive
        elif part == "point":
            value, alive, bad = _points(column, own)
        elif part == "path":
            points, line, _ = _listed(column)
            x, y, line, bounds, boxed, alive, bad = _paths(*_fields(points).T, line, m, own)
            some = (alive & ~bad)[line]
            path_xy, path_of = np.stack([x, y], 1)[some], rows[line[some]]
        else:
            inner, owner, _ = _listed(column)
            points, ring, missing = _listed(inner)
            x, y, ring, left, bounds, boxed, alive, bad = _rings(*_fields(points).T, ring, owner, m, own, floor)
            bad[owner[missing]] = True
            of = left[ring]
            some, lasts = (alive & ~bad)[of], (alive & ~bad)[left]
            ring_xy, ring_of = np.stack([x, y], 1)[some], (np.cumsum(lasts) - 1)[ring[some]]
            ring_owner = rows[left[lasts]]
        done[rows], good = ~bad, alive & ~bad
        kept[part][rows] = good
        if part in flat:
            flat[part][rows] = value
        if bounds is not None:
            flat["bbox"][rows], kept["bbox"][rows] = bounds, good & boxed
    polygons = _lists(ring_of, len(ring_owner), _structs(ring_xy, "x y"))
    built = {
        "bbox": _structs(flat["bbox"], "x y w h", kept["bbox"]), "obb": _structs(flat["obb"], "cx cy w h angle", kept["obb"]),
        "rings": _lists(ring_owner, n, polygons, kept["rings"]), "path": _lists(path_of, n, _structs(path_xy, "x y"), kept["path"]),
        "point": _structs(flat["point"], "x y", kept["point"]),
    }
    some = kept["bbox"] | kept["obb"] | kept["rings"] | kept["path"] | kept["point"]
    after = pa.StructArray.from_arrays([built[c] for c in parts], list(parts), mask=pa.array(~some))
    return pa.StructArray.from_arrays([pa.array(done), after], ["done", "shape"])


def chained(kind: Column, shape: Column, changed: Column, steps: Sequence[Column], clips: Sequence[bool], kinds: dict[str, str], floor: float) -> Column:
    """``done, shape`` by ``run``, for the steps of ``transforms.plan_variants``; ``kinds`` are the types of the shape's members.

    All plain numbers travel in one list: Spark measures every vector of a batch again for each row it adds.
    """
    clips = list(clips)

    def move(kind: pa.Array, numbers: pa.Array, rings: pa.Array, path: pa.Array) -> pa.Array:
        values = np.asarray(numbers.flatten().fill_null(np.nan)).reshape(len(kind), -1)
        with np.errstate(all="ignore"):
            return run(kind, values, rings, path, clips, floor)

    members = ",".join(f"{c}:{k}" for c, k in kinds.items())
    udf = F.arrow_udf(move, f"struct<done:boolean,shape:struct<{members}>>")
    yes = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    numbers = [yes(shape["obb"].isNotNull())]
    numbers += [shape[part][c] for part, names in (("bbox", "x y w h"), ("obb", "cx cy w h angle"), ("point", "x y")) for c in names.split()]
    for s in steps:
        numbers += [yes(changed & s["on"]), *[s[k] for k in NUMBERS]]
    return udf(kind, F.array(*numbers), shape["rings"], shape["path"])
