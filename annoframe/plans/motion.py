"""Queries on remapped, tiled and augmented annotations and pixels: J5, X22-X30, G1-G16, U1-U3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.functions import geometry as g
from annoframe.operators import pixels, transforms
from annoframe.plans.detection import rounded
from annoframe.plans.registry import query
from annoframe.plans.shapes import TURNED, area_sql
from annoframe.plans.tables import Tables, sql

BOXES_ONLY = {"obb": "struct<cx:double,cy:double,w:double,h:double,angle:double>", "rings": f"array<{g.RING}>",
              "path": g.RING, "point": "struct<x:double,y:double>"}


def box_annotations(t: Tables) -> DataFrame:
    """The truth boxes as canonical annotation rows."""
    empty = {c: F.lit(None).cast(kind) for c, kind in BOXES_ONLY.items()}
    b = g.box(*[F.col(c) for c in "xywh"])
    return t.gt.select("image_id", "ann_id", "name", F.lit("bbox").alias("type"), b.alias("bbox")).withColumns(empty)


def mixed_annotations(t: Tables) -> DataFrame:
    """All geometry kinds: box, rotated box, polygon (some with a hole), polyline, keypoint."""
    kind = (F.col("ann_id") % 5).cast("int")
    b = g.box(*[F.col(c) for c in "xywh"])
    obb = F.struct(
        (F.col("x") + F.col("w") / 2).alias("cx"), (F.col("y") + F.col("h") / 2).alias("cy"), F.col("w"), F.col("h"),
        (F.col("ann_id") * 7 % 360).cast("double").alias("angle"),
    )
    names = F.array(*map(F.lit, ("bbox", "bbox", "polygon", "polyline", "keypoint")))
    return t.polygons.select(
        "image_id",
        "ann_id",
        "name",
        F.element_at(names, kind + 1).alias("type"),
        F.when(kind <= 1, b).alias("bbox"),
        F.when(kind == 1, obb).alias("obb"),
        F.when(kind == 2, F.col("rings")).alias("rings"),
        F.when(kind == 3, F.col("rings")[0]).alias("path"),
        F.when(kind == 4, g.point(F.col("x"), F.col("y"))).alias("point"),
    )


def flat_boxes(df: DataFrame, *keys: str) -> DataFrame:
    return rounded(df.select(*keys, *[F.col(f"bbox.{c}").alias(c) for c in "xywh"]), *"xywh", digits=6)


# --- maps and clips -------------------------------------------------------------------------------


@query(
    "X22_affine_points",
    sql("SELECT ann_id, px * 2 + py * 3 - 5 AS x, px * 0.5::DOUBLE - py + 7 AS y FROM keypoints", "keypoints"),
)
def affine_points(t: Tables) -> DataFrame:
    fn = g.affine(2, 3, -5, 0.5, -1, 7)
    ring = g.map_ring(F.array(g.point(F.col("px"), F.col("py"))), fn)
    return t.keypoints.select("ann_id", F.inline(ring))


@query(
    "U1_user_point_map",
    sql("SELECT ann_id, round(sqrt(px * px + py * py), 6) AS x, round(px + py, 6) AS y FROM keypoints", "keypoints"),
)
def user_point_map(t: Tables) -> DataFrame:
    """A user's own non-affine map, written with columns."""
    ring = g.map_ring(F.array(g.point(F.col("px"), F.col("py"))), lambda x, y: (F.sqrt(x * x + y * y), x + y))
    return rounded(t.keypoints.select("ann_id", F.inline(ring)), "x", "y", digits=6)


CLIPPED = """clipped AS (SELECT *, least(greatest(x, 0), 300) AS x0, least(greatest(y, 0), 200) AS y0,
    least(greatest(x + w, 0), 300) AS x1, least(greatest(y + h, 0), 200) AS y1 FROM gt)"""


@query(
    "X23_clipped_boxes",
    sql(
        "SELECT ann_id, x0 AS x, y0 AS y, x1 - x0 AS w, y1 - y0 AS h FROM clipped WHERE x1 > x0 AND y1 > y0",
        "gt",
        more=CLIPPED,
    ),
)
def clipped_boxes(t: Tables) -> DataFrame:
    cut = g.clip_box(g.box(*[F.col(c) for c in "xywh"]), F.lit(300.0), F.lit(200.0))
    return t.gt.select("ann_id", cut.alias("b")).where("b is not null").select("ann_id", "b.*")


@query(
    "X24_clipped_ring_area",
    sql(
        "SELECT ann_id, (w - ann_id % 9) * (h - ann_id % 7) - 12.5::DOUBLE AS area FROM polygons",
        "polygons",
    ),
)
def clipped_ring_area(t: Tables) -> DataFrame:
    shift = g.affine(1, 0, -(F.col("x") + F.col("ann_id") % 9), 0, 1, -(F.col("y") + F.col("ann_id") % 7))
    moved = g.map_ring(F.col("rings")[0], shift)
    return t.polygons.select("ann_id", g.ring_area(g.clip_ring(moved, F.lit(5000.0), F.lit(5000.0))).alias("area"))


@query(
    "X25_remapped_boxes",
    sql(
        """SELECT ann_id, x0 AS x, y0 AS y, x1 - x0 AS w, y1 - y0 AS h FROM clipped WHERE x1 > x0 AND y1 > y0
        AND (x1 - x0) * (y1 - y0) / (w * h) >= 0.4""",
        "gt",
        more=CLIPPED,
    ),
)
def remapped_boxes(t: Tables) -> DataFrame:
    out = transforms.remap(box_annotations(t), g.affine(1, 0, 0, 0, 1, 0), F.lit(300.0), F.lit(200.0), True, 0.4)
    return flat_boxes(out, "ann_id")


@query(
    "X26_mirrored_rotated_boxes",
    sql(
        """SELECT ann_id, round(500 - cx, 4) AS cx, round(cy, 4) AS cy, round(w, 4) AS w, round(h, 4) AS h,
        fmod(round(fmod(540 - angle, 360), 4), 360) AS angle FROM turned""",
        "gt",
        more=TURNED,
    ),
)
def mirrored_rotated_boxes(t: Tables) -> DataFrame:
    from annoframe.plans.shapes import _turned

    out = _turned(t).select(
        "ann_id", g.remap_rotated(F.col("obb"), g.affine(-1, 0, 500, 0, 1, 0), F.lit(500.0), F.lit(500.0), False)["obb"].alias("o")
    )
    out = rounded(out.select("ann_id", "o.*"), "cx", "cy", "w", "h", "angle", digits=4)
    return out.withColumn("angle", F.col("angle") % 360)


@query(
    "X27_remapped_polygons",
    sql(
        f"""SELECT ann_id, CASE WHEN ann_id % 3 = 0 AND ann_id % 9 < 9 AND ann_id % 13 < 12 THEN 2 ELSE 1 END AS rings,
        w - ann_id % 13 AS w, h AS h, {area_sql('outer_ring')} - (ann_id % 13) * h AS outer_area FROM polygons""",
        "polygons",
    ),
)
def remapped_polygons(t: Tables) -> DataFrame:
    """Cut from the left by up to 12 pixels, which removes the hole at 12 of 4..12."""
    shift = g.affine(1, 0, -(F.col("x") + F.col("ann_id") % 13), 0, 1, -F.col("y"))
    out = t.polygons.select("ann_id", g.remap_rings(F.col("rings"), shift, F.lit(900.0), F.lit(900.0), True).alias("m"))
    real = F.filter(F.col("m.rings"), lambda r: g.ring_area(r) > 0)
    return out.select(
        "ann_id", F.size(real).alias("rings"), F.col("m.bbox.w").alias("w"), F.col("m.bbox.h").alias("h"),
        g.ring_area(F.col("m.rings")[0]).alias("outer_area"),
    )


@query(
    "X28_remapped_polylines",
    sql(
        """SELECT ann_id, i - 1 AS pos, px AS x, py AS y FROM (SELECT *, row_number() OVER (PARTITION BY ann_id ORDER BY n) AS i,
          count(*) OVER (PARTITION BY ann_id) AS c FROM (SELECT *, lag(px) OVER o AS lx, lag(py) OVER o AS ly FROM (
            SELECT ann_id, n, least(greatest(outer_ring[n].x, 0), 250) AS px, least(greatest(outer_ring[n].y, 0), 150) AS py
            FROM polygons, range(1, 6) r(n)) WINDOW o AS (PARTITION BY ann_id ORDER BY n))
          WHERE lx IS NULL OR lx <> px OR ly <> py) WHERE c >= 2""",
        "polygons",
    ),
)
def remapped_polylines(t: Tables) -> DataFrame:
    line = g.remap_path(F.col("rings")[0], g.affine(1, 0, 0, 0, 1, 0), F.lit(250.0), F.lit(150.0), True)
    rows = t.polygons.select("ann_id", F.posexplode(line["path"]).alias("pos", "p"))
    return rows.select("ann_id", F.col("pos").cast("long").alias("pos"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))


@query(
    "X29_remapped_keypoints",
    sql(
        """SELECT ann_id, instance_id, px - 50 AS x, py - 40 AS y FROM keypoints WHERE px - 50 BETWEEN 0 AND 200
        AND py - 40 BETWEEN 0 AND 120""",
        "keypoints",
    ),
)
def remapped_keypoints(t: Tables) -> DataFrame:
    p = g.remap_point(g.point(F.col("px"), F.col("py")), g.affine(1, 0, -50, 0, 1, -40), F.lit(200.0), F.lit(120.0), True)
    rows = t.keypoints.select("ann_id", "instance_id", p.alias("p")).where("p is not null")
    return rows.select("ann_id", "instance_id", "p.*")


# --- tiles ----------------------------------------------------------------------------------------

TILES = """cell AS (SELECT image_id, width, height, r, c, round_even(c * width / 3, 0) AS bx0, round_even((c + 1) * width / 3, 0) AS bx1,
    round_even(r * height / 2, 0) AS by0, round_even((r + 1) * height / 2, 0) AS by1 FROM images, range(2) a(r), range(3) b(c)),
  tile AS MATERIALIZED (SELECT image_id, r::INT AS "row", c::INT AS col, greatest(0, bx0 - round_even((bx1 - bx0) * 0.1::DOUBLE, 0)) AS x0,
    greatest(0, by0 - round_even((by1 - by0) * 0.1::DOUBLE, 0)) AS y0, least(width, bx1 + round_even((bx1 - bx0) * 0.1::DOUBLE, 0)) AS x1,
    least(height, by1 + round_even((by1 - by0) * 0.1::DOUBLE, 0)) AS y1 FROM cell),
  hit AS MATERIALIZED (SELECT g.image_id, g.ann_id, g.name, t."row", t.col, g.x - t.x0 AS x, g.y - t.y0 AS y, g.w, g.h,
    t.x1 - t.x0 AS tw, t.y1 - t.y0 AS th FROM gt g JOIN tile t USING (image_id)
    WHERE g.x < t.x1 AND g.x + g.w > t.x0 AND g.y < t.y1 AND g.y + g.h > t.y0),
  part AS MATERIALIZED (SELECT *, greatest(x, 0) AS cx0, greatest(y, 0) AS cy0, least(x + w, tw) AS cx1, least(y + h, th) AS cy1
    FROM hit WHERE (least(x + w, tw) - greatest(x, 0)) * (least(y + h, th) - greatest(y, 0)) / (w * h) >= 0.1)"""
GRID = {"rows": 2, "cols": 3, "overlap": 0.1}


@query("X30_tile_grid", sql('SELECT image_id, "row", col, x0, y0, x1, y1 FROM tile', "gt", "images", more=TILES))
def tile_grid(t: Tables) -> DataFrame:
    tiles = transforms.tile_grid(t.images, **GRID)
    return tiles.select("image_id", "row", "col", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("J5_tile_overlaps", sql('SELECT image_id, ann_id, "row", col FROM hit', "gt", "images", more=TILES))
def tile_overlaps(t: Tables) -> DataFrame:
    return transforms.touching_tiles(box_annotations(t), t.images, **GRID).select("image_id", "ann_id", "row", "col")


@query(
    "X30_tiled_boxes",
    sql(
        'SELECT image_id, ann_id, "row", col, cx0 AS x, cy0 AS y, cx1 - cx0 AS w, cy1 - cy0 AS h FROM part',
        "gt",
        "images",
        more=TILES,
    ),
)
def tiled_boxes(t: Tables) -> DataFrame:
    out = transforms.tile_annotations(box_annotations(t), t.images, **GRID)
    return flat_boxes(out, "image_id", "ann_id", "row", "col")


@query(
    "G16_tile_report",
    sql(
        """SELECT count(DISTINCT image_id) AS images, count(*) AS tiles, count(*) FILTER (n IS NULL) AS empty_tiles,
        sum(coalesce(n, 0))::BIGINT AS annotations FROM tile LEFT JOIN (SELECT image_id, "row", col, count(*) AS n
        FROM part GROUP BY ALL) USING (image_id, "row", col)""",
        "gt",
        "images",
        more=TILES,
    ),
)
def tile_report(t: Tables) -> DataFrame:
    tiled = transforms.tile_annotations(box_annotations(t), t.images, **GRID)
    return transforms.tile_report(transforms.tiles_with_counts(transforms.tile_grid(t.images, **GRID), tiled))


@query("X30_tiled_annotations_of_every_kind")
def tiled_annotations(t: Tables) -> DataFrame:
    out = transforms.tile_annotations(mixed_annotations(t), t.images, **GRID)
    return out.groupBy("row", "col", "type").agg(F.count(F.lit(1)).alias("n"))


# --- augmentation ---------------------------------------------------------------------------------

SEED = 42


def draw_sql(op: int, which: int) -> str:
    return (
        f"(('0x' || substr(md5('{SEED}:' || image_id || ':' || variant || ':{op}:{which}'), 1, 13))::BIGINT"
        f" / 4503599627370496)"
    )


def augmented_boxes(t: Tables, specs: list[dict], n: int = 1) -> DataFrame:
    ops = transforms.build_ops(specs)
    variants = transforms.plan_variants(t.images, ops, n, SEED)
    out = transforms.augment_annotations(box_annotations(t), variants, ops)
    return flat_boxes(out, "image_id", "variant", "ann_id")


VARIANT = """var AS MATERIALIZED (SELECT i.image_id, variant::INT AS variant, i.width, i.height, g.ann_id, g.x, g.y, g.w, g.h
    FROM images i JOIN gt g USING (image_id), range(1, {n} + 1) v(variant))"""


def affine_sql(select: str, n: int = 1, where: str = "true", more: str = "") -> str:
    """Boxes of variants from a SELECT list giving nx, ny, nw, nh."""
    return sql(
        f"""SELECT image_id, variant, ann_id, round(nx, 6) AS x, round(ny, 6) AS y, round(nw, 6) AS w, round(nh, 6) AS h
        FROM (SELECT *, {select} FROM {'prep' if more else 'var'}) WHERE {where}""",
        "gt",
        "images",
        more=VARIANT.format(n=n) + (", " + more if more else ""),
    )


@query("G1_horizontal_flip", affine_sql(
    f"CASE WHEN {draw_sql(0, 0)} < 0.5 THEN width - x - w ELSE x END AS nx, y AS ny, w AS nw, h AS nh", n=2))
def horizontal_flip(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "flip"}], n=2)


@query("G2_vertical_flip", affine_sql("x AS nx, height - y - h AS ny, w AS nw, h AS nh"))
def vertical_flip(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "vflip", "p": 1.0}])


@query("G3_rotate90", affine_sql(
    """CASE k WHEN 1 THEN y WHEN 2 THEN width - x - w ELSE height - y - h END AS nx,
    CASE k WHEN 1 THEN width - x - w WHEN 2 THEN height - y - h ELSE x END AS ny,
    CASE k WHEN 2 THEN w ELSE h END AS nw, CASE k WHEN 2 THEN h ELSE w END AS nh""",
    more=f"prep AS (SELECT *, floor({draw_sql(0, 1)} * 3)::INT + 1 AS k FROM var)"))
def rotate90(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "rotate90"}])


ROTATED = f"""ang AS (SELECT *, radians(-15 + {draw_sql(0, 1)} * 30) AS a FROM var),
  canvas AS (SELECT *, (abs(cos(a)) * width + abs(sin(a)) * height) / 2 AS dx,
    (abs(sin(a)) * width + abs(cos(a)) * height) / 2 AS dy FROM ang),
  prep AS (SELECT *, ceil(round(width / 2 + dx, 9)) - floor(round(width / 2 - dx, 9)) AS nwid,
    ceil(round(height / 2 + dy, 9)) - floor(round(height / 2 - dy, 9)) AS nhei,
    x + w / 2 - width / 2 AS mx, y + h / 2 - height / 2 AS my,
    (abs(cos(a)) * w + abs(sin(a)) * h) AS bw, (abs(sin(a)) * w + abs(cos(a)) * h) AS bh FROM canvas)"""


@query("G4_rotate", affine_sql(
    """mx * cos(a) + my * sin(a) + nwid / 2 - bw / 2 AS nx, -mx * sin(a) + my * cos(a) + nhei / 2 - bh / 2 AS ny,
    bw AS nw, bh AS nh""", more=ROTATED))
def rotate(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "rotate", "degrees": 15}])


@query("G5_resize", affine_sql(
    "x * (320 / width) AS nx, y * (200 / height) AS ny, w * (320 / width) AS nw, h * (200 / height) AS nh"))
def resize(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "resize", "width": 320, "height": 200}])


CROPPED = f"""size AS (SELECT *, greatest(1, round_even(width * s, 0)) AS cw, greatest(1, round_even(height * s, 0)) AS ch
    FROM (SELECT *, 0.3::DOUBLE + {draw_sql(0, 1)} * (0.6::DOUBLE - 0.3::DOUBLE) AS s FROM var)),
  prep AS (SELECT *, x - floor({draw_sql(0, 2)} * (width - cw + 1)) AS qx, y - floor({draw_sql(0, 3)} * (height - ch + 1)) AS qy FROM size)"""
CROP_BOX = """greatest(qx, 0) AS nx, greatest(qy, 0) AS ny, least(qx + w, cw) - greatest(qx, 0) AS nw,
    least(qy + h, ch) - greatest(qy, 0) AS nh"""


@query("G6_crop", affine_sql(CROP_BOX, where="nw > 0 AND nh > 0 AND nw * nh / (w * h) >= 0.1", more=CROPPED))
def crop(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "crop", "scale": [0.3, 0.6]}])


SHEARED = f"""prep AS (SELECT *, x + least(k * y, k * (y + h)) AS sx, w + abs(k) * h AS sw FROM (
    SELECT *, tan(radians(-10 + {draw_sql(0, 1)} * 20)) AS k FROM var))"""
SHEAR_BOX = """greatest(sx, 0) AS nx, y AS ny, least(sx + sw, width) - greatest(sx, 0) AS nw, h AS nh"""


@query("G7_shear", affine_sql(SHEAR_BOX, where="nw > 0 AND nw * nh / (sw * h) >= 0.1", more=SHEARED))
def shear(t: Tables) -> DataFrame:
    return augmented_boxes(t, [{"op": "shear", "degrees": 10}])


CHAIN = [{"op": "flip"}, {"op": "crop", "scale": 0.7, "p": 0.8}, {"op": "rotate90"}, {"op": "brightness"}, {"op": "shear"}]


@query("G14_pipeline_from_specs")
def pipeline_from_specs(t: Tables) -> DataFrame:
    """A chain of ops over every geometry kind."""
    ops = transforms.build_ops(CHAIN)
    variants = transforms.plan_variants(t.images, ops, 2, SEED)
    out = transforms.augment_annotations(mixed_annotations(t), variants, ops)
    return out.groupBy("variant", "type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "G15_planned_variants",
    sql(
        f"""SELECT image_id, variant, CASE WHEN variant > 0 AND {draw_sql(0, 0)} < 0.5 THEN true ELSE false END AS flipped,
        CASE WHEN variant > 0 THEN height ELSE width END AS width, CASE WHEN variant > 0 THEN width ELSE height END AS height
        FROM images, (SELECT unnest(range(0, 4))::INT AS variant)""",
        "images",
    ),
)
def planned_variants(t: Tables) -> DataFrame:
    ops = transforms.build_ops([{"op": "flip"}, {"op": "rotate90", "k": 1}])
    plan = transforms.plan_variants(t.images, ops, 3, SEED, include_original=True)
    flipped = (F.col("variant") > 0) & F.col("_step0.on")
    return plan.select("image_id", "variant", flipped.alias("flipped"), "width", "height")


# --- pixels ---------------------------------------------------------------------------------------


def pictures(t: Tables) -> DataFrame:
    """A small picture per vector: 8 x 8 pixels, blue, green and red from one component each."""
    byte = F.transform("embedding", lambda v: F.pmod(F.floor(v.cast("double") * 1000), F.lit(256)).cast("int"))
    three = F.flatten(F.transform(byte, lambda v: F.array(v, (v * 7) % 256, (v * 13) % 256)))
    data = F.unhex(F.array_join(F.transform(three, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))
    image = F.struct(
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), data.alias("data")
    )
    return t.vectors.select(F.col("vec_id").alias("image_id"), F.lit(8).alias("width"), F.lit(8).alias("height"), image.alias("image"))


PIX = """byte AS (SELECT vec_id AS image_id, i - 1 AS p, ((floor(embedding[i]::DOUBLE * 1000)::BIGINT % 256) + 256) % 256 AS v
    FROM vectors, range(1, 65) r(i)),
  pix AS MATERIALIZED (SELECT image_id, p, p % 8 AS x, p // 8 AS y, v AS b, v * 7 % 256 AS g, v * 13 % 256 AS r FROM byte),
  grey AS MATERIALIZED (SELECT *, (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 AS l FROM pix)"""


def pixel_sql(x: str, y: str, b: str, g_: str, r: str, table: str = "grey", more: str = "") -> str:
    return sql(
        f"""SELECT image_id, ((({y}) * 8 + ({x})) * 3 + c)::INT AS at, (CASE c WHEN 0 THEN {b} WHEN 1 THEN {g_} ELSE {r} END)::INT AS value
        FROM {table}, range(3) k(c)""",
        "vectors",
        more=PIX + more,
    )


def changed_pixels(t: Tables, specs: list[dict]) -> DataFrame:
    ops = transforms.build_ops(specs)
    out = pixels.augment_pixels(transforms.plan_variants(pictures(t), ops, 1, SEED), ops, SEED)
    return pixels.pixel_rows(out, "image_id")


@query("G1_flipped_pixels", pixel_sql("7 - x", "y", "b", "g", "r"))
def flipped_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "flip", "p": 1.0}])


@query("G2_upside_down_pixels", pixel_sql("x", "7 - y", "b", "g", "r"))
def upside_down_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "vflip", "p": 1.0}])


@query("G3_turned_pixels", pixel_sql("y", "7 - x", "b", "g", "r"))
def turned_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "rotate90", "k": 1}])


def taps(name: str, wanted: int) -> str:
    """Weights of the eight pixels of an axis for each of ``wanted`` new ones, in fixed point."""
    scale = 8 / wanted
    reach = max(scale, 1.0)
    return f"""{name} AS MATERIALIZED (SELECT o, k, floor(w / sum(w) OVER (PARTITION BY o) * 4194304 + 0.5)::BIGINT AS w FROM (
      SELECT o, k, CASE WHEN k >= trunc(greatest(m - {reach!r}::DOUBLE + 0.5, 0)) AND k < trunc(m + {reach!r}::DOUBLE + 0.5)
        THEN greatest(0, 1 - abs((k - m + 0.5) / {reach!r}::DOUBLE)) ELSE 0 END AS w
      FROM (SELECT o, k, (o + 0.5::DOUBLE) * {scale!r}::DOUBLE AS m FROM range({wanted}) a(o), range(8) b(k))))"""


def _whole(v: str) -> str:
    return f"least(255, greatest(0, (sum(w * {v}) + 2097152)::BIGINT >> 22))"


RESIZED = f""", {taps("across", 12)}, {taps("down", 5)},
  wide AS MATERIALIZED (SELECT image_id, o AS x, y, {", ".join(f"{_whole(c)} AS {c}" for c in "bgr")} FROM pix JOIN across ON k = x GROUP BY 1, 2, 3),
  resized AS (SELECT image_id, x, o AS y, {", ".join(f"{_whole(c)} AS {c}" for c in "bgr")} FROM wide JOIN down ON k = y GROUP BY 1, 2, 3)"""


@query("G5_resized_pixels", pixel_sql("x", "y", "b", "g", "r", "resized", RESIZED).replace("* 8 +", "* 12 +"))
def resized_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "resize", "width": 12, "height": 5}])


def moved_sql(steps: str) -> str:
    """Every pixel of the new image takes the pixel it comes from, black where there is none. ``steps`` gives the affine
    numbers and the new size (nw, nh) for each image."""
    come = """SELECT image_id, nw, px, py, floor((e * rx - b * ry) / (a * e - b * d) + 1e-9) AS x, floor((a * ry - d * rx) / (a * e - b * d) + 1e-9) AS y
      FROM (SELECT *, px + 0.5 - c AS rx, py + 0.5 - f AS ry FROM steps, range(13) i(px), range(13) j(py) WHERE px < nw AND py < nh)"""
    return sql(
        """SELECT image_id, ((py * nw + px) * 3 + ch)::INT AS at, coalesce(CASE ch WHEN 0 THEN b WHEN 1 THEN g ELSE r END, 0)::INT AS value
        FROM come LEFT JOIN (SELECT image_id, x, y, b, g, r FROM pix) USING (image_id, x, y), range(3) k(ch)""",
        "vectors",
        more=f"""{PIX}, var AS (SELECT DISTINCT image_id, 1 AS variant, 8 AS width, 8 AS height FROM pix), {steps},
      come AS MATERIALIZED ({come})""",
    )


TURNED = f"""turn AS (SELECT *, radians(-15 + {draw_sql(0, 1)} * 30) AS t FROM var),
  canvas AS (SELECT *, 4 * (abs(cos(t)) + abs(sin(t))) AS reach FROM turn),
  grown AS (SELECT *, ceil(round(4 + reach, 9)) - floor(round(4 - reach, 9)) AS nw FROM canvas),
  steps AS (SELECT image_id, nw, nw AS nh, cos(t) AS a, sin(t) AS b, nw / 2 - 4 * cos(t) - 4 * sin(t) AS c, -sin(t) AS d, cos(t) AS e,
    nw / 2 + 4 * sin(t) - 4 * cos(t) AS f FROM grown)"""


@query("G4_rotated_pixels", moved_sql(TURNED))
def rotated_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "rotate", "degrees": 15}])


WINDOW = f"""share AS (SELECT *, greatest(1, round_even(8 * (0.3::DOUBLE + {draw_sql(0, 1)} * (0.6::DOUBLE - 0.3::DOUBLE)), 0)) AS n FROM var),
  steps AS (SELECT image_id, n AS nw, n AS nh, 1 AS a, 0 AS b, -floor({draw_sql(0, 2)} * (8 - n + 1)) AS c, 0 AS d, 1 AS e,
    -floor({draw_sql(0, 3)} * (8 - n + 1)) AS f FROM share)"""


@query("G6_cropped_pixels", moved_sql(WINDOW))
def cropped_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "crop", "scale": [0.3, 0.6]}])


SLANTED = f"""steps AS (SELECT image_id, 8 AS nw, 8 AS nh, 1 AS a, tan(radians(-10 + {draw_sql(0, 1)} * 20)) AS b, 0 AS c, 0 AS d, 1 AS e, 0 AS f FROM var)"""


@query("G7_sheared_pixels", moved_sql(SLANTED))
def sheared_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "shear", "degrees": 10}])


def _dim(v: str) -> str:
    return f"trunc(least(255, {v} * 1.5::FLOAT))"


@query("G8_brighter_pixels", pixel_sql("x", "y", _dim("b"), _dim("g"), _dim("r")))
def brighter_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "brightness", "factor": [1.5, 1.5]}])


def _mix(base: str, v: str) -> str:
    return f"trunc(least(255, greatest(0, {base} + 0.5::DOUBLE * ({v} - {base}))))"


@query("G8_lower_contrast_pixels", pixel_sql("x", "y", _mix("m", "b"), _mix("m", "g"), _mix("m", "r"), "flat",
    ", flat AS (SELECT *, floor(avg(l) OVER (PARTITION BY image_id) + 0.5) AS m FROM grey)"))
def lower_contrast_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "contrast", "factor": [0.5, 0.5]}])


@query("G8_less_saturated_pixels", pixel_sql("x", "y", _mix("l", "b"), _mix("l", "g"), _mix("l", "r")))
def less_saturated_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "saturation", "factor": [0.5, 0.5]}])


@query("G9_grey_pixels", pixel_sql("x", "y", "l", "l", "l"))
def grey_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "grayscale"}])


def tap_sum(source: str, line: str) -> str:
    """Weighted sum along one axis; beyond the edge the edge pixel counts."""
    at = lambda axis: f"least(7, greatest(0, p.{axis} + n.d))" if axis == line else f"p.{axis}"
    sums = ", ".join(f"sum(n.k * q.{c}) AS {c}" for c in "bgr")
    return f"""SELECT p.image_id, p.x, p.y, {sums} FROM pix p JOIN norm n USING (image_id)
    JOIN {source} q ON q.image_id = p.image_id AND q.x = {at("x")} AND q.y = {at("y")} GROUP BY 1, 2, 3"""


BLURRED = f""", rad AS (SELECT DISTINCT image_id, {draw_sql(0, 1)} * 2 AS radius FROM (SELECT image_id, 1 AS variant FROM pix)),
  taps AS (SELECT image_id, d, exp(-0.5 * (d / radius) ** 2) AS k FROM rad, range(-6, 7) t(d) WHERE abs(d) <= greatest(1, ceil(3 * radius))),
  norm AS MATERIALIZED (SELECT image_id, d, k / sum(k) OVER (PARTITION BY image_id) AS k FROM taps),
  upright AS MATERIALIZED ({tap_sum("pix", "y")}), blurred AS MATERIALIZED ({tap_sum("upright", "x")})"""


@query("G10_blurred_pixels", pixel_sql("x", "y", *[f"least(255, greatest(0, round_even({c}, 0)))" for c in "bgr"], "blurred", BLURRED))
def blurred_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "blur", "radius": 2.0}])


def counted(at: str, op: int = 0) -> str:
    """The generator of the pixel ops at a place, for variant 1."""
    m = pixels.STEPS
    z = f"(({SEED * m[0] + m[2] + op * m[3]} + image_id * {m[1]} + ({at}) * {m[4]}) % {pixels.PRIME})"
    for _ in range(pixels.ROUNDS):
        z = f"(SELECT xor(t, t >> {pixels.SHIFT}) FROM (SELECT ({z} * {pixels.TURN} + 11) % {pixels.PRIME} AS t))"
    return f"(({z} + 0.5::DOUBLE) / 2147483648)"


NOISE = f""", drawn AS MATERIALIZED (SELECT *, {counted("p * 2")} AS u, {counted("p * 2 + 1")} AS v, {draw_sql(0, 1)} * 0.08::DOUBLE AS amount
    FROM (SELECT *, 1 AS variant FROM pix)),
  noisy AS (SELECT *, round_even(sqrt(-2 * ln(u)) * cos(2 * pi() * v) * (amount * 96), 0) AS n FROM drawn)"""


@query("G11_noisy_pixels", pixel_sql("x", "y", *[f"least(255, greatest(0, {c} + n))" for c in "bgr"], "noisy", NOISE))
def noisy_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "noise", "amount": 0.08}])


def turned(n: int) -> str:
    k = f"fmod({n} + hue * 6, 6)"
    return f"round_even(top * (1 - sat * greatest(0, least(1, least({k}, 4 - {k})))) * 255, 0)"


HUES = f""", unit AS (SELECT image_id, x, y, b / 255 AS b, g / 255 AS g, r / 255 AS r, -20 + {draw_sql(0, 1)} * 40 AS degrees
    FROM (SELECT *, 1 AS variant FROM pix)),
  tops AS (SELECT *, greatest(r, g, b) AS top, greatest(r, g, b) - least(r, g, b) AS span,
    ((round_even(degrees / 360 * 256, 0)::BIGINT % 256) + 256) % 256 AS turn FROM unit),
  wheel AS (SELECT *, CASE WHEN span = 0 THEN 0 ELSE (CASE WHEN top = r THEN (g - b) / span WHEN top = g THEN 2 + (b - r) / span
    ELSE 4 + (r - g) / span END) / 6 END AS h0, CASE WHEN top = 0 THEN 0 ELSE span / top END AS sat FROM tops),
  hued AS (SELECT image_id, x, y, top, sat, (floor((h0 - floor(h0)) * 255)::BIGINT + turn) % 256 / 255 AS hue FROM wheel)"""


@query("G12_hue_shifted_pixels", pixel_sql("x", "y", turned(1), turned(3), turned(5), "hued", HUES))
def hue_shifted_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "hue_shift", "degrees": 20}])


HOLES = f""", hole AS MATERIALIZED (SELECT *, greatest(1, round_even(8 * (0.1::DOUBLE + s * 0.2::DOUBLE), 0)) AS c FROM (SELECT image_id,
      {counted("3 * i")} AS s, {counted("3 * i + 1")} AS u, {counted("3 * i + 2")} AS v FROM (SELECT DISTINCT image_id FROM pix), range(2) r(i))),
  spot AS (SELECT image_id, c, floor(u * (8 - c + 1)) AS l, floor(v * (8 - c + 1)) AS t FROM hole),
  holed AS (SELECT p.*, EXISTS (SELECT 1 FROM spot s WHERE s.image_id = p.image_id AND x BETWEEN l AND l + c AND y BETWEEN t AND t + c) AS cut FROM pix p)"""


@query("G13_cut_out_pixels", pixel_sql("x", "y", *[f"CASE WHEN cut THEN 128 ELSE {c} END" for c in "bgr"], "holed", HOLES))
def cut_out_pixels(t: Tables) -> DataFrame:
    return changed_pixels(t, [{"op": "cutout", "size": 0.3, "count": 2}])


@query("U2_user_augmentation", pixel_sql("x", "y", "255 - b", "255 - g", "255 - r"))
def user_augmentation(t: Tables) -> DataFrame:
    return pixels.pixel_rows(pixels.map_images(pictures(t), lambda a, row: 255 - a), "image_id")


@query("U3_user_image_transform", pixel_sql("y", "x", "b", "g", "r"))
def user_image_transform(t: Tables) -> DataFrame:
    return pixels.pixel_rows(pixels.map_images(pictures(t), lambda a, row: a.transpose(1, 0, 2)), "image_id")


@query(
    "X30_tile_pixels",
    sql(
        """SELECT image_id, (y // 4)::INT AS "row", (x // 4)::INT AS col, ((y % 4 * 4 + x % 4) * 3 + c)::INT AS at,
        (CASE c WHEN 0 THEN b WHEN 1 THEN g ELSE r END)::INT AS value FROM pix, range(3) k(c)""",
        "vectors",
        more=PIX,
    ),
)
def tile_pixels(t: Tables) -> DataFrame:
    return pixels.pixel_rows(pixels.tile_pixels(transforms.tile_grid(pictures(t))), "image_id", "row", "col")
