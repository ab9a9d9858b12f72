"""Queries on geometry, keypoints and poses: X1-X19, A24, A25, J10-J12, F8, W1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.functions import geometry as g
from annoframe.functions import keypoints as k
from annoframe.operators import poses
from annoframe.plans.detection import rounded
from annoframe.plans.registry import query
from annoframe.plans.tables import Tables, sql


def area_sql(ring: str) -> str:
    """Shoelace area of a ring in DuckDB."""
    return (
        f"abs(list_sum([{ring}[i].x * {ring}[i % len({ring}) + 1].y - {ring}[i % len({ring}) + 1].x * {ring}[i].y"
        f" FOR i IN range(1, len({ring}) + 1)])) / 2"
    )


def inside_sql(x: str, y: str, ring: str) -> str:
    return f"""(len(list_filter(range(1, len({ring}) + 1), lambda i:
      ({ring}[i].y > {y}) <> ({ring}[i % len({ring}) + 1].y > {y}) AND {x} < {ring}[i].x + ({y} - {ring}[i].y)
      * ({ring}[i % len({ring}) + 1].x - {ring}[i].x) / nullif({ring}[i % len({ring}) + 1].y - {ring}[i].y, 0))) % 2 = 1)"""


@query(
    "X1_enclosing_box",
    sql(
        """SELECT ann_id, x, y, w, h, true AS boxed FROM polygons WHERE ann_id % 10 <> 1
        UNION ALL SELECT ann_id, NULL, NULL, NULL, NULL, false FROM polygons WHERE ann_id % 10 = 1""",
        "polygons",
    ),
)
def enclosing_box(t: Tables) -> DataFrame:
    ring = F.col("rings")[0]
    flat = F.transform(ring, lambda p: F.struct(p["x"].alias("x"), F.lit(1.0).alias("y")))
    b = g.enclosing_box(F.when(F.col("ann_id") % 10 == 1, flat).otherwise(ring))
    return t.polygons.select("ann_id", b.alias("b")).select(
        "ann_id", *[F.col(f"b.{c}").alias(c) for c in "xywh"], F.col("b").isNotNull().alias("boxed")
    )


@query(
    "X2_ring_area",
    sql(f"SELECT ann_id, {area_sql('outer_ring')} AS area FROM polygons", "polygons"),
)
def ring_area(t: Tables) -> DataFrame:
    return t.polygons.select("ann_id", g.ring_area(F.col("rings")[0]).alias("area"))


@query(
    "X3_point_in_ring",
    sql(
        f"""SELECT ann_id, {inside_sql('x + w / 2', 'y + h / 2', 'outer_ring')} AS centre,
        {inside_sql('x + w - 1', 'y + h - 1', 'outer_ring')} AS cut_corner,
        {inside_sql('x + ann_id % 100', 'y + ann_id % 37', 'outer_ring')} AS other FROM polygons""",
        "polygons",
    ),
)
def point_in_ring(t: Tables) -> DataFrame:
    ring, x, y, w, h, i = F.col("rings")[0], F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("ann_id")
    return t.polygons.select(
        "ann_id",
        g.point_in_ring(x + w / 2, y + h / 2, ring).alias("centre"),
        g.point_in_ring(x + w - 1, y + h - 1, ring).alias("cut_corner"),
        g.point_in_ring(x + i % 100, y + i % 37, ring).alias("other"),
    )


@query(
    "X4_rings_area",
    sql(
        f"""SELECT ann_id, {area_sql('outer_ring')} - CASE WHEN ann_id % 3 = 0 THEN 64 ELSE 0 END AS area FROM polygons""",
        "polygons",
    ),
)
def rings_area(t: Tables) -> DataFrame:
    return t.polygons.select("ann_id", g.rings_area(F.col("rings")).alias("area"))


@query(
    "X5_annotation_box",
    sql(
        """SELECT ann_id, CASE ann_id % 4 WHEN 3 THEN NULL ELSE x END AS x, CASE ann_id % 4 WHEN 3 THEN NULL ELSE y END AS y,
        CASE ann_id % 4 WHEN 0 THEN 7 WHEN 3 THEN NULL ELSE w END AS w, CASE ann_id % 4 WHEN 3 THEN NULL ELSE h END AS h
        FROM polygons""",
        "polygons",
    ),
)
def annotation_box(t: Tables) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, ("bbox", "polygon", "polyline", "keypoint"))), (F.col("ann_id") % 4).cast("int") + 1)
    stored = F.when(kind == "bbox", g.box(F.col("x"), F.col("y"), F.lit(7.0), F.col("h")))
    b = g.annotation_box(kind, stored, F.col("rings"), F.col("rings")[0])
    return t.polygons.select("ann_id", b.alias("b")).select("ann_id", *[F.col(f"b.{c}").alias(c) for c in "xywh"])


@query(
    "X6_flat_ring_round_trip",
    sql(
        """SELECT ann_id, i AS pos, CASE WHEN i % 2 = 0 THEN outer_ring[i // 2 + 1].x ELSE outer_ring[i // 2 + 1].y END AS value,
        5 AS points FROM polygons, range(10) r(i)""",
        "polygons",
    ),
)
def flat_ring(t: Tables) -> DataFrame:
    flat = g.flatten_ring(F.col("rings")[0])
    odd = F.concat("flat", F.array(F.lit(1.0)))
    # Counted before the explode: beside a generator it would be counted anew for each number.
    rows = t.polygons.select("ann_id", flat.alias("flat")).withColumn("points", F.size(g.points_from_flat(odd)))
    return rows.select("ann_id", "points", F.posexplode("flat").alias("pos", "value"))


def _turned(t: Tables) -> DataFrame:
    obb = F.struct(
        (F.col("x") + F.col("w") / 2).alias("cx"),
        (F.col("y") + F.col("h") / 2).alias("cy"),
        F.col("w"),
        F.col("h"),
        g.normalize_angle((F.col("ann_id") * 7 - 5000).cast("double")).alias("angle"),
    )
    return t.gt.select("image_id", "ann_id", "name", obb.alias("obb"))


TURNED = """turned AS (SELECT ann_id, x + w / 2 AS cx, y + h / 2 AS cy, w, h,
    CASE WHEN fmod(ann_id * 7 - 5000, 360) < 0 THEN fmod(ann_id * 7 - 5000, 360) + 360
    ELSE fmod(ann_id * 7 - 5000, 360) END AS angle FROM gt),
  corners AS (SELECT ann_id, angle, w, h, cx, cy, i, cx + lx * cos(radians(angle)) - ly * sin(radians(angle)) AS px,
    cy + lx * sin(radians(angle)) + ly * cos(radians(angle)) AS py FROM (SELECT *, unnest([0, 1, 2, 3]) AS i,
      unnest([-w / 2, w / 2, w / 2, -w / 2]) AS lx, unnest([-h / 2, -h / 2, h / 2, h / 2]) AS ly FROM turned))"""


@query("X8_normalized_angle", sql("SELECT ann_id, angle FROM turned", "gt", more=TURNED))
def normalized_angle(t: Tables) -> DataFrame:
    return _turned(t).select("ann_id", F.col("obb.angle").alias("angle"))


@query(
    "X9_rotated_corners",
    sql("SELECT ann_id, i AS corner, round(px, 6) AS x, round(py, 6) AS y FROM corners", "gt", more=TURNED),
)
def rotated_corners(t: Tables) -> DataFrame:
    rows = _turned(t).select("ann_id", F.posexplode(g.rotated_corners(F.col("obb"))).alias("corner", "p"))
    return rows.select("ann_id", "corner", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query(
    "X10_rotated_box_from_corners",
    sql(
        """SELECT ann_id, round(cx, 4) AS cx, round(cy, 4) AS cy, round(w, 4) AS w, round(h, 4) AS h,
        fmod(round(angle, 4), 360) AS angle FROM turned""",
        "gt",
        more=TURNED,
    ),
)
def rotated_from_corners(t: Tables) -> DataFrame:
    fitted = _turned(t).select("ann_id", g.rotated_from_corners(g.rotated_corners(F.col("obb"))).alias("o"))
    fitted = rounded(fitted.select("ann_id", "o.*"), "cx", "cy", "w", "h", "angle", digits=4)
    return fitted.withColumn("angle", F.col("angle") % 360)


@query(
    "X11_rotated_enclosure",
    sql(
        """SELECT ann_id, round(min(px), 6) AS x, round(min(py), 6) AS y, round(max(px) - min(px), 6) AS w,
        round(max(py) - min(py), 6) AS h FROM corners GROUP BY ann_id""",
        "gt",
        more=TURNED,
    ),
)
def rotated_enclosure(t: Tables) -> DataFrame:
    out = _turned(t).select("ann_id", g.rotated_enclosure(F.col("obb")).alias("b")).select("ann_id", "b.*")
    return rounded(out, "x", "y", "w", "h", digits=6)


@query(
    "X12_keypoint_visibility",
    sql("SELECT ann_id, CASE WHEN occluded IS NULL THEN 2 ELSE 1 END AS v FROM keypoints", "keypoints"),
)
def keypoint_visibility(t: Tables) -> DataFrame:
    return t.keypoints.select("ann_id", k.visibility(F.col("attributes")).alias("v"))


@query(
    "X13_attributes_without_occluded",
    sql("SELECT ann_id, CASE WHEN color IS NULL THEN 0 ELSE 1 END AS kept, color FROM keypoints", "keypoints"),
)
def attributes_without_occluded(t: Tables) -> DataFrame:
    rest = k.other_attributes(F.col("attributes"))
    return t.keypoints.select("ann_id", F.size(rest).alias("kept"), F.element_at(rest, "color").alias("color"))


@query(
    "F8_finite_keypoints",
    sql("SELECT ann_id FROM keypoints WHERE ann_id % 13 NOT IN (0, 1)", "keypoints"),
)
def finite_keypoints(t: Tables) -> DataFrame:
    bad = t.keypoints.withColumn(
        "px",
        F.when(F.col("ann_id") % 13 == 0, F.lit(float("nan")))
        .when(F.col("ann_id") % 13 == 1, F.lit(float("inf")))
        .otherwise(F.col("px")),
    )
    return bad.where(k.has_finite_point(F.col("px"), F.col("py"))).select("ann_id")


OBJECTS = """obj AS MATERIALIZED (SELECT *, coalesce('i' || instance_id, 'p' || ann_id) AS object_id FROM keypoints)"""
SLOTTED = (
    OBJECTS
    + """, hits AS (SELECT o.image_id, o.object_id, s.class, count(DISTINCT o.joint) AS n, min(s.place) AS place
      FROM obj o JOIN (SELECT class, place, unnest(joints) AS joint FROM templates) s ON s.joint = o.joint GROUP BY 1, 2, 3),
    best AS (SELECT image_id, object_id, class FROM hits
      QUALIFY row_number() OVER (PARTITION BY image_id, object_id ORDER BY n DESC, place) = 1),
    slotted AS MATERIALIZED (SELECT o.*, b.class, CASE WHEN row_number() OVER (PARTITION BY o.image_id, o.object_id, o.joint
        ORDER BY o.pos) = 1 AND list_contains(t.joints, o.joint) THEN list_position(t.joints, o.joint) - 1 END AS slot,
        t.joints, t.edges
      FROM obj o LEFT JOIN best b ON b.image_id = o.image_id AND b.object_id = o.object_id
      LEFT JOIN templates t ON t.class = b.class)"""
)


@query(
    "A24_ordered_keypoint_objects",
    sql(
        """SELECT image_id, object_id, ann_id, joint, row_number() OVER (PARTITION BY image_id, object_id
        ORDER BY CASE joint WHEN 'tail' THEN 0 WHEN 'nose' THEN 1 ELSE 2 END, pos)::INT AS place FROM obj""",
        "keypoints",
        more=OBJECTS,
    ),
)
def ordered_objects(t: Tables) -> DataFrame:
    return poses.ordered_objects(t.keypoints, ["tail", "nose"]).select("image_id", "object_id", "ann_id", "joint", "place")


HULL = """hull AS (SELECT image_id, object_id, count(*) AS points, min(px) AS x0, min(py) AS y0, max(px) - min(px) AS w0,
    max(py) - min(py) AS h0 FROM obj GROUP BY 1, 2),
  obox AS (SELECT image_id, object_id, points, x0 - greatest(0, 1 - w0) / 2 AS x, y0 - greatest(0, 1 - h0) / 2 AS y,
    greatest(w0, 1) AS w, greatest(h0, 1) AS h FROM hull)"""


@query("A25_object_boxes", sql("SELECT * FROM obox", "keypoints", more=f"{OBJECTS}, {HULL}"))
def object_boxes(t: Tables) -> DataFrame:
    return poses.object_boxes(t.keypoints).select("image_id", "object_id", "points", "bbox.*")


TRAIN = """wide AS (SELECT o.*, i.width, i.height, greatest(1.0::DOUBLE, least(i.width, i.height) * 0.05::DOUBLE) AS f
    FROM obox o JOIN images i USING (image_id)),
  grown AS (SELECT *, x - greatest(0, f - w) / 2 AS gx, y - greatest(0, f - h) / 2 AS gy, greatest(w, f) AS gw,
    greatest(h, f) AS gh FROM wide),
  cut AS (SELECT image_id, object_id, greatest(0, least(gx, width)) AS x0, greatest(0, least(gy, height)) AS y0,
    greatest(0, least(gx + gw, width)) AS x1, greatest(0, least(gy + gh, height)) AS y1 FROM grown)"""


@query(
    "X17_trainable_boxes",
    sql(
        """SELECT image_id, object_id, round(x0, 6) AS x, round(y0, 6) AS y, round(x1 - x0, 6) AS w,
        round(y1 - y0, 6) AS h FROM cut""",
        "keypoints",
        "images",
        more=f"{OBJECTS}, {HULL}, {TRAIN}",
    ),
)
def trainable_boxes(t: Tables) -> DataFrame:
    boxes = poses.object_boxes(t.keypoints).join(t.images.select("image_id", "width", "height"), "image_id")
    out = boxes.select(
        "image_id", "object_id", k.trainable_box(F.col("bbox"), F.col("width").cast("double"), F.col("height").cast("double")).alias("b")
    )
    return rounded(out.select("image_id", "object_id", "b.*"), "x", "y", "w", "h", digits=6)


@query(
    "J10_matched_template",
    sql("SELECT image_id, object_id, class FROM best", "keypoints", "templates", more=SLOTTED),
)
def matched_template(t: Tables) -> DataFrame:
    return poses.match_templates(t.keypoints, t.templates)


@query(
    "J11_slotted_joints",
    sql(
        "SELECT image_id, object_id, ann_id, joint, class, slot::INT AS slot FROM slotted",
        "keypoints",
        "templates",
        more=SLOTTED,
    ),
)
def slotted_joints(t: Tables) -> DataFrame:
    return poses.slotted(t.keypoints, t.templates).select("image_id", "object_id", "ann_id", "joint", "class", "slot")


@query(
    "J12_limbs",
    sql(
        """SELECT a.image_id, a.object_id, a.class, e.i, e.j, a.px AS x1, a.py AS y1, b.px AS x2, b.py AS y2
        FROM (SELECT image_id, object_id, class, slot, px, py, unnest(edges) AS e FROM slotted WHERE slot IS NOT NULL) a
        JOIN slotted b ON b.image_id = a.image_id AND b.object_id = a.object_id AND a.e.i = a.slot AND b.slot = a.e.j""",
        "keypoints",
        "templates",
        more=SLOTTED,
    ),
)
def limbs(t: Tables) -> DataFrame:
    return poses.limbs(t.keypoints, t.templates)


FLAT = """flat AS (SELECT e.image_id, e.object_id, e.class, e.s - 1 AS slot, w.px, w.py, w.occluded, w.ann_id FROM
    (SELECT image_id, object_id, class, unnest(range(1, len(joints) + 1)) AS s FROM slotted
      WHERE slot IS NOT NULL GROUP BY image_id, object_id, class, joints) e
    LEFT JOIN slotted w ON w.image_id = e.image_id AND w.object_id = e.object_id AND w.slot = e.s - 1)"""


@query(
    "X14_coco_triplets",
    sql(
        """SELECT image_id, object_id, class, slot::INT AS slot, coalesce(px, 0) AS x, coalesce(py, 0) AS y,
        CASE WHEN ann_id IS NULL THEN 0 WHEN occluded IS NULL THEN 2 ELSE 1 END::DOUBLE AS v FROM flat""",
        "keypoints",
        "templates",
        more=f"{SLOTTED}, {FLAT}",
    ),
)
def coco_triplets(t: Tables) -> DataFrame:
    flat = poses.pose_entries(t.keypoints, t.templates).select(
        "image_id", "object_id", "class", "keypoints", F.posexplode("keypoints").alias("pos", "value")
    )
    kp = F.col("keypoints")
    return flat.where("pos % 3 = 0").select(
        "image_id",
        "object_id",
        "class",
        F.floor(F.col("pos") / 3).cast("int").alias("slot"),
        F.col("value").alias("x"),
        F.get(kp, F.col("pos") + 1).alias("y"),
        F.get(kp, F.col("pos") + 2).alias("v"),
    )


@query(
    "X15_labelled_joints",
    sql(
        "SELECT image_id, object_id, count(*)::INT AS labelled FROM slotted WHERE slot IS NOT NULL GROUP BY 1, 2",
        "keypoints",
        "templates",
        more=SLOTTED,
    ),
)
def labelled_joints(t: Tables) -> DataFrame:
    entries = poses.pose_entries(t.keypoints, t.templates)
    return entries.select("image_id", "object_id", k.labelled(F.col("keypoints")).alias("labelled"))


RAW_TEMPLATE = """rawt AS (SELECT p_partkey, list_concat(string_split(p_name, ' '), ['', p_type]) AS names,
    [[0, 1], [1, 1], [p_size % 5, p_partkey % 4], [2]] AS edges FROM part),
  cleant AS (SELECT p_partkey, list_filter(names, lambda n: n <> '') AS joints, edges FROM rawt)"""


@query(
    "X16_clean_templates",
    "WITH "
    + RAW_TEMPLATE
    + """ SELECT p_partkey, len(joints)::INT AS joints, e[1]::INT AS i, e[2]::INT AS j FROM
    (SELECT p_partkey, joints, unnest(edges) AS e FROM cleant) WHERE len(e) = 2 AND e[1] <> e[2]
    AND e[1] < len(joints) AND e[2] < len(joints)""",
)
def clean_templates(t: Tables) -> DataFrame:
    names = F.concat(F.split("p_name", " "), F.array(F.lit(""), F.col("p_type")))
    nodes = F.transform(names, lambda n: F.struct(n.alias("name")))
    edges = F.expr("array(array(0, 1), array(1, 1), array(p_size % 5, cast(p_partkey % 4 as int)), array(2))")
    raw = t.raw("part").select("p_partkey", k.template_joints(nodes).alias("names"), edges.alias("edges"))
    return raw.select(
        "p_partkey", F.size("names").alias("joints"), F.inline(k.template_edges(F.col("edges"), F.col("names")))
    )


def coco_like(t: Tables) -> DataFrame:
    """One COCO-style keypoint entry per truth box: three triplets with visibilities 0..3."""
    return t.gt.selectExpr(
        "image_id as file_name",
        "ann_id as pos",
        "name",
        "array(x, y, ann_id % 4, x + w, y, (ann_id + 1) % 3, x, y + h, ann_id % 2, 9.0) as kps",
        "case when ann_id % 3 = 0 then array('head', 'foot') else array() end as joints",
        "map('side', 'left') as attributes",
    )


TRIPLETS = """trip AS (SELECT image_id AS file_name, ann_id AS pos, name, s AS slot, tx AS x, ty AS y,
    least(2, v) AS v, ann_id % 3 = 0 AS named FROM (SELECT *, unnest([0, 1, 2]) AS s, unnest([x, x + w, x]) AS tx,
      unnest([y, y, y + h]) AS ty, unnest([ann_id % 4, (ann_id + 1) % 3, ann_id % 2]) AS v FROM gt)),
  placed AS (SELECT *, count(*) OVER (PARTITION BY pos) AS n,
    row_number() OVER (PARTITION BY pos ORDER BY slot) - 1 AS idx FROM trip WHERE v > 0)"""


@query(
    "X18_expanded_triplets",
    sql(
        """SELECT pos, idx::INT AS idx, slot::INT AS slot, x, y, CASE WHEN named AND slot < 2 THEN
        (['head', 'foot'])[slot + 1] ELSE name END AS joint, v = 1 AS occluded, n = 1 AND NOT named AS lone FROM placed""",
        "gt",
        more=TRIPLETS,
    ),
)
def expanded_triplets(t: Tables) -> DataFrame:
    joints = k.expand_triplets(F.col("kps"), F.col("joints"), F.col("name"), F.col("attributes"))
    rows = coco_like(t).select("pos", F.inline(joints))
    return rows.select(
        "pos",
        "idx",
        "slot",
        F.col("point.x").alias("x"),
        F.col("point.y").alias("y"),
        F.col("name").alias("joint"),
        F.map_contains_key("attributes", F.lit("occluded")).alias("occluded"),
        "lone",
    )


@query(
    "W1_image_scoped_instance_ids",
    sql(
        """SELECT file_name, pos, CASE WHEN NOT lone THEN (sum(CASE WHEN lone THEN 0 ELSE 1 END) OVER
        (PARTITION BY file_name ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT END AS instance_id
        FROM (SELECT DISTINCT file_name, pos, n = 1 AND NOT named AS lone FROM placed)""",
        "gt",
        more=TRIPLETS,
    ),
)
def image_scoped_instance_ids(t: Tables) -> DataFrame:
    entries = coco_like(t).where(k.any_placed(F.col("kps"))).select(
        "file_name", "pos", k.lone_entry(F.col("kps"), F.col("joints")).alias("lone")
    )
    return poses.number_objects(entries).select("file_name", "pos", "instance_id")


@query(
    "X19_polygons_from_flat_rings",
    sql(
        """SELECT ann_id, 0 AS ring, 5 AS points, outer_ring[1].x AS first_x, outer_ring[5].y AS last_y FROM polygons
        WHERE ann_id % 4 > 0 UNION ALL SELECT ann_id, CASE WHEN ann_id % 4 > 0 THEN 1 ELSE 0 END, 4, hole_ring[1].x,
        hole_ring[4].y FROM polygons WHERE hole_ring IS NOT NULL""",
        "polygons",
    ),
)
def polygons_from_flat(t: Tables) -> DataFrame:
    flat = F.transform(F.col("rings"), lambda r, i: F.when(
        (i == 0) & (F.col("ann_id") % 4 == 0), F.slice(g.flatten_ring(r), 1, 5)).otherwise(g.flatten_ring(r)))
    rows = t.polygons.select("ann_id", F.posexplode(k.rings_from_flat(flat)).alias("ring", "p"))
    return rows.select(
        "ann_id", "ring", F.size("p").alias("points"), F.element_at("p", 1)["x"].alias("first_x"),
        F.element_at("p", -1)["y"].alias("last_y"),
    )
