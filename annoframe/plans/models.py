"""Queries on vectors, raw model rows and masks: J6, J7, W3, A7-A9, A18, T4, T5, X20, X21, X31-X37, U4, U5."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.functions import geometry as g
from annoframe.operators import masks, matching, metrics, scores, signatures, similarity
from annoframe.plans.detection import COUNTS, F1, PRF, match_ctes, rounded
from annoframe.plans.registry import query
from annoframe.plans.tables import Tables, sql

# --- similarity -----------------------------------------------------------------------------------

NEAR = 0.4
PAIRS = """unit AS MATERIALIZED (SELECT vec_id, [v::DOUBLE FOR v IN embedding] AS e FROM vectors),
  pairs AS MATERIALIZED (SELECT * FROM (SELECT a.vec_id AS a, b.vec_id AS b,
    list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) AS similarity
    FROM unit a JOIN unit b ON a.vec_id < b.vec_id) WHERE similarity >= 0.4)"""
RANKED = """both_ways AS (SELECT a AS src, b AS dst, similarity FROM pairs UNION ALL SELECT b, a, similarity FROM pairs),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY similarity DESC, dst) AS rank FROM both_ways)"""


@query("J6_near_duplicate_pairs", sql("SELECT a, b, round(similarity, 6) AS similarity FROM pairs", "vectors", more=PAIRS))
def near_duplicate_pairs(t: Tables) -> DataFrame:
    return rounded(similarity.similar_pairs(t.vectors, NEAR), "similarity", digits=6)


@query(
    "J6_near_duplicates_by_neighbours",
    sql(
        """SELECT least(src, dst) AS a, greatest(src, dst) AS b, round(max(similarity), 6) AS similarity FROM ranked
        WHERE rank <= 1 GROUP BY 1, 2""",
        "vectors",
        more=f"{PAIRS}, {RANKED}",
    ),
)
def near_duplicates_by_neighbours(t: Tables) -> DataFrame:
    edges, _ = similarity.near_duplicates(similarity.similar_pairs(t.vectors, NEAR), k=1)
    return rounded(edges, "similarity", digits=6)


@query(
    "W3_nearest_neighbours",
    sql("SELECT src, dst, rank::INT AS rank, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 2", "vectors",
        more=f"{PAIRS}, {RANKED}"),
)
def nearest_neighbours(t: Tables) -> DataFrame:
    return rounded(similarity.neighbours(similarity.similar_pairs(t.vectors, NEAR), 2), "similarity", digits=6)


@query(
    "J7_similar_images",
    sql(
        """SELECT vec_id, round(s, 6) AS similarity FROM (SELECT b.vec_id, list_inner_product(a.e, b.e)
        / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) AS s FROM unit a, unit b
        WHERE a.vec_id = 7 AND b.vec_id <> 7) WHERE s >= 0.05 ORDER BY s DESC, vec_id LIMIT 50""",
        "vectors",
        more="unit AS (SELECT vec_id, [v::DOUBLE FOR v IN embedding] AS e FROM vectors)",
    ),
)
def similar_images(t: Tables) -> DataFrame:
    return rounded(similarity.similar_to(t.vectors, 7, threshold=0.05), "similarity", digits=6)


@query(
    "A18_duplicate_clusters",
    sql(
        """SELECT label, size, max_similarity, size - 1 AS redundant FROM (SELECT label, count(*) AS size FROM comp GROUP BY 1)
        JOIN (SELECT label, round(max(similarity), 6) AS max_similarity FROM pairs JOIN comp ON comp.id = pairs.a GROUP BY 1)
        USING (label)""",
        "vectors",
        recursive=True,
        more=PAIRS
        + """, reach AS (SELECT a AS id, a AS other FROM pairs UNION SELECT b, b FROM pairs
            UNION SELECT r.id, CASE WHEN p.a = r.other THEN p.b ELSE p.a END FROM reach r
            JOIN pairs p ON p.a = r.other OR p.b = r.other),
          comp AS (SELECT id, min(other) AS label FROM reach GROUP BY 1)""",
    ),
)
def duplicate_clusters(t: Tables) -> DataFrame:
    return rounded(similarity.duplicate_groups(similarity.similar_pairs(t.vectors, NEAR)), "max_similarity", digits=6)


def frames(t: Tables) -> DataFrame:
    """Bursts of three frames: each vector whole, and twice with every 16th value gone, from another place on."""
    shot = F.explode(F.sequence(F.lit(0), F.lit(2)))
    rows = t.vectors.select(F.col("vec_id").alias("own"), F.transform("embedding", lambda v: v.cast("double")).alias("e"), shot.alias("j"))
    gone = lambda i: (F.col("j") > 0) & ((i + F.col("own") + F.col("j")) % 16 == 0)
    return rows.select(
        (F.col("own") * 3 + F.col("j")).alias("vec_id"), F.transform("e", lambda v, i: F.when(gone(i), 0.0).otherwise(v)).alias("embedding")
    )


#: So few pairs at the threshold are missed that none is in any table of a size DuckDB can pair off.
FRAMES_NEAR, FRAMES_RECALL = 0.92, 1 - 1e-9
FRAMES = """frames AS MATERIALIZED (SELECT vec_id * 3 + j AS vec_id, [CASE WHEN j > 0 AND (i - 1 + vec_id + j) % 16 = 0 THEN 0::DOUBLE
    ELSE embedding[i]::DOUBLE END FOR i IN range(1, len(embedding) + 1)] AS embedding FROM vectors, range(3) s(j)),
  unit AS MATERIALIZED (SELECT vec_id, embedding AS e FROM frames),
  pairs AS MATERIALIZED (SELECT * FROM (SELECT a.vec_id AS a, b.vec_id AS b,
    list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) AS similarity
    FROM unit a JOIN unit b ON a.vec_id < b.vec_id) WHERE similarity >= 0.92)"""


@query("J6_near_pairs_by_signatures", sql("SELECT a, b, round(similarity, 6) AS similarity FROM pairs", "vectors", more=FRAMES))
def near_pairs_by_signatures(t: Tables) -> DataFrame:
    return rounded(signatures.near_pairs(frames(t), FRAMES_NEAR, FRAMES_RECALL), "similarity", digits=6)


@query(
    "W3_neighbours_by_signatures",
    sql("SELECT src, dst, rank::INT AS rank, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 1", "vectors",
        more=f"{FRAMES}, {RANKED}"),
)
def neighbours_by_signatures(t: Tables) -> DataFrame:
    return rounded(similarity.neighbours(signatures.near_pairs(frames(t), FRAMES_NEAR, FRAMES_RECALL), 1), "similarity", digits=6)


REACHED = """reach AS (SELECT a AS id, a AS other FROM edges UNION SELECT b, b FROM edges
    UNION SELECT r.id, CASE WHEN p.a = r.other THEN p.b ELSE p.a END FROM reach r JOIN edges p ON p.a = r.other OR p.b = r.other),
  comp AS (SELECT id, min(other) AS label FROM reach GROUP BY 1)"""
CLUSTERS = f"""edges AS MATERIALIZED (SELECT least(src, dst) AS a, greatest(src, dst) AS b, max(similarity) AS similarity FROM ranked
    WHERE rank <= 1 GROUP BY 1, 2), {REACHED}"""
DUPLICATES = f"""edges AS MATERIALIZED (SELECT least(src, dst) AS a, greatest(src, dst) AS b, max(similarity) AS similarity FROM ranked
    WHERE rank <= 1 AND least(src, dst) IN (SELECT vec_id FROM frames ORDER BY vec_id LIMIT 600)
    OR rank <= 1 AND greatest(src, dst) IN (SELECT vec_id FROM frames ORDER BY vec_id LIMIT 600) GROUP BY 1, 2),
  {REACHED}"""
SOURCED = RANKED.replace("FROM pairs UNION ALL SELECT b, a, similarity FROM pairs", "FROM sourced UNION ALL SELECT b, a, similarity FROM sourced")
SOURCED = """sourced AS (SELECT p.* FROM pairs p WHERE p.a IN (SELECT vec_id FROM frames ORDER BY vec_id LIMIT 600)
    OR p.b IN (SELECT vec_id FROM frames ORDER BY vec_id LIMIT 600)), """ + SOURCED


@query(
    "A18_duplicate_clusters_by_signatures",
    sql(
        """SELECT label, size, max_similarity, size - 1 AS redundant FROM (SELECT label, count(*) AS size FROM comp GROUP BY 1)
        JOIN (SELECT label, round(max(similarity), 6) AS max_similarity FROM edges JOIN comp ON comp.id = edges.a GROUP BY 1)
        USING (label)""",
        "vectors",
        recursive=True,
        more=f"{FRAMES}, {RANKED}, {CLUSTERS}",
    ),
)
def clusters_by_signatures(t: Tables) -> DataFrame:
    _, groups, _ = signatures.duplicate_report(frames(t), FRAMES_NEAR, 1, recall=FRAMES_RECALL)
    return rounded(groups, "max_similarity", digits=6)


#: The caps are what this query is about.
SOURCES, MOST_PAIRS = 600, 300


@query(
    "J6_duplicate_caps",
    sql(
        """SELECT (SELECT count(*) FROM frames) AS total_images, least(600, (SELECT count(*) FROM frames)) AS analyzed,
        (SELECT count(*) FROM frames) > 600 AS sample_capped, (SELECT count(*) FROM edges) AS pairs, (SELECT count(*) FROM edges) > 300 AS pairs_capped""",
        "vectors",
        recursive=True,
        more=f"{FRAMES}, {SOURCED}, {DUPLICATES}",
    ),
)
def duplicate_caps(t: Tables) -> DataFrame:
    _, _, flags = signatures.duplicate_report(frames(t), FRAMES_NEAR, 1, SOURCES, MOST_PAIRS, FRAMES_RECALL)
    return flags.select("total_images", "analyzed", "sample_capped", "pairs", "pairs_capped")


# --- classification -------------------------------------------------------------------------------

CLASSES = [f"kind_{i}" for i in range(63)]  # the last of the 64 logits has no name
SOFT = """soft AS MATERIALIZED (SELECT image_id, truth, i - 1 AS c, exp(logits[i] - list_max(logits)) /
    list_sum([exp(v - list_max(logits)) FOR v IN logits]) AS p FROM logits, range(1, 65) r(i)),
  topped AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY p DESC, c) - 1 AS rank FROM soft)"""


@query(
    "T4_top_classes",
    sql(
        """SELECT image_id, rank::INT AS rank, 'kind_' || c AS name, round(p, 9) AS confidence FROM topped
        WHERE rank < 3 AND c < 63 AND (rank = 0 OR p >= CASE c WHEN 2 THEN 0.05::DOUBLE ELSE 0.2::DOUBLE END)""",
        "logits",
        more=SOFT,
    ),
)
def top_classes(t: Tables) -> DataFrame:
    out = scores.top_classes(t.logits, CLASSES, 3, 0.2, {"kind_2": 0.05})
    return rounded(out, "confidence")


def classified(t: Tables) -> DataFrame:
    best = scores.best_class(F.col("logits"))["class_id"].cast("int")
    return t.logits.select("truth", best.alias("predicted"))


@query(
    "A7_classification_metrics",
    sql(
        """SELECT round((SELECT avg((truth = c)::INT) FROM topped WHERE rank = 0), 9) AS accuracy,
        round(avg(precision), 9) AS macro_precision, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1 FROM
        (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1
          FROM (SELECT CASE WHEN p = 0 THEN 0 ELSE tp / p END AS precision, CASE WHEN g = 0 THEN 0 ELSE tp / g END AS recall
            FROM (SELECT label, sum(p) AS p, sum(g) AS g, sum(m) AS tp FROM (
              SELECT c AS label, 1 AS p, 0 AS g, (c = truth)::INT AS m FROM topped WHERE rank = 0
              UNION ALL SELECT truth, 0, 1, 0 FROM topped WHERE rank = 0) GROUP BY 1)))""",
        "logits",
        more=SOFT,
    ),
)
def classification_metrics(t: Tables) -> DataFrame:
    return rounded(metrics.classification_metrics(classified(t)), "accuracy", "macro_precision", "macro_recall", "macro_f1")


@query(
    "A7_classification_matrix",
    sql("SELECT truth, c::INT AS predicted, count(*) AS count FROM topped WHERE rank = 0 GROUP BY 1, 2", "logits", more=SOFT),
)
def classification_matrix(t: Tables) -> DataFrame:
    return metrics.classification_matrix(classified(t))


# --- detector rows --------------------------------------------------------------------------------

THREE = ["car", "bus", "dog"]


def heads(n: int):
    """``n`` numbers from a whole vector: the sums of every ``n``-th value."""
    own = lambda c: F.filter("embedding", lambda v, i: i % n == c)
    total = lambda c: F.aggregate(own(c), F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), total)


def _heads(n: int) -> str:
    sums = ", ".join(f"list_sum([embedding[i]::DOUBLE FOR i IN range({c}, len(embedding) + 1, {n})])" for c in range(1, n + 1))
    return f"[{sums}]"


def query_rows(t: Tables) -> DataFrame:
    """Raw detector queries: four logits (the last is background) and a box in shares of the image."""

    def part(i: int):
        return F.abs(F.get("places", F.lit(i))) * 4 % 1

    # Two vectors out of three share a small area, so that suppression has work to do.
    near = F.when(F.col("vec_id") % 3 > 0, F.lit(0.1)).otherwise(F.lit(1.0))
    return t.vectors.withColumn("places", heads(6)).select(
        (F.col("vec_id") % 10).alias("image_id"),
        F.col("vec_id").alias("query"),
        F.transform(heads(4), lambda v: v * 3).alias("logits"),
        (part(0) * near).alias("cx"), (part(1) * near).alias("cy"),
        (part(2) * 0.2 + 0.2).alias("w"), (part(3) * 0.2 + 0.2).alias("h"),
        F.lit(640).alias("image_width"), F.lit(480).alias("image_height"),
        F.transform(heads(18), lambda v: F.abs(v) * 4 % 1).alias("keypoints"),
    )


def _part(i: int) -> str:
    return f"fmod(abs(places[{i + 1}]) * 4, 1)"


QUERIES = f"""headed AS (SELECT vec_id, {_heads(4)} AS logits, {_heads(6)} AS places, {_heads(18)} AS points FROM vectors),
  rawq AS (SELECT vec_id % 10 AS image_id, vec_id AS query, [1 / (1 + exp(-(v * 3))) FOR v IN logits[1:3]] AS s,
    {_part(0)} * CASE WHEN vec_id % 3 > 0 THEN 0.1::DOUBLE ELSE 1 END AS cx, {_part(1)} * CASE WHEN vec_id % 3 > 0 THEN 0.1::DOUBLE ELSE 1 END AS cy,
    {_part(2)} * 0.2::DOUBLE + 0.2::DOUBLE AS w, {_part(3)} * 0.2::DOUBLE + 0.2::DOUBLE AS h, points FROM headed),
  bestq AS (SELECT *, list_max(s) AS score, list_position(s, list_max(s)) - 1 AS class_id FROM rawq),
  topq AS (SELECT * FROM bestq QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY score DESC, query) <= 300),
  gate AS MATERIALIZED (SELECT image_id, query AS ann_id, class_id::VARCHAR AS name, score AS confidence, points,
    least(greatest((cx - w / 2) * 640, 0), 640) AS x1, least(greatest((cy - h / 2) * 480, 0), 480) AS y1,
    least(greatest((cx + w / 2) * 640, 0), 640) AS x2, least(greatest((cy + h / 2) * 480, 0), 480) AS y2
    FROM topq WHERE score >= 0.6),
  boxes AS MATERIALIZED (SELECT *, x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h,
    row_number() OVER (PARTITION BY image_id, name ORDER BY confidence DESC, ann_id) AS k FROM gate)"""


def nms_walk(threshold: str) -> str:
    """Suppression over ``boxes`` as a recursive walk."""
    from annoframe.plans.detection import SOFT as soft_iou

    return f"""hit AS MATERIALIZED (SELECT r.image_id, r.name, r.k, list(k.k) AS by FROM boxes r JOIN boxes k
      ON r.image_id = k.image_id AND r.name = k.name AND k.k < r.k AND {soft_iou} > {threshold} GROUP BY 1, 2, 3),
    walk AS (SELECT image_id, name, 0::BIGINT AS k, []::BIGINT[] AS kept, false AS keep FROM boxes WHERE k = 1
      UNION ALL SELECT image_id, name, k, CASE WHEN good THEN list_append(kept, k) ELSE kept END, good FROM (
        SELECT l.image_id, l.name, l.k, v.kept, NOT coalesce(list_has_any(v.kept, h.by), false) AS good
        FROM walk v JOIN boxes l ON l.image_id = v.image_id AND l.name = v.name AND l.k = v.k + 1
        LEFT JOIN hit h ON h.image_id = l.image_id AND h.name = l.name AND h.k = l.k)),
    live AS MATERIALIZED (SELECT b.* FROM boxes b JOIN walk v USING (image_id, name, k) WHERE v.keep)"""


@query(
    "T5_top_queries",
    sql(
        """SELECT image_id, query, round(score, 9) AS score FROM bestq QUALIFY row_number() OVER (PARTITION BY image_id
        ORDER BY score DESC, query) <= 5""",
        "vectors",
        more=QUERIES,
    ),
)
def top_queries(t: Tables) -> DataFrame:
    front = F.transform(F.slice("logits", 1, 3), scores.sigmoid)
    rows = query_rows(t).withColumn("score", F.array_max(front))
    return rounded(scores.top_queries(rows, 5).select("image_id", "query", "score"), "score")


@query(
    "X31_boxes_in_pixels",
    sql("SELECT image_id, ann_id, round(x1, 6) AS x, round(y1, 6) AS y, round(x2 - x1, 6) AS w, round(y2 - y1, 6) AS h FROM gate",
        "vectors", more=QUERIES),
)
def boxes_in_pixels(t: Tables) -> DataFrame:
    out = scores.gated_boxes(query_rows(t), THREE, 4, 0.6).select("image_id", "ann_id", "x", "y", "w", "h")
    return rounded(out, *"xywh", digits=6)


@query(
    "X32_decoded_detections",
    sql("SELECT image_id, ann_id, name, round(confidence, 9) AS confidence, round(x, 6) AS x, round(w, 6) AS w FROM live",
        "vectors", recursive=True, more=f"{QUERIES}, {nms_walk('0.3')}"),
)
def decoded_detections(t: Tables) -> DataFrame:
    out = scores.decode_detections(query_rows(t), THREE, 4, 0.6, 0.3)
    out = rounded(out.select("image_id", "ann_id", "name", "confidence", "x", "w"), "x", "w", digits=6)
    return rounded(out, "confidence")


def anchor_rows(t: Tables) -> DataFrame:
    """Dense detector rows for 64 x 64 inputs: 84 anchors an image; the last image is short."""
    return t.vectors.select(
        F.floor(F.col("vec_id") / 84).alias("image_id"),
        (F.col("vec_id") % 84).cast("int").alias("anchor"),
        F.transform(heads(8), lambda v, i: F.when(i < 4, v).otherwise(F.abs(v) * 3)).alias("raw"),
    )


ANCHORS = f"""grid AS (SELECT row_number() OVER (ORDER BY 64 // s * 0 + s, gy, gx) - 1 AS anchor, gx, gy, s FROM
    (SELECT unnest([8, 16, 32]) AS s), range(8) a(gy), range(8) b(gx) WHERE gx < 64 // s AND gy < 64 // s),
  dense AS (SELECT vec_id // 84 AS image_id, vec_id % 84 AS anchor, {_heads(8)} AS e FROM vectors),
  whole AS (SELECT image_id FROM dense GROUP BY 1 HAVING count(*) = 84),
  raw AS (SELECT image_id, anchor, (e[1] + gx) * s AS cx, (e[2] + gy) * s AS cy, exp(e[3]) * s AS aw, exp(e[4]) * s AS ah,
    [abs(v) * 3 * (abs(e[5]) * 3) FOR v IN e[6:8]] AS sc FROM dense JOIN whole USING (image_id) JOIN grid USING (anchor)),
  decoded AS MATERIALIZED (SELECT image_id, anchor, cx - aw / 2 AS x1, cy - ah / 2 AS y1, cx + aw / 2 AS x2, cy + ah / 2 AS y2, sc FROM raw)"""


@query(
    "X33_decoded_anchors",
    sql(
        """SELECT image_id, anchor::INT AS anchor, round(x1, 6) AS x1, round(y2, 6) AS y2, round(sc[1], 9) AS s0, round(sc[3], 9) AS s2
        FROM decoded UNION ALL SELECT image_id, -1, NULL, NULL, NULL, NULL FROM dense GROUP BY 1 HAVING count(*) <> 84""",
        "vectors",
        more=ANCHORS,
    ),
)
def decoded_anchors(t: Tables) -> DataFrame:
    good, refused = scores.decode_anchors(anchor_rows(t), (64, 64))
    s = F.col("scores")
    rows = good.select("image_id", "anchor", F.round("x1", 6).alias("x1"), F.round("y2", 6).alias("y2"),
                       F.round(s[0], 9).alias("s0"), F.round(s[2], 9).alias("s2"))
    none = F.lit(None).cast("double")
    return rows.unionAll(refused.select("image_id", F.lit(-1), none, none, none, none))


@query(
    "X35_named_annotations",
    sql(
        """SELECT image_id, ann_id, (['car', 'bus'])[name::INT + 1] AS name, round(confidence, 9) AS confidence FROM live
        WHERE name::INT < 2 AND confidence >= CASE name WHEN '0' THEN 0.08::DOUBLE ELSE 0.05::DOUBLE END""",
        "vectors",
        recursive=True,
        more=f"""{ANCHORS}, boxes AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id, name ORDER BY confidence DESC, ann_id) AS k
          FROM (SELECT image_id, anchor AS ann_id, (list_position(sc, list_max(sc)) - 1)::VARCHAR AS name, list_max(sc) AS confidence,
            x1 AS x, y1 AS y, x2 - x1 AS w, y2 - y1 AS h FROM decoded) WHERE confidence >= 0.05), {nms_walk('0.45')}""",
    ),
)
def named_annotations(t: Tables) -> DataFrame:
    good, _ = scores.decode_anchors(anchor_rows(t), (64, 64))
    out = scores.anchors_to_annotations(good, ["car", "bus"], 0.05, {"car": 0.08})
    return rounded(out.select("image_id", "ann_id", "name", "confidence"), "confidence")


NODES = {"car": ["front", "roof"]}
POSES = f"""slot AS (SELECT l.image_id, l.ann_id, l.name, l.confidence, l.x, l.y, l.w, l.h, j, n.arity,
      fmod(abs(points[1 + name::INT * 9 + j * 3]) * 4, 1) * 640 AS px,
      fmod(abs(points[2 + name::INT * 9 + j * 3]) * 4, 1) * 480 AS py,
      1 / (1 + exp(-fmod(abs(points[3 + name::INT * 9 + j * 3]) * 4, 1))) AS c
    FROM live l JOIN (SELECT unnest(['0', '1']) AS name, unnest([3, 1]) AS arity) n USING (name), range(3) r(j) WHERE j < n.arity),
  fits AS (SELECT *, c >= 0.65 AS good, max(c) OVER o AS best, bool_or(c >= 0.65) OVER o AS any_good FROM slot
    WINDOW o AS (PARTITION BY image_id, ann_id)),
  num AS (SELECT image_id, ann_id, row_number() OVER (PARTITION BY image_id ORDER BY ann_id) AS instance_id FROM
    (SELECT DISTINCT image_id, ann_id FROM slot))"""


@query(
    "X34_decoded_poses",
    sql(
        """SELECT image_id, instance_id::INT AS instance_id, ann_id, CASE WHEN name = '1' THEN 'bus' ELSE
          (['front', 'roof', 'point_2'])[j + 1] END AS joint,
        round(CASE WHEN name = '1' AND NOT good THEN x + w / 2 ELSE px END, 6) AS x,
        round(CASE WHEN name = '1' AND NOT good THEN y + h / 2 ELSE py END, 6) AS y
        FROM fits JOIN num USING (image_id, ann_id) WHERE good OR name = '1' OR (NOT any_good AND c = best)""",
        "vectors",
        recursive=True,
        more=f"{QUERIES}, {nms_walk('0.3')}, {POSES}",
    ),
)
def decoded_poses(t: Tables) -> DataFrame:
    out = scores.decode_poses(query_rows(t), THREE, 4, [3, 1, 0], NODES, 0.6, 0.3, 0.65)
    return rounded(out.select("image_id", "instance_id", "ann_id", "joint", "x", "y"), "x", "y", digits=6)


# --- pixels ---------------------------------------------------------------------------------------


def channel_pixels(t: Tables) -> DataFrame:
    """Sixteen pixels of four channels per vector; every third image is already in [0, 1]."""
    scaled = F.col("vec_id") % 3 == 0
    chans = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda c: F.get("embedding", F.col("pixel") + c * 16).cast("double"),
    )
    rows = t.vectors.withColumn("pixel", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return rows.select(
        F.col("vec_id").alias("image_id"), "pixel",
        F.transform(chans, lambda v: F.when(scaled, F.abs(v)).otherwise(v * 10)).alias("logits"),
    )


PROB = """chan AS (SELECT vec_id AS image_id, p AS pixel, c, CASE WHEN vec_id % 3 = 0 THEN abs(embedding[p + c * 16 + 1]::DOUBLE)
      ELSE embedding[p + c * 16 + 1]::DOUBLE * 10 END AS v FROM vectors, range(16) a(p), range(4) b(c)),
  kind AS (SELECT image_id, min(v) >= -1e-6::DOUBLE AND max(v) <= 1 + 1e-6::DOUBLE AS scaled FROM chan GROUP BY 1),
  prob AS MATERIALIZED (SELECT image_id, pixel, c, CASE WHEN scaled THEN least(greatest(v, 0), 1) ELSE
    exp(v - max(v) OVER w) / sum(exp(v - m)) OVER w END AS p FROM (SELECT *, max(v) OVER (PARTITION BY image_id, pixel) AS m FROM chan)
    JOIN kind USING (image_id) WINDOW w AS (PARTITION BY image_id, pixel)),
  pick AS MATERIALIZED (SELECT image_id, pixel, c, p, CASE WHEN c > 0 AND p >= CASE c WHEN 2 THEN 0.3::DOUBLE ELSE 0.5::DOUBLE END
    THEN c - 1 END AS class_id FROM prob QUALIFY row_number() OVER (PARTITION BY image_id, pixel ORDER BY p DESC, c) = 1)"""


@query(
    "X36_pixel_probabilities",
    sql("SELECT image_id, pixel::INT AS pixel, c::INT AS channel, round(p, 9) AS p FROM prob", "vectors", more=PROB),
)
def pixel_probabilities(t: Tables) -> DataFrame:
    rows = scores.pixel_probabilities(channel_pixels(t))
    return rounded(rows.select("image_id", "pixel", F.posexplode("p").alias("channel", "p")), "p")


@query("X37_pixel_classes", sql("SELECT image_id, pixel::INT AS pixel, class_id::INT AS class_id FROM pick", "vectors", more=PROB))
def pixel_classes(t: Tables) -> DataFrame:
    probs = scores.pixel_probabilities(channel_pixels(t))
    return scores.pixel_classes(probs, 0.5, {1: 0.3}).select("image_id", "pixel", "class_id")


@query(
    "X37_region_confidence",
    sql(
        """SELECT image_id, class_id::INT AS class_id, count(*) AS pixels, round(avg(p), 9) AS confidence FROM pick
        WHERE class_id IS NOT NULL GROUP BY 1, 2""",
        "vectors",
        more=PROB,
    ),
)
def region_confidence(t: Tables) -> DataFrame:
    probs = scores.pixel_probabilities(channel_pixels(t))
    return rounded(scores.region_confidence(scores.pixel_classes(probs, 0.5, {1: 0.3})), "confidence")


# --- masks ----------------------------------------------------------------------------------------


def coded_masks(t: Tables) -> DataFrame:
    """Compressed and plain run lengths of an 8 x 8 mask; some do not cover it, some break off."""
    i = F.col("ann_id")
    a, b, c, d = (i % n + 1 for n in (5, 3, 4, 2))
    rest = 64 - a - b - c - d - b
    # The fourth and fifth numbers are written as differences from the second and third.
    small = F.concat(*[F.chr(48 + v) for v in (a, b, c)], F.chr(48 + F.pmod(d, F.lit(16))))
    text = F.concat(small, F.chr(48 + (rest - c).bitwiseAND(F.lit(31)) + 32), F.chr(48 + F.shiftright(rest - c, 5)))
    broken = F.when(i % 10 == 9, F.concat(small, F.lit("P"))).when(i % 10 == 8, F.concat(text, F.lit("1"))).otherwise(text)
    counts = F.when(i % 2 == 0, masks.counts_from_text(broken)).otherwise(
        F.array(a, b, c, d + b, F.when(i % 10 == 7, rest + 1).otherwise(rest))
    )
    return t.gt.select("image_id", "ann_id", F.lit(8).alias("h"), F.lit(8).alias("w"), counts.alias("counts"))


CODED = """coded AS (SELECT image_id, ann_id, ann_id % 5 + 1 AS a, ann_id % 3 + 1 AS b, ann_id % 4 + 1 AS c, ann_id % 2 + 1 AS d FROM gt)"""


@query(
    "X20_mask_areas_and_rejects",
    sql(
        """SELECT ann_id, CASE WHEN ann_id % 10 NOT IN (7, 8) THEN b + d + b END AS area,
        CASE WHEN ann_id % 10 IN (7, 8) THEN 'runs do not cover the mask' END AS reason FROM coded""",
        "gt",
        more=CODED,
    ),
)
def mask_areas(t: Tables) -> DataFrame:
    good, bad = masks.check_counts(coded_masks(t))
    return good.select("ann_id", masks.mask_area(F.col("counts")).alias("area"), F.lit(None).cast("string").alias("reason")).unionAll(
        bad.select("ann_id", F.lit(None).cast("bigint"), "reason")
    )


@query(
    "X20_mask_runs",
    sql(
        """SELECT ann_id, a AS start, b AS len FROM coded WHERE ann_id % 10 NOT IN (7, 8)
        UNION ALL SELECT ann_id, a + b + c, d + b FROM coded WHERE ann_id % 10 NOT IN (7, 8)""",
        "gt",
        more=CODED,
    ),
)
def mask_runs(t: Tables) -> DataFrame:
    return masks.runs_of(masks.check_counts(coded_masks(t))[0]).select("ann_id", "start", "len")


def box_runs(boxes: DataFrame) -> DataFrame:
    """A mask per box, one run per pixel row, in images 1000 pixels wide."""
    first = (F.greatest(F.col("y"), F.lit(0.0)) * 1000 + F.col("x") + 3).cast("long")
    h, w = F.col("h").cast("long"), F.col("w").cast("long")
    starts = F.sequence(first, first + (h - 1) * 1000, F.lit(1000).cast("long"))
    return boxes.select("image_id", "ann_id", starts.alias("starts"), F.array_repeat(w, h.cast("int")).alias("lens"))


INTER = """greatest(0, least(g.x + g.w, p.x + p.w) - greatest(g.x, p.x)) *
    greatest(0, least(g.y + g.h, greatest(p.y, 0) + p.h) - greatest(g.y, p.y))"""


@query(
    "X21_mask_overlaps",
    sql(
        f"""SELECT image_id, left_id, right_id, px::BIGINT AS pixels, round(px / (u - px), 9) AS iou, round(2 * px / u, 9) AS dice FROM (
        SELECT g.image_id, g.ann_id AS left_id, p.ann_id AS right_id, {INTER} AS px, g.w * g.h + p.w * p.h AS u
        FROM gt g JOIN pred p USING (image_id)) WHERE px > 0""",
        "gt",
        "pred",
    ),
)
def mask_overlaps(t: Tables) -> DataFrame:
    pred, gt = t.boxes
    return rounded(masks.mask_overlaps(box_runs(gt), box_runs(pred)), "iou", "dice")


def label_runs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Label maps: line n of an order is one labelled run, the prediction shifted and sometimes renamed."""
    start = (F.col("line") * 1000 + F.col("x")).cast("long")
    gt = t.boxes[1]
    truth = gt.select("image_id", "name", start.alias("start"), F.col("w").cast("long").alias("len"))
    moved = gt.where("ann_id % 9 <> 0").select(
        "image_id",
        F.when(F.col("ann_id") % 11 == 0, F.lit("class_0")).otherwise(F.col("name")).alias("name"),
        (start + F.col("ann_id") % 7 - 3).alias("start"),
        F.col("w").cast("long").alias("len"),
    )
    size = gt.select("image_id").distinct().select("image_id", F.lit(20000).cast("long").alias("pixels"))
    return truth, moved, size


CONF = """lab AS (SELECT ann_id, name AS g, CASE WHEN ann_id % 9 = 0 THEN NULL WHEN ann_id % 11 = 0 THEN 'class_0' ELSE name END AS p,
    w::BIGINT AS w, w::BIGINT - abs(ann_id % 7 - 3) AS o FROM gt),
  conf AS MATERIALIZED (SELECT g AS gt_label, p AS pred_label, sum(n)::BIGINT AS pixels FROM (
    SELECT g, p, o AS n FROM lab WHERE p IS NOT NULL
    UNION ALL SELECT g, '__background__', CASE WHEN p IS NULL THEN w ELSE w - o END FROM lab
    UNION ALL SELECT '__background__', p, w - o FROM lab WHERE p IS NOT NULL
    UNION ALL SELECT '__background__', '__background__', 20000 * (SELECT count(DISTINCT image_id) FROM gt)
      - (SELECT sum(CASE WHEN p IS NULL THEN w ELSE 2 * w - o END) FROM lab)) GROUP BY 1, 2),
  cls AS MATERIALIZED (SELECT name, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM (
    SELECT gt_label AS name, CASE WHEN gt_label = pred_label THEN pixels ELSE 0 END AS tp, 0 AS fp,
      CASE WHEN gt_label <> pred_label THEN pixels ELSE 0 END AS fn FROM conf
    UNION ALL SELECT pred_label, 0, CASE WHEN gt_label <> pred_label THEN pixels ELSE 0 END, 0 FROM conf)
    WHERE name <> '__background__' GROUP BY 1)"""


@query("X21_pixel_confusion", sql("SELECT * FROM conf", "gt", more=CONF))
def pixel_confusion(t: Tables) -> DataFrame:
    return masks.pixel_confusion(*label_runs(t))


@query(
    "A8_semantic_classes",
    sql(
        """SELECT name, tp, fp, fn, tp + fn AS support, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
        round(tp / (tp + fp + fn), 9) AS iou, round(2 * tp / (2 * tp + fp + fn), 9) AS dice FROM cls""",
        "gt",
        more=CONF,
    ),
)
def semantic_classes(t: Tables) -> DataFrame:
    return rounded(masks.semantic_classes(masks.pixel_confusion(*label_runs(t))), "precision", "recall", "iou", "dice")


@query(
    "A8_semantic_overall",
    sql(
        """SELECT round(avg(tp / (tp + fp + fn)), 9) AS miou, round(avg(2 * tp / (2 * tp + fp + fn)), 9) AS mean_dice,
        round(avg(tp / (tp + fn)), 9) AS mean_pixel_accuracy,
        round(sum(tp / (tp + fp + fn) * (tp + fn)) / sum(tp + fn), 9) AS frequency_weighted_iou,
        (SELECT round(sum(CASE WHEN gt_label = pred_label THEN pixels ELSE 0 END) / sum(pixels), 9) FROM conf) AS pixel_accuracy FROM cls""",
        "gt",
        more=CONF,
    ),
)
def semantic_overall(t: Tables) -> DataFrame:
    out = masks.semantic_overall(masks.pixel_confusion(*label_runs(t)))
    return rounded(out, *out.columns)


SWEEP = (0.1, 0.3, 0.5, 0.7, 0.9)


@query(
    "A9_threshold_sweep",
    sql(
        f"""SELECT threshold, tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
        first_value(threshold) OVER (ORDER BY f1 DESC, threshold ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS best_threshold
        FROM (SELECT *, {F1} AS f1 FROM (SELECT *, {PRF} FROM swept))""",
        "gt",
        "pred",
        recursive=True,
        more=match_ctes()
        + """, won AS (SELECT threshold, (SELECT count(*) FROM matched m JOIN pred p ON p.ann_id = m.pid WHERE p.confidence >= threshold) AS tp,
            (SELECT count(*) FROM pred WHERE confidence >= threshold) AS p
            FROM (SELECT unnest([0.1::DOUBLE, 0.3::DOUBLE, 0.5::DOUBLE, 0.7::DOUBLE, 0.9::DOUBLE]) AS threshold)),
          swept AS (SELECT threshold, tp, p - tp AS fp, n - tp AS fn FROM won, (SELECT count(*) AS n FROM gt))""",
    ),
)
def threshold_sweep(t: Tables) -> DataFrame:
    found = matching.greedy_matches(t.pred, t.gt)
    return rounded(masks.threshold_sweep(t.pred, t.gt, found, SWEEP), "precision", "recall", "f1")


# --- user models ----------------------------------------------------------------------------------


def load_sum_model():
    """A user's model: a fixed linear map of the vector, one box and score per row."""

    def predict(batch: pd.DataFrame) -> pd.DataFrame:
        m = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
        score, place = 1 / (1 + np.exp(-m.sum(1))), m.reshape(len(m), -1, 4).sum(1) * 100
        return pd.DataFrame(
            {"image_id": batch["vec_id"], "class_id": (batch["vec_id"] % 3).astype("int32"), "confidence": score,
             "x": place[:, 0], "y": place[:, 1], "w": place[:, 2], "h": place[:, 3]}
        )

    return predict


MODEL = "image_id bigint, class_id int, confidence double, x double, y double, w double, h double"


@query(
    "U4_scored_batches",
    sql(
        """SELECT vec_id AS image_id, (['car', 'bus', 'dog'])[(vec_id % 3)::INT + 1] AS name, round(s, 6) AS confidence FROM (SELECT vec_id,
        1 / (1 + exp(-list_sum([v::DOUBLE FOR v IN embedding]))) AS s FROM vectors) WHERE s >= CASE vec_id % 3 WHEN 1 THEN 0.4::DOUBLE ELSE 0.6::DOUBLE END
        AND vec_id % 3 <> 2""",
        "vectors",
    ),
)
def scored_batches(t: Tables) -> DataFrame:
    raw = scores.score_batches(t.vectors.select("vec_id", "embedding"), load_sum_model, MODEL)
    named = scores.to_annotations(raw, THREE, 0.6, {"bus": 0.4}, ["car", "bus"])
    return rounded(named.select("image_id", "name", "confidence"), "confidence", digits=6)


@query(
    "U5_typed_predictions",
    sql(
        """SELECT vec_id AS image_id, 'object_detection' AS task, true AS has_id FROM vectors
        WHERE list_sum([embedding[i]::DOUBLE FOR i IN range(3, 65, 4)]) > 0 AND list_sum([embedding[i]::DOUBLE FOR i IN range(4, 65, 4)]) > 0""",
        "vectors",
    ),
)
def typed_predictions(t: Tables) -> DataFrame:
    raw = scores.score_batches(t.vectors.select("vec_id", "embedding"), load_sum_model, MODEL)
    rows = raw.select(
        "image_id", F.lit(None).cast("string").alias("id"), g.box(*[F.col(c) for c in "xywh"]).alias("bbox"),
        F.lit(None).cast(g.BOX).alias("obb"), F.lit(None).cast(f"array<{g.RING}>").alias("rings"),
    )
    return scores.typed_predictions(rows, "object_detection").select("image_id", "task", F.col("id").isNotNull().alias("has_id"))
