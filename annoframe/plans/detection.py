"""Queries on matched detections: J2-J4, J8, J9, A1-A6, W2, E2, X7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.functions.geometry import iou
from annoframe.operators import matching, metrics
from annoframe.plans.registry import query
from annoframe.plans.tables import Tables, sql
from annoframe.session import cut

IOU = """CASE WHEN least({a}.x + {a}.w, {b}.x + {b}.w) > greatest({a}.x, {b}.x)
 AND least({a}.y + {a}.h, {b}.y + {b}.h) > greatest({a}.y, {b}.y)
 THEN (least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x))
    * (least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y))
    / ({a}.w * {a}.h + {b}.w * {b}.h
       - (least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x))
       * (least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y))) ELSE 0 END"""
PG_IOU = IOU.format(a="p", b="g")


def match_ctes(threshold: str = "0.5", by_class: bool = True) -> str:
    """The greedy match as a recursive walk over each group's predictions."""
    key = "p.name" if by_class else "'any'"
    same = "AND p.name = g.name" if by_class else ""
    return f"""pair AS MATERIALIZED (SELECT image_id, grp, pid, conf, gid, iou FROM (
      SELECT p.image_id, {key} AS grp, p.ann_id AS pid, p.confidence AS conf, g.ann_id AS gid, {PG_IOU} AS iou
      FROM pred p JOIN gt g ON p.image_id = g.image_id {same}) WHERE iou >= {threshold}),
    wish AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id, grp ORDER BY conf DESC, pid) AS k FROM (
      SELECT image_id, grp, pid, conf, list(gid ORDER BY iou DESC, gid DESC) AS cands FROM pair GROUP BY ALL)),
    fold AS (SELECT DISTINCT image_id, grp, 0::BIGINT AS k, []::BIGINT[] AS claimed, NULL::BIGINT AS pid,
        NULL::BIGINT AS gid FROM wish
      UNION ALL SELECT image_id, grp, k, CASE WHEN pick IS NULL THEN claimed ELSE list_append(claimed, pick) END,
        pid, pick FROM (SELECT w.image_id, w.grp, w.k, f.claimed, w.pid,
          list_filter(w.cands, lambda c: NOT list_contains(f.claimed, c))[1] AS pick
          FROM fold f JOIN wish w ON f.image_id = w.image_id AND f.grp = w.grp AND w.k = f.k + 1)),
    matched AS MATERIALIZED (SELECT image_id, grp, pid, gid FROM fold WHERE gid IS NOT NULL)"""


COUNTS = """counts AS MATERIALIZED (SELECT name, sum(m)::BIGINT AS tp, (sum(p) - sum(m))::BIGINT AS fp,
      (sum(g) - sum(m))::BIGINT AS fn FROM (
        SELECT name, 1 AS p, 0 AS g, 0 AS m FROM pred UNION ALL SELECT name, 0, 1, 0 FROM gt
        UNION ALL SELECT grp, 0, 0, 1 FROM matched) GROUP BY name)"""
PRF = """CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall"""
F1 = "CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END"
SCORED = f"scored AS (SELECT *, {F1} AS f1 FROM (SELECT *, {PRF} FROM counts))"
CURVE = """flag AS (SELECT p.name, p.image_id, p.ann_id, p.confidence,
      CASE WHEN m.pid IS NULL THEN 0 ELSE 1 END AS is_tp
      FROM pred p LEFT JOIN matched m ON p.image_id = m.image_id AND p.ann_id = m.pid),
    run AS (SELECT *, sum(is_tp) OVER w AS running_tp, count(*) OVER w AS rank FROM flag
      WINDOW w AS (PARTITION BY name ORDER BY confidence DESC, image_id, ann_id ROWS UNBOUNDED PRECEDING)),
    curve AS MATERIALIZED (SELECT *, max(running_tp / rank) OVER (PARTITION BY name ORDER BY rank
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS envelope FROM run)"""
AP = """ap AS (SELECT c.name, CASE WHEN c.tp + c.fn = 0 THEN 0 ELSE
      coalesce(sum(v.envelope) FILTER (v.is_tp = 1), 0) / (c.tp + c.fn) END AS ap
      FROM counts c LEFT JOIN curve v ON c.name = v.name GROUP BY c.name, c.tp, c.fn)"""


def match_sql(body: str, *more: str, threshold: str = "0.5", by_class: bool = True) -> str:
    return sql(body, "gt", "pred", recursive=True, more=", ".join([match_ctes(threshold, by_class), *more]))


@query(
    "J2_greedy_match_by_class",
    match_sql("SELECT image_id, grp AS name, pid AS pred_id, gid AS gt_id FROM matched"),
)
def greedy_match_by_class(t: Tables) -> DataFrame:
    return matching.greedy_matches(*t.boxes)


@query(
    "J3_greedy_match_any_class",
    match_sql("SELECT image_id, pid AS pred_id, gid AS gt_id FROM matched", by_class=False),
)
def greedy_match_any_class(t: Tables) -> DataFrame:
    return matching.greedy_matches(*t.boxes, by_class=False).select("image_id", "pred_id", "gt_id")


@query(
    "A1_class_metrics",
    match_sql(
        "SELECT name, tp, fp, fn, tp + fn AS support, round(precision, 9) AS precision, round(recall, 9) AS recall,"
        " round(f1, 9) AS f1 FROM scored",
        COUNTS,
        SCORED,
    ),
)
def class_metrics(t: Tables) -> DataFrame:
    return rounded(metrics.class_metrics(*matched(t)), "precision", "recall", "f1")


def matched(t: Tables) -> tuple[DataFrame, DataFrame, float, DataFrame]:
    """Predictions, truth, the IoU threshold and the pairs claimed at it, each made once."""
    pred, gt = t.boxes
    return pred, gt, 0.5, cut(matching.greedy_matches(pred, gt))


def rounded(df: DataFrame, *names: str, digits: int = 9) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "A2_overall_metrics",
    match_sql(
        f"""SELECT tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall, round({F1}, 9) AS f1,
        round(macro_f1, 9) AS macro_f1 FROM (SELECT *, {PRF} FROM (SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp,
        sum(fn)::BIGINT AS fn, avg(f1) AS macro_f1 FROM scored))""",
        COUNTS,
        SCORED,
    ),
)
def overall_metrics(t: Tables) -> DataFrame:
    return rounded(
        metrics.overall_metrics(metrics.class_metrics(*matched(t))), "precision", "recall", "f1", "macro_f1"
    )


@query("A3_average_precision", match_sql("SELECT name, round(ap, 9) AS ap FROM ap", COUNTS, CURVE, AP))
def average_precision(t: Tables) -> DataFrame:
    return rounded(metrics.average_precision(*matched(t)), "ap")


@query(
    "W2_precision_curve",
    match_sql(
        """SELECT name, image_id, ann_id, is_tp, running_tp::BIGINT AS running_tp, rank,
        round(running_tp / rank, 9) AS precision, round(envelope, 9) AS envelope FROM curve""",
        CURVE,
    ),
)
def precision_curve(t: Tables) -> DataFrame:
    pred, _, _, found = matched(t)
    curve = metrics.precision_curve(pred, found).drop("confidence")
    return rounded(curve, "precision", "envelope")


SWEEP = (0.5, 0.75, 0.9)


def _map_oracle() -> str:
    part = match_sql("SELECT round(avg(ap), 9) AS map FROM ap", COUNTS, CURVE, AP, threshold="{t}")
    return " UNION ALL ".join(
        f"SELECT {t}::DOUBLE AS iou_threshold, map FROM ({part.replace('{t}', str(t))})" for t in SWEEP
    )


@query("A4_mean_average_precision_sweep", _map_oracle())
def mean_average_precision(t: Tables) -> DataFrame:
    return rounded(metrics.mean_average_precision(*t.boxes, SWEEP), "map")


@query(
    "A5_confusion_matrix",
    match_sql(
        """SELECT r.label AS gt_label, c.label AS pred_label, coalesce(n.n, 0) AS count
        FROM labels r CROSS JOIN labels c LEFT JOIN cells n ON n.g = r.label AND n.p = c.label""",
        """pairs AS (SELECT coalesce(g.name, '__background__') AS g, coalesce(p.name, '__background__') AS p
          FROM pred p LEFT JOIN matched m ON p.ann_id = m.pid LEFT JOIN gt g ON g.ann_id = m.gid
          UNION ALL SELECT name, '__background__' FROM gt WHERE ann_id NOT IN (SELECT gid FROM matched)),
        cells AS (SELECT g, p, count(*) AS n FROM pairs GROUP BY 1, 2),
        labels AS (SELECT g AS label FROM cells UNION SELECT p FROM cells)""",
        by_class=False,
    ),
)
def confusion_matrix(t: Tables) -> DataFrame:
    return metrics.confusion_matrix(*t.boxes)


PER_IMAGE = """per_image AS (SELECT image_id, sum(m)::BIGINT AS tp, (sum(p) - sum(m))::BIGINT AS fp,
      (sum(g) - sum(m))::BIGINT AS fn, sum(g)::BIGINT AS gt_count, sum(p)::BIGINT AS pred_count FROM (
        SELECT image_id, 1 AS p, 0 AS g, 0 AS m FROM pred UNION ALL SELECT image_id, 0, 1, 0 FROM gt
        UNION ALL SELECT image_id, 0, 0, 1 FROM matched) GROUP BY 1)"""


@query("J4_outer_image_join", match_sql("SELECT * FROM per_image", PER_IMAGE))
def outer_image_join(t: Tables) -> DataFrame:
    return metrics.image_performance(*matched(t))


@query(
    "A6_best_and_worst_images",
    match_sql(
        """(SELECT *, 'best' AS side FROM per_image WHERE gt_count > 0 ORDER BY fp + fn, image_id LIMIT 10)
        UNION ALL (SELECT *, 'worst' AS side FROM per_image ORDER BY fp + fn DESC, image_id LIMIT 10)""",
        PER_IMAGE,
    ),
)
def best_and_worst(t: Tables) -> DataFrame:
    return metrics.best_and_worst(metrics.image_performance(*matched(t)))


@query(
    "E2_union_of_image_keys",
    sql("SELECT image_id FROM gt UNION SELECT image_id FROM pred", "gt", "pred"),
)
def union_of_image_keys(t: Tables) -> DataFrame:
    return t.gt.select("image_id").union(t.pred.select("image_id")).distinct()


@query(
    "X7_box_iou",
    sql(
        f"""SELECT p.ann_id AS pred_id, g.ann_id AS gt_id, round({PG_IOU}, 9) AS iou FROM pred p JOIN gt g
        ON p.image_id = g.image_id""",
        "gt",
        "pred",
    ),
)
def box_iou(t: Tables) -> DataFrame:
    p, g = t.pred.alias("p"), t.gt.alias("g")
    value = iou(*[F.col(f"p.{c}") for c in "xywh"], *[F.col(f"g.{c}") for c in "xywh"])
    return p.join(g, F.col("p.image_id") == F.col("g.image_id")).select(
        F.col("p.ann_id").alias("pred_id"), F.col("g.ann_id").alias("gt_id"), F.round(value, 9).alias("iou")
    )


SOFT = """(greatest(0, least(k.x + k.w, r.x + r.w) - greatest(k.x, r.x))
  * greatest(0, least(k.y + k.h, r.y + r.h) - greatest(k.y, r.y)))
  / (k.w * k.h + r.w * r.h - (greatest(0, least(k.x + k.w, r.x + r.w) - greatest(k.x, r.x))
  * greatest(0, least(k.y + k.h, r.y + r.h) - greatest(k.y, r.y))) + 1e-9::DOUBLE)"""


@query(
    "J8_multiclass_nms",
    sql(
        "SELECT image_id, name, ann_id, x, y, w, h, confidence FROM walk WHERE keep AND k > 0",
        "pred",
        recursive=True,
        more=f"""line AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id, name
            ORDER BY confidence DESC, ann_id) AS k FROM pred),
          hit AS MATERIALIZED (SELECT r.image_id, r.name, r.k, list(k.k) AS by FROM line r JOIN line k
            ON r.image_id = k.image_id AND r.name = k.name AND k.k < r.k AND {SOFT} > 0.5 GROUP BY 1, 2, 3),
          walk AS (SELECT image_id, name, 0::BIGINT AS k, []::BIGINT[] AS kept, false AS keep, 0::BIGINT AS ann_id,
              0::DOUBLE AS x, 0::DOUBLE AS y, 0::DOUBLE AS w, 0::DOUBLE AS h, 0::DOUBLE AS confidence
              FROM line WHERE k = 1
            UNION ALL SELECT image_id, name, k, CASE WHEN good THEN list_append(kept, k) ELSE kept END, good, ann_id,
              x, y, w, h, confidence FROM (SELECT l.image_id, l.name, l.k, v.kept, l.ann_id, l.x, l.y, l.w, l.h,
                l.confidence, NOT coalesce(list_has_any(v.kept, h.by), false) AS good
              FROM walk v JOIN line l ON l.image_id = v.image_id AND l.name = v.name AND l.k = v.k + 1
              LEFT JOIN hit h ON h.image_id = l.image_id AND h.name = l.name AND h.k = l.k))""",
    ),
)
def multiclass_nms(t: Tables) -> DataFrame:
    return matching.nms(t.pred).select("image_id", "name", "ann_id", "x", "y", "w", "h", "confidence")


@query(
    "J9_new_drafts",
    sql(
        f"""SELECT p.image_id, p.name, p.ann_id FROM pred p WHERE NOT EXISTS (SELECT 1 FROM gt g
        WHERE g.image_id = p.image_id AND g.name = p.name AND {PG_IOU} >= 0.9)""",
        "gt",
        "pred",
    ),
)
def new_drafts(t: Tables) -> DataFrame:
    return matching.new_drafts(t.pred, t.gt).select("image_id", "name", "ann_id")
