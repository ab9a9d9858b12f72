"""Queries on image rows, insights, ledgers, folders, tags, edits and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.functions import geometry as g
from annoframe.functions import text
from annoframe.operators import edits, images, insights, names, splits
from annoframe.plans.detection import rounded
from annoframe.plans.registry import query
from annoframe.plans.tables import Tables, sql

STATS = """stat AS MATERIALIZED (SELECT i.*, coalesce(c.n, 0) AS annotation_count, c.m AS min_confidence FROM images i
    LEFT JOIN (SELECT image_id, count(*) AS n, min(confidence) AS m FROM pred GROUP BY 1) c USING (image_id))"""


def stat_sql(body: str, *more: str) -> str:
    return sql(body, "gt", "pred", "images", more=", ".join([STATS, *more]))


def stats(t: Tables) -> DataFrame:
    return images.with_annotation_stats(t.images, t.pred)


@query("A17_annotation_stats", stat_sql("SELECT image_id, annotation_count, min_confidence FROM stat"))
def annotation_stats(t: Tables) -> DataFrame:
    return stats(t).select("image_id", "annotation_count", "min_confidence")


@query(
    "F1_image_list",
    stat_sql(
        """SELECT image_id, filename, min_confidence FROM stat WHERE directory = '/1/urgent' AND status = 'complete'
        AND split = 'train' AND NOT is_archived AND min_confidence < 0.9 ORDER BY created_at DESC, image_id DESC"""
    ),
)
def image_list(t: Tables) -> DataFrame:
    rows = images.list_images(
        stats(t), directory="/1/urgent", status="complete", split="train", min_confidence_lt=0.9
    )
    return images.newest_first(rows).select("image_id", "filename", "min_confidence")


WANTED = "SELECT l_orderkey * 2 AS image_id FROM lineitem WHERE l_returnflag = 'R'"


def wanted_ids(t: Tables) -> DataFrame:
    """A list of ids with repeats and unknown ids."""
    return t.raw("lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey * 2 as image_id")


@query(
    "F2_selected_images",
    sql(f"SELECT image_id, filename FROM images WHERE image_id IN ({WANTED})", "images"),
)
def selected_images(t: Tables) -> DataFrame:
    return images.select_images(t.images, ids=wanted_ids(t)).select("image_id", "filename")


@query(
    "F3_annotation_run_plan",
    stat_sql(
        """SELECT image_id, (row_number() OVER (ORDER BY image_id) - 1) // 5000 AS batch_no FROM stat WHERE annotation_count = 0"""
    ),
)
def annotation_run_plan(t: Tables) -> DataFrame:
    return images.plan_annotation_run(stats(t))[0].select("image_id", "batch_no")


@query(
    "F3_annotation_run_report",
    stat_sql(
        """SELECT e AS attempted, n - e AS skipped, 0::BIGINT AS capped, ceil(e / 5000)::BIGINT AS batches
        FROM (SELECT count(*) AS n, count(*) FILTER (annotation_count = 0) AS e FROM stat)"""
    ),
)
def annotation_run_report(t: Tables) -> DataFrame:
    return images.plan_annotation_run(stats(t))[1]


@query("F4_class_filter", sql("SELECT ann_id FROM pred WHERE name IN ('class_1', 'class_3')", "pred"))
def class_filter(t: Tables) -> DataFrame:
    return images.keep_classes(t.pred, ["class_1", "class_3"]).select("ann_id")


@query("F4_empty_class_filter", sql("SELECT name, count(*) AS n FROM pred GROUP BY 1", "pred"))
def empty_class_filter(t: Tables) -> DataFrame:
    return images.keep_classes(t.pred, []).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "F5_class_thresholds",
    sql(
        """SELECT ann_id, name, confidence FROM pred WHERE confidence >=
        CASE name WHEN 'class_0' THEN 0.9::DOUBLE WHEN 'class_2' THEN 0.1::DOUBLE ELSE 0.5::DOUBLE END""",
        "pred",
    ),
)
def class_thresholds(t: Tables) -> DataFrame:
    own = {"class_0": 0.9, "class_2": 0.1}
    gated = t.pred.where(F.col("confidence") >= images.confidence_floor(0.5, own))
    return gated.where(F.col("confidence") >= images.class_threshold(F.col("name"), 0.5, own)).select(
        "ann_id", "name", "confidence"
    )


@query(
    "F6_no_zero_extent",
    sql("SELECT ann_id FROM polygons WHERE ann_id % 7 <> 0 AND ann_id % 11 <> 0 AND NOT (ann_id % 3 = 0 AND ann_id % 2 = 0)", "polygons"),
)
def no_zero_extent(t: Tables) -> DataFrame:
    i = F.col("ann_id")
    b = F.when(i % 5 > 0, g.box(F.col("x"), F.col("y"), F.when(i % 7 == 0, F.lit(0.0)).otherwise(F.col("w")), F.col("h")))
    b = F.when(i % 7 == 0, g.box(F.col("x"), F.col("y"), F.lit(0.0), F.col("h"))).otherwise(b)
    obb = F.when(i % 11 == 0, g.box(F.col("x"), F.col("y"), F.lit(4.0), F.lit(-1.0)))
    rings = F.when(i % 2 == 0, F.transform("rings", lambda r, n: F.when(n == 1, F.slice(r, 1, 2)).otherwise(r))).otherwise(F.col("rings"))
    return t.polygons.where(images.has_extent(b, obb, rings)).select("ann_id")


@query(
    "F7_dropped_classes",
    sql(
        """SELECT image_id, count(*) AS kept FROM gt WHERE name NOT IN ('class_0', 'class_1', 'class_2') GROUP BY 1""",
        "gt",
    ),
)
def dropped_classes(t: Tables) -> DataFrame:
    nested = t.gt.groupBy("image_id").agg(F.collect_list(F.struct("name", "ann_id")).alias("annotations"))
    rows = images.without_classes(nested, ["class_0", "class_1", "class_2"], skip_empty=True)
    return rows.select("image_id", F.size("annotations").cast("long").alias("kept"))


@query(
    "F9_tag_search",
    sql(
        """SELECT image_id FROM tags WHERE list_contains(objects, 'red') AND list_contains(scenes, 'ECONOMY')""",
        "tags",
    ),
)
def tag_search(t: Tables) -> DataFrame:
    return images.by_tag(t.tags, objects=["red"], scenes=["ECONOMY"], attributes=[]).select("image_id")


def public_datasets(t: Tables) -> DataFrame:
    return t.tags.selectExpr(
        "image_id as dataset_id",
        "concat('Set ', element_at(objects, 1), ' ', image_id) as name",
        "scenes as tags",
        "objects as classes",
        "timestamp_seconds(1700000000 + image_id % 50 * 3600) as created_at",
    )


def stars(t: Tables) -> DataFrame:
    return t.raw("events").selectExpr("event_id % 97 as dataset_id", "cast(ts as timestamp) as time")


CATALOG = """pub AS (SELECT image_id AS dataset_id, 'Set ' || objects[1] || ' ' || image_id AS name, scenes AS tags,
    objects AS classes FROM tags),
  star AS (SELECT event_id % 97 AS dataset_id, count(*) AS star_count,
    count(*) FILTER (ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY) AS stars_week FROM events GROUP BY 1)"""


@query(
    "F10_public_catalog",
    sql(
        """SELECT p.dataset_id, p.name, coalesce(star_count, 0) AS star_count, coalesce(stars_week, 0) AS stars_week
        FROM pub p LEFT JOIN star USING (dataset_id) WHERE (contains(lower(name), 'econ') OR
        len(list_filter(tags, lambda t: contains(lower(t), 'econ'))) > 0) AND list_contains(classes, 'bolt')""",
        "tags",
        more=CATALOG,
    ),
)
def public_catalog(t: Tables) -> DataFrame:
    now = F.lit("2024-01-30").cast("timestamp")
    rows = images.catalog(public_datasets(t), stars(t), now, search="Econ", class_name="bolt", sort="trending")
    return rows.select("dataset_id", "name", "star_count", "stars_week")


@query(
    "T7_trending_catalog",
    sql(
        """SELECT dataset_id, stars_week FROM (SELECT p.dataset_id, coalesce(stars_week, 0) AS stars_week
        FROM pub p LEFT JOIN star USING (dataset_id)) ORDER BY stars_week DESC, dataset_id""",
        "tags",
        more=CATALOG,
    ),
)
def trending_catalog(t: Tables) -> DataFrame:
    now = F.lit("2024-01-30").cast("timestamp")
    return images.catalog(public_datasets(t), stars(t), now, sort="trending").select("dataset_id", "stars_week")


@query("F13_review_queue", stat_sql("SELECT image_id, min_confidence FROM stat WHERE min_confidence < 0.3 AND NOT is_archived"))
def review_queue(t: Tables) -> DataFrame:
    return images.review_queue(stats(t), 0.3).select("image_id", "min_confidence")


@query(
    "A16_confidence_bands",
    stat_sql(
        """SELECT count(c) AS flagged, min(c) AS lowest, round(avg(c), 9) AS avg_flagged,
        count(*) FILTER (c < 0.5) AS lt50, count(*) FILTER (c >= 0.5 AND c < 0.7) AS b50_70,
        count(*) FILTER (c >= 0.7 AND c < 0.9) AS b70_90, count(*) FILTER (c >= 0.9) AS b90_100
        FROM (SELECT CASE WHEN min_confidence < 1 THEN min_confidence END AS c FROM stat)"""
    ),
)
def confidence_bands(t: Tables) -> DataFrame:
    return rounded(images.confidence_bands(stats(t)), "avg_flagged")


@query(
    "F14_badges",
    sql(
        """SELECT image_id, name, pos FROM (SELECT image_id, name, confidence, first_pos,
          row_number() OVER (PARTITION BY image_id ORDER BY first_pos) - 1 AS pos FROM (
          SELECT image_id, name, max(confidence) AS confidence, min(p) AS first_pos FROM (
            SELECT image_id, name, confidence, row_number() OVER (PARTITION BY image_id ORDER BY ann_id) AS p FROM pred)
          WHERE confidence >= 0.6 GROUP BY 1, 2))""",
        "pred",
    ),
)
def badges(t: Tables) -> DataFrame:
    ranked = t.pred.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("ann_id", "name", "confidence"))).alias("c"))
    shown = ranked.select("image_id", F.posexplode(images.badges(F.col("c"), 0.6)).alias("pos", "b"))
    return shown.select("image_id", F.col("b.name").alias("name"), F.col("pos").cast("long").alias("pos"))


@query(
    "F15_child_folders",
    sql("SELECT DISTINCT '/' || split_part(directory, '/', 2) AS path, split_part(directory, '/', 2) AS name FROM tags", "tags"),
)
def child_folders(t: Tables) -> DataFrame:
    return images.children(t.tags, "/")


@query(
    "J15_picked_and_failed",
    sql(
        f"""SELECT image_id, true AS found FROM images WHERE image_id IN ({WANTED}) UNION ALL
        SELECT DISTINCT image_id, false FROM ({WANTED}) WHERE image_id NOT IN (SELECT image_id FROM images)""",
        "images",
    ),
)
def picked_and_failed(t: Tables) -> DataFrame:
    hit, miss = images.pick(t.images, wanted_ids(t))
    return hit.select("image_id", F.lit(True).alias("found")).unionAll(miss.select("image_id", F.lit(False)))


CURSOR = ("1998-06-15", 700)


@query(
    "T1_keyset_page",
    sql(
        """SELECT image_id, created_at FROM images WHERE (created_at, image_id) < (TIMESTAMP '1998-06-15', 700)
        ORDER BY created_at DESC, image_id DESC LIMIT 50""",
        "images",
    ),
)
def keyset_page(t: Tables) -> DataFrame:
    return images.page_after(t.images, CURSOR, 50).select("image_id", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(
    "T2_offset_page",
    sql("SELECT image_id FROM images ORDER BY created_at DESC, image_id DESC LIMIT 30 OFFSET 100", "images"),
)
def offset_page(t: Tables) -> DataFrame:
    return images.page_at(t.images, 100, 50, max_total=130).select("image_id")


@query("T3_first_rows", sql("SELECT image_id FROM images ORDER BY created_at DESC, image_id DESC LIMIT 7", "images"))
def first_rows(t: Tables) -> DataFrame:
    return images.first(t.images, 7).select("image_id")


@query(
    "T6_largest_regions",
    sql(
        """SELECT image_id, name, ann_id FROM (SELECT g.image_id, g.name, g.ann_id, g.w * g.h AS area,
          i.width * i.height * 0.005::DOUBLE AS floor, row_number() OVER (PARTITION BY g.image_id, g.name ORDER BY g.w * g.h DESC, g.ann_id) AS r
          FROM gt g JOIN images i USING (image_id)) WHERE r <= 2 AND (area >= floor OR r = 1)""",
        "gt",
        "images",
    ),
)
def largest_regions(t: Tables) -> DataFrame:
    regions = t.gt.join(t.images.select("image_id", (F.col("width") * F.col("height")).alias("image_area")), "image_id")
    regions = regions.withColumn("area", F.col("w") * F.col("h"))
    return images.region_cut(regions, 0.005, 2).select("image_id", "name", "ann_id")


# --- insights -------------------------------------------------------------------------------------


@query(
    "A10_dataset_totals",
    stat_sql(
        """SELECT count(*) AS total_images, sum(annotation_count)::BIGINT AS total_annotations,
        count(*) FILTER (annotation_count > 0) AS annotated_images, count(*) FILTER (annotation_count = 0) AS unannotated_images,
        round(sum(annotation_count) / count(*), 9) AS avg_annotations_per_image, sum(file_size)::BIGINT AS total_bytes
        FROM stat WHERE NOT is_archived"""
    ),
)
def dataset_totals(t: Tables) -> DataFrame:
    return rounded(insights.dataset_totals(stats(t)), "avg_annotations_per_image")


@query(
    "A11_stage_counts",
    sql(
        """SELECT count(*) FILTER (status = 'new') AS "new", count(*) FILTER (status = 'annotate') AS annotate,
        count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'complete') AS complete
        FROM images WHERE NOT is_archived""",
        "images",
    ),
)
def stage_counts(t: Tables) -> DataFrame:
    return insights.stage_counts(t.images)


@query(
    "A12_class_balance",
    sql("SELECT name, count(*) AS instances, count(DISTINCT image_id) AS images FROM gt GROUP BY 1", "gt"),
)
def class_balance(t: Tables) -> DataFrame:
    return insights.class_balance(t.gt)


TYPED = "(['bbox', 'polygon', 'polyline', 'keypoint'])[(ann_id % 4)::INT + 1]"


def typed(t: Tables) -> DataFrame:
    kinds = F.array(*map(F.lit, ("bbox", "polygon", "polyline", "keypoint")))
    return t.gt.withColumn("type", F.element_at(kinds, (F.col("ann_id") % 4).cast("int") + 1))


@query("A13_type_counts", sql(f"SELECT {TYPED} AS type, count(*) AS instances FROM gt GROUP BY 1", "gt"))
def type_counts(t: Tables) -> DataFrame:
    return insights.type_counts(typed(t))


@query(
    "A14_density_histogram",
    stat_sql(
        """SELECT b.bucket, count(s.image_id) AS images FROM (SELECT unnest(['0', '1-2', '3-5', '6-10', '11-20', '21-50',
        '51+']) AS bucket, unnest([0, 1, 3, 6, 11, 21, 51]) AS lo, unnest([0, 2, 5, 10, 20, 50, 1000000000]) AS hi) b
        LEFT JOIN stat s ON s.annotation_count BETWEEN b.lo AND b.hi AND NOT s.is_archived GROUP BY 1"""
    ),
)
def density_histogram(t: Tables) -> DataFrame:
    return insights.density_histogram(stats(t))


SIZED = """sized AS (SELECT * REPLACE (CASE WHEN image_id % 17 = 0 THEN NULL ELSE width END AS width) FROM images
    WHERE NOT is_archived)"""


def sized(t: Tables) -> DataFrame:
    return t.images.withColumn("width", F.when(F.col("image_id") % 17 != 0, F.col("width")))


@query(
    "A15_dimension_stats",
    sql(
        """SELECT min(width) AS min_width, max(width) AS max_width, round_even(avg(width), 0)::BIGINT AS avg_width,
        min(height) AS min_height, max(height) AS max_height, round_even(avg(height), 0)::BIGINT AS avg_height,
        count(*) FILTER (width > height) AS landscape, count(*) FILTER (width < height) AS portrait,
        count(*) FILTER (width = height) AS square, count(width) AS images_with_dimensions,
        count(*) - count(width) AS images_missing_dimensions FROM sized""",
        "images",
        more=SIZED,
    ),
)
def dimension_stats(t: Tables) -> DataFrame:
    return insights.dimension_stats(sized(t))


@query(
    "A15_top_sizes",
    sql(
        """SELECT width, height, count(*) AS images FROM sized WHERE width IS NOT NULL GROUP BY 1, 2
        ORDER BY 3 DESC, 1, 2 LIMIT 5""",
        "images",
        more=SIZED,
    ),
)
def top_sizes(t: Tables) -> DataFrame:
    return insights.top_sizes(sized(t), 5)


@query(
    "A19_directory_stats",
    sql(
        """SELECT count(DISTINCT directory) AS directories, count(*) AS images, sum(file_size)::BIGINT AS bytes,
        count(*) FILTER (status = 'new') AS "new", count(*) FILTER (status = 'annotate') AS annotate,
        count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'complete') AS complete
        FROM images WHERE directory = '/2' OR starts_with(directory, '/2/')""",
        "images",
    ),
)
def directory_stats(t: Tables) -> DataFrame:
    return insights.directory_stats(t.images, "/2")


@query(
    "A20_directory_tree",
    sql(
        """SELECT path, sum(CASE WHEN path = directory THEN 1 ELSE 0 END)::BIGINT AS image_count,
        count(*) AS nested_image_count FROM (SELECT directory, unnest(['/', '/' || split_part(directory, '/', 2), directory])
        AS path FROM tags) GROUP BY 1""",
        "tags",
    ),
)
def directory_tree(t: Tables) -> DataFrame:
    return insights.directory_tree(t.tags)


LEDGER_NOW = "1998-07-01"


@query(
    "A21_usage_by_operation",
    sql(
        """SELECT operation, (-sum(amount))::BIGINT AS total_micro_usd, count(*) AS events FROM ledger WHERE amount < 0
        AND created_at >= TIMESTAMP '1998-07-01' - INTERVAL 30 DAY GROUP BY ROLLUP (operation)""",
        "ledger",
    ),
)
def usage_by_operation(t: Tables) -> DataFrame:
    return insights.usage_by_operation(t.ledger, F.lit(LEDGER_NOW).cast("timestamp"), "month")


@query(
    "T7_operations_by_spend",
    sql(
        """SELECT operation, (-sum(amount))::BIGINT AS total_micro_usd, count(*) AS events FROM ledger WHERE amount < 0
        GROUP BY 1 ORDER BY 2 DESC, 1""",
        "ledger",
    ),
)
def operations_by_spend(t: Tables) -> DataFrame:
    return insights.by_spend(insights.usage_by_operation(t.ledger, F.current_timestamp(), "all"))


@query(
    "A22_budget_position",
    sql(
        """SELECT org, greatest(0, allowance - s)::BIGINT AS allowance_left, s::BIGINT AS spend,
        greatest(0, s - allowance)::BIGINT AS overage, greatest(0, budget - s)::BIGINT AS budget_left FROM (
          SELECT o.org, 100000000000 AS allowance, 100000000000 + o.org * 60000000000 AS budget, coalesce(s, 0) AS s
          FROM (SELECT DISTINCT org FROM ledger) o LEFT JOIN (SELECT org, -sum(amount) AS s FROM ledger WHERE amount < 0
            AND created_at >= TIMESTAMP '1998-07-01' GROUP BY 1) USING (org))""",
        "ledger",
    ),
)
def budget_position(t: Tables) -> DataFrame:
    plans = t.ledger.select("org").distinct().selectExpr(
        "org", "100000000000 as allowance", "100000000000 + org * 60000000000 as budget"
    )
    return insights.budget_position(t.ledger, plans, F.lit(LEDGER_NOW).cast("timestamp"))


@query(
    "W4_running_balance",
    sql(
        """SELECT id, org, (sum(amount) OVER (PARTITION BY org ORDER BY created_at, id ROWS UNBOUNDED PRECEDING))::BIGINT
        AS balance_after FROM ledger""",
        "ledger",
    ),
)
def running_balance(t: Tables) -> DataFrame:
    return insights.running_balance(t.ledger).select("id", "org", "balance_after")


LAST = """savers AS (SELECT image_id, user_id, completed FROM work QUALIFY row_number() OVER (PARTITION BY image_id
    ORDER BY saved_at DESC, user_id DESC, completed DESC) = 1)"""


@query("W10_last_savers", sql("SELECT image_id, user_id FROM savers", "work", more=LAST))
def last_savers(t: Tables) -> DataFrame:
    return insights.last_savers(t.work).select("image_id", "user_id")


@query(
    "A23_contributions",
    sql(
        """SELECT e.user_id, active_seconds::BIGINT AS active_seconds, images_worked, coalesce(images_completed, 0) AS images_completed,
        coalesce(annotations_added, 0)::BIGINT AS annotations_added FROM
        (SELECT user_id, sum(seconds) AS active_seconds, count(DISTINCT image_id) AS images_worked FROM work GROUP BY 1) e
        LEFT JOIN (SELECT user_id, count(*) FILTER (completed) AS images_completed, sum(n) AS annotations_added FROM savers
          LEFT JOIN (SELECT image_id, count(*) AS n FROM gt GROUP BY 1) USING (image_id) GROUP BY 1) c USING (user_id)""",
        "work",
        "gt",
        more=LAST,
    ),
)
def contributions(t: Tables) -> DataFrame:
    return insights.contributions(t.work, t.gt)


@query(
    "A26_stream_summary",
    sql(
        """SELECT kind, count(*) AS count, min(time) AS first_time, max(time) AS last_time, count(*) FILTER (k > 50) AS passed,
        count(*) FILTER (k <= 50 AND k >= 10) AS failed FROM log GROUP BY 1""",
        "log",
    ),
)
def stream_summary(t: Tables) -> DataFrame:
    rows = t.log.withColumn("condition", F.when(F.col("k") >= 10, F.col("k") > 50))
    return ntz(insights.stream_summary(rows), "first_time", "last_time")


def ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query(
    "A27_top_tags",
    sql(
        """SELECT tag, count(*) AS images FROM (SELECT DISTINCT image_id, unnest(list_concat(objects, scenes, attributes)) AS tag
        FROM tags) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "tags",
    ),
)
def top_tags(t: Tables) -> DataFrame:
    return insights.top_tags(t.tags)


# --- splits ---------------------------------------------------------------------------------------


def _split_sql(table: str, key: str, group: str) -> str:
    return f"""SELECT {key} AS image_id, CASE WHEN r <= floor(n * 20 / 100) THEN 'val'
      WHEN r <= floor(n * 20 / 100) + floor(n * 10 / 100) THEN 'test' ELSE 'train' END AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY md5('42:' || {key}), {key}) AS r,
        count(*) OVER (PARTITION BY {group}) AS n FROM {table})"""


@query("W5_random_split", sql(_split_sql("images", "image_id", "1"), "images"))
def random_split(t: Tables) -> DataFrame:
    return splits.assign_splits(t.images)


@query("W6_stratified_split", sql(_split_sql("vectors", "vec_id", "cluster"), "vectors"))
def stratified_split(t: Tables) -> DataFrame:
    return splits.assign_splits(t.vectors.withColumnRenamed("vec_id", "image_id"), by="cluster")


# --- edits ----------------------------------------------------------------------------------------

IDS = "SELECT image_id FROM images WHERE image_id % 3 = 0"


def third(t: Tables) -> DataFrame:
    return t.images.where("image_id % 3 = 0").select("image_id")


def part_third(t: Tables) -> DataFrame:
    return t.tags.where("image_id % 3 = 0").select("image_id")


@query(
    "E1_tags_added",
    sql(
        """SELECT image_id, tag FROM (SELECT image_id, unnest(objects) AS tag FROM tags UNION
        SELECT image_id, unnest(['red', 'checked']) FROM tags WHERE image_id % 3 = 0)""",
        "tags",
    ),
)
def tags_added(t: Tables) -> DataFrame:
    rows = t.tags.withColumn("tags", F.array_distinct("objects"))
    return edits.bulk_tag(rows, part_third(t), ["red", "checked"]).select("image_id", F.explode("tags").alias("tag"))


@query(
    "E1_tags_removed",
    sql(
        """SELECT DISTINCT image_id, tag FROM (SELECT image_id, unnest(objects) AS tag FROM tags)
        WHERE NOT (image_id % 3 = 0 AND tag IN ('red', 'bolt'))""",
        "tags",
    ),
)
def tags_removed(t: Tables) -> DataFrame:
    rows = t.tags.withColumn("tags", F.array_distinct("objects"))
    return edits.bulk_tag(rows, part_third(t), ["red", "bolt"], add=False).select("image_id", F.explode("tags").alias("tag"))


CLASS_LISTS = """base AS (SELECT p_partkey AS pos, 'c' || p_partkey AS name, 'bbox' AS type, p_brand AS color FROM part
    WHERE p_partkey % 5 < 4),
  edited AS (SELECT pos, name, type, CASE WHEN pos % 7 = 0 THEN 'new' ELSE color END AS color FROM base WHERE pos % 11 <> 0
    UNION ALL SELECT p_partkey, 'c' || p_partkey, 'polygon', 'added' FROM part WHERE p_partkey % 13 = 0),
  stored AS (SELECT pos, name, type, CASE WHEN pos % 3 = 0 THEN 'theirs' ELSE color END AS color FROM base WHERE pos % 17 <> 0
    UNION ALL SELECT p_partkey, 'c' || p_partkey, 'bbox', 'other' FROM part WHERE p_partkey % 5 = 4)"""


@query(
    "E4_merged_class_list",
    "WITH "
    + CLASS_LISTS
    + """ SELECT coalesce(s.name, e.name) AS name, coalesce(s.type, e.type) AS type,
    CASE WHEN e.name IS NOT NULL AND (b.name IS NULL OR e.color <> b.color) THEN e.color ELSE s.color END AS color
    FROM stored s FULL JOIN edited e ON s.name = e.name AND s.type = e.type
    LEFT JOIN base b ON b.name = coalesce(s.name, e.name) AND b.type = coalesce(s.type, e.type)
    WHERE NOT (b.name IS NOT NULL AND e.name IS NULL)
    AND (s.name IS NOT NULL OR b.name IS NULL OR e.color <> b.color)""",
)
def merged_class_list(t: Tables) -> DataFrame:
    part = t.raw("part").selectExpr("p_partkey as pos", "concat('c', p_partkey) as name", "'bbox' as type", "p_brand as color")
    pos = F.col("pos")
    base = part.where(pos % 5 < 4)
    edited = base.where(pos % 11 != 0).withColumn("color", F.when(pos % 7 == 0, F.lit("new")).otherwise(F.col("color")))
    edited = edited.unionByName(part.where(pos % 13 == 0).withColumns({"type": F.lit("polygon"), "color": F.lit("added")}))
    stored = base.where(pos % 17 != 0).withColumn("color", F.when(pos % 3 == 0, F.lit("theirs")).otherwise(F.col("color")))
    stored = stored.unionByName(part.where(pos % 5 == 4).withColumn("color", F.lit("other")))
    return edits.merge_class_lists(base, edited, stored)


@query(
    "E5_renamed_class",
    sql("SELECT CASE name WHEN 'class_4' THEN 'lorry' ELSE name END AS name, count(*) AS n FROM gt GROUP BY 1", "gt"),
)
def renamed_class(t: Tables) -> DataFrame:
    return edits.rename_class(t.gt, "class_4", "lorry").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "E6_merged_class",
    sql("SELECT ann_id, CASE name WHEN 'class_4' THEN 'class_5' ELSE name END AS name FROM gt", "gt"),
)
def merged_class(t: Tables) -> DataFrame:
    return edits.rename_class(t.gt, "class_4", "class_5").select("ann_id", "name")


@query("E7_deleted_class", sql("SELECT name, count(*) AS n FROM gt WHERE name <> 'class_2' GROUP BY 1", "gt"))
def deleted_class(t: Tables) -> DataFrame:
    rows = edits.delete_class(t.gt, "class_2", delete_annotations=True)
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "E7_class_ontology_after_delete",
    sql(f"SELECT DISTINCT name, {TYPED} AS type FROM gt WHERE NOT (name = 'class_2' AND {TYPED} = 'polygon')", "gt"),
)
def class_ontology_after_delete(t: Tables) -> DataFrame:
    return edits.remove_from_ontology(typed(t).select("name", "type").distinct(), "class_2", "polygon")


@query(
    "A29_class_edit_counts",
    sql(
        """SELECT count(DISTINCT image_id) AS images_updated, count(*) AS annotations_updated FROM gt WHERE name = 'class_4'""",
        "gt",
    ),
)
def class_edit_counts(t: Tables) -> DataFrame:
    return edits.class_edit_counts(t.gt, "class_4")


@query(
    "E8_replaced_annotations",
    sql(
        f"""SELECT image_id, ann_id, name FROM gt WHERE image_id NOT IN (SELECT image_id FROM ({WANTED}) WHERE image_id IN
        (SELECT image_id FROM images)) UNION ALL SELECT image_id, ann_id, name FROM pred WHERE image_id IN ({WANTED})
        AND image_id IN (SELECT image_id FROM images)""",
        "gt",
        "pred",
        "images",
    ),
)
def replaced_annotations(t: Tables) -> DataFrame:
    cols = ["image_id", "ann_id", "name"]
    return edits.replace_annotations(t.gt.select(cols), t.pred.select(cols), wanted_ids(t), t.images)[0]


@query(
    "E8_failed_saves",
    sql(f"SELECT DISTINCT image_id FROM ({WANTED}) WHERE image_id NOT IN (SELECT image_id FROM images)", "images"),
)
def failed_saves(t: Tables) -> DataFrame:
    cols = ["image_id", "ann_id", "name"]
    return edits.replace_annotations(t.gt.select(cols), t.pred.select(cols), wanted_ids(t), t.images)[1]


@query(
    "E9_bulk_update",
    sql(
        """SELECT image_id, CASE WHEN image_id % 3 = 0 THEN 'review' ELSE status END AS status,
        CASE WHEN image_id % 3 = 0 THEN NULL ELSE split END AS split,
        CASE WHEN image_id % 3 = 0 THEN true ELSE is_archived END AS is_archived FROM images""",
        "images",
    ),
)
def bulk_update(t: Tables) -> DataFrame:
    out = edits.bulk_update(t.images, third(t), status="review", clear_split=True, is_archived=True)
    return out.select("image_id", "status", "split", "is_archived")


@query(
    "E10_review",
    sql(
        """SELECT image_id, CASE WHEN image_id % 3 = 0 THEN 'annotate' ELSE status END AS status,
        CASE WHEN image_id % 3 = 0 THEN 'tighter boxes' END AS note FROM images""",
        "images",
    ),
)
def review(t: Tables) -> DataFrame:
    return edits.review(t.images, third(t), "request_changes", "tighter boxes").select("image_id", "status", "note")


@query("E11_deleted_images", sql("SELECT image_id FROM images WHERE image_id % 3 <> 0", "images"))
def deleted_images(t: Tables) -> DataFrame:
    return edits.delete_images(t.images, third(t), permanent=True).select("image_id")


@query(
    "E11_archived_images",
    sql("SELECT image_id, is_archived OR image_id % 3 = 0 AS is_archived FROM images", "images"),
)
def archived_images(t: Tables) -> DataFrame:
    return edits.delete_images(t.images, third(t)).select("image_id", "is_archived")


@query(
    "E12_moved_folder",
    sql(
        """SELECT image_id, CASE WHEN directory = '/ECONOMY' OR starts_with(directory, '/ECONOMY/')
        THEN '/old' || directory ELSE directory END AS directory FROM tags""",
        "tags",
    ),
)
def moved_folder(t: Tables) -> DataFrame:
    return edits.move_folder(t.tags, "/ECONOMY", "/old").select("image_id", "directory")


@query(
    "E12_renamed_folder",
    sql(
        """SELECT image_id, CASE WHEN directory = '/SMALL' OR starts_with(directory, '/SMALL/')
        THEN '/tiny' || substr(directory, 7) ELSE directory END AS directory FROM tags""",
        "tags",
    ),
)
def renamed_folder(t: Tables) -> DataFrame:
    return edits.rename_folder(t.tags, "/SMALL", "/tiny").select("image_id", "directory")


@query(
    "E13_deleted_folder",
    sql("SELECT image_id, CASE directory WHEN '/1/urgent' THEN '/1' ELSE directory END AS directory FROM images", "images"),
)
def deleted_folder(t: Tables) -> DataFrame:
    return edits.delete_folder(t.images, "/1/urgent", cascade=True).select("image_id", "directory")


# --- names ----------------------------------------------------------------------------------------


def label_keys(t: Tables) -> DataFrame:
    """Label files named for orders: exact names, stems, repeats and names no image has."""
    ext = F.element_at(F.array(*map(F.lit, (".jpg", ".txt", ".xml"))), (F.col("l_partkey") % 3).cast("int") + 1)
    rows = t.raw("lineitem").groupBy("l_orderkey", "l_partkey").agg(F.lit(1))
    return rows.select(
        F.concat(F.lit("img_"), (F.col("l_orderkey") * 9 % 7 * 100 + F.col("l_orderkey")).cast("string"), ext).alias("key"),
        (F.col("l_orderkey") * 1000000 + F.col("l_partkey")).alias("pos"),
    )


def named_images(t: Tables) -> DataFrame:
    """Images whose names repeat and share stems."""
    i = F.col("image_id")
    name = F.when(i % 10 == 0, F.concat(F.lit("img_"), (i + 1).cast("string"), F.lit(".png"))).when(
        i % 10 == 5, F.concat(F.lit("img_"), (i + 1).cast("string"), F.lit(".jpg"))
    )
    return t.images.select("image_id", F.coalesce(name, F.col("filename")).alias("filename"))


FILES = """named AS MATERIALIZED (SELECT image_id, CASE image_id % 10 WHEN 0 THEN 'img_' || (image_id + 1) || '.png'
    WHEN 5 THEN 'img_' || (image_id + 1) || '.jpg' ELSE filename END AS filename FROM images),
  files AS MATERIALIZED (SELECT 'img_' || (l_orderkey * 9 % 7 * 100 + l_orderkey) || (['.jpg', '.txt', '.xml'])[(l_partkey % 3)::INT + 1] AS key,
    l_orderkey * 1000000 + l_partkey AS pos FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)),
  nm AS (SELECT filename, count(*) AS c, min(image_id) AS id FROM named GROUP BY 1),
  st AS (SELECT split_part(filename, '.', 1) AS stem, count(*) AS names, arg_min(filename, filename) AS f FROM nm GROUP BY 1),
  hit AS MATERIALIZED (SELECT f.key, f.pos, CASE WHEN n.filename IS NULL AND s.names > 1 THEN 'ambiguous'
      WHEN coalesce(n.c, n2.c) > 1 THEN 'duplicate' WHEN coalesce(n.id, n2.id) IS NULL THEN 'unmatched' END AS status,
      coalesce(n.id, n2.id) AS id FROM files f LEFT JOIN nm n ON n.filename = f.key
    LEFT JOIN st s ON s.stem = split_part(f.key, '.', 1) LEFT JOIN nm n2 ON n2.filename = s.f)"""


@query(
    "J1_label_files_to_images",
    sql(
        """SELECT key, pos, status, CASE WHEN status IN ('matched', 'second') THEN id END AS image_id FROM (
        SELECT key, pos, id, coalesce(status, CASE WHEN row_number() OVER (PARTITION BY id, status IS NULL ORDER BY pos) = 1
          THEN 'matched' ELSE 'second' END) AS status FROM hit)""",
        "images",
        more=FILES,
    ),
)
def label_files_to_images(t: Tables) -> DataFrame:
    return names.match_files(label_keys(t), named_images(t))


@query(
    "J14_missing_classes",
    sql(
        f"""SELECT name, arg_min({TYPED}, ann_id) AS type FROM gt WHERE name NOT IN ('class_1', 'class_2') GROUP BY 1""",
        "gt",
    ),
)
def missing_classes(t: Tables) -> DataFrame:
    declared = t.gt.where("name in ('class_1', 'class_2')").select("name").distinct()
    return names.missing_classes(typed(t).withColumn("pos", F.col("ann_id")), declared)


def collision_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Images moving into a folder that already holds some of their names and numbered forms."""
    i = F.col("image_id")
    moving = t.images.where("image_id % 4 <> 0").select(
        "image_id", F.concat(F.lit("p"), (i % 50).cast("string"), F.lit(".jpg")).alias("filename"), i.alias("pos")
    )
    target = t.images.where("image_id % 4 = 0").select(
        F.concat(
            F.lit("p"), (i % 40).cast("string"), F.when(i % 3 > 0, F.concat(F.lit("-"), (i % 13).cast("string"))).otherwise(F.lit("")),
            F.lit(".jpg"),
        ).alias("filename")
    )
    return moving, target


COLLIDE = """moving AS MATERIALIZED (SELECT image_id, 'p' || (image_id % 50) || '.jpg' AS filename, image_id AS pos FROM images
    WHERE image_id % 4 <> 0),
  held AS MATERIALIZED (SELECT DISTINCT 'p' || (image_id % 40) || CASE WHEN image_id % 3 > 0 THEN '-' || (image_id % 13) ELSE '' END
    || '.jpg' AS filename FROM images WHERE image_id % 4 = 0),
  judged AS MATERIALIZED (SELECT *, filename IN (SELECT filename FROM held) OR
    pos > min(pos) OVER (PARTITION BY filename) AS clash FROM moving)"""


@query(
    "W8_collision_suffixes",
    sql(
        """SELECT image_id, filename, filename AS new_name, 'kept' AS status FROM judged WHERE NOT clash UNION ALL
        SELECT c.image_id, c.filename, f.new_name, 'renamed' FROM (SELECT *, row_number() OVER (PARTITION BY filename
          ORDER BY pos) AS k FROM judged WHERE clash) c JOIN free f ON f.base = c.filename AND f.k = c.k""",
        "images",
        more=COLLIDE
        + """, free AS (SELECT base, new_name, row_number() OVER (PARTITION BY base ORDER BY n) AS k FROM (
            SELECT b.filename AS base, n, replace(b.filename, '.jpg', '-' || n || '.jpg') AS new_name
            FROM (SELECT filename, count(*) AS c FROM judged WHERE clash GROUP BY 1) b, range(1, 20000) r(n)
            WHERE n <= b.c + 20) WHERE new_name NOT IN (SELECT filename FROM held)
            AND new_name NOT IN (SELECT filename FROM judged WHERE NOT clash))""",
    ),
)
def collision_suffixes(t: Tables) -> DataFrame:
    return names.place_images(*collision_tables(t))


@query(
    "J16_name_collisions",
    sql(
        """SELECT image_id, filename, CASE WHEN NOT clash THEN filename END AS new_name,
        CASE WHEN clash THEN 'failed' ELSE 'kept' END AS status FROM judged""",
        "images",
        more=COLLIDE,
    ),
)
def name_collisions(t: Tables) -> DataFrame:
    return names.place_images(*collision_tables(t), mode="skip")


@query(
    "S13_rows_not_yet_held",
    sql(
        """SELECT n.image_id, h.image_id IS NOT NULL AS skipped FROM images n LEFT JOIN (SELECT * FROM images
        WHERE image_id % 3 = 0) h ON h.dataset_id = n.dataset_id AND h.directory = n.directory AND h.filename = n.filename""",
        "images",
    ),
)
def rows_not_yet_held(t: Tables) -> DataFrame:
    new, skipped = images.not_yet_held(t.images, t.images.where("image_id % 3 = 0"))
    return new.select("image_id", F.lit(False).alias("skipped")).unionAll(skipped.select("image_id", F.lit(True)))


@query(
    "S14_bulk_registered",
    sql(
        """SELECT image_id, CASE WHEN o THEN 'already held' WHEN pos > min(pos) OVER (PARTITION BY dataset_id, directory, name)
        THEN 'repeated in the call' END AS reason FROM (SELECT image_id, image_id AS pos, dataset_id, directory,
          'p' || (image_id % 30) AS name, EXISTS (SELECT 1 FROM images h WHERE h.image_id % 15 = 0
            AND h.dataset_id = i.dataset_id AND h.directory = i.directory AND h.image_id % 30 = i.image_id % 30) AS o
          FROM images i)""",
        "images",
    ),
)
def bulk_registered(t: Tables) -> DataFrame:
    rows = t.images.withColumns({"filename": F.expr("concat('p', image_id % 30)"), "pos": F.col("image_id")})
    good, bad = images.bulk_register(rows, rows.where("image_id % 15 = 0"))
    return good.select("image_id", F.lit(None).cast("string").alias("reason")).unionAll(bad.select("image_id", "reason"))


@query(
    "A28_import_report",
    sql(
        """SELECT count(*) AS attempted, count(*) FILTER (status = 'matched') AS written,
        count(*) FILTER (status = 'unmatched') AS skipped, count(*) FILTER (status NOT IN ('matched', 'unmatched')) AS failed
        FROM (SELECT coalesce(status, CASE WHEN row_number() OVER (PARTITION BY id, status IS NULL ORDER BY pos) = 1
          THEN 'matched' ELSE 'second' END) AS status FROM hit)""",
        "images",
        more=FILES,
    ),
)
def import_report(t: Tables) -> DataFrame:
    status = F.col("status")
    outcome = F.when(status == "matched", "written").when(status == "unmatched", "skipped").otherwise("failed")
    return insights.outcome_report(names.match_files(label_keys(t), named_images(t)).select(outcome.alias("outcome")))


@query(
    "S27_copied_dataset",
    sql(
        """SELECT g.ann_id, g.name, i.image_id + 1000000 AS image_id, i.split, i.status FROM gt g JOIN images i USING (image_id)
        WHERE i.dataset_id = 3""",
        "gt",
        "images",
    ),
)
def copied_dataset(t: Tables) -> DataFrame:
    from annoframe.sinks.copy import copy_dataset

    rows, anns, _ = copy_dataset(
        t.images.where("dataset_id = 3"), t.gt, t.gt.select("name").distinct(), t.gt.select("name").limit(0),
        into=99, new_id=F.col("image_id") + 1000000,
    )
    return anns.join(rows.select("image_id", "split", "status"), "image_id").select(
        "ann_id", "name", "image_id", "split", "status"
    )


# --- text, clocks and prices ----------------------------------------------------------------------


@query(
    "X38_image_addresses",
    sql(
        """SELECT image_id, trim(directory, '/') || '/' || filename AS address, '/' || trim(directory, '/') AS folder,
        split_part(directory, '/', 2) AS org, split_part(directory, '/', 3) AS name FROM images""",
        "images",
    ),
)
def image_addresses(t: Tables) -> DataFrame:
    org, name = text.split_ref(text.trim_slashes(F.col("directory")))
    return t.images.select(
        "image_id",
        text.image_address(F.concat(F.col("directory"), F.lit("/")), F.col("filename")).alias("address"),
        text.canonical_directory(F.concat(F.lit(" "), F.col("directory"), F.lit("/ "))).alias("folder"),
        org.alias("org"),
        name.alias("name"),
    )


@query(
    "X39_content_types",
    sql(
        """SELECT type, count(*) AS n FROM (SELECT CASE image_id % 4 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png'
        WHEN 2 THEN 'image/tiff' ELSE 'application/octet-stream' END AS type FROM images) GROUP BY 1""",
        "images",
    ),
)
def content_types(t: Tables) -> DataFrame:
    ext = F.element_at(F.array(*map(F.lit, (".JPG", ".png", ".Tif", ".heics"))), (F.col("image_id") % 4).cast("int") + 1)
    kind = text.content_type(F.concat(F.lit("a.b"), ext))
    return t.images.groupBy(kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "X40_track_ids",
    sql("SELECT event_id, try_cast(CASE WHEN k % 3 = 0 THEN 'x' || k ELSE k::VARCHAR END AS BIGINT) AS track FROM (SELECT event_id, (props->>'$.k')::INT AS k FROM events)"),
)
def track_ids(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    raw = F.when(k.cast("int") % 3 == 0, F.concat(F.lit("x"), k)).otherwise(k)
    return t.raw("events").select("event_id", text.track_id(F.create_map(F.lit("track_id"), raw)).alias("track"))


@query(
    "X41_record_identities",
    sql(
        """SELECT identity AS event_id, CASE WHEN identity % 4 = 3 THEN 1 ELSE 7 END AS parts,
        CASE WHEN identity % 4 < 3 THEN session::VARCHAR END AS second FROM log WHERE identity % 4 <> 2
        UNION ALL SELECT identity, 1, NULL FROM log WHERE identity % 4 = 2""",
        "log",
    ),
)
def record_identities(t: Tables) -> DataFrame:
    """Cursors: url-safe base64 of a JSON list, of a list too short, or no base64 at all."""
    i = F.col("identity")
    long_list = F.concat(F.lit('["w",'), F.col("session").cast("string"), F.lit(',3,4,5,6,"?>~",8]'))
    body = F.when(i % 4 == 2, F.lit('["w", 1]')).otherwise(long_list)
    cursor = F.translate(F.base64(F.encode(body, "utf-8")), "+/=", "-_")
    cursor = F.when(i % 4 == 3, F.lit("!!not a cursor!!")).otherwise(cursor)
    rows = t.log.select(i.alias("event_id"), text.record_identity(cursor).alias("key"))
    return rows.select("event_id", F.size("key").alias("parts"), F.when(F.size("key") > 1, F.get("key", F.lit(1))).alias("second"))


@query(
    "X42_capture_clock",
    sql(
        """SELECT identity, CASE WHEN identity % 10 > 0 THEN epoch_us(time) // 1000 END AS capture_ms,
        CASE WHEN identity % 10 > 0 THEN 5.5 END::DOUBLE AS latency_ms FROM log""",
        "log",
    ),
)
def capture_clock(t: Tables) -> DataFrame:
    ns = F.when(F.col("identity") % 10 > 0, F.unix_micros("time") * 1000 + 7).otherwise(F.lit(0))
    return t.log.select(
        "identity",
        F.unix_millis(text.capture_time(ns)).alias("capture_ms"),
        text.capture_latency_ms(ns + 5500000, ns).alias("latency_ms"),
    )


@query(
    "X43_prices",
    sql(
        """SELECT id, (abs(amount) // 1000000)::BIGINT AS dollars, abs(amount) % 1000000 AS micros, abs(amount) * 3 AS total,
        abs(amount) * 3 <= 5000000000 AS sufficient FROM ledger""",
        "ledger",
    ),
)
def prices(t: Tables) -> DataFrame:
    price = F.abs("amount")
    shown = text.usd(price)
    return t.ledger.select(
        "id",
        F.floor(shown).cast("bigint").alias("dollars"),
        ((shown - F.floor(shown)) * 1000000).cast("bigint").alias("micros"),
        (price * 3).alias("total"),
        (price * 3 <= 5000000000).alias("sufficient"),
    )


@query(
    "X44_frame_counts",
    sql("SELECT identity, floor(latency_ms * 30)::BIGINT AS frames FROM log", "log"),
)
def frame_counts(t: Tables) -> DataFrame:
    return t.log.select("identity", text.frame_count(F.col("latency_ms"), F.lit(30.0)).alias("frames"))


@query(
    "S17_sampled_frames",
    sql(
        """SELECT session, frame, round(frame / 30.0::DOUBLE, 9) AS media_time FROM log
        WHERE frame % greatest(1, round_even(30.0::DOUBLE / greatest(session % 7 * 2, 0.01), 0)::BIGINT) = 0""",
        "log",
    ),
)
def sampled_frames(t: Tables) -> DataFrame:
    stride = text.frame_stride(F.lit(30.0), (F.col("session") % 7 * 2).cast("double"))
    return t.log.where(F.col("frame") % stride == 0).select(
        "session", "frame", F.round(F.col("frame") / 30.0, 9).alias("media_time")
    )
