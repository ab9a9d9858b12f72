"""COCO files to annotation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoframe.functions.geometry import box, enclosing_box
from annoframe.functions.keypoints import any_placed, expand_triplets, rings_from_flat, template_edges
from annoframe.operators.poses import number_objects
from annoframe.schemas import BOX, COCO, COCO_ANNOTATION, OBB, POINT, RING
from annoframe.scale import global_rank
from annoframe.session import kept


def read_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(images, categories, annotations)`` of whole COCO files. One file is one task: for large sets
    write the annotations as JSON lines and use ``read_coco_lines``."""
    whole = spark.read.schema(COCO).option("multiLine", True).json(path)
    return (
        whole.select(F.inline("images")),
        whole.select(F.inline("categories")),
        whole.select(F.posexplode("annotations").alias("pos", "a")).select(F.col("pos").cast("bigint").alias("pos"), "a.*"),
    )


def read_coco_lines(spark: SparkSession, path: str) -> DataFrame:
    """Annotations from JSON lines, which split; ``pos`` is part of each line."""
    rows = spark.read.schema(f"pos bigint, a {COCO_ANNOTATION}").json(path)
    return rows.select("pos", "a.*")


def _joined(images: DataFrame, categories: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotations of known images and categories; the rest is left out."""
    files = images.select(F.col("id").alias("image_id"), "file_name")
    classes = categories.select(F.col("id").alias("category_id"), "name", F.col("keypoints").alias("joints"))
    rows = annotations.join(files, "image_id").join(classes, "category_id")
    seg = F.col("segmentation")
    return rows.withColumns(
        {
            "confidence": F.coalesce("score", F.lit(1.0)),
            "flat": F.when(seg.startswith("["), F.from_json(seg, "array<array<double>>")),
            "rle": F.when(seg.startswith("{"), F.from_json(seg, "size array<int>, counts string")),
            "posed": any_placed(F.col("keypoints")),
        }
    )


def from_coco(images: DataFrame, categories: DataFrame, annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(annotation rows, unconverted masks)``.

    Placed keypoints win over a segmentation, which wins over the box. A polygon without a usable ring
    falls back to the box. A run-length mask is listed, never boxed; its runs go to the run table.
    """
    rows = _joined(images, categories, annotations)
    masked = ~F.col("posed") & F.col("rle.counts").isNotNull() & F.col("rle.size").isNotNull()
    unconverted = rows.where(masked).select("file_name", F.col("id").alias("ann_id"), "name", "rle")
    rest = rows.where(~F.coalesce(masked, F.lit(False)))

    joints = expand_triplets(F.col("keypoints"), F.col("joints"), F.col("name"), F.col("attributes"))
    # Sizes, ids and points read these, so the text is parsed once for them.
    posed = kept(rest.where("posed").select("file_name", "pos", "id", "name", "confidence", "attributes", joints.alias("joint")))
    ids = number_objects(
        posed.where(F.size("joint") > 0).select("file_name", "pos", F.element_at("joint", 1)["lone"].alias("lone"))
    )
    points = (
        posed.join(ids.select("file_name", "pos", "instance_id"), ["file_name", "pos"])
        .select("file_name", "pos", "id", "confidence", "instance_id", F.inline("joint"))
        .select(
            "file_name",
            F.when(F.col("id").isNotNull(), F.concat_ws("-", "id", "idx")).alias("ann_id"),
            "pos",
            "name",
            F.lit("keypoint").alias("type"),
            F.lit(None).cast(BOX).alias("bbox"),
            F.lit(None).cast(f"array<{RING}>").alias("rings"),
            F.col("point").cast(POINT).alias("point"),
            F.col("instance_id").cast("int").alias("instance_id"),
            "confidence",
            "attributes",
        )
    )
    b = F.col("bbox")
    shaped = rest.where(~F.col("posed")).withColumn("rings", rings_from_flat(F.col("flat"))).withColumn(
        "bbox",
        F.when(F.col("rings").isNotNull(), enclosing_box(F.flatten("rings"))).when(
            (F.size(b) == 4) & (b[2] > 0) & (b[3] > 0), box(b[0], b[1], b[2], b[3])
        ),
    )
    shapes = shaped.where("rings is not null or bbox is not null").select(
        "file_name",
        F.col("id").alias("ann_id"),
        "pos",
        "name",
        F.when(F.col("rings").isNotNull(), F.lit("polygon")).otherwise(F.lit("bbox")).alias("type"),
        F.col("bbox").cast(BOX).alias("bbox"),
        F.col("rings").cast(f"array<{RING}>").alias("rings"),
        F.lit(None).cast(POINT).alias("point"),
        F.lit(None).cast("int").alias("instance_id"),
        "confidence",
        F.coalesce("attributes", F.create_map().cast("map<string,string>")).alias("attributes"),
    )
    out = shapes.unionByName(points)
    return out.withColumns({"obb": F.lit(None).cast(OBB), "path": F.lit(None).cast(RING)}), unconverted


def class_list(categories: DataFrame) -> DataFrame:
    """``name, place``: categories by id, each pose category followed by its joints not listed before.

    Places are ranks over ranges of ids, so that no task holds the whole list.
    """
    many = F.size("keypoints") > 1
    own = categories.select("id", F.lit(-1).alias("slot"), "name", F.lit(True).alias("category"))
    joints = categories.where(many).select("id", F.posexplode("keypoints").alias("slot", "name"), F.lit(False).alias("category"))
    listed = own.unionByName(joints)
    first = listed.groupBy("name").agg(F.min(F.struct("id", "slot")).alias("f"))
    kept = listed.join(first, "name").where(F.col("category") | ((F.col("f.id") == F.col("id")) & (F.col("f.slot") == F.col("slot"))))
    ranked = global_rank(kept.select("name", "id", "slot"), [F.col("id").asc(), F.col("slot").asc()], "rank")
    return ranked.select("name", (F.col("rank") - 1).cast("int").alias("place"))


def pose_templates(categories: DataFrame) -> DataFrame:
    """S3: class, joints and 0-indexed edges of categories with more than one joint."""
    return categories.where(F.size("keypoints") > 1).select(
        F.col("name").alias("class"),
        F.col("keypoints").alias("joints"),
        template_edges(F.coalesce("skeleton", F.array().cast("array<array<int>>")), F.col("keypoints"), base=1).alias("edges"),
    )
