"""Pascal VOC, canonical JSON and image-folder sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoframe.functions.geometry import box
from annoframe.functions.text import IMAGE_SUFFIXES, base_name, suffix
from annoframe.schemas import CANONICAL, VOC


def voc_image_names(files: DataFrame) -> DataFrame:
    """``path, image_name``: the image each document names, null when it names none."""
    doc = files.select("path", F.from_xml("text", VOC, {"mode": "PERMISSIVE"}).alias("d"))
    return doc.select("path", F.nullif(F.trim("d.filename"), F.lit("")).alias("image_name"))


def from_voc(files: DataFrame) -> DataFrame:
    """``path, image_name, pos, name, bbox`` of ``path, text`` rows of VOC XML.

    An object needs a name and a box of positive area; a document that is no XML gives no row.
    """
    doc = files.select("path", F.from_xml("text", VOC, {"mode": "PERMISSIVE"}).alias("d"))
    rows = doc.select("path", F.nullif(F.trim("d.filename"), F.lit("")).alias("image_name"), F.posexplode("d.object").alias("pos", "o"))
    b = F.col("o.bndbox")
    w, h = b["xmax"] - b["xmin"], b["ymax"] - b["ymin"]
    named = rows.where((F.trim("o.name") != "") & (w > 0) & (h > 0))
    return named.select("path", "image_name", "pos", F.trim("o.name").alias("name"), box(b["xmin"], b["ymin"], w, h).alias("bbox"))


FIELDS = (
    "id", "name", "type", "bounding_box", "oriented_box", "polygon", "polyline", "keypoint", "instance_id", "confidence",
    "created_by", "attributes",
)


def judged_canonical(rows: DataFrame, column: str = "json") -> DataFrame:
    """``rows`` with the parsed object ``a`` and the ``reason`` to reject it, null for a valid one, in one pass."""
    text = F.col(column)
    old_list = F.startswith(F.ltrim(F.get_json_object(text, "$.attributes")), F.lit("["))
    a = F.from_json(F.when(old_list, F.regexp_replace(text, r'"attributes"\s*:\s*\[[^\]]*\]', '"attributes":{}')).otherwise(text), CANONICAL)
    # The generator keeps the parse a step of its own: inlined, every check below would parse again.
    parsed = F.explode(F.array(F.struct(a.alias("a"), F.json_object_keys(text).alias("keys"))))
    read = rows.withColumn("_p", parsed).withColumns({"a": F.col("_p.a"), "_keys": F.col("_p.keys")}).drop("_p")
    v = F.col("a")
    kind = v["type"]
    short = lambda r: F.size(r) < 3
    box_ok = lambda b: b.isNull() | ((b["w"] > 0) & (b["h"] > 0))
    reason = (
        F.when(F.col("_keys").isNull(), F.lit("not an object"))
        .when(F.size(F.array_except("_keys", F.array(*map(F.lit, FIELDS)))) > 0, F.lit("unknown field"))
        .when(F.coalesce(F.trim(v["name"]), F.lit("")) == "", F.lit("blank name"))
        .when(~F.coalesce(kind.isin("bbox", "polygon", "polyline", "keypoint"), F.lit(False)), F.lit("unknown type"))
        .when(~F.coalesce(v["confidence"], F.lit(1.0)).between(0.0, 1.0), F.lit("confidence outside 0..1"))
        .when(~box_ok(v["bounding_box"]) | ~box_ok(v["oriented_box"]), F.lit("box without extent"))
        .when((kind == "bbox") & v["bounding_box"].isNull(), F.lit("no box"))
        .when((kind != "bbox") & v["oriented_box"].isNotNull(), F.lit("rotated box beside no box"))
        .when((kind == "polygon") & (F.coalesce(F.size(v["polygon"]["paths"]), F.lit(0)) < 1), F.lit("no ring"))
        .when((kind == "polygon") & F.exists(v["polygon"]["paths"], short), F.lit("ring under three points"))
        .when((kind == "polyline") & (F.coalesce(F.size(v["polyline"]["path"]), F.lit(0)) < 2), F.lit("path under two points"))
        .when((kind == "keypoint") & (v["keypoint"]["x"].isNull() | v["keypoint"]["y"].isNull()), F.lit("no point"))
        .when((kind == "keypoint") & v["bounding_box"].isNotNull(), F.lit("a keypoint has no box"))
        .when(v["instance_id"] < 1, F.lit("instance id under 1"))
    )
    return read.withColumn("reason", reason)


def from_canonical(rows: DataFrame, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """``(valid annotation rows, rejected rows with reason)``; unknown fields are errors.

    Other columns of ``rows`` are carried. An attribute list (the old form) reads as no attributes.
    """
    judged = judged_canonical(rows, column)
    carried = [c for c in rows.columns if c != column]
    good = judged.where("reason is null").select(
        *carried,
        F.col("a.id").alias("ann_id"), "a.name", "a.type", F.col("a.bounding_box").alias("bbox"), F.col("a.oriented_box").alias("obb"),
        F.col("a.polygon.paths").alias("rings"), F.col("a.polyline.path").alias("path"), F.col("a.keypoint").alias("point"),
        "a.instance_id", F.coalesce("a.confidence", F.lit(1.0)).alias("confidence"), "a.created_by",
        F.coalesce("a.attributes", F.create_map().cast("map<string,string>")).alias("attributes"),
    )
    return good, judged.where("reason is not null").select(*carried, column, "reason")


def virtual_directory(relative, preserve_structure: bool = False, organize_by_class: bool = True):
    """The folder of a file below the root: the whole chain, its first level, or the root."""
    chain = F.regexp_replace(F.regexp_replace(relative, "^/+", ""), "/?[^/]*$", "")
    if preserve_structure:
        return F.concat(F.lit("/"), chain)
    if organize_by_class:
        return F.concat(F.lit("/"), F.split_part(chain, F.lit("/"), F.lit(1)))
    return F.lit("/")


def image_rows(files: DataFrame, root: str, **layout: bool) -> DataFrame:
    """Image files ``path, length`` as rows; other suffixes are ignored."""
    relative = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    return files.where(suffix(F.col("path")).isin(*IMAGE_SUFFIXES)).select(
        "path", base_name(F.col("path")).alias("filename"), virtual_directory(relative, **layout).alias("directory"), F.col("length").alias("file_size")
    )


def read_image_folder(spark: SparkSession, root: str, **layout: bool) -> DataFrame:
    """The images under a folder. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return image_rows(files.select("path", "length"), root, **layout)


def read_pixels(spark: SparkSession, root: str) -> DataFrame:
    """Decoded pixels by Spark's image source."""
    return spark.read.format("image").option("recursiveFileLookup", True).load(root).select("image.*")
