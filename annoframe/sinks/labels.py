"""Annotation rows to label lines and files: YOLO, VOC, rotated boxes, poses."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from annoframe.functions.geometry import annotation_box, flatten_ring, rotated_corners
from annoframe.functions.text import stem


@F.pandas_udf(StringType())
def six_digits(values: pd.Series) -> pd.Series:
    """Numbers with six decimals, rounded from their exact binary value, joined by blanks."""
    return values.map(lambda row: " ".join(f"{v:.6f}" for v in row))


def _numbered(annotations: DataFrame, classes: DataFrame) -> DataFrame:
    """Boxes and polygons with their class number; a class not in the list is an error."""
    rows = annotations.where(F.col("type").isin("bbox", "polygon")).join(F.broadcast(classes.select("idx", "name")), "name", "left")
    missing = F.raise_error(F.concat(F.lit("class not in the class list: "), F.col("name")))
    return rows.withColumn("idx", F.when(F.col("idx").isNull(), missing).otherwise(F.col("idx")))


def _box() -> Column:
    return annotation_box(F.col("type"), F.col("bbox"), F.col("rings"), F.col("path"))


def to_yolo(annotations: DataFrame, classes: DataFrame, images: DataFrame, segmentation: bool = False) -> DataFrame:
    """``image_id, pos, line``; with ``segmentation`` a polygon is its first ring, else its box."""
    rows = _numbered(annotations, classes).join(images.select("image_id", "width", "height"), "image_id")
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    b = F.col("_b")
    boxed = F.array((b["x"] + b["w"] / 2) / w, (b["y"] + b["h"] / 2) / h, b["w"] / w, b["h"] / h)
    values = boxed
    if segmentation:
        ring = F.transform(flatten_ring(F.get("rings", F.lit(0))), lambda v, i: v / F.when(i % 2 == 0, w).otherwise(h))
        values = F.when(F.col("type") == "polygon", ring).otherwise(boxed)
    out = rows.withColumn("_b", _box()).where((F.col("type") == "polygon") & F.lit(segmentation) | F.col("_b").isNotNull())
    return out.select("image_id", "pos", F.concat_ws(" ", F.col("idx").cast("string"), six_digits(values)).alias("line"))


def to_yolo_obb(annotations: DataFrame, classes: DataFrame, images: DataFrame) -> DataFrame:
    """Class number and four corner pairs in shares of the image, cut to it."""
    rows = _numbered(annotations.where("obb is not null"), classes).join(images.select("image_id", "width", "height"), "image_id")
    w, h = F.col("width").cast("double"), F.col("height").cast("double")
    shares = F.transform(
        flatten_ring(rotated_corners(F.col("obb"))),
        lambda v, i: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / F.when(i % 2 == 0, w).otherwise(h))),
    )
    return rows.select("image_id", "pos", F.concat_ws(" ", F.col("idx").cast("string"), six_digits(shares)).alias("line"))


def to_dota(annotations: DataFrame) -> DataFrame:
    """Four corner pairs in pixels, class name and a zero difficulty."""
    corners = flatten_ring(rotated_corners(F.col("obb")))
    return annotations.where("obb is not null").select(
        "image_id", "pos", F.concat_ws(" ", six_digits(corners), F.col("name"), F.lit("0")).alias("line")
    )


def to_yolo_pose(entries: DataFrame, classes: DataFrame, images: DataFrame) -> DataFrame:
    """Class number, box and joint triplets in shares of the image.

    ``entries`` carries ``image_id, pos, name, bbox, keypoints``.
    """
    rows = entries.join(F.broadcast(classes.select("idx", "name")), "name").join(images.select("image_id", "width", "height"), "image_id")
    w, h, b = F.col("width").cast("double"), F.col("height").cast("double"), F.col("bbox")
    boxed = F.array((b["x"] + b["w"] / 2) / w, (b["y"] + b["h"] / 2) / h, b["w"] / w, b["h"] / h)
    joints = F.transform("keypoints", lambda v, i: v / F.when(i % 3 == 0, w).when(i % 3 == 1, h).otherwise(F.lit(1.0)))
    return rows.select(
        "image_id", "pos", F.concat_ws(" ", F.col("idx").cast("string"), six_digits(F.concat(boxed, joints))).alias("line")
    )


def to_voc(annotations: DataFrame) -> DataFrame:
    """``image_id, pos, line``: one ``<object>`` element per box or polygon, corners to whole pixels."""
    b = F.col("_b")
    rows = annotations.where(F.col("type").isin("bbox", "polygon")).withColumn("_b", _box()).where("_b is not null")
    whole = lambda v: F.bround(v).cast("bigint")
    entry = F.struct(
        "name", F.lit("Unspecified").alias("pose"), F.lit(0).alias("truncated"), F.lit(0).alias("difficult"),
        F.struct(
            whole(b["x"]).alias("xmin"), whole(b["y"]).alias("ymin"), whole(b["x"] + b["w"]).alias("xmax"), whole(b["y"] + b["h"]).alias("ymax")
        ).alias("bndbox"),
    )
    return rows.select("image_id", "pos", F.to_xml(entry, {"rowTag": "object", "declaration": ""}).alias("line"))


def voc_heads(images: DataFrame, depth: int = 3) -> DataFrame:
    """What stands before the objects: folder, file name and size."""
    size = F.struct("width", "height", F.lit(depth).alias("depth"))
    text = F.concat(
        F.lit("<annotation>"), _element("directory"), _element("filename"), F.to_xml(size, {"rowTag": "size", "declaration": ""})
    )
    return images.select("image_id", text.alias("head"))


def _element(name: str) -> Column:
    safe = F.replace(F.replace(F.replace(F.col(name), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit(f"<{name}>"), F.coalesce(safe, F.lit("")), F.lit(f"</{name}>"))


def write_label_files(lines: DataFrame, images: DataFrame, folder: str, suffix: str) -> None:
    """One text file per image with its lines in order, written as the sorted rows stream by.

    ``folder`` is shared by all executors: a path or any address that pyarrow's file systems know. A file is written
    beside its name and renamed, so a lost task leaves none half written and a repeated one gives the same files.
    """
    ready = (
        lines.join(images.select("image_id", stem(F.col("filename")).alias("_stem")), "image_id")
        .repartition("image_id")
        .sortWithinPartitions("image_id", "pos")
        .select("_stem", "line")
    )

    def write(rows: Iterator) -> None:
        system, home = fs.FileSystem.from_uri(folder)
        system.create_dir(home, recursive=True)
        for name, group in itertools.groupby(rows, key=lambda r: r["_stem"]):
            path, beside = f"{home}/{name}{suffix}", f"{home}/.{name}{suffix}.{uuid.uuid4().hex}"
            with system.open_output_stream(beside) as out:
                for i, row in enumerate(group):
                    out.write((("\n" if i else "") + row["line"]).encode())
            system.move(beside, path)

    ready.foreachPartition(write)
