"""Canonical exports, split folders, manifests and training targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(annotations: DataFrame) -> DataFrame:
    """``image_id, json``: each annotation as its stored object, absent fields left out."""
    kind = F.col("type")
    fields = F.struct(
        F.col("ann_id").cast("string").alias("id"),
        "name",
        "type",
        F.when(kind != "keypoint", F.col("bbox")).alias("bounding_box"),
        F.when(F.col("obb").isNotNull(), F.col("obb")).alias("oriented_box"),
        F.when(kind == "polygon", F.struct(F.col("rings").alias("paths"))).alias("polygon"),
        F.when(kind == "polyline", F.struct("path")).alias("polyline"),
        F.col("point").alias("keypoint"),
        "instance_id",
        "confidence",
        "attributes",
    )
    return annotations.select("image_id", F.to_json(fields).alias("json"))


def canonical_csv(annotations: DataFrame) -> DataFrame:
    """One flat row per annotation."""
    b = F.col("bbox")
    return annotations.select(
        "image_id", "ann_id", "name", "type", *[b[c].alias(c) for c in "xywh"], "confidence", F.to_json("attributes").alias("attributes")
    )


def export_split(split: Column) -> Column:
    """The folder of a split: train, valid or test; no split goes to train."""
    return F.when(split == "val", F.lit("valid")).otherwise(F.coalesce(split, F.lit("train")))


def export_rows(
    images: DataFrame, annotations: DataFrame, class_filter: Sequence[str] = (), status_filter: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of an export; empty filters mean everything."""
    kept = images.where(F.col("status").isin(*status_filter)) if status_filter else images
    kept = kept.withColumn("split", export_split(F.col("split")))
    anns = annotations.where(F.col("name").isin(*class_filter)) if class_filter else annotations
    return kept, anns.join(kept.select("image_id", "split"), "image_id")


def write_by_split(rows: DataFrame, path: str, fmt: str = "json") -> None:
    """One folder per split."""
    rows.write.mode("overwrite").partitionBy("split").format(fmt).save(path)


def manifest(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Image and annotation counts of an export per split."""
    n, zero = F.count(F.lit(1)), F.lit(0).cast("bigint")
    parts = images.groupBy("split").agg(n.alias("i")).select("split", "i", zero.alias("a")).unionAll(
        annotations.groupBy("split").agg(n.alias("a")).select("split", zero, "a")
    )
    return parts.groupBy("split").agg(F.sum("i").alias("images"), F.sum("a").alias("annotations"))


def detection_targets(annotations: DataFrame, classes: DataFrame) -> DataFrame:
    """Corners, label number, area and iscrowd per annotation of a known class.

    A keypoint is a zero-size box here; a flat polygon keeps its zero-size enclosure.
    """
    points = F.when(F.col("type") == "polygon", F.flatten("rings")).when(F.col("type") == "polyline", F.col("path")).otherwise(
        F.array("point")
    )
    rows = annotations.join(F.broadcast(classes.select("idx", "name")), "name").withColumn("_p", points)
    b, p = F.col("bbox"), F.col("_p")
    x1 = F.coalesce(b["x"], F.array_min(p["x"]))
    y1 = F.coalesce(b["y"], F.array_min(p["y"]))
    x2 = F.coalesce(b["x"] + b["w"], F.array_max(p["x"]))
    y2 = F.coalesce(b["y"] + b["h"], F.array_max(p["y"]))
    out = rows.select("image_id", "ann_id", F.col("idx").alias("label"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return out.where("x1 is not null").withColumns(
        {"area": (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")), "iscrowd": F.lit(0)}
    )
