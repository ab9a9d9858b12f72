"""Copying a dataset's rows into another dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def copy_dataset(
    images: DataFrame, annotations: DataFrame, classes: DataFrame, held_classes: DataFrame, into: int, new_id: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(image rows, annotation rows, classes the target lacks)`` under new image ids."""
    ids = images.select("image_id", new_id.alias("_new"))
    rows = images.withColumn("image_id", new_id).withColumn("dataset_id", F.lit(into))
    anns = annotations.join(ids, "image_id").withColumn("image_id", F.col("_new")).drop("_new")
    return rows, anns, classes.join(held_classes.select("name"), "name", "left_anti")
