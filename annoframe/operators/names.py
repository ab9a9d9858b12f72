"""Matching and resolving names: label files to images (J1), missing classes (J14), collisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions.text import stem
from annoframe.scale import running_sums


def match_files(files: DataFrame, images: DataFrame) -> DataFrame:
    """``key, pos, image_id, status`` for every label file.

    An exact image name wins, else the stem when one image name has it. ``status`` is ``matched``,
    ``unmatched``, ``ambiguous`` (several image names share the stem), ``duplicate`` (several images
    share the name) or ``second`` (an earlier file already took the image). All name groups are
    aggregated before they are joined.
    """
    by_name = images.groupBy("filename").agg(F.count(F.lit(1)).alias("same_name"), F.min("image_id").alias("image_id"))
    by_stem = (
        by_name.groupBy(stem(F.col("filename")).alias("stem"))
        .agg(F.count(F.lit(1)).alias("names"), F.min_by("image_id", "filename").alias("stem_image"),
             F.min_by("same_name", "filename").alias("stem_same"))
    )
    found = (
        files.withColumn("stem", stem(F.col("key")))
        .join(by_name.withColumnRenamed("filename", "key"), "key", "left")
        .join(by_stem, "stem", "left")
        .select(
            "key",
            "pos",
            F.coalesce("image_id", F.when(F.col("names") == 1, F.col("stem_image"))).alias("image_id"),
            F.when(F.col("image_id").isNull() & (F.col("names") > 1), F.lit("ambiguous"))
            .when(F.coalesce("same_name", "stem_same") > 1, F.lit("duplicate"))
            .when(F.coalesce("image_id", "stem_image").isNull(), F.lit("unmatched"))
            .alias("status"),
        )
    )
    good = found.where("status is null").groupBy("image_id").agg(F.min("pos").alias("first_pos"))
    status = F.coalesce(
        "status", F.when(F.col("pos") == F.col("first_pos"), F.lit("matched")).otherwise(F.lit("second"))
    )
    return found.join(good, "image_id", "left").select(
        "key", "pos", F.when(status.isin("matched", "second"), F.col("image_id")).alias("image_id"), status.alias("status")
    )


def missing_classes(annotations: DataFrame, declared: DataFrame) -> DataFrame:
    """Classes used but not declared, with the first type seen."""
    used = annotations.groupBy("name").agg(F.min_by("type", "pos").alias("type"))
    return used.join(declared.select("name"), "name", "left_anti")


def _numbered(base: Column, n: Column) -> Column:
    """``photo.png`` and 2 give ``photo-2.png``."""
    short = stem(base)
    return F.concat(short, F.lit("-"), n.cast("string"), F.substr(base, F.length(short) + 1))


def place_images(moving: DataFrame, target: DataFrame, mode: str = "rename", start: int = 1) -> DataFrame:
    """``image_id, filename, new_name, status`` of images put into a folder.

    A name is free when the folder does not hold it and no earlier image of the call keeps it. With
    ``rename`` a clashing image takes the next free ``-n`` from ``start`` (move: 1, copy: 2); with
    ``skip`` it fails; with ``overwrite`` it replaces what is there. ``target`` is the folder's
    ``filename`` list; ``moving`` carries ``image_id, filename, pos``.
    """
    held = target.select("filename", F.lit(True).alias("held")).distinct()
    firsts = moving.groupBy("filename").agg(F.min("pos").alias("first_pos"))
    judged = moving.join(firsts.join(held, "filename", "left"), "filename").withColumn(
        "clash", F.coalesce("held", F.lit(False)) | (F.col("pos") > F.col("first_pos"))
    )
    same = judged.select("image_id", "filename", F.col("filename").alias("new_name"))
    if mode == "skip":
        return same.join(judged.select("image_id", "clash"), "image_id").select(
            "image_id", "filename", F.when(~F.col("clash"), F.col("new_name")).alias("new_name"),
            F.when(F.col("clash"), F.lit("failed")).otherwise(F.lit("kept")).alias("status"),
        )
    if mode == "overwrite":
        return judged.select(
            "image_id", "filename", F.col("filename").alias("new_name"),
            F.when(F.col("clash"), F.lit("replaced")).otherwise(F.lit("kept")).alias("status"),
        )
    if mode != "rename":
        raise ValueError("mode is rename, skip or overwrite")
    clashing = judged.where("clash").select("image_id", F.col("filename").alias("base"), "pos")
    # Names in use after the call, read as numbered forms of a clashing base name.
    in_use = held.select("filename").unionAll(judged.where("not clash").select("filename")).distinct()
    number = F.regexp_extract(stem(F.col("filename")), r"-([1-9][0-9]{0,8})$", 1)
    taken = (
        in_use.withColumn("n", number.try_cast("bigint"))
        .where(F.col("n") >= start)
        .select(
            F.concat(
                F.regexp_replace(stem(F.col("filename")), r"-[1-9][0-9]{0,8}$", ""),
                F.substr("filename", F.length(stem(F.col("filename"))) + 1),
            ).alias("base"),
            "n",
        )
        .join(clashing.select("base").distinct(), "base", "left_semi")
    )
    # The j-th taken number t leaves t - start + 1 - j free numbers below it. The i-th clashing image
    # skips every taken number with fewer than i free ones below: a merge of the two sorted lists.
    one = F.lit(1)
    free_before = running_sums(taken, ["base"], [F.col("n")], {"j": one}).select(
        "base", (F.col("n") - start + 1 - F.col("j")).alias("at"), F.lit(1).alias("late"), F.lit(0).alias("pos"),
        F.lit(None).cast("bigint").alias("image_id"), F.lit(1).alias("skip"), F.lit(None).cast("bigint").alias("i"),
    )
    wanted = running_sums(clashing, ["base"], [F.col("pos")], {"i": one}).select(
        "base", F.col("i").alias("at"), F.lit(0).alias("late"), "pos", "image_id", F.lit(0).alias("skip"), "i"
    )
    merged = running_sums(
        free_before.unionByName(wanted), ["base"], [F.col("at"), F.col("late"), F.col("pos")], {"skipped": F.col("skip")}
    ).where("image_id is not null")
    renamed = merged.select(
        "image_id", F.col("base").alias("filename"),
        _numbered(F.col("base"), F.col("i") + F.col("skipped") + start - 1).alias("new_name"), F.lit("renamed").alias("status"),
    )
    kept = judged.where("not clash").select(
        "image_id", "filename", F.col("filename").alias("new_name"), F.lit("kept").alias("status")
    )
    return kept.unionByName(renamed)
