"""Bulk edits of image, class and annotation tables (E1, E4-E13, A29). Each returns the new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bulk_tag(images: DataFrame, ids: DataFrame, tags: Sequence[str], add: bool = True) -> DataFrame:
    """Add or remove tags on the named images; doing it twice changes nothing."""
    wanted = F.array(*map(F.lit, tags))
    changed = F.array_union("tags", wanted) if add else F.array_except("tags", wanted)
    return _on(images, ids, {"tags": changed})


def _on(images: DataFrame, ids: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Apply column changes to the images named by ``ids``."""
    marked = images.join(ids.select("image_id", F.lit(True).alias("_hit")).distinct(), "image_id", "left")
    return marked.withColumns(
        {c: F.when(F.col("_hit"), new).otherwise(F.col(c)) for c, new in changes.items()}
    ).drop("_hit")


def merge_class_lists(base: DataFrame, edited: DataFrame, stored: DataFrame) -> DataFrame:
    """Apply the edit from ``base`` to ``edited`` onto the stored class list.

    Classes are keyed on (name, type) and carry ``color`` and ``pos``. A class the edit added or
    changed is taken from it, a class the edit removed goes, and everything else stays as stored.
    """
    key = ["name", "type"]

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(*key, F.lit(True).alias(p), F.col("color").alias(f"{p}_color"), F.col("pos").alias(f"{p}_pos"))

    rows = side(base, "b").join(side(edited, "e"), key, "full").join(side(stored, "s"), key, "full")
    edit_made = F.col("e") & (F.col("b").isNull() | ~F.col("e_color").eqNullSafe(F.col("b_color")))
    removed = F.coalesce(F.col("b") & F.col("e").isNull(), F.lit(False))
    kept = F.coalesce("s", F.lit(False)) | F.coalesce(edit_made, F.lit(False))
    return rows.where(kept & ~removed).select(
        *key,
        F.when(F.coalesce(edit_made, F.lit(False)), F.col("e_color")).otherwise(F.col("s_color")).alias("color"),
    )


def rename_class(annotations: DataFrame, old: str, new: str) -> DataFrame:
    """Annotations of one class carry the other name."""
    return annotations.withColumn("name", F.when(F.col("name") == old, F.lit(new)).otherwise(F.col("name")))


def rename_in_ontology(classes: DataFrame, old: str, new: str) -> DataFrame:
    """E5: the class list with the new name; a class of that name and type already there is an error."""
    there = classes.where(F.col("name") == new).select("type", F.lit(True).alias("_there")).distinct()
    clash = (F.col("name") == old) & F.coalesce("_there", F.lit(False))
    renamed = F.when(F.col("name") == old, F.lit(new)).otherwise(F.col("name"))
    checked = F.when(clash, F.raise_error(F.lit(f"a class {new} of that type exists"))).otherwise(renamed)
    return classes.join(there, "type", "left").withColumn("name", checked).drop("_there")


def remove_from_ontology(classes: DataFrame, name: str, class_type: str | None = None) -> DataFrame:
    """The class list without one class, or without one (class, type)."""
    gone = F.col("name") == name
    return classes.where(~(gone & (F.col("type") == class_type) if class_type else gone))


def delete_class(annotations: DataFrame, name: str, delete_annotations: bool = False) -> DataFrame:
    """Annotations stay unless their removal is asked for."""
    return annotations.where(F.col("name") != name) if delete_annotations else annotations


def class_edit_counts(annotations: DataFrame, name: str) -> DataFrame:
    """Images and annotations an edit of a class touches."""
    per_image = annotations.where(F.col("name") == name).groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    return per_image.agg(
        F.count(F.lit(1)).alias("images_updated"), F.coalesce(F.sum("n"), F.lit(0)).alias("annotations_updated")
    )


def replace_annotations(
    annotations: DataFrame, saves: DataFrame, saved_images: DataFrame, images: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``(annotations after the save, unknown image ids)``.

    ``saved_images`` names every image of the call, so an empty save clears an image.
    """
    asked = saved_images.select("image_id").distinct()
    known = asked.join(images, "image_id", "left_semi")
    kept = annotations.join(known, "image_id", "left_anti")
    return kept.unionByName(saves.join(known, "image_id", "left_semi")), asked.join(images, "image_id", "left_anti")


def bulk_update(
    images: DataFrame,
    ids: DataFrame,
    *,
    status: str | None = None,
    split: str | None = None,
    clear_split: bool = False,
    is_archived: bool | None = None,
    display_name: str | None = None,
) -> DataFrame:
    """Stage, split, archive flag and name of the named images."""
    if split is not None and clear_split:
        raise ValueError("give split or clear_split, not both")
    changes: dict[str, Column] = {}
    if status is not None:
        changes["status"] = F.lit(status)
    if split is not None or clear_split:
        changes["split"] = F.lit(split).cast("string")
    if is_archived is not None:
        changes["is_archived"] = F.lit(is_archived)
    if display_name is not None:
        changes["filename"] = F.lit(display_name)
    if not changes:
        raise ValueError("nothing to update")
    return _on(images, ids, changes)


def review(images: DataFrame, ids: DataFrame, action: str, note: str | None = None) -> DataFrame:
    """``approve`` completes an image; ``request_changes`` sends it back with a note."""
    stage = {"approve": "complete", "request_changes": "annotate"}[action]
    return _on(images.withColumn("note", F.lit(None).cast("string")), ids, {"status": F.lit(stage), "note": F.lit(note)})


def delete_images(images: DataFrame, ids: DataFrame, permanent: bool = False) -> DataFrame:
    """Archive the named images, or remove their rows."""
    if permanent:
        return images.join(ids.select("image_id"), "image_id", "left_anti")
    return _on(images, ids, {"is_archived": F.lit(True)})


def _under(directory: str) -> Column:
    return (F.col("directory") == directory) | F.col("directory").startswith(directory.rstrip("/") + "/")


def rename_folder(images: DataFrame, old: str, new: str) -> DataFrame:
    """A folder and everything below it under a new path."""
    moved = F.concat(F.lit(new), F.substr(F.col("directory"), F.lit(len(old) + 1)))
    return images.withColumn("directory", F.when(_under(old), moved).otherwise(F.col("directory")))


def move_folder(images: DataFrame, directory: str, into: str) -> DataFrame:
    """A folder, with its subtree, becomes a child of another folder."""
    return rename_folder(images, directory, into.rstrip("/") + "/" + directory.rstrip("/").rsplit("/", 1)[-1])


def delete_folder(images: DataFrame, directory: str, cascade: bool = False) -> DataFrame:
    """Images of a deleted folder move to its parent.

    Refused when the folder has sub-folders, and, without ``cascade``, when it holds images.
    """
    parent = directory.rstrip("/").rsplit("/", 1)[0] or "/"
    below = F.col("directory").startswith(directory.rstrip("/") + "/")
    here = F.col("directory") == directory
    held = F.when(here, F.lit(parent) if cascade else F.raise_error(F.lit("the folder is not empty")))
    refused = F.when(below, F.raise_error(F.lit("the folder has sub-folders")))
    return images.withColumn("directory", F.coalesce(refused, held, F.col("directory")))
