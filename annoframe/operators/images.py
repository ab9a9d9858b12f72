"""Listing, selecting and paging image rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.scale import global_rank

# Fixed value: most images one annotation batch may hold.
BATCH_IMAGES = 5000


def with_annotation_stats(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """``annotation_count`` and ``min_confidence`` per image (null without annotations)."""
    stats = annotations.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("annotation_count"), F.min("confidence").alias("min_confidence")
    )
    return images.join(stats, "image_id", "left").withColumn(
        "annotation_count", F.coalesce("annotation_count", F.lit(0))
    )


def list_images(
    images: DataFrame,
    *,
    directory: str | None = None,
    filename: str | None = None,
    status: str | None = None,
    split: str | None = None,
    include_archived: bool = False,
    min_confidence_lt: float | None = None,
) -> DataFrame:
    """every given filter must hold; a null confidence is never below a bound."""
    out = images
    for name, value in (("directory", directory), ("filename", filename), ("status", status), ("split", split)):
        if value is not None:
            out = out.where(F.col(name) == value)
    if not include_archived:
        out = out.where(~F.col("is_archived"))
    if min_confidence_lt is not None:
        out = out.where(F.col("min_confidence") < min_confidence_lt)
    return out


def newest_first(images: DataFrame) -> DataFrame:
    return images.orderBy(F.desc("created_at"), F.desc("image_id"))


def review_queue(images: DataFrame, threshold: float) -> DataFrame:
    """images below a confidence, least certain first."""
    return list_images(images, min_confidence_lt=threshold).orderBy("min_confidence", "image_id")


def confidence_bands(images: DataFrame) -> DataFrame:
    """Flagged images (below 1), lowest and mean confidence, and four bands."""
    c = F.when(F.col("min_confidence") < 1.0, F.col("min_confidence"))
    return images.agg(
        F.count(c).alias("flagged"),
        F.min(c).alias("lowest"),
        F.avg(c).alias("avg_flagged"),
        F.count_if(c < 0.5).alias("lt50"),
        F.count_if((c >= 0.5) & (c < 0.7)).alias("b50_70"),
        F.count_if((c >= 0.7) & (c < 0.9)).alias("b70_90"),
        F.count_if(c >= 0.9).alias("b90_100"),
    )


def select_images(
    images: DataFrame, *, ids: DataFrame | None = None, filters: dict | None = None, everything: bool = False
) -> DataFrame:
    """exactly one of an id table, filters, or everything. Repeated ids count once."""
    if sum((ids is not None, filters is not None, everything)) != 1:
        raise ValueError("give exactly one of ids, filters and everything")
    if ids is not None:
        return images.join(ids.select("image_id"), "image_id", "left_semi")
    return list_images(images, **filters) if filters is not None else images


def pick(images: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows named by the ids, ids no row has)``."""
    wanted = ids.select("image_id").distinct()
    return images.join(wanted, "image_id", "left_semi"), wanted.join(images, "image_id", "left_anti")


def plan_annotation_run(
    images: DataFrame, *, overwrite: bool = False, max_images: int | None = None, batch_images: int = BATCH_IMAGES
) -> tuple[DataFrame, DataFrame]:
    """``(images to submit with their batch_no, report)``; annotated images are left out unless ``overwrite``.

    Every eligible image is submitted, ``batch_images`` to a batch in id order. ``max_images`` is the one bound, and the
    report says how many images it left out.
    """
    eligible = images if overwrite else images.where("annotation_count = 0")
    if max_images is not None:
        eligible = eligible.orderBy("image_id").limit(max_images)
    ranked = global_rank(eligible, [F.col("image_id").asc()], "_rank")
    chosen = ranked.withColumn("batch_no", F.floor((F.col("_rank") - 1) / batch_images)).drop("_rank")
    open_image = F.lit(True) if overwrite else F.col("annotation_count") == 0
    sent = F.col("eligible") if max_images is None else F.least(F.col("eligible"), F.lit(max_images))
    report = images.agg(F.count(F.lit(1)).alias("total"), F.count_if(open_image).alias("eligible")).select(
        sent.cast("bigint").alias("attempted"),
        (F.col("total") - F.col("eligible")).alias("skipped"),
        (F.col("eligible") - sent).cast("bigint").alias("capped"),
        F.ceil(sent / batch_images).cast("bigint").alias("batches"),
    )
    return chosen, report


def without_classes(nested: DataFrame, classes: Sequence[str], skip_empty: bool = False) -> DataFrame:
    """drop classes from ``annotations`` arrays, then images left empty if asked."""
    out = nested.withColumn("annotations", F.filter("annotations", lambda a: ~a["name"].isin(*classes)))
    return out.where(F.size("annotations") > 0) if skip_empty else out


def children(images: DataFrame, parent: str) -> DataFrame:
    """the direct sub-folders of a path that hold images at any depth."""
    base = "/" + parent.strip("/") + "/" if parent.strip("/") else "/"
    rest = F.substr(F.col("directory"), F.lit(len(base) + 1))
    child = F.split_part(rest, F.lit("/"), F.lit(1))
    return (
        images.where(F.col("directory").startswith(base) & (F.length("directory") > len(base)))
        .select(F.concat(F.lit(base), child).alias("path"), child.alias("name"))
        .distinct()
    )


def page_after(rows: DataFrame, cursor: tuple | None, size: int) -> DataFrame:
    """The page after ``(created_at, id)``: a range filter that reaches the scan, never an offset."""
    if cursor is not None:
        at, last = F.lit(cursor[0]).cast("timestamp"), F.lit(cursor[1])
        rows = rows.where(
            (F.col("created_at") <= at) & ((F.col("created_at") < at) | (F.col("image_id") < last))
        )
    return newest_first(rows).limit(size)


def page_at(rows: DataFrame, offset: int, size: int, max_total: int | None = None) -> DataFrame:
    """Offset paging, never past ``max_total`` rows in all."""
    size = size if max_total is None else max(0, min(size, max_total - offset))
    return newest_first(rows).offset(offset).limit(size)


def first(rows: DataFrame, total: int = 1) -> DataFrame:
    """The first row, or the first ``total``."""
    return newest_first(rows).limit(total)


def not_yet_held(new: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows to load, skipped rows)``: skipped when folder and name are already held."""
    held = images.select("dataset_id", "directory", "filename")
    keys = ["dataset_id", "directory", "filename"]
    return new.join(held, keys, "left_anti"), new.join(held, keys, "left_semi")


def bulk_register(new: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(registered, refused with reason)``: a name already held, or repeated in the call.

    The first row of a name is found by a pre-aggregated minimum, so copies of one name are combined
    before the shuffle.
    """
    keys = ["dataset_id", "directory", "filename"]
    first_rows = new.groupBy(*keys).agg(F.min("pos").alias("first_pos"))
    held = images.select(*keys, F.lit(True).alias("held")).distinct()
    judged = (
        new.join(first_rows.join(held, keys, "left"), keys)
        .withColumn(
            "reason",
            F.when(F.col("held"), F.lit("already held")).when(F.col("pos") > F.col("first_pos"), F.lit("repeated in the call")),
        )
        .drop("held", "first_pos")
    )
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def class_threshold(name: Column, default: float, per_class: dict[str, float] | None = None) -> Column:
    """the threshold a class is held to."""
    if not per_class:
        return F.lit(float(default))
    own = F.create_map(*[F.lit(v) for k, t in per_class.items() for v in (k, float(t))])
    return F.coalesce(F.element_at(own, name), F.lit(float(default)))


def confidence_floor(default: float, per_class: dict[str, float] | None = None) -> float:
    """the loosest threshold of any class."""
    return min([float(default), *map(float, (per_class or {}).values())])


def keep_classes(rows: DataFrame, classes: Sequence[str]) -> DataFrame:
    """rows of the named classes; an empty list means every class."""
    return rows.where(F.col("name").isin(*classes)) if classes else rows


def has_extent(bbox: Column, obb: Column, rings: Column) -> Column:
    """no zero-size box or rotated box, no ring under three points; what is absent passes."""

    def sized(b: Column) -> Column:
        return F.coalesce((b["w"] > 0) & (b["h"] > 0), F.lit(True))

    return sized(bbox) & sized(obb) & ~F.coalesce(F.exists(rings, lambda r: F.size(r) < 3), F.lit(False))


def badges(classes: Column, min_confidence: float) -> Column:
    """classes at or over the threshold, each once, in the order given."""
    good = F.filter(classes, lambda c: c["confidence"] >= min_confidence)
    names = good["name"]
    return F.filter(good, lambda c, i: F.array_position(names, c["name"]) == i + 1)


def by_tag(rows: DataFrame, **wanted: Sequence[str]) -> DataFrame:
    """every given tag must be there, within and across objects, scenes and attributes."""
    given = {k: v for k, v in wanted.items() if v}
    if not given:
        raise ValueError("give at least one tag")
    for column, tags in given.items():
        rows = rows.where(F.size(F.array_except(F.array(*map(F.lit, tags)), F.col(column))) == 0)
    return rows


def catalog(
    datasets: DataFrame,
    stars: DataFrame,
    now: Column,
    *,
    search: str | None = None,
    class_name: str | None = None,
    sort: str = "recent",
) -> DataFrame:
    """public datasets by text (name or tag) and class, with a sort and a full tie-break.

    ``popular`` counts all stars, ``trending`` those of the last seven days.
    """
    if search is not None:
        needle = F.lower(F.lit(search))
        datasets = datasets.where(
            F.contains(F.lower("name"), needle) | F.exists("tags", lambda t: F.contains(F.lower(t), needle))
        )
    if class_name is not None:
        datasets = datasets.where(F.array_contains("classes", class_name))
    counts = stars.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("star_count"),
        F.count_if(F.col("time") >= now - F.expr("interval 7 days")).alias("stars_week"),
    )
    out = datasets.join(counts, "dataset_id", "left").fillna(0, ["star_count", "stars_week"])
    order = {
        "recent": F.desc("created_at"),
        "popular": F.desc("star_count"),
        "trending": F.desc("stars_week"),
        "alphabetical": F.lower("name"),
    }[sort]
    return out.orderBy(order, "dataset_id")


def region_cut(regions: DataFrame, min_area_ratio: float = 0.002, max_regions: int = 300) -> DataFrame:
    """Largest regions per (image, class) on an area share; the largest stays if none reaches it."""
    share = F.col("area") >= F.col("image_area") * min_area_ratio
    order = Window.partitionBy("image_id", "name").orderBy(F.desc("area"), "ann_id")
    # Only the first row can be below the share and stay, and it does so only when it is the largest.
    ranked = regions.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_regions)
    return ranked.where(share | (F.col("rank") == 1))
