"""Dataset health, ledgers, folders and work reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.operators.metrics import ratio
from annoframe.scale import running_sums

STAGES = ("new", "annotate", "review", "complete")
# Lower bounds and labels of the annotations-per-image histogram.
DENSITY = ((0, "0"), (1, "1-2"), (3, "3-5"), (6, "6-10"), (11, "11-20"), (21, "21-50"), (51, "51+"))
TOP_SIZES = 200


def dataset_totals(images: DataFrame) -> DataFrame:
    """A10: totals over images that are not archived (with ``annotation_count``)."""
    n, a = F.count(F.lit(1)), F.coalesce(F.sum("annotation_count"), F.lit(0))
    return images.where(~F.col("is_archived")).agg(
        n.alias("total_images"),
        a.alias("total_annotations"),
        F.count_if(F.col("annotation_count") > 0).alias("annotated_images"),
        F.count_if(F.col("annotation_count") == 0).alias("unannotated_images"),
        ratio(a, n).alias("avg_annotations_per_image"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"),
    )


def stage_counts(images: DataFrame) -> DataFrame:
    """A11."""
    return images.where(~F.col("is_archived")).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STAGES])


def class_balance(annotations: DataFrame) -> DataFrame:
    """Instances and images per class. Rows collapse to (class, image) before classes are counted."""
    pairs = annotations.groupBy("name", "image_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("name").agg(F.sum("n").alias("instances"), F.count(F.lit(1)).alias("images"))


def type_counts(annotations: DataFrame) -> DataFrame:
    """A13."""
    return annotations.groupBy("type").agg(F.count(F.lit(1)).alias("instances"))


def density_histogram(images: DataFrame) -> DataFrame:
    """Images per annotations-per-image bucket, empty buckets included."""
    n = F.col("annotation_count")
    bucket = F.lit(DENSITY[0][1])
    for low, label in DENSITY[1:]:
        bucket = F.when(n >= low, F.lit(label)).otherwise(bucket)
    counts = images.where(~F.col("is_archived")).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("images"))
    full = images.sparkSession.createDataFrame([(label,) for _, label in DENSITY], "bucket string")
    return full.join(counts, "bucket", "left").select("bucket", F.coalesce("images", F.lit(0)).alias("images"))


def dimension_stats(images: DataFrame) -> DataFrame:
    """Extremes, rounded means, orientation and missing sizes."""
    rows = images.where(~F.col("is_archived"))
    w, h = F.col("width"), F.col("height")
    known = w.isNotNull() & h.isNotNull()
    return rows.agg(
        *[f(c).alias(f"{n}_{c}") for c in ("width", "height") for n, f in (("min", F.min), ("max", F.max))],
        *[F.bround(F.avg(c)).cast("bigint").alias(f"avg_{c}") for c in ("width", "height")],
        F.count_if(known & (w > h)).alias("landscape"),
        F.count_if(known & (w < h)).alias("portrait"),
        F.count_if(known & (w == h)).alias("square"),
        F.count_if(known).alias("images_with_dimensions"),
        F.count_if(~known).alias("images_missing_dimensions"),
    )


def size_counts(images: DataFrame) -> DataFrame:
    """Images per distinct size."""
    rows = images.where(~F.col("is_archived") & F.col("width").isNotNull() & F.col("height").isNotNull())
    return rows.groupBy("width", "height").agg(F.count(F.lit(1)).alias("images"))


def top_sizes(images: DataFrame, k: int = TOP_SIZES) -> DataFrame:
    """The ``k`` most frequent sizes."""
    return size_counts(images).orderBy(F.desc("images"), "width", "height").limit(k)


def top_tags(tagged: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent tags over objects, scenes and attributes."""
    tag = F.explode(F.array_distinct(F.concat("objects", "scenes", "attributes"))).alias("tag")
    counts = tagged.select(tag).groupBy("tag").agg(F.count(F.lit(1)).alias("images"))
    return counts.orderBy(F.desc("images"), "tag").limit(k)


# --- ledger ---------------------------------------------------------------------------------------

RANGES = {"day": "1 day", "week": "7 days", "month": "30 days"}


def usage_by_operation(ledger: DataFrame, now: Column, window: str = "month") -> DataFrame:
    """Debits per operation in the window, and one total row with a null operation."""
    debits = ledger.where("amount < 0")
    if window != "all":
        debits = debits.where(F.col("created_at") >= now - F.expr(f"interval {RANGES[window]}"))
    return debits.rollup("operation").agg(
        (-F.sum("amount")).alias("total_micro_usd"), F.count(F.lit(1)).alias("events")
    )


def by_spend(usage: DataFrame) -> DataFrame:
    """Operations by spend, largest first, ties by name."""
    return usage.where("operation is not null").orderBy(F.desc("total_micro_usd"), "operation")


def budget_position(ledger: DataFrame, plans: DataFrame, start: Column) -> DataFrame:
    """Per organisation: allowance left, spend, overage and budget left in the period.

    ``plans`` holds ``org, allowance, budget``; an organisation without debits has spent 0.
    """
    spent = (
        ledger.where((F.col("amount") < 0) & (F.col("created_at") >= start))
        .groupBy("org")
        .agg((-F.sum("amount")).alias("spend"))
    )
    zero, spend = F.lit(0), F.coalesce(F.col("spend"), F.lit(0))
    return plans.join(spent, "org", "left").select(
        "org",
        F.greatest(zero, F.col("allowance") - spend).alias("allowance_left"),
        spend.alias("spend"),
        F.greatest(zero, spend - F.col("allowance")).alias("overage"),
        F.greatest(zero, F.col("budget") - spend).alias("budget_left"),
    )


def running_balance(ledger: DataFrame) -> DataFrame:
    """Balance after every entry of an organisation, in time order (ties by id)."""
    order = [F.col("created_at"), F.col("id")]
    return running_sums(ledger, ["org"], order, {"balance_after": F.col("amount")})


# --- folders --------------------------------------------------------------------------------------


def ancestors(directory: Column) -> Column:
    """Every folder on the way from the root to a path, the path included."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    chain = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(F.lit("/")), chain)


def directory_tree(images: DataFrame) -> DataFrame:
    """Direct and nested image counts of every folder. Folders are counted before they are exploded."""
    direct = images.groupBy("directory").agg(F.count(F.lit(1)).alias("n"))
    up = direct.select(F.explode(ancestors(F.col("directory"))).alias("path"), "directory", "n")
    return up.groupBy("path").agg(
        F.sum(F.when(F.col("path") == F.col("directory"), F.col("n")).otherwise(0)).alias("image_count"),
        F.sum("n").alias("nested_image_count"),
    )


def directory_stats(images: DataFrame, directory: str = "/", subtree: bool = True) -> DataFrame:
    """Folders, images and bytes under a path, and images by stage."""
    base = "/" + directory.strip("/")
    inside = F.col("directory") == base
    if subtree:
        inside = inside | F.col("directory").startswith(base.rstrip("/") + "/")
    rows = images.where(inside).groupBy("directory").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("file_size").alias("bytes"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STAGES],
    )
    return rows.agg(
        F.count(F.lit(1)).alias("directories"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("images"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in STAGES],
    )


# --- work -----------------------------------------------------------------------------------------


def last_savers(work: DataFrame) -> DataFrame:
    """The last saver of each image (latest time, then largest user id)."""
    return work.groupBy("image_id").agg(
        F.max(F.struct("saved_at", "user_id", "completed")).alias("last")
    ).select("image_id", F.col("last.user_id").alias("user_id"), F.col("last.completed").alias("completed"))


def contributions(work: DataFrame, annotations: DataFrame) -> DataFrame:
    """Seconds and images worked per user; completed images and annotations go to the last saver."""
    touched = work.groupBy("user_id", "image_id").agg(F.sum("seconds").alias("s"))
    effort = touched.groupBy("user_id").agg(F.sum("s").alias("active_seconds"), F.count(F.lit(1)).alias("images_worked"))
    per_image = annotations.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    credit = (
        last_savers(work)
        .join(per_image, "image_id", "left")
        .groupBy("user_id")
        .agg(F.count_if("completed").alias("images_completed"), F.coalesce(F.sum("n"), F.lit(0)).alias("annotations_added"))
    )
    return effort.join(credit, "user_id", "left").fillna(0, ["images_completed", "annotations_added"])


def stream_summary(log: DataFrame) -> DataFrame:
    """Per stream of a run's log: records, first and last time, and each branch's count."""
    return log.groupBy("kind").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.count_if(F.col("condition")).alias("passed"),
        F.count_if(~F.col("condition")).alias("failed"),
    )


def outcome_report(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attempted, written, skipped and failed rows of an import, tiling or annotation run."""
    cells = [F.count(F.lit(1)).alias("attempted")] + [
        F.count_if(F.col("outcome") == o).alias(o) for o in ("written", "skipped", "failed")
    ]
    return outcomes.groupBy(*by).agg(*cells) if by else outcomes.agg(*cells)
