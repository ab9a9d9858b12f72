"""Masks as run tables: decoding, overlap and semantic scores.

A run is ``start, len`` in the flattened mask. Overlaps come from one sweep over the sorted runs of an image.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions.geometry import let
from annoframe.operators import sweep
from annoframe.operators.metrics import ratio
from annoframe.session import cut

BACKGROUND = "__background__"


def counts_from_text(text: Column) -> Column:
    """Run lengths of a compressed counts string; null when it ends inside a number.

    Six bits a character from '0': five value bits and one for "more"; the last group's top bit is the
    sign. From the fourth number on, values are differences from the number two places before.
    """
    start = F.struct(
        F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("x"), F.lit(0).alias("k")
    )

    def step(acc: Column, ch: Column) -> Column:
        c = F.ascii(ch) - 48
        x = acc["x"].bitwiseOR(F.call_function("shiftleft", c.bitwiseAND(F.lit(31)).cast("bigint"), acc["k"] * 5))
        more = c.bitwiseAND(F.lit(32)) != 0
        negative = c.bitwiseAND(F.lit(16)) != 0
        signed = F.when(
            negative, x.bitwiseOR(F.call_function("shiftleft", F.lit(-1).cast("bigint"), acc["k"] * 5 + 5))
        ).otherwise(x)
        base = F.when(F.size(acc["out"]) > 2, F.element_at(acc["out"], -2)).otherwise(F.lit(0).cast("bigint"))
        grown = F.struct(acc["out"].alias("out"), x.alias("x"), (acc["k"] + 1).alias("k"))
        closed = F.struct(
            F.array_append(acc["out"], signed + base).alias("out"), F.lit(0).cast("bigint").alias("x"), F.lit(0).alias("k")
        )
        return F.when(more, grown).otherwise(closed)

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.aggregate(chars, start, step, lambda acc: F.when(acc["k"] == 0, acc["out"]))


def check_counts(masks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, refused with reason)``: run lengths must not be negative and must cover h x w."""
    def judge(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
        reason = (
            F.when(counts.isNull(), F.lit("counts end inside a run length"))
            .when(F.exists(counts, lambda c: c < 0), F.lit("negative run"))
            .when(total != F.col("h") * F.col("w"), F.lit("runs do not cover the mask"))
        )
        return F.struct(counts.alias("counts"), reason.alias("reason"))

    # The generator decodes and judges once per row; a filter on a plain column would decode anew for each use.
    judged = masks.withColumn("_j", F.explode(F.array(let(F.col("counts"), judge))))
    judged = judged.withColumns({"counts": F.col("_j.counts"), "reason": F.col("_j.reason")}).drop("_j")
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def runs_of(masks: DataFrame) -> DataFrame:
    """The foreground runs ``start, len`` of each mask: every second count, from the second."""
    ends = F.aggregate(
        "counts",
        F.array(F.lit(0).cast("bigint")),
        lambda acc, v: F.array_append(acc, F.element_at(acc, -1) + v),
    )
    pairs = F.zip_with(F.col("counts"), F.slice(F.col("_e"), 1, F.size("counts")), lambda n, s: F.struct(s.alias("start"), n.alias("len")))
    odd = F.filter(pairs, lambda r, i: (i % 2 == 1) & (r["len"] > 0))
    keep = [c for c in masks.columns if c != "counts"]
    return masks.withColumn("_e", ends).select(*keep, F.inline(odd))


def mask_area(counts: Column) -> Column:
    """Foreground pixels."""
    return F.aggregate(F.filter(counts, lambda v, i: i % 2 == 1), F.lit(0).cast("bigint"), lambda acc, v: acc + v)


def _masks(rows: DataFrame) -> DataFrame:
    """Rows with ``starts, lens``; a run table (``start, len``) becomes rows of one run each."""
    return rows if "starts" in rows.columns else rows.withColumns(sweep.one_run(F.col("start"), F.col("len")))


def mask_overlaps(left: DataFrame, right: DataFrame, hot_runs: int = sweep.HOT_RUNS) -> DataFrame:
    """``image_id, left_id, right_id, pixels, iou, dice`` of masks that share a pixel.

    A side is a run table (``image_id, ann_id, start, len``) or has a row per mask with arrays ``starts, lens``, which shuffles less.
    Runs of one mask must not overlap each other.
    """
    both = sweep.overlaps(_masks(left), _masks(right), "ann_id", hot_runs)
    total = F.col("left_area") + F.col("right_area")
    return both.select(
        "image_id",
        F.col("l").alias("left_id"),
        F.col("r").alias("right_id"),
        "pixels",
        (F.col("pixels") / (total - F.col("pixels"))).alias("iou"),
        (2 * F.col("pixels") / total).alias("dice"),
    )


def pixel_confusion(truth: DataFrame, predicted: DataFrame, pixels: DataFrame, hot_runs: int = sweep.HOT_RUNS) -> DataFrame:
    """``gt_label, pred_label, pixels`` over all images, background included.

    Label maps are runs with ``name``; every pixel has at most one label on a side. ``pixels`` holds
    ``image_id, pixels`` (the image size). Background counts are totals minus what is labelled.
    """
    matched = sweep.overlaps(_masks(truth), _masks(predicted), "name", hot_runs).groupBy(
        F.col("l").alias("gt_label"), F.col("r").alias("pred_label")
    ).agg(F.sum("pixels").alias("n"))
    back = F.lit(BACKGROUND)
    gt = truth.groupBy(F.col("name").alias("gt_label")).agg(F.sum("len").alias("n"))
    pr = predicted.groupBy(F.col("name").alias("pred_label")).agg(F.sum("len").alias("n"))
    whole = pixels.agg(F.sum("pixels").alias("n"))
    signed = (
        matched.select("gt_label", "pred_label", "n")
        .unionAll(gt.select("gt_label", back, "n"))
        .unionAll(matched.select("gt_label", back, -F.col("n")))
        .unionAll(pr.select(back, "pred_label", "n"))
        .unionAll(matched.select(back, "pred_label", -F.col("n")))
        .unionAll(whole.select(back, back, "n"))
        .unionAll(gt.select(back, back, -F.col("n")))
        .unionAll(pr.select(back, back, -F.col("n")))
        .unionAll(matched.select(back, back, "n"))
    )
    return signed.groupBy("gt_label", "pred_label").agg(F.sum("n").alias("pixels"))


def semantic_classes(confusion: DataFrame) -> DataFrame:
    """Per foreground class: TP, FP and FN pixels, support, precision, recall, IoU and Dice."""
    hit = F.col("gt_label") == F.col("pred_label")
    n, zero = F.col("pixels"), F.lit(0).cast("long")
    sides = confusion.select(F.col("gt_label").alias("name"), F.when(hit, n).otherwise(zero).alias("tp"), zero.alias("fp"), F.when(~hit, n).otherwise(zero).alias("fn"))
    sides = sides.unionAll(confusion.select("pred_label", zero, F.when(~hit, n).otherwise(zero), zero))
    sums = sides.where(F.col("name") != BACKGROUND).groupBy("name").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        "name", "tp", "fp", "fn", (tp + fn).alias("support"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(tp, tp + fp + fn).alias("iou"), ratio(2 * tp, 2 * tp + fp + fn).alias("dice"),
    )


def semantic_overall(confusion: DataFrame) -> DataFrame:
    """Mean IoU and Dice over classes, pixel accuracy (background included), mean class accuracy
    and IoU weighted by truth pixels."""
    none = F.lit(None)
    right = F.when(F.col("gt_label") == F.col("pred_label"), F.col("pixels")).otherwise(0)
    # Class rows and pixel rows side by side, so that one aggregate makes the one row.
    rows = semantic_classes(confusion).select("iou", "dice", "recall", "support", none.cast("long").alias("right"), none.cast("long").alias("pixels"))
    rows = rows.unionAll(confusion.select(none, none, none, none, right, "pixels"))
    return rows.agg(
        F.avg("iou").alias("miou"),
        F.avg("dice").alias("mean_dice"),
        F.avg("recall").alias("mean_pixel_accuracy"),
        ratio(F.sum(F.col("iou") * F.col("support")), F.sum("support")).alias("frequency_weighted_iou"),
        ratio(F.sum("right"), F.sum("pixels")).alias("pixel_accuracy"),
    )


def threshold_sweep(pred: DataFrame, gt: DataFrame, matches: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """TP, FP, FN, precision, recall and F1 at each confidence threshold, and which is best.

    Matching goes by confidence, so a prediction under the threshold never changes the matches above
    it: one match serves every threshold. Rows are counted by the number of thresholds they reach.
    """
    steps = sorted(float(t) for t in thresholds)
    spark = pred.sparkSession
    reach = F.size(F.filter(F.array(*map(F.lit, steps)), lambda t: t <= F.col("confidence")))
    hits = matches.join(pred.select("image_id", F.col("ann_id").alias("pred_id"), "confidence"), ["image_id", "pred_id"])
    one = F.lit(1).cast("long")
    counts = (
        pred.select(reach.alias("r"), one.alias("p"), F.lit(0).cast("long").alias("m"))
        .unionAll(hits.select(reach, F.lit(0).cast("long"), one))
        .groupBy("r")
        .agg(F.sum("p").alias("p"), F.sum("m").alias("m"))
    )
    # A row that reaches r thresholds counts for levels 1 to r.
    levels = counts.where("r > 0").select(F.explode(F.sequence(F.lit(1), F.col("r"))).alias("level"), "p", "m")
    table = spark.createDataFrame([(i + 1, t) for i, t in enumerate(steps)], "level int, threshold double")
    at = table.join(levels, "level", "left").groupBy("threshold").agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("p"), F.coalesce(F.sum("m"), F.lit(0)).alias("tp")
    )
    fp, fn = F.col("p") - F.col("tp"), F.lit(gt.count()) - F.col("tp")
    rows = at.select("threshold", "tp", fp.alias("fp"), fn.alias("fn"))
    precision, recall = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    scored = rows.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    # A row per threshold: one window over them all.
    best = F.max_by("threshold", F.struct("f1", -F.col("threshold"))).over(Window.partitionBy(F.lit(1)))
    return scored.withColumn("best_threshold", best)
