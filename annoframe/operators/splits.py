"""Seeded train / val / test assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_splits(
    images: DataFrame, train: int = 70, val: int = 20, test: int = 10, seed: int = 42, by: str | None = None
) -> DataFrame:
    """``image_id, split``: val and test take the floor of their share, train the rest.

    Images are ordered by ``md5(seed:image_id)``; with ``by`` the same shares are cut inside every
    group (a null group is a group of its own). No row is ranked globally: hash prefixes are counted,
    the two cut points fall into one prefix bucket each, only those buckets are ranked, and every row
    is then compared with its group's cut keys.
    """
    if min(train, val, test) < 0 or train + val + test != 100:
        raise ValueError("train, val and test are whole percentages that add up to 100")
    group = F.lit(0) if by is None else F.coalesce(F.col(by).cast("string"), F.lit("\x00none"))
    rows = images.select(
        "image_id", group.alias("_g"), F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("image_id").cast("string"))).alias("_h")
    ).withColumn("_key", F.struct("_h", "image_id")).withColumn("_p", F.substring("_h", 1, 4))
    running = Window.partitionBy("_g").orderBy("_p")
    buckets = (
        rows.groupBy("_g", "_p")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy("_g")))
        .withColumn("_val", F.floor(F.col("_total") * val / 100))
        .withColumn("_test", F.col("_val") + F.floor(F.col("_total") * test / 100))
    )

    def holds(rank: Column) -> Column:
        return (rank > F.col("_upto") - F.col("_n")) & (rank <= F.col("_upto"))

    edge = buckets.where(holds(F.col("_val")) | holds(F.col("_test")))
    ranked = rows.join(edge, ["_g", "_p"]).withColumn(
        "_rank",
        F.col("_upto") - F.col("_n") + F.row_number().over(Window.partitionBy("_g", "_p").orderBy("_key")),
    )
    cuts = ranked.groupBy("_g").agg(
        F.max(F.when(F.col("_rank") == F.col("_val"), F.col("_key"))).alias("_last_val"),
        F.max(F.when(F.col("_rank") == F.col("_test"), F.col("_key"))).alias("_last_test"),
    )
    if by is None:
        # Two cut keys for the whole table: two scalars in the comparison, no join.
        found = cuts.select("_last_val._h", "_last_val.image_id", "_last_test._h", "_last_test.image_id").first() or (None,) * 4
        placed = rows.select("image_id", "_key", *[_cut_key(rows, *found[i : i + 2]).alias(n) for i, n in ((0, "_last_val"), (2, "_last_test"))])
    else:
        placed = rows.join(cuts, "_g", "left")
    return placed.select(
        "image_id",
        F.when(F.col("_key") <= F.col("_last_val"), F.lit("val"))
        .when(F.col("_key") <= F.col("_last_test"), F.lit("test"))
        .otherwise(F.lit("train"))
        .alias("split"),
    )


def _cut_key(rows: DataFrame, digest: str | None, image_id) -> Column:
    kind = rows.schema["_key"].dataType
    if digest is None:
        return F.lit(None).cast(kind)
    return F.struct(F.lit(digest).alias("_h"), F.lit(image_id).cast(rows.schema["image_id"].dataType).alias("image_id"))
