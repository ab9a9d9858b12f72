"""Skew-safe building blocks: hot groups, grid pairing, chunked ranks.

A group (one image, one class, one session) may hold a third of all rows. Nothing here puts such
a group into one task: hot groups are found by a pre-aggregated count, boxes are paired by grid
cell, and ranks inside a huge group are computed chunk by chunk with chunk offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.session import cut


def hot_groups(tables: Sequence[DataFrame], keys: Sequence[str], limit: int) -> DataFrame | None:
    """Groups of ``keys`` with more than ``limit`` rows over all ``tables``; ``None`` if there are none.

    Counts are combined map-side, so only one row per group and task is shuffled. The result has at
    most rows/limit rows.
    """
    rows = tables[0].select(*keys)
    for other in tables[1:]:
        rows = rows.unionAll(other.select(*keys))
    hot = rows.groupBy(*keys).count().where(F.col("count") > limit).drop("count")
    return hot if hot.limit(1).count() else None


def split_hot(df: DataFrame, hot: DataFrame | None, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """``(bounded groups, hot groups)`` of ``df``."""
    if hot is None:
        return df, None
    return df.join(hot, list(keys), "left_anti"), df.join(hot, list(keys), "left_semi")


def _level(side: Column, cell: float) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log2(side / cell))).cast("int")


def _cells(level: Column, x0: Column, y0: Column, x1: Column, y1: Column, cell: float) -> Column:
    """Every (level, column, row) cell of one grid level that a box touches."""
    size = F.lit(cell) * F.pow(F.lit(2.0), level)
    columns = F.sequence(F.floor(x0 / size), F.floor(x1 / size))
    rows = F.sequence(F.floor(y0 / size), F.floor(y1 / size))
    return F.flatten(
        F.transform(
            columns,
            lambda c: F.transform(rows, lambda r: F.struct(level.alias("lv"), c.alias("cx"), r.alias("cy"))),
        )
    )


def _sit(df: DataFrame, p: str, cell: float) -> DataFrame:
    """One row per cell a box touches on its own level (at most four)."""
    x, y, w, h = (F.col(f"{p}{c}") for c in "xywh")
    return df.withColumn("_c", F.explode(_cells(_level(F.greatest(w, h), cell), x, y, x + w, y + h, cell)))


def _probe(df: DataFrame, p: str, cell: float, first: int, min_iou: float) -> DataFrame:
    """One row per cell on the levels from ``own + first`` to the largest a partner can have."""
    x, y, w, h = (F.col(f"{p}{c}") for c in "xywh")
    side = F.greatest(w, h)
    own = _level(side, cell) + first
    top = F.least(_level(side / min_iou, cell), F.lit(TOP_LEVEL)) if min_iou > 0 else F.lit(TOP_LEVEL)
    levels = F.when(top >= own, F.sequence(own, top)).otherwise(F.array().cast("array<int>"))
    return df.withColumn(
        "_c", F.explode(F.flatten(F.transform(levels, lambda lv: _cells(lv, x, y, x + w, y + h, cell))))
    )


TOP_LEVEL = 30


def grid_pairs(
    left: DataFrame, right: DataFrame, keys: Sequence[str], min_iou: float = 0.0, cell: float = 256.0
) -> DataFrame:
    """Join overlapping boxes that could reach ``min_iou``, each pair exactly once, on grid cells.

    ``left`` carries ``lx, ly, lw, lh`` and ``right`` carries ``rx, ry, rw, rh`` (positive sizes).
    A box lives on the grid level whose cell is at least as large as its longer side, so it touches
    at most four cells; the smaller box of a pair probes upwards. IoU >= t bounds the ratio of the
    longer sides by t, and so the levels to probe. A pair is emitted only in the cell holding the
    top-left corner of the intersection, so no distinct is needed.
    """

    def meet(lft: DataFrame, rgt: DataFrame) -> DataFrame:
        size = F.lit(cell) * F.pow(F.lit(2.0), F.col("_c.lv"))
        overlap = (
            (F.least(F.col("lx") + F.col("lw"), F.col("rx") + F.col("rw")) > F.greatest("lx", "rx"))
            & (F.least(F.col("ly") + F.col("lh"), F.col("ry") + F.col("rh")) > F.greatest("ly", "ry"))
        )
        here = (F.floor(F.greatest("lx", "rx") / size) == F.col("_c.cx")) & (
            F.floor(F.greatest("ly", "ry") / size) == F.col("_c.cy")
        )
        return lft.join(rgt, [*keys, "_c"]).where(overlap & here).drop("_c")

    up = meet(_probe(left, "l", cell, 0, min_iou), _sit(right, "r", cell))
    down = meet(_sit(left, "l", cell), _probe(right, "r", cell, 1, min_iou))
    return up.unionByName(down)


def chunked(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], sizes: DataFrame, max_rows: int
) -> tuple[DataFrame, bool]:
    """Add ``_chunk``: 0 everywhere when every group fits one task, else a range-partition number.

    ``sizes`` is any cheap table with the same group sizes (it is only counted). With a huge group
    the rows are range-partitioned on (group, order), which cuts the group at row boundaries, and
    the partition number is made durable before anything depends on it.
    """
    biggest = (
        sizes.groupBy(*group).count().agg(F.max("count")).first()[0]
        if group
        else sizes.count()
    ) or 0
    if biggest <= max_rows:
        return df.withColumn("_chunk", F.lit(0)), False
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-biggest // max_rows) * 2)
    ranged = df.repartitionByRange(parts, *group, *order).withColumn("_chunk", F.spark_partition_id())
    return cut(ranged), True


def chunk_offsets(df: DataFrame, group: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Per (group, chunk): the sum of every total over the chunks before it."""
    per_chunk = df.groupBy(*group, "_chunk").agg(*[v.alias(k) for k, v in totals.items()])
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        *group, "_chunk", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_before") for k in totals]
    )


def global_rank(
    df: DataFrame, order: Sequence[Column], name: str = "rank", group: Sequence[str] = (), max_rows: int = 1_000_000
) -> DataFrame:
    """1-based row number over a full order (or inside each group), never in a single task.

    Rows are range-partitioned on the order; each chunk ranks its own rows and adds the number of
    rows in the chunks before it.
    """
    spread, many = chunked(df, group, order, df, max_rows)
    local = F.row_number().over(Window.partitionBy(*group, "_chunk").orderBy(*order))
    if not many:
        return spread.withColumn(name, local.cast("long")).drop("_chunk")
    offsets = chunk_offsets(spread, group, {"_n": F.count(F.lit(1))})
    return (
        spread.withColumn("_local", local)
        .join(offsets, [*group, "_chunk"])
        .withColumn(name, (F.col("_local") + F.col("_n_before")).cast("long"))
        .select(*df.columns, name)
    )


def running_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    max_rows: int = 1_000_000,
) -> DataFrame:
    """Add running totals over each group's order; a huge group is summed chunk by chunk."""
    spread, many = chunked(df, group, order, df, max_rows)
    run = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if not many:
        return spread.withColumns({k: F.sum(v).over(run) for k, v in sums.items()}).drop("_chunk")
    before = chunk_offsets(spread, group, {k: F.sum(v) for k, v in sums.items()})
    local = spread.withColumns({k: F.sum(v).over(run) for k, v in sums.items()}).join(before, [*group, "_chunk"])
    return local.withColumns({k: F.col(k) + F.col(f"{k}_before") for k in sums}).select(*df.columns, *sums)


def _carried(
    spread: DataFrame, group: Sequence[str], order: Sequence[str], first: Column, last: Column, back: bool, ahead: bool
) -> DataFrame:
    """``spread`` with ``_back`` and ``_ahead``: what the chunks of its group before a row's chunk end with, and what those after it start with."""
    edges = spread.groupBy(*group, "_chunk").agg(first.alias("_first"), last.alias("_last"))
    chunks = Window.partitionBy(*group).orderBy("_chunk")
    before = F.last("_last", True).over(chunks.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_first", True).over(chunks.rowsBetween(1, Window.unboundedFollowing))
    carry = edges.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate([*group, "_chunk"])],
        *([before.alias("_back")] if back else []),
        *([after.alias("_ahead")] if ahead else []),
    )
    on = F.lit(True)
    for i, k in enumerate([*group, "_chunk"]):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return spread.join(carry, on).drop(*[f"_k{i}" for i in range(len(group) + 1)])


def neighbours(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    row: Column,
    back: str | None = None,
    ahead: str | None = None,
    sizes: DataFrame | None = None,
    max_rows: int = 1_000_000,
) -> DataFrame:
    """Add ``row`` (a struct) of the row before as ``back`` and of the row after as ``ahead``, null where there is none.

    A huge group is cut into ranges of its order; each range passes its first and last row on, so that only one row
    per range meets in a window over the whole group. ``sizes`` is a cheaper table with groups at least as large.
    """
    spread, many = chunked(df, group, order, df if sizes is None else sizes, max_rows)
    if many:
        key = F.struct(*order)
        spread = _carried(spread, group, order, F.min_by(row, key), F.max_by(row, key), back is not None, ahead is not None)
    w = Window.partitionBy(*group, *(["_chunk"] if many else [])).orderBy(*order)
    added = {}
    if back:
        added[back] = F.coalesce(F.lag(row).over(w), F.col("_back")) if many else F.lag(row).over(w)
    if ahead:
        added[ahead] = F.coalesce(F.lead(row).over(w), F.col("_ahead")) if many else F.lead(row).over(w)
    return spread.withColumns(added).select(*df.columns, *added)


def last_known(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str, max_rows: int = 1_000_000
) -> DataFrame:
    """Add the last non-null ``value`` of the rows before; a huge group passes it on from range to range."""
    spread, many = chunked(df, group, order, df, max_rows)
    if many:
        known = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
        spread = _carried(spread, group, order, known, known, True, False)
    w = Window.partitionBy(*group, *(["_chunk"] if many else [])).orderBy(*order)
    local = F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return spread.withColumn(name, F.coalesce(local, F.col("_back")) if many else local).select(*df.columns, name)


#: Quantiles taken of a hot group to bracket a rank, and the sketch's error as one part of so many.
GRID, ACCURACY = 1000, 10_000


def hot_percentiles(df: DataFrame, group: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """``group`` and the array ``p`` of interpolated percentiles of each group's non-null values, for few large groups.

    A mergeable sketch gives quantiles whose ranks are off by at most one part in ``ACCURACY``. Two of them, with twice
    that error to spare, bracket the ranks a percentile lies between; a second pass counts the values below the bracket and each distinct value in it.
    Results are exact; a task holds a sketch, and a window sorts some thousandths of a group.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    finite = F.when(F.isnan("_v"), F.lit(float("inf"))).otherwise(F.col("_v"))
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketch = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(finite, grid, ACCURACY).alias("_q"))
    places = []
    for i, share in enumerate(shares):
        at = F.lit(float(share)) * (F.col("_n") - 1)
        spare = 2.0 / ACCURACY
        lo = F.floor((F.floor(at) / F.col("_n") - spare) * GRID).cast("int")
        hi = F.ceil(((F.ceil(at) + 1) / F.col("_n") + spare) * GRID).cast("int")
        places.append(
            F.struct(
                F.lit(i).alias("i"),
                at.alias("at"),
                F.when(lo > 0, F.get("_q", lo)).alias("lo"),  # null: open
                F.when(hi < GRID, F.get("_q", hi)).alias("hi"),
            )
        )
    asked = cut(sketch.select(*group, F.explode(F.array(*places)).alias("_a")))
    below = F.coalesce(F.col("_v") < F.col("_a.lo"), F.lit(False))
    inside = F.col("_a.hi").isNull() | (F.col("_v") <= F.col("_a.hi"))
    counted = (
        rows.join(asked, list(group))
        .where(inside)
        .groupBy(*group, "_a", below.alias("_below"), F.when(~below, F.col("_v")).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    w = Window.partitionBy(*group, "_a").orderBy(F.desc("_below"), "_v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("_c").over(w))
    holds = lambda rank: (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank) & ~F.col("_below")
    at = F.col("_a.at")
    found = upto.groupBy(*group, "_a").agg(
        F.max(F.when(holds(F.floor(at)), F.col("_v"))).alias("_lo"), F.max(F.when(holds(F.ceil(at)), F.col("_v"))).alias("_hi")
    )
    part = at - F.floor(at)
    missed = F.col("_lo").isNull() | F.col("_hi").isNull()
    exact = F.when(missed, F.raise_error(F.lit("a rank lies outside the sketch's bracket"))).when(
        F.col("_lo") == F.col("_hi"), F.col("_lo")
    ).otherwise((1 - part) * F.col("_lo") + part * F.col("_hi"))
    listed = F.sort_array(F.collect_list(F.struct(F.col("_a.i").alias("i"), exact.alias("p"))))
    return found.groupBy(*group).agg(listed.alias("_l")).select(*group, F.col("_l.p").alias("p"))
