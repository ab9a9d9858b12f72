"""Overlapping runs of two sides per image, by a sweep over sorted starts.

Rows are masks: ``image_id``, a key and the arrays ``starts`` and ``lens`` of its runs; several rows may share a key. Rows of an
image come together once. Inside a task the runs of both sides are sorted by start: of two overlapping runs the later start lies
inside the other run, so two binary searches a run give every overlap once, and nothing that does not overlap is looked at.

An image of more than ``HOT_RUNS`` runs is cut at pixel places that share its runs evenly; a run that is active at a
border is carried on as a piece of its own in the next chunk, pieces add up, and so one image may fill many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.session import cut

HOT_RUNS = 1 << 21
#: Runs a task sweeps over at a time (whole images); a sweep holds some 20 numbers a run.
HELD_RUNS = 1 << 17


def one_run(start: Column, length: Column) -> dict[str, Column]:
    """The arrays of a row that is a single run."""
    return {"starts": F.array(start.cast("long")), "lens": F.array(length.cast("long"))}


def _numbers(keys: pa.Array) -> np.ndarray:
    return keys.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _dense(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes from 0 without gaps, and for each code a row that has it."""
    _, first, dense = np.unique(codes, return_index=True, return_inverse=True)
    return dense, first


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) for every i and every j in ``lo[i] .. hi[i] - 1``."""
    n = np.maximum(hi - lo, 0)
    i = np.repeat(np.arange(len(n)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + lo[i]


def swept(group: np.ndarray, side: np.ndarray, key: np.ndarray, offsets: np.ndarray, start: np.ndarray, length: np.ndarray):
    """Rows (group, side, key) with runs ``offsets[i] .. offsets[i + 1]``: per overlapping (group, left key, right key) a row
    of each side, the shared pixels and both areas."""
    row = np.repeat(np.arange(len(group)), np.diff(offsets))
    solid = length > 0
    row, start, length = row[solid], start[solid], length[solid]
    none = np.empty(0, np.int64)
    if not len(row):
        return none, none, none, none, none
    start = start - start.min()
    width = int((start + length).max()) + 1
    at = group[row] * width + start
    mask, first = _dense(group * (int(key.max()) + 1) + key + np.where(side, (int(group.max()) + 1) * (int(key.max()) + 1), 0))
    own = mask[row]
    area = np.bincount(own, weights=length, minlength=len(first)).astype(np.int64)
    sides = []
    for wanted in (False, True):
        mine = np.flatnonzero(side[row] == wanted)
        mine = mine[np.argsort(at[mine], kind="stable")]
        sides.append((at[mine], at[mine] + length[mine], own[mine]))
    (ls, le, lm), (rs, re, rm) = sides
    i, j = _spread(np.searchsorted(rs, ls), np.searchsorted(rs, le))
    q, p = _spread(np.searchsorted(ls, rs, side="right"), np.searchsorted(ls, re))
    pixels = np.concatenate([np.minimum(le[i], re[j]) - rs[j], np.minimum(le[p], re[q]) - ls[p]])
    pair = np.concatenate([lm[i] * len(first) + rm[j], lm[p] * len(first) + rm[q]])
    if not len(pair):
        return none, none, none, none, none
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    left, right = pair[heads] // len(first), pair[heads] % len(first)
    return first[left], first[right], np.add.reduceat(pixels[order], heads), area[left], area[right]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def result(table: pa.Table) -> pa.RecordBatch:
        rows = table.combine_chunks().to_batches()[0]
        image, key, starts = rows.column("image_id"), rows.column("key"), rows.column("starts")
        group = _groups(image, rows.column("chunk"))
        numbers = lambda name: rows.column(name).flatten().to_numpy(zero_copy_only=False)
        offsets = starts.offsets.to_numpy() - starts.offsets[0].as_py()
        steps = np.append(0, np.cumsum(numbers("starts")))
        begins = steps[1:] - np.repeat(steps[offsets[:-1]], np.diff(offsets))
        left, right, pixels, la, ra = swept(
            group, rows.column("right").to_numpy(zero_copy_only=False), _numbers(key), offsets, begins, numbers("lens")
        )
        arrays = [image.take(pa.array(left)), key.take(pa.array(left)), key.take(pa.array(right)), pa.array(pixels), pa.array(la), pa.array(ra)]
        return pa.RecordBatch.from_arrays(arrays, ["image_id", "l", "r", "pixels", "left_area", "right_area"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += len(batch.column("starts").flatten())
        if size >= HELD_RUNS:
            table = pa.Table.from_batches(held)
            group = _groups(table.column("image_id").combine_chunks(), table.column("chunk").combine_chunks())
            last = int(np.searchsorted(group, group[-1]))  # rows of the last image may go on in the next batch
            if last:
                yield result(table.slice(0, last))
            held = table.slice(last).to_batches()
            size = sum(len(b.column("starts").flatten()) for b in held)
    if held:
        yield result(pa.Table.from_batches(held))


def _groups(image: pa.Array, chunk: pa.Array) -> np.ndarray:
    """Numbers of the (image, chunk) that rows side by side share."""
    a, b = _numbers(image), chunk.to_numpy(zero_copy_only=False)
    return np.append(0, np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1])))


def _stepped(rows: DataFrame) -> DataFrame:
    """Each start as the step from the one before: mostly equal numbers, which a shuffle packs to a fraction."""
    step = F.transform("starts", lambda v, i: v - F.when(i > 0, F.get("starts", i - 1)).otherwise(F.lit(0)))
    return rows.withColumn("starts", F.when(F.size("starts") > 1, step).otherwise(F.col("starts")))


def _swept(rows: DataFrame) -> DataFrame:
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    together = _stepped(rows).repartition("image_id", "chunk").sortWithinPartitions("image_id", "chunk")
    schema = f"image_id {kind['image_id']}, l {kind['key']}, r {kind['key']}, pixels bigint, left_area bigint, right_area bigint"
    return together.mapInArrow(_sweep, schema)


def _chunked(rows: DataFrame, sizes: DataFrame, hot_runs: int) -> DataFrame:
    """Rows of hot images cut at places that share the runs of an image evenly, a row per (row, chunk)."""
    runs = rows.select("image_id", "key", "right", F.inline(F.arrays_zip(F.col("starts").alias("start"), F.col("lens").alias("len")))).where("len > 0")
    # A sample of an image's starts, as many per chunk, gives its borders: evenness is all they are for.
    share = F.least(F.lit(1.0), 64.0 * F.ceil(F.col("n") / hot_runs) / F.col("n"))
    picked = F.pmod(F.xxhash64("start", "key"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    starts = runs.join(sizes.select("image_id", "n", share.alias("share")), "image_id").where(picked)
    place = F.sort_array(F.collect_list("start"))
    parts = F.ceil(F.max("n") / hot_runs).cast("int") + 1
    borders = starts.groupBy("image_id").agg(place.alias("s"), parts.alias("parts"))
    cuts = F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.col("parts") - 1), lambda i: F.element_at("s", F.greatest(F.lit(1), (F.size("s") * i / F.col("parts")).cast("int"))))
    )
    borders = cut(borders.select("image_id", cuts.alias("cuts")))
    # The chunk of a pixel is the number of borders at or before it.
    before = lambda p: F.size(F.filter("cuts", lambda c: c <= p))
    spread = runs.join(borders, "image_id", "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<bigint>")))
    end = F.col("start") + F.col("len")
    spread = spread.withColumn("chunk", F.explode(F.sequence(before(F.col("start")), before(end - 1))))
    lo = F.greatest("start", F.coalesce(F.get("cuts", F.col("chunk") - 1), F.col("start")))
    hi = F.least(end, F.coalesce(F.get("cuts", F.col("chunk")), end))
    return spread.select("image_id", "chunk", "key", "right", *[v.alias(k) for k, v in one_run(lo, hi - lo).items()])


def overlaps(left: DataFrame, right: DataFrame, key: str, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``image_id, l, r, pixels, left_area, right_area`` of the keys that share pixels, one row each. Rows without image or
    key, and runs without pixels, meet nothing."""
    of = lambda df, is_right: df.select(
        "image_id", F.col(key).alias("key"), F.lit(is_right).alias("right"), F.lit(0).alias("chunk"), "starts", "lens"
    ).where(F.size("starts") > 0)
    rows = of(left, False).unionAll(of(right, True)).where("image_id IS NOT NULL AND key IS NOT NULL")
    sizes = rows.groupBy("image_id").agg(F.sum(F.size("starts")).alias("n")).where(F.col("n") > hot_runs)
    hot = cut(sizes)
    if hot.isEmpty():
        return _swept(rows)
    chunks = _chunked(rows.join(hot.select("image_id"), "image_id", "left_semi"), hot, hot_runs)
    shared = _swept(chunks).groupBy("image_id", "l", "r").agg(F.sum("pixels").alias("pixels"))
    length = F.aggregate("lens", F.lit(0).cast("long"), lambda a, n: a + F.greatest(n, F.lit(0).cast("long")))
    areas = rows.join(hot.select("image_id"), "image_id", "left_semi").groupBy("image_id", "key", "right").agg(F.sum(length).alias("area"))
    la = areas.where("NOT right").select("image_id", F.col("key").alias("l"), F.col("area").alias("left_area"))
    ra = areas.where("right").select("image_id", F.col("key").alias("r"), F.col("area").alias("right_area"))
    large = shared.join(la, ["image_id", "l"]).join(ra, ["image_id", "r"]).select("image_id", "l", "r", "pixels", "left_area", "right_area")
    return _swept(rows.join(hot.select("image_id"), "image_id", "left_anti")).unionAll(large)
