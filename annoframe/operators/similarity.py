"""Similar images, near-duplicate pairs and their clusters.

Vectors are ``vec_id, embedding``. Similarity is the cosine of the two vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.session import cut

# Most pivots kept on the driver and sent to every task, and rows of one comparison block: a vector is copied once for
# every block it meets. A block's product is made so many rows at a time.
MAX_PIVOTS = 256
BLOCK_ROWS = 8192
PRODUCT_ROWS = 1024


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, in doubles, JVM-side."""

    def dot(p: Column, q: Column) -> Column:
        both = F.zip_with(p, q, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(both, F.lit(0.0), lambda acc, v: acc + v)

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def similar_to(vectors: DataFrame, vec_id: int, threshold: float = 0.6, limit: int = 50) -> DataFrame:
    """The images most similar to one image, itself left out. One vector travels with the plan."""
    source = vectors.where(F.col("vec_id") == vec_id).select("embedding").first()
    if source is None:
        raise ValueError(f"no image {vec_id}")
    query = F.array(*[F.lit(float(v)) for v in source["embedding"]])
    scored = vectors.where(F.col("vec_id") != vec_id).select("vec_id", cosine(F.col("embedding"), query).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold).orderBy(F.desc("similarity"), "vec_id").limit(limit)


def _unit(batch: pd.Series) -> np.ndarray:
    m = np.stack(batch.to_numpy()).astype(np.float64) if len(batch) else np.zeros((0, 1))
    norm = np.sqrt((m * m).sum(1, keepdims=True))
    return m / np.where(norm == 0, 1, norm)


def similar_pairs(vectors: DataFrame, threshold: float = 0.92, pivots: int = 64, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every pair ``a < b`` with cosine at or above the threshold, exactly.

    Unit vectors at cosine c are ``sqrt(2 - 2c)`` apart. Each vector lives in the cell of its nearest
    pivot and, by the triangle inequality, can only have partners in cells whose pivot is at most
    twice that distance farther than its own. It is sent to those cells alone. A cell of any size is
    cut into blocks of ``block_rows``, compared block against block by matrix products; only pairs
    that pass leave a task. Vectors travel as they were given and are scaled where they are compared.
    """
    if not -1.0 < threshold <= 1.0:
        raise ValueError("threshold must be in (-1, 1]")
    chosen = vectors.orderBy(F.md5(F.col("vec_id").cast("string"))).limit(min(pivots, MAX_PIVOTS)).select("embedding")
    base = _unit(pd.Series([row["embedding"] for row in chosen.collect()]))
    if not len(base):
        return vectors.selectExpr("vec_id as a", "vec_id as b", "0D as similarity").limit(0)
    slack = 2 * math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            unit = _unit(pdf["embedding"])
            far = np.sqrt(np.maximum(0.0, 2 - 2 * unit @ base.T))
            home = far.argmin(1)
            near = far <= far.min(1, keepdims=True) + slack
            # A pair of cells is compared once, from the larger cell number's side.
            near &= np.arange(len(base)) <= home[:, None]
            cells = [np.flatnonzero(row).tolist() for row in near]
            yield pd.DataFrame(
                {"vec_id": pdf["vec_id"], "given": pdf["embedding"], "home": home.astype(np.int32), "cells": cells}
            )

    kind = vectors.schema["embedding"].dataType.simpleString()
    placed = cut(
        vectors.select("vec_id", "embedding").mapInPandas(
            place, f"vec_id bigint, given {kind}, home int, cells array<int>"
        )
    )
    sizes = placed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("home").alias("cell"), F.ceil(F.col("n") / block_rows).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks").cast("long")).cast("int")
    members = (
        placed.withColumnRenamed("home", "cell")
        .join(sizes, "cell")
        .select("cell", block.alias("block"), F.col("vec_id").alias("host_id"), F.col("given").alias("host"))
    )
    # Visitors of a cell go to each of its blocks, in bounded groups of their own.
    visits = placed.select("vec_id", "given", "home", F.explode("cells").alias("cell"))
    groups = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("v")).select(
        "cell", F.ceil(F.col("v") / block_rows).cast("int").alias("groups")
    )
    plan = sizes.join(groups, "cell")
    visitors = visits.join(plan, "cell").select(
        "cell",
        F.pmod(F.xxhash64("vec_id"), F.col("groups").cast("long")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "vec_id",
        "given",
        (F.col("home") == F.col("cell")).alias("own"),
    )
    hosts = members.join(groups, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), "block", "host_id", "host"
    )
    low = float(threshold)

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "similarity": []}).astype({"a": "int64", "b": "int64"})
        theirs = _unit(right["host"]).T
        found = []
        for first in range(0, len(left), PRODUCT_ROWS):
            some = left.iloc[first : first + PRODUCT_ROWS]
            sims = _unit(some["given"]) @ theirs
            i, j = np.nonzero(sims >= low)
            x, y = some["vec_id"].to_numpy()[i], right["host_id"].to_numpy()[j]
            # Inside one cell both orders meet; between cells a pair meets once.
            good = np.where(some["own"].to_numpy()[i], x < y, x != y)
            x, y, s = x[good], y[good], sims[i, j][good]
            found.append(pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "similarity": np.minimum(s, 1.0)}))
        return pd.concat(found)

    keys = ["cell", "part", "block"]
    return visitors.groupBy(*keys).cogroup(hosts.groupBy(*keys)).applyInPandas(
        compare, "a bigint, b bigint, similarity double"
    )


def neighbours(pairs: DataFrame, k: int = 10) -> DataFrame:
    """Each source's ``k`` most similar partners, ranked by similarity, then id.

    A pair is stored once; the rank filter is applied before rows of one source meet.
    """
    both = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"), "similarity").unionAll(
        pairs.select("b", "a", "similarity")
    )
    order = Window.partitionBy("src").orderBy(F.desc("similarity"), "dst")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def near_duplicates(pairs: DataFrame, k: int = 10, max_pairs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(edges, flags)``: pairs one side of which ranks the other among its ``k``; caps are flagged."""
    ranked = neighbours(pairs, k).select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "similarity"
    )
    edges = ranked.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
    flags = edges.agg(F.count(F.lit(1)).alias("pairs")).withColumn(
        "pairs_capped", F.lit(False) if max_pairs is None else F.col("pairs") > max_pairs
    )
    if max_pairs is not None:
        edges = edges.orderBy(F.desc("similarity"), "a", "b").limit(max_pairs)
    return edges, flags


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` with the smallest id of each connected component as its label.

    Alternates large-star and small-star steps: only minima per node are aggregated, so a node with
    most of the edges is combined before the shuffle. Each round is made durable.
    """
    now = cut(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = now.unionAll(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        linked = down.join(low, "u")
        small = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v"))
        )
        now = cut(small.distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).unionAll(
        now.select("v", "v").distinct()
    )


def duplicate_groups(edges: DataFrame) -> DataFrame:
    """Per cluster its size, largest similarity and redundant images (size - 1)."""
    edges = cut(edges)  # read twice: the pairs are not compared again
    labels = cut(components(edges))
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    strength = (
        edges.join(labels.withColumnRenamed("id", "a"), "a").groupBy("label").agg(F.max("similarity").alias("max_similarity"))
    )
    return sizes.join(strength, "label").withColumn("redundant", F.col("size") - 1)
