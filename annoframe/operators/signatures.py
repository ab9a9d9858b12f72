"""Near pairs of vectors by banded random-hyperplane signatures (J6, W3, A18 at high thresholds).

Each vector gets sign bits against fixed random hyperplanes; two vectors at angle v agree in a bit with probability
1 - v / pi. The bits are cut into bands, vectors that agree in a whole band are candidates, a sketch of the first bands thins
them out, and the cosine of the vectors decides. Bits a band grow with the logarithm of the table, so that unlike vectors
rarely meet, and the number of bands follows from the recall asked for: candidates grow as a power of the table that is
near one for high thresholds (1.2 at 0.92). At low thresholds no signature helps; ``similarity.similar_pairs`` compares exactly.

Only keys and sketches are shuffled by band, once; whole vectors are joined to the candidates that are left. Equal vectors are
collapsed to the one of least id first and come back as pairs with it, so that a hot group of copies makes no bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.operators.similarity import cosine, duplicate_groups, near_duplicates
from annoframe.session import cut

SEED = 20_240
#: Unlike vectors in a bucket, about. Fewer need longer keys, and so more bands to shuffle.
BUCKET = 16
#: Bits that go with a key, at least (as far as the bands have them): enough to tell pairs that only share a band.
SKETCH_BITS = 192


@dataclass(frozen=True)
class Plan:
    """Bands of so many bits, for a threshold."""

    bands: int
    bits: int
    threshold: float
    recall: float

    @staticmethod
    def of(rows: int, threshold: float, recall: float) -> Plan:
        """Buckets hold some ``BUCKET`` unlike vectors; bands enough for pairs at the threshold to be found with ``recall``."""
        bits = min(60, max(8, math.ceil(math.log2(max(rows, 2) / BUCKET))))
        miss = 1 - agreement(threshold) ** bits
        # Half of what may be missed is left to the sketch.
        bands = math.ceil(math.log((1 - recall) / 2) / math.log(miss)) if miss > 0 else 1
        return Plan(max(1, bands), bits, threshold, recall)

    @property
    def per_word(self) -> int:
        """Whole bands in a 64-bit word of the sketch."""
        return 64 // self.bits

    @property
    def words(self) -> int:
        """64-bit words of the sketch, which holds the first bands."""
        return -(-min(self.bands, -(-SKETCH_BITS // self.bits)) // self.per_word)

    @property
    def sketched(self) -> int:
        """Bands that the sketch holds."""
        return min(self.bands, self.words * self.per_word)

    @property
    def most_differing(self) -> int:
        """Bits of the sketch in which a pair at the threshold differs at most, but for a share of half of what may be missed."""
        n, q = self.sketched * self.bits, 1 - agreement(self.threshold)
        rest, over = (1 - self.recall) / 2, 0.0
        for m in range(n, 0, -1):
            over += math.comb(n, m) * q**m * (1 - q) ** (n - m)
            if over > rest:
                return m
        return 1


def agreement(similarity: float) -> float:
    """Probability that two vectors of this cosine lie on the same side of a random hyperplane."""
    return 1 - math.acos(max(-1.0, min(1.0, similarity))) / math.pi


def _signer(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            n, column = batch.num_rows, batch.column("embedding")
            if not n:
                continue
            sizes = np.diff(column.offsets.to_numpy())
            if (sizes != sizes[0]).any():
                raise ValueError("vectors of one table must have one length")
            dim = int(sizes[0])
            if dim not in planes:
                planes[dim] = np.random.default_rng(SEED).standard_normal((dim, plan.bands * plan.bits))
            signs = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, dim) @ planes[dim] > 0
            keys = signs.reshape(n, plan.bands, plan.bits) @ (1 << np.arange(plan.bits, dtype=np.int64))
            words = np.zeros((n, plan.words), np.int64)
            for band in range(plan.sketched):
                words[:, band // plan.per_word] |= keys[:, band] << (band % plan.per_word * plan.bits)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * plan.bands), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), lists, *[pa.array(np.ascontiguousarray(words[:, i])) for i in range(plan.words)]],
                ["vec_id", "keys", *[f"s{i}" for i in range(plan.words)]],
            )

    return run


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(one vector of each, copies as vec_id and first)``. Vectors that are null, empty, not finite or all zero have no
    direction and are left out."""
    whole = vectors.where(F.size("embedding") > 0).where(
        F.expr("NOT exists(embedding, v -> v IS NULL OR isnan(v) OR abs(v) = double('inf')) AND exists(embedding, v -> v <> 0)")
    )
    firsts = cut(whole.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n")))
    again = firsts.where("n > 1").select("embedding", F.col("vec_id").alias("first"))
    copies = whole.join(again, "embedding").where("vec_id > first").select("vec_id", "first")
    return firsts.select("vec_id", "embedding"), copies


def candidates(firsts: DataFrame, plan: Plan) -> DataFrame:
    """(``a``, ``b``) once each, ``a < b``: the pairs that share a band and whose sketches differ little."""
    words = [f"s{i}" for i in range(plan.words)]
    schema = "vec_id bigint, keys array<bigint>, " + ", ".join(f"{w} bigint" for w in words)
    signed = cut(firsts.select("vec_id", "embedding").mapInArrow(_signer(plan), schema))
    rows = signed.select("vec_id", F.posexplode("keys").alias("band", "key"), *words)
    left = rows.select("band", "key", F.col("vec_id").alias("a"), *[F.col(w).alias(f"a_{w}") for w in words])
    right = rows.select("band", "key", F.col("vec_id").alias("b"), *[F.col(w).alias(f"b_{w}") for w in words])
    apart = [F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}")) for w in words]
    differing = sum((F.bit_count(x) for x in apart), F.lit(0))
    met = left.join(right, ["band", "key"]).where("a < b").where(differing <= plan.most_differing)
    # A near pair shares many bands; one that met in a band of the sketch already is not given again.
    before = F.lit(False)
    for band in range(plan.sketched):
        mask = ((1 << plan.bits) - 1) << (band % plan.per_word * plan.bits)
        own = F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")
        before = before | ((F.col("band") > band) & (apart[band // plan.per_word].bitwiseAND(own) == 0))
    return met.where(~before).select("a", "b").distinct()


def near_pairs(vectors: DataFrame, threshold: float = 0.92, recall: float = 0.99) -> DataFrame:
    """``a, b, similarity`` with cosine at or above the threshold: pairs of different vectors, each found with at least
    ``recall``, and each copy with the first vector equal to it."""
    if not 0.0 < threshold <= 1.0 or not 0.0 < recall < 1.0:
        raise ValueError("threshold must be in (0, 1], recall in (0, 1)")
    firsts, copies = distinct_vectors(vectors)
    met = candidates(firsts, Plan.of(firsts.count(), threshold, recall))
    of = lambda p: firsts.select(F.col("vec_id").alias(p), F.col("embedding").alias(f"v{p}"))
    scored = met.join(of("a"), "a").join(of("b"), "b").select("a", "b", F.least(F.lit(1.0), cosine(F.col("va"), F.col("vb"))).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold).unionAll(
        copies.select(F.col("first").alias("a"), F.col("vec_id").alias("b"), F.lit(1.0).alias("similarity"))
    )


def duplicate_report(
    vectors: DataFrame,
    threshold: float = 0.92,
    neighbours: int = 10,
    sample: int | None = None,
    max_pairs: int | None = None,
    recall: float = 0.99,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(edges, groups, flags)``.

    With ``sample`` only pairs with one of the first so many ids as source are kept, and with ``max_pairs`` only the
    most similar ones; ``flags`` (one row) says what was analysed and which cap took effect.
    """
    pairs = cut(near_pairs(vectors, threshold, recall))
    if sample is not None:
        sources = cut(vectors.orderBy("vec_id").limit(sample).select("vec_id"))
        mine = pairs.join(sources, pairs.a == sources.vec_id, "left_semi")
        pairs = cut(mine.unionAll(pairs.join(sources, pairs.b == sources.vec_id, "left_semi")).distinct())
    edges = cut(near_duplicates(pairs, neighbours)[0])
    kept = edges if max_pairs is None else cut(edges.orderBy(F.desc("similarity"), "a", "b").limit(max_pairs))
    groups = duplicate_groups(kept)
    none = F.lit(0).cast("long")
    # One row of counts from three tables: their rows side by side under one aggregate.
    rows = vectors.select(F.lit(1).cast("long").alias("image"), none.alias("pair"), none.alias("group"), none.alias("size"))
    rows = rows.unionAll(edges.select(none, F.lit(1).cast("long"), none, none)).unionAll(groups.select(none, none, F.lit(1).cast("long"), "size"))
    sums = rows.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in ("image", "pair", "group", "size")])
    analysed = F.col("image") if sample is None else F.least("image", F.lit(sample).cast("long"))
    flags = sums.select(
        F.col("image").alias("total_images"),
        analysed.alias("analyzed"),
        (analysed < F.col("image")).alias("sample_capped"),
        F.col("pair").alias("pairs"),
        (F.lit(False) if max_pairs is None else F.col("pair") > max_pairs).alias("pairs_capped"),
        F.col("group").alias("group_count"),
        F.col("size").alias("duplicate_image_count"),
        (F.col("size") - F.col("group")).alias("redundant_count"),
    )
    return kept, groups, flags
