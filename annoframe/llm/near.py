"""Near duplicates: improved consistent weighted sampling over tf-idf shingles, banded, verified, joined to classes.

1. Document counts. Shingles of five words in more than ``RARE`` of all documents weigh less (down to one half). They
   are found exactly in two passes without shuffling shingles: a block of documents reports what more than half of
   ``RARE`` of its documents hold; only a shingle reported often enough can be frequent (at most 2 / RARE times the mean
   number of shingles per document, so it may be broadcast), and those are then counted over all documents.
2. Every document gets ``BANDS * ROWS`` consistent weighted samples (with ``plain``, under both weights where they differ): two documents agree in one with the probability of
   their weighted Jaccard similarity. Rows are hashed to one key per band. Equal texts are one class from here on.
3. Classes that share a key form a bucket. Its pivot, the member that shares buckets with most others, is compared with
   all its members; of a small bucket all pairs are compared. Links join classes into components, and a bucket whose
   members are one component is done. In the others each member is written as its difference to the pivot: added and
   missing shingles with their weights. By the triangle inequality two members that the pivot leaves in different
   components can only be linked if their differences overlap by a known weight, so each member needs to offer only the
   rarest keys of its difference whose rest weighs less (a prefix), and only members that meet in one are compared.
   Nothing is lost inside a bucket, members with edits of their own meet nobody, and no bucket has a cap.
4. A link is a weighted Jaccard similarity of at least ``THRESHOLD`` over the whole texts, by tf-idf weights or, with
   ``plain``, also by plain counts: the shared shingles of a large group of near copies weigh less than the edits, so
   tf-idf alone raises the threshold there. Texts with frequent shingles are then sampled under both weights, so that
   either similarity is found. The registered query and the pipeline link by both. Classes are the connected
   components; the smallest key names a class.

Defined cases: texts without a word (null, empty, blank) are alike to nothing, not even each other. Texts of fewer
than five words have one shingle. A null key sorts before all others; rows equal in key and text count as copies, and
one of them stays. Other columns pass through whatever their names. An empty table gives an empty result.
Two texts at similarity s share a band with probability 1 - (1 - s^4)^10: 0.995 at 0.8, 0.9999 at 0.87.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annoframe.llm.common import keyed, unpacked
from annoframe.llm.shingles import MIX, Weights, mixed, shingles
from annoframe.session import cut

THRESHOLD = 0.8
BANDS, ROWS = 10, 4
#: Share of all documents above which a shingle loses weight.
RARE = 0.1
#: Documents of a block and, for long texts, shingles of a block: what one task holds at a time.
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 1 << 21
#: Members of a bucket of which all pairs are compared.
SMALL = 8
#: A link needs a sum of absolute differences of at most this share of the sum of both weights.
SLACK = (1 - THRESHOLD) / (1 + THRESHOLD)


# --- document counts -------------------------------------------------------------------------------------------------


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: its number of documents (hash 0, block row) and the shingles in more than RARE / 2 of them."""
    held: list[np.ndarray] = []
    size = 0

    def flush():
        u, df = np.unique(np.concatenate(held), return_counts=True)
        often = df > RARE / 2 * len(held)
        n = int(often.sum())
        return pa.RecordBatch.from_pydict(
            {
                "h": pa.array(np.append(u[often].view(np.int64), 0)),
                "df": pa.array(np.append(df[often], 0).astype(np.int64)),
                "docs": pa.array(np.full(n + 1, len(held), np.int64)),
                "block": pa.array(np.append(np.zeros(n, bool), True)),
            }
        )

    for batch in batches:
        for text in batch.column(0).to_pylist():
            h = shingles(text)[0]
            if len(h):
                held.append(h)
                size += len(h)
                if len(held) >= BLOCK_DOCS or size >= BLOCK_SHINGLES:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def _count(candidates: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                h = shingles(text)[0]
                at = np.minimum(np.searchsorted(candidates, h), len(candidates) - 1)
                total[at[candidates[at] == h]] += 1
        yield pa.RecordBatch.from_pydict({"h": pa.array(candidates.view(np.int64)), "df": pa.array(total)})

    return run


def document_counts(texts: DataFrame) -> tuple[dict[int, int], int]:
    """Exact document counts of the shingles in more than ``RARE`` of all documents, and the number of documents."""
    seen = cut(
        texts.mapInArrow(_reports, "h long, df long, docs long, block boolean")
        .groupBy("block", "h")
        .agg(F.sum("df").alias("df"), F.sum("docs").alias("docs"))
    )
    docs = seen.where("block").agg(F.sum("docs")).first()[0] or 0
    # Where a shingle was not reported it has at most RARE / 2 of the documents.
    possible = seen.where("NOT block").where(F.col("df") + RARE / 2 * (docs - F.col("docs")) > RARE * docs).select("h")
    found = np.sort(np.array([r[0] for r in possible.collect()], dtype=np.int64).view(np.uint64))
    if not len(found):
        return {}, docs
    exact = texts.mapInArrow(_count(found), "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))
    rows = exact.where(F.col("df") > RARE * docs).collect()
    return {r["h"] % (1 << 64): r["df"] for r in rows}, docs


# --- consistent weighted samples -------------------------------------------------------------------------------------


def _gamma2(levels: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middle of ``levels`` equal shares."""
    x = np.linspace(0, 40, 400_001)
    return np.interp((np.arange(levels) + 0.5) / levels, 1 - np.exp(-x) * (1 + x), x)


class Sampler:
    """Draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) per shingle and sample from the bits of one hash (4,096 levels each)."""

    LEVELS = 4096

    def __init__(self, samples: int):
        self.seeds = mixed(np.arange(1, samples + 1, dtype=np.uint64) * MIX[3])
        self.r = _gamma2(self.LEVELS)
        self.log_c = np.log(self.r)
        self.b = (np.arange(self.LEVELS) + 0.5) / self.LEVELS

    def least(self, h: np.ndarray, log_w: np.ndarray | None, starts: np.ndarray) -> np.ndarray:
        """Samples x documents: the least value, which names the sampled shingle and its level. ``log_w`` None: all weights are 1."""
        out = np.empty((len(self.seeds), len(starts)))
        low = np.uint64(self.LEVELS - 1)
        for k, seed in enumerate(self.seeds):
            z = (h ^ seed) * MIX[4]
            z ^= z >> np.uint64(32)
            z *= MIX[2]
            r = self.r[(z >> np.uint64(52)).view(np.int64)]
            b = self.b[((z >> np.uint64(40)) & low).view(np.int64)]
            value = self.log_c[((z >> np.uint64(28)) & low).view(np.int64)]
            level = 1 - b if log_w is None else np.floor(log_w / r + b) - b + 1
            value -= r * level
            out[k] = np.minimum.reduceat(value, starts)
        return out


def _band_keys(least: np.ndarray) -> np.ndarray:
    """Documents x bands."""
    bits = np.ascontiguousarray(least).view(np.uint64).reshape(BANDS, ROWS, -1)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * MIX[0], bits[:, 0].shape).copy()
    for i in range(ROWS):
        key = mixed((key ^ bits[:, i]) * MIX[3])
    return key.T


def _sign(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS)
        for batch in batches:
            keys: list[np.ndarray] = [np.empty(0, np.uint64)] * batch.num_rows
            solid = np.zeros(batch.num_rows, bool)
            rows: list[int] = []
            parts: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0

            def flush():
                lengths = np.array([len(p[0]) for p in parts])
                w = np.concatenate([p[1] for p in parts])
                log_w = None if (w == 1).all() else np.log(w)
                least = sampler.least(np.concatenate([p[0] for p in parts]), log_w, np.cumsum(lengths) - lengths)
                for row, own in zip(rows, _band_keys(least)):
                    keys[row] = np.union1d(keys[row], own)
                solid[rows] = True

            for i, text in enumerate(batch.column("text").to_pylist()):
                h, tf = shingles(text)
                if not len(h):
                    continue
                for w in weights.each(h, tf):
                    rows.append(i)
                    parts.append((h, w))
                    size += len(h)
                if size >= 1 << 15:
                    flush()
                    rows, parts, size = [], [], 0
            if rows:
                flush()
            offsets = np.cumsum([0, *map(len, keys)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("fp"), lists, pa.array(solid)], ["key", "fp", "bands", "solid"]
            )

    return run


# --- links and classes -----------------------------------------------------------------------------------------------


def _verify(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, tuple] = (None, ())
        for batch in batches:
            near = []
            for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if a != last[0]:
                    last = (a, shingles(a))
                near.append(weights.nearest(last[1], shingles(b)) >= THRESHOLD)
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    return run


def _weigh(weights: Weights):
    """A row per shingle: ``fp``, hash, weight and plain weight (the same without ``plain``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp, text in zip(batch.column("fp").to_pylist(), batch.column("text").to_pylist()):
                h, tf = shingles(text)
                each = weights.each(h, tf)
                columns = [pa.array([fp] * len(h)), pa.array(h.view(np.int64)), pa.array(each[0]), pa.array(each[-1])]
                yield pa.RecordBatch.from_arrays(columns, ["fp", "h", "w", "p"])

    return run


def _differ(weights: Weights):
    """A row per added or missing shingle of a member against its pivot: ``ref``, ``fp``, ``comp``, ``far``, key (of shingle and
    sign), and for tf-idf and plain weights the weight of the difference, its sum less SLACK of the member's weight, and
    SLACK of the pivot's weight, which that of every far member exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, tuple] = (None, ())
        for batch in batches:
            texts = zip(*(batch.column(c).to_pylist() for c in ("ref", "fp", "comp", "far", "text_a", "text_b")))
            for ref, fp, comp, far, a, b in texts:
                if a != last[0]:
                    last = (a, shingles(a))
                (ha, ta), (hb, tb) = last[1], shingles(b)
                h = np.union1d(ha, hb)
                at_a, at_b = np.searchsorted(h, ha), np.searchsorted(h, hb)
                diffs, heights, floors = [], [], []
                each_a, each_b = weights.each(ha, ta), weights.each(hb, tb)
                for wa, wb in ((each_a[0], each_b[0]), (each_a[-1], each_b[-1])):
                    diff = np.zeros(len(h))
                    diff[at_b] += wb
                    diff[at_a] -= wa
                    diffs.append(diff)
                    heights.append(np.abs(diff).sum() - SLACK * wb.sum())
                    floors.append(SLACK * wa.sum())
                on = (diffs[0] != 0) | (diffs[1] != 0)
                key = mixed(h[on] * MIX[3] + (diffs[1][on] > 0).astype(np.uint64))
                n = int(on.sum())
                columns = [pa.array([v] * n, t) for v, t in ((ref, pa.string()), (fp, pa.string()), (comp, pa.string()), (far, pa.bool_()))]
                columns.append(pa.array(key.view(np.int64)))
                for k in (0, 1):
                    columns += [pa.array(np.abs(diffs[k][on])), pa.array(np.full(n, heights[k])), pa.array(np.full(n, floors[k]))]
                yield pa.RecordBatch.from_arrays(columns, ["ref", "fp", "comp", "far", "h", "w0", "d0", "p0", "w1", "d1", "p1"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``comp``): the least node of each connected component, by min labels and pointer jumping."""
    both = cut(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("m"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", "comp", F.least("comp", "m").alias("c1"))
        up = labels.select(F.col("node").alias("c1"), F.col("comp").alias("c2"))
        step = cut(lower.join(up, "c1", "left").select("node", F.col("comp").alias("old"), F.least("c1", "c2").alias("comp")))
        labels = step.select("node", "comp")
        if step.where("old <> comp").isEmpty():
            return labels


class Classes:
    """The near-duplicate classes of one table of documents."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", plain: bool = False):
        self.docs, self.key, self.text = docs, key, text
        self.rows = docs.select(
            F.col(key).cast("long").alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("fp"), F.col(text).alias("text")
        )
        common, n = document_counts(docs.select(text))
        self.weights = Weights(common, n, RARE, plain)
        signed = self.rows.mapInArrow(_sign(self.weights), "key long, fp string, bands array<long>, solid boolean")
        self.signed = cut(signed)
        self.labels = self._join()

    def _texts(self, members: DataFrame, distinct: DataFrame) -> DataFrame:
        """One whole text for each class that meets another: that of its least key, so that copies stay apart."""
        wanted = distinct.join(members.select("fp").distinct(), "fp", "left_semi").select("fp", F.coalesce("key", F.lit(0)).alias("k"))
        rows = self.rows.withColumn("k", F.coalesce("key", F.lit(0)))
        return cut(rows.join(wanted, ["fp", "k"]).groupBy("fp").agg(F.any_value("text").alias("text")))

    def _may_link(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """The members that can still have a link: the shingles a text shares with any other member at all bound its
        similarity, so one that shares less than THRESHOLD of its weight, tf-idf and plain, has none. Nothing is lost by leaving it out."""
        rows = texts.join(members.select("fp").distinct(), "fp").mapInArrow(_weigh(self.weights), "fp string, h long, w double, p double")
        rows = cut(rows)
        shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", F.lit(1).alias("also"))
        share = lambda w: F.sum(F.col(w) * F.coalesce("also", F.lit(0))) / F.sum(w)
        kept = (
            rows.join(shared, "h", "left")
            .groupBy("fp")
            .agg(F.greatest(share("w"), share("p")).alias("share"))
            .where(F.col("share") >= THRESHOLD - 1e-9)
        )
        return members.join(cut(kept.select("fp")), "fp")

    def _join(self) -> DataFrame | None:
        """(``node``, ``comp``) for the classes of equal texts that are linked to another; None without links."""
        distinct = cut(self.signed.where("solid").groupBy("fp").agg(F.any_value("bands").alias("bands"), F.min("key").alias("key")))
        members = distinct.select("fp", F.explode("bands").alias("bucket"))
        shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        members = cut(members.join(shared, "bucket"))
        if members.isEmpty():
            return None
        texts = self._texts(members, distinct)
        # The member that shares buckets with most others stands nearest to all: few pivots, small differences.
        score = members.groupBy("fp").agg(F.sum("n").alias("score"))
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("score"), "fp"))
        # Spark keeps only the first ranks of each bucket before it shuffles.
        first = members.join(score, "fp").withColumn("__r", rank).where(F.col("__r") <= SMALL)
        heads = cut(
            first.where((F.col("__r") == 1) | (F.col("n") <= SMALL))
            .groupBy("bucket")
            .agg(F.max_by("fp", -F.col("__r")).alias("ref"), F.collect_list("fp").alias("p"))
        )
        pairs = (
            members.join(heads, "bucket")
            .select("fp", F.explode(F.filter("p", lambda q: q != F.col("fp"))).alias("q"))
            .select(F.least("fp", "q").alias("a"), F.greatest("fp", "q").alias("b"))
        )
        edges = self._verified(pairs, texts)
        if edges.isEmpty():
            labels = None
            named = members.withColumn("comp", F.col("fp"))
        else:
            labels = components(edges)
            named = members.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
        named = cut(named.where(F.col("n") > SMALL))
        spread = named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        open_members = cut(named.join(spread, "bucket").join(heads.select("bucket", "ref"), "bucket").select("ref", "fp", "comp").distinct())
        if open_members.isEmpty():
            return labels
        found = self._verified(self._meetings(self._may_link(open_members, texts), texts, labels), texts)
        if found.isEmpty():
            return labels
        return components(cut(edges.unionAll(found)))

    def _verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs whose whole texts are alike."""
        ta = texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a"))
        tb = texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b"))
        return cut(pairs.distinct().join(tb, "b").join(ta, "a").mapInArrow(_verify(self.weights), "a string, b string"))

    def _meetings(self, members: DataFrame, texts: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Pairs (``a``, ``b``) of members of one pivot but of different components whose differences to it may overlap
        enough. For a link the overlap must reach half the sum of both heights ``d``. A pair across components has a far
        member, not linked to the pivot, and such a height is over ``p``."""
        refs = members.select("ref").distinct()
        if labels is None:
            refs = refs.withColumn("ref_comp", F.col("ref"))
        else:
            refs = refs.join(labels.select(F.col("node").alias("ref"), F.col("comp").alias("ref_comp")), "ref", "left").withColumn("ref_comp", F.coalesce("ref_comp", "ref"))
        ta = texts.select(F.col("fp").alias("ref"), F.col("text").alias("text_a"))
        tb = texts.select("fp", F.col("text").alias("text_b"))
        whole = members.join(refs, "ref").select("ref", "fp", "comp", (F.col("comp") != F.col("ref_comp")).alias("far"))
        schema = "ref string, fp string, comp string, far boolean, h long, w0 double, d0 double, p0 double, w1 double, d1 double, p1 double"
        rows = cut(whole.join(tb, "fp").join(ta, "ref").mapInArrow(_differ(self.weights), schema))
        # A key that only one member has, or no far one, makes no pair.
        keys = (
            rows.groupBy("ref", "h")
            .agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("meets"), F.min("d0").alias("lo0"), F.min("d1").alias("lo1"))
            .where("n > 1 AND meets")
        )
        own = Window.partitionBy("ref", "fp")
        before = own.orderBy("n", "h").rowsBetween(Window.unboundedPreceding, -1)
        eps = 1e-6
        shared = rows.join(keys, ["ref", "h"]).withColumns({f"m{k}": F.sum(f"w{k}").over(own) for k in (0, 1)})
        # Partners have at least the height ``p`` where the member is near, and at least ``lo`` at this key.
        alive = shared.where(" OR ".join(f"(d{k} + greatest(lo{k}, IF(far, lo{k}, p{k}))) / 2 <= m{k} + {eps}" for k in (0, 1)))
        rest = alive.withColumns({f"r{k}": F.sum(f"w{k}").over(own) - F.coalesce(F.sum(f"w{k}").over(before), F.lit(0.0)) for k in (0, 1)})
        # Far members may meet near ones under any of their keys, and each other only under both prefixes.
        offered = " OR ".join(f"r{k} + {eps} >= (d{k} + p{k}) / 2" for k in (0, 1))
        rest = cut(rest.select("ref", "fp", "comp", "far", "h", "d0", "d1", "m0", "m1", F.expr(offered).alias("prefix")))
        x, y = rest.where("far").alias("x"), rest.where("prefix").alias("y")
        enough = " OR ".join(f"least(x.m{k}, y.m{k}) + {eps} >= (x.d{k} + y.d{k}) / 2" for k in (0, 1))
        met = x.join(y, F.expr(f"x.ref = y.ref AND x.h = y.h AND x.comp <> y.comp AND (x.prefix OR NOT y.far) AND ({enough})"))
        return met.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"))

    def _named(self) -> DataFrame:
        """Every row as (``key``, ``fp``, ``solid``, ``comp``)."""
        rows = self.signed.select("key", "fp", "solid")
        if self.labels is None:
            return rows.withColumn("comp", F.col("fp"))
        return rows.join(self.labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))

    def report(self) -> DataFrame:
        """Per row: its key, the least key of its class and the number of rows of the class."""
        named = self._named()
        ids = named.where("solid").groupBy("comp").agg(F.min_by("key", F.struct("key", "fp")).alias("class_id"), F.count(F.lit(1)).alias("class_size"))
        return named.join(ids, "comp", "left").select(
            F.col("key").alias(self.key),
            F.when(F.col("solid"), F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
            F.when(F.col("solid"), F.col("class_size")).otherwise(F.lit(1).cast("long")).alias("class_size"),
        )

    def representatives(self) -> DataFrame:
        """The rows of ``docs`` that stay: the least key of each class, and every text without a word."""
        named = self._named().where("solid")
        first = named.groupBy("comp").agg(F.min(F.struct("key", "fp")).alias("m")).select("m.key", "m.fp")
        same = named.groupBy("key", "fp").agg(F.count(F.lit(1)).alias("__n"))
        stay = first.join(same, (first.key.eqNullSafe(same.key)) & (first.fp == same.fp)).select(
            F.coalesce(first.key, F.lit(0)).alias("__id"), first.fp.alias("__fp"), first.key.isNull().alias("__null"), "__n"
        )
        blank = self.signed.where("NOT solid").select(F.coalesce("key", F.lit(0)).alias("__id"), F.col("fp").alias("__fp"), F.col("key").isNull().alias("__null")).distinct()
        stay = cut(stay.unionAll(blank.withColumn("__n", F.lit(1).cast("long"))))
        rows = keyed(self.docs, self.key, self.text).select(
            "__row", "__id", F.md5(F.coalesce("__text", F.lit(""))).alias("__fp"), F.col("__key").isNull().alias("__null")
        ).join(stay, ["__id", "__fp", "__null"])
        once = rows.where("__n > 1").dropDuplicates(["__id", "__fp", "__null"])
        return unpacked(rows.where("__n = 1").unionAll(once))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", plain: bool = False) -> DataFrame:
    return Classes(docs, key, text, plain).report()


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text", plain: bool = False) -> DataFrame:
    return Classes(docs, key, text, plain).representatives()
