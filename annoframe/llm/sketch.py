"""Document fingerprints: every shingle hash below a fixed fraction of the hash range is kept.

A sketch is the sorted set of the kept 64-bit hashes of a document's shingles (five words; a shorter text is one
shingle). Sketches of parts merge by union, and since every document is cut at the same hash, intersections estimate
Jaccard similarity and containment between documents of any lengths. The smallest hash is kept even above the cut, so
that a text with a word never has an empty sketch. Equal texts have equal sketches.

The text that follows a document in key order comes from a window over ranges of keys: the cut points are quantiles of
the keys (found by one aggregate, placed by a 16-step search), and each range also gets a copy of the first row of the
next one. No text passes through one task that is not of its range.

Defined cases: a null or empty text has no shingle: an empty sketch, empty fingerprint, and likeness 1 to another empty
sketch and 0 to any other. Null keys come first; rows with equal keys are ordered by a hash of their text. One row alone
is its own next document. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.llm.common import let, words_of

WORDS = 5
#: One in FRACTION hashes is kept.
FRACTION = 4
#: Characters of text per range of keys, and the most ranges.
RANGE_CHARS, RANGES = 16_000_000, 1 << 16


def sketch(text: Column) -> Column:
    """Sorted distinct kept hashes of the text's shingles."""
    cut = -(1 << 63) + (1 << 64) // FRACTION

    def hashes(w: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)])
        )
        return F.when(F.size(w) >= WORDS, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    def kept(h: Column) -> Column:
        low = F.filter(h, lambda x: x < F.lit(cut))
        least = F.when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(h)
        return let(low, lambda x: F.when(F.size(x) > 0, F.sort_array(F.array_distinct(x))).otherwise(least))

    return let(words_of(text), lambda w: let(hashes(w), kept))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two parts together."""
    cut = -(1 << 63) + (1 << 64) // FRACTION
    both = F.sort_array(F.array_union(a, b))
    return let(both, lambda u: F.filter(u, lambda x, i: (x < F.lit(cut)) | (i == 0)))


def containment(a: Column, b: Column) -> Column:
    """The share of ``a``'s shingles that ``b`` has too."""
    return F.when(F.size(a) == 0, (F.size(b) == 0).cast("double")).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the shingles."""
    return let(
        F.size(F.array_intersect(a, b)),
        lambda n: F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(n / F.greatest(F.lit(1), F.size(a) + F.size(b) - n)),
    )


def fingerprint(kept: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits for each kept hash."""
    return F.array_join(F.transform(kept, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted cut points are at or below the key; -1 for null."""
    points = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    steps = [1 << i for i in reversed(range(max(1, len(cuts)).bit_length()))]
    placed = let(
        points,
        lambda p: F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, step: F.when(F.get(p, at + step - 1) <= key, at + step).otherwise(at),
        ),
    )
    return F.when(key.isNull(), F.lit(-1)).otherwise(placed)


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, ``text``, ``next``): each text with the whole next text in key order, the first after the last."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.length("text")), F.count("key")).first()
    n = min(RANGES, math.ceil((size[0] or 0) / RANGE_CHARS) or 1)
    cuts: list[int] = []
    if n > 1 and size[1]:
        shares = [i / n for i in range(1, n)]
        cuts = sorted(set(rows.agg(F.percentile_approx("key", shares, 100 * n)).first()[0]))
    placed = rows.withColumn("range", _range_of(F.col("key"), cuts)).withColumn("h", F.xxhash64("text"))
    # At most one row per range, RANGES in all: their order is a window over so few rows, and they may be broadcast.
    lead = F.struct(F.col("key").isNotNull().alias("solid"), F.col("key").alias("k"), F.col("h").alias("fh"))
    firsts = placed.groupBy(F.col("range").alias("from")).agg(F.min(lead).alias("f")).select("from", "f.k", "f.fh")
    firsts = firsts.withColumn("to", F.lag("from").over(Window.orderBy("from")))
    last = firsts.agg(F.max("from")).first()[0]
    firsts = F.broadcast(firsts.withColumn("to", F.coalesce("to", F.lit(last).cast("int"))))
    met = (F.col("range") == F.col("from")) & F.col("key").eqNullSafe(F.col("k")) & (F.col("h") == F.col("fh"))
    ghosts = placed.join(firsts, met).dropDuplicates(["from"]).select("key", "text", F.col("to").alias("range"), "h", F.lit(True).alias("ghost"))
    both = placed.withColumn("ghost", F.lit(False)).select("key", "text", "range", "h", "ghost").unionByName(ghosts)
    w = Window.partitionBy("range").orderBy("ghost", F.col("key").asc_nulls_first(), "h")
    return both.withColumn("next", F.lead("text").over(w))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and the likenesses of its own to that and to the next text's."""
    rows = with_next(docs, key, text)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.select("key", "range", "h", "ghost", n.cast("long").alias("n_chars"), edited.alias("edited"), sketch(F.col("text")).alias("own"))
    w = Window.partitionBy("range").orderBy("ghost", F.col("key").asc_nulls_first(), "h")
    rows = rows.withColumn("after", F.lead("own").over(w)).where("NOT ghost")
    rows = rows.withColumns({"edited_sha256": F.sha2(F.col("edited"), 256), "other": sketch(F.col("edited"))})
    return rows.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
