"""Spelling variants: asymmetric q-chunks join words one edit apart; each word takes its most frequent near word as form.

1. Counting. Tasks take the runs of letters of each whole text, count them per document, and add up the counts of many
   documents before anything is shuffled. Spark sums them per word.
2. Candidates. Of two words one edit apart the longer (either, if equally long) is cut into two disjoint chunks of
   ``q = length // 2`` code points, the head at place 0 and the tail at ``length - q``. One edit touches at most one chunk,
   so the other stands whole in the shorter word, moved by at most one place. The shorter word contributes its positional
   grams of that length. A surviving head stands at place 0, a surviving tail at the end, so of all positional grams
   those two per partner length (its own, or one more) are the only ones within shift one that can meet a chunk,
   and only they are made. Words meet on (partner length, chunk, gram).
3. Hot chunks. A chunk that more than ``LIMIT`` words hold is dealt again: what is left of the word beside the chunk is
   cut into two chunks in its turn, and so on until a group is small or one code point is left, when all its words are
   near. So every pair is found, and no group is paired with itself while it is large. The limit never changes the result.
4. Verification. A pair is near if its edit distance is one. A pair that meets on several chunks counts where it
   meets first: a tail is only taken if the heads differ.
5. Forms. A word's form is its near word of largest count (ties: the least in code-point order), if that count is at least
   ``RATIO`` times its own. Counts grow along a chain of forms, so it ends; pointer doubling finds its end, the root.

Defined cases: null and empty texts have no words. A null key is written as nothing where places are drawn by key.
Repeated rows count again. Other columns are not read. An empty table gives an empty result. Words of any length are
handled. A word without a near word has ``n_near`` 0, no form, and itself as root.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.session import cut

#: Letters of a word (fixed values), and the only ones whose case is folded.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
#: Words of one chunk that are paired directly.
LIMIT = 48
#: Distinct words a task holds before it hands its counts on.
HELD = 200_000

Rewrite = Callable[[str, str], str]


def _lower(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(LOWER)


def lose_a_letter(key: str, word: str) -> str:
    """The rule of the registered query: some words of some documents lose one code point, drawn by key and word."""
    h = crc32(f"{key}:{word}".encode())
    return word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]


def _same(key: str, word: str) -> str:
    return word


def _counter(rewrite: Rewrite, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                key, own = "" if key is None else key, {}
                for found in LETTERS.findall(text or ""):
                    own[found] = own.get(found, 0) + 1
                for found, n in own.items():
                    word = rewrite(key, _lower(found))
                    if len(word) >= min_chars:
                        total[word] = total.get(word, 0) + n
                if len(total) >= HELD:
                    yield handed()
                    total.clear()
        yield handed()

    return run


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite = _same, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT
) -> DataFrame:
    """(``word``, ``n``): words of at least ``min_chars`` code points with at least ``min_count`` occurrences overall."""
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    parts = rows.mapInArrow(_counter(rewrite, min_chars), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row's rest ``[lo, hi)`` cut once more: a row for the head and one for the tail of the rest.

    ``size`` is the length of the longer word of the pairs sought. ``met`` spells the chunks held so far, and ``differ``
    is the least length at which the words of a pair must differ already (so that a pair counts once).
    """
    q = ((F.col("hi") - F.col("lo") + F.col("size") - F.col("chars")) / 2).cast("int")
    piece = lambda at: F.substr("word", at + 1, q)
    head = F.struct(
        F.concat("met", F.lit("<"), piece(F.col("lo"))).alias("met"), (F.col("lo") + q).alias("lo"), F.col("hi"), F.col("differ")
    )
    tail = F.struct(
        F.concat("met", F.lit(">"), piece(F.col("hi") - q)).alias("met"),
        F.col("lo"),
        (F.col("hi") - q).alias("hi"),
        F.least("differ", F.col("lo") + q).alias("differ"),
    )
    return rows.withColumn("c", F.explode(F.array(head, tail))).select(
        "word", "n", "chars", "size", F.col("c.met").alias("met"), F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"), F.col("c.differ").alias("differ")
    )


def _paired(rows: DataFrame) -> DataFrame:
    """Pairs one edit apart among rows that hold the same chunks: ``a`` is cut in chunks, ``b`` gives the grams."""
    side = lambda p: [F.col(c).alias(f"{c}_{p}") for c in ("word", "n", "chars")]
    a = rows.where("chars = size").select("size", "met", "differ", *side("a"))
    b = rows.select("size", "met", *side("b"))
    return (
        a.join(b, ["size", "met"])
        .where("chars_b < size OR word_a < word_b")
        .where("left(word_a, differ) <> left(word_b, differ)")
        .where(F.levenshtein("word_a", "word_b", 1) == 1)
        .select("word_a", "n_a", "word_b", "n_b")
    )


def near_pairs(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(``word_a``, ``n_a``, ``word_b``, ``n_b``): every pair of distinct ``words`` one edit apart, once."""
    chars = F.length("word")
    sized = words.withColumn("chars", chars).withColumn("size", F.explode(F.array(chars, chars + 1)))
    whole = sized.select("word", "n", "chars", "size", F.lit("").alias("met"), F.lit(0).alias("lo"), F.col("chars").alias("hi"), F.lit(1 << 30).alias("differ"))
    # A longer word of one code point has no two chunks: words of one code point and the empty word meet as they are.
    short = whole.where("size < 2")
    rows, pairs = _dealt(whole.where("size >= 2")), _paired(short)
    while True:
        rows = cut(rows)
        groups = rows.groupBy("size", "met").agg(
            F.count(F.lit(1)).alias("k"), F.sum((F.col("chars") == F.col("size")).cast("int")).alias("longer"), F.max("hi").alias("hi"), F.max("lo").alias("lo")
        )
        # Groups without two words, or with shorter words only, have no pair.
        groups = cut(groups.where("k > 1 AND longer > 0"))
        # With a rest of one code point in the longer words, no more than that can be cut.
        deal = F.col("k") > limit
        large = groups.where(deal).select("size", "met")
        rest = F.col("hi") - F.col("lo") + F.col("size") - F.col("chars")
        again = rows.where(rest > 1).join(large, ["size", "met"], "left_semi")
        done = rows.join(groups.where(~deal).select("size", "met"), ["size", "met"], "left_semi").unionAll(
            rows.where(rest <= 1).join(large, ["size", "met"], "left_semi")
        )
        pairs = pairs.unionAll(cut(_paired(done)))
        if large.isEmpty():
            return pairs
        rows = _dealt(again)


def forms(words: DataFrame, limit: int = LIMIT, ratio: int = RATIO) -> DataFrame:
    """``words`` (``word``, ``n``) plus ``n_near``, ``form``, ``form_n`` and ``root``."""
    words = cut(words)
    pairs = near_pairs(words, limit)
    both = pairs.selectExpr("word_a AS word", "word_b AS near", "n_b AS m").unionAll(pairs.selectExpr("word_b", "word_a", "n_a"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("near"))).alias("best"))
    counted = words.join(best, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    takes: Column = -F.col("best.less") >= ratio * F.col("n")
    formed = cut(
        counted.select(
            "word", "n", "n_near", F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")
        )
    )
    return formed.join(_roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(formed: DataFrame) -> DataFrame:
    """(``word``, ``root``) of the words that have a form, by pointer doubling."""
    steps = cut(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = cut(steps.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moves")))
        steps = moved.select("word", "root")
        if moved.where("moves").isEmpty():
            return steps


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Rewrite = lose_a_letter) -> DataFrame:
    """One row per word: its form and root, its count, the number of near words and the form's count."""
    return forms(word_counts(docs, key, text, rewrite)).select("word", "form", "root", "n", "n_near", "form_n")
