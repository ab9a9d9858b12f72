"""Line dedup, quality rules, near duplicates, mixing and fingerprints on small tables with every odd case."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.llm import lines, mixing, near, quality, sketch
from annoframe.llm.queries import QUERIES
from annoframe.llm.shingles import Weights, shingles, similarity

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, gone string, __n string, bucket string, key string"


def odd(spark, rows):
    """Documents with extra columns whose names the operators might use themselves."""
    return spark.createDataFrame([(i, t, None, s, "g", "n", "b", "k") for i, t, s in rows], ODD)


def prose(rng, n, end=" "):
    return end.join("w" + str(rng.randrange(5000)) for _ in range(n))


@pytest.fixture(scope="module")
def strange(spark):
    rng = random.Random(5)
    long_text = prose(rng, 4000)
    line = "the same long line stands in many of the documents here"
    rows = [
        (1, prose(rng, 120) + "\n" + line, "src1"), (2, line + "\n" + prose(rng, 120), "src2"), (3, line, "src1"),
        (4, None, None), (5, "", "src1"), (None, "null key " + prose(rng, 80), "src3"), (6, " \n\t\n ", "src0"),
        (7, long_text, "src0"), (8, long_text, "src0"), (7, long_text, "src0"), (9, "x\ny\nx\ny\nx\ny", "src12"), (10, "one", "src0"),
    ]
    return odd(spark, rows).cache()


def gone_lines(texts):
    """Brute force over all pairs of starts."""
    seqs = [[(i, x) for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")] if t else [] for t in texts]
    out = [set() for _ in texts]
    starts = [(d, p) for d, s in enumerate(seqs) for p in range(len(s))]
    for d, p in starts:
        for e, q in starts:
            if (e, q) >= (d, p):
                continue
            n = 0
            while p + n < len(seqs[d]) and q + n < len(seqs[e]) and seqs[d][p + n][1] == seqs[e][q + n][1]:
                n += 1
            if sum(len(x) for _, x in seqs[d][p : p + n]) >= lines.MIN_CHARS:
                out[d] |= {i for i, _ in seqs[d][p : p + n]}
    return out


def test_line_runs_equal_brute_force(spark):
    rng = random.Random(2)
    pool = [prose(rng, rng.choice([1, 1, 2, 9])) for _ in range(12)]
    texts = ["\n".join(rng.choice(pool + ["", " "]) for _ in range(rng.randrange(0, 14))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lines.report(docs).collect()}
    for i, gone in enumerate(gone_lines(texts)):
        assert got[i].n_deleted == len(gone)
        if 0 < len(gone) < got[i].n_lines:
            assert got[i].text == "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)


def test_line_dedup_odd_rows(spark, strange):
    out = lines.drop_copies(strange)
    assert out.columns == strange.columns
    texts = defaultdict(list)
    for r in out.collect():
        texts[r.doc_id].append(r.text)
    assert 3 not in texts and 8 not in texts  # nothing is left of them
    assert texts[4] == [None] and texts[5] == [""] and texts[6] == [" \n\t\n "]
    assert len(texts[7]) == 2  # repeated rows are cleaned alike
    assert "the same long line" in texts[1][0] and "the same long line" not in texts[2][0]
    assert lines.drop_copies(strange.limit(0)).count() == 0


def test_quality_counts_and_odd_rows(spark, strange):
    rows = {(r.doc_id, r.n_words): r for r in quality.report(strange).collect()}
    assert rows[4, 0].base_failed and not rows[4, 0].kept
    assert rows[9, 6].n_dup_lines == 4 and rows[9, 6].n_repeat_words == 6
    assert quality.keep_good(strange).columns == strange.columns
    assert quality.keep_good(strange.limit(0)).count() == 0
    kept = {r.doc_id for r in quality.keep_good(strange).collect()}
    assert {1, 2, 7, 8, None} <= kept and not kept & {4, 5, 6, 9, 10}


def test_quality_on_labelled_rows(spark):
    """The fitted verdict agrees with held-out labels, which the fit never sees."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    rows = quality.report(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    right = sum((r.kept and r.label == 1) or (not r.kept and r.label == 0) for r in rows)
    assert right / len(rows) > 0.97


def classes_by_hand(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    counts = defaultdict(int)
    for h, _ in sets.values():
        for x in h.tolist():
            counts[x] += 1
    n = sum(1 for h, _ in sets.values() if len(h))
    w = Weights({k: v for k, v in counts.items() if v > near.RARE * n}, n, near.RARE)
    weighted = {i: (h, w.of(h, tf)) for i, (h, tf) in sets.items()}
    up = {i: i for i in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and len(sets[a][0]) and similarity(weighted[a], weighted[b]) >= near.THRESHOLD:
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in ids}


def test_near_classes_equal_brute_force(spark):
    rng = random.Random(11)
    texts, common = {}, prose(rng, 30)
    for g in range(12):
        base = prose(rng, rng.randrange(60, 200)).split()
        for k in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(k // 2):
                words[rng.randrange(len(words))] = f"edit{g}x{k}"
            texts[len(texts)] = common + " " + " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.report(docs).collect()}
    assert got == classes_by_hand(texts)
    kept = {r.doc_id for r in near.drop_near(docs).collect()}
    assert kept == set(got.values())


def test_near_copies_in_a_group_of_a_third_of_all_rows(spark, tmp_path):
    """Plain similarities are 0.81; by tf-idf, where the group's own shingles weigh less, 0.78."""
    rng = random.Random(4)
    base = prose(rng, 99).split()
    texts = [" ".join("edit" + str(k) if i == 5 + 9 * k else w for i, w in enumerate(base)) for k in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts + [prose(rng, 99) for _ in range(20)])), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.class_id, r.class_size) for r in QUERIES["op9_near_dedup"](spark, str(tmp_path)).collect()}
    assert got == {i: (0, 10) if i < 10 else (i, 1) for i in range(30)}
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [0, *range(10, 30)]


def test_near_odd_rows(spark, strange):
    rows = near.report(strange).collect()
    assert len(rows) == strange.count()
    by = {r.doc_id: r for r in rows}
    assert by[8].class_id == 7 and by[8].class_size == 3 and by[4].class_id == 4 and by[6].class_size == 1
    kept = near.drop_near(strange)
    assert kept.columns == strange.columns
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == [-1, 1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert near.report(strange.limit(0)).count() == 0


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    h.sort()
    a, b = rng.integers(1, 4, 400).astype(float), rng.integers(1, 4, 400).astype(float)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sampler = near.Sampler(2000)
    start = np.array([0])
    same = (sampler.least(h, np.log(a), start) == sampler.least(h, np.log(b), start)).mean()
    assert abs(same - true) < 0.05


def test_mixing_odd_rows_and_shares(spark, strange):
    out = mixing.mix(strange)
    assert out.columns == strange.columns
    assert mixing.mix(strange.limit(0)).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.report(docs).collect()
    taken, words = defaultdict(int), sum(len((r.text or "").split()) for r in docs.collect())
    for r in rows:
        taken[r.domain] += r.n_words * r.copies
        assert 1 <= r.copies <= mixing.DEFAULT.max_epochs
    assert sum(taken.values()) <= words
    assert sum(r.copies for r in rows) == mixing.mix(docs).count()


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("crawl", "en", "a", 10), ("crawl", "en", "b", 400), ("crawl", "de", "a", 400), ("forum", "en", "a", 1000)],
        "domain string, lang string, source string, words long",
    )
    plan = mixing.Plan(domains={"crawl": 1, "forum": 1}, langs={"en": 1, "de": 1}, share=50, max_epochs=1)
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.budgets(leaves, plan).collect()}
    # 905 words: 452 a domain; crawl gives 226 a language; a can take 10 of its 113, b takes the rest of en.
    assert got == {("crawl", "en", "a"): 10, ("crawl", "en", "b"): 216, ("crawl", "de", "a"): 226, ("forum", "en", "a"): 452}


@pytest.mark.parametrize("chars", [16_000_000, 2_000])
def test_fingerprints(spark, strange, chars, monkeypatch):
    monkeypatch.setattr(sketch, "RANGE_CHARS", chars)
    rows = sketch.report(strange.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text or "" for r in strange.collect() if r.doc_id is not None}
    ids = sorted(texts)
    assert [r.doc_id for r in rows] == ids
    for r, after in zip(rows, ids[1:] + ids[:1]):
        t, nxt = texts[r.doc_id], texts[after]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == 1 or edited != t
    same = [r.fingerprint for r in rows if r.doc_id in (7, 8)]
    assert same[0] == same[1] != ""
    assert sketch.report(strange).count() == strange.count()
    assert sketch.report(strange.limit(0)).count() == 0


def test_sketches_merge_and_estimate_containment(spark):
    rng = random.Random(8)
    whole = prose(rng, 3000)
    part = " ".join(whole.split()[:300])
    row = spark.createDataFrame([(whole, part)], "a string, b string").select(
        sketch.sketch(F.col("a")).alias("a"), sketch.sketch(F.col("b")).alias("b")
    )
    r = row.select(
        sketch.containment(F.col("b"), F.col("a")).alias("inside"), sketch.containment(F.col("a"), F.col("b")).alias("around"),
        (sketch.merge(F.col("a"), F.col("b")) == F.col("a")).alias("same"),
    ).first()
    assert r.inside == 1.0 and r.same and abs(r.around - 296 / 2996) < 0.05
