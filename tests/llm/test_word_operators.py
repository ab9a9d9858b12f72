"""Language identification, spelling variants and periodic runs against brute force, with every odd case."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoframe.llm import languages, periods, spelling
from annoframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, runs string, __row string, word string, score string, key string"
VOCAB = {
    "en": "the and of that with this from have which there house water light under never".split(),
    "de": "der die und nicht mit sich auch eine wird über straße haus wasser licht niemals".split(),
    "ru": "что это как они был все дом вода свет никогда под мост река город ночь".split(),
}


def odd(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, "r", "w", "x", "s", "k") for i, t, lang in rows], ODD)


def prose(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def strange(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, lang, rng.randrange(5, 60)), lang) for i, lang in enumerate(["en", "de", "ru"] * 30)]
    rows += [
        (200, None, "en"), (201, "", "de"), (202, "12 + 34 = \n 46!", "ru"), (None, prose(rng, "en", 20), "en"),
        (203, prose(rng, "de", 30000), "de"), (204, prose(rng, "ru", 12), None), (5, rows[5][1], rows[5][2]), (205, "über", "de"),
        (206, "a b c a b c a b c a b c a b c", "en"), (206, "a b c a b c a b c a b c a b c", "en"), (207, " \t\n", "en"),
    ]
    return odd(spark, rows).cache()


# --- language identification -----------------------------------------------------------------------------------------


def gram_set(text):
    plain = " " + re.sub(r"[^a-zäöüßа-я]+", " ", text.lower()).strip() + " "
    return {plain[i : i + n] for n in range(1, languages.ORDER + 1) for i in range(len(plain) - n + 1)}


def test_kernel_equals_sets():
    rng = random.Random(1)
    texts = [prose(rng, lang, n) + ", 12 " + prose(rng, lang, 2) for lang in VOCAB for n in (1, 4, 30)]
    codes = [languages.spelled(t) for t in texts]
    sets = [gram_set(t) for t in texts]
    want = [[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets]
    assert np.allclose(languages.Landmarks.of(codes).kernel(codes), want)


def test_all_rows_as_landmarks_is_exact_kernel_ridge(spark):
    rng = random.Random(2)
    rows = [(prose(rng, lang, rng.randrange(2, 12)), lang) for lang in VOCAB for _ in range(12)]
    model = languages.fit(spark.createDataFrame(rows, "text string, lang string"), landmarks=1000, ridge=0.01)
    assert model.languages == sorted(VOCAB)
    sets, n = [gram_set(t) for t, _ in rows], len(rows)
    k = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    y = np.array([[float(lang == x) for x in model.languages] for _, lang in rows])
    centre = np.eye(n) - 1 / n
    alpha = np.linalg.solve(centre @ k @ centre + n * 0.01 * np.eye(n), centre @ y)
    new = [prose(rng, lang, 5) for lang in VOCAB]
    kn = np.array([[len(gram_set(t) & b) / np.sqrt(len(gram_set(t)) * len(b)) for b in sets] for t in new])
    want = (kn - k.mean(0)) @ centre @ alpha + y.mean(0)
    assert np.allclose(model.values([languages.spelled(t) for t in new]), want, atol=1e-6)


def test_held_out_accuracy(spark):
    out = QUERIES["op11_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_reads_only_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, F.col("lang")).otherwise("xx"))
    changed = changed.withColumn("source", F.lit("other"))
    key = lambda df: sorted(map(tuple, languages.report(df).collect()))
    assert key(docs) == key(changed)


def test_language_odd_rows(spark, strange):
    rows = languages.report(strange).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == strange.count()
    for i in (200, 201, 202, 207):
        assert (by[i][0].lang_pred, by[i][0].score) == ("und", 0.0)
    assert by[None][0].lang_pred == "en" and by[None][0].held_out is False
    assert by[203][0].lang_pred == "de" and by[204][0].lang_pred == "ru" and by[205][0].lang_pred == "de"
    assert len(by[5]) == 2 and by[5][0] == by[5][1]
    model = languages.fit(strange)
    out = model.predict(strange)
    assert out.select("__row.*").columns == strange.columns


def test_language_without_anything_to_learn(spark, strange):
    none = strange.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in languages.report(none).collect()} == {("und", 0.0)}
    assert languages.report(strange.limit(0)).count() == 0


def test_sample_is_bounded_per_language_and_ignores_copies(spark):
    rows = [(f"copy of one text {i % 3}", "en") for i in range(600)] + [(f"text number {i}", "en") for i in range(500)] + [("ein Text", "de")]
    got = languages.sample(spark.createDataFrame(rows, "text string, lang string"), 40).collect()
    assert Counter(r.lang for r in got) == {"en": 20, "de": 1}
    assert len({r.text for r in got}) == 21


# --- spelling variants -----------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_forms(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def brute_counts(docs):
    total = Counter()
    for key, text in docs:
        for found in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found)
            h = crc32(f"{key}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 5:
                total[word] += 1
    return {w: n for w, n in total.items() if n >= 3}


@pytest.mark.parametrize("limit", [1, 3, 48])
def test_near_words_equal_brute_force_at_every_limit(spark, limit):
    rng = random.Random(limit)
    words = {"".join(rng.choice("abÉ") for _ in range(rng.randrange(1, 9))) for _ in range(400)} | {"a" * 40, "a" * 41, "a" * 39 + "b", "a" * 42}
    counts = {w: rng.choice([1, 2, 2, 3, 5, 9, 30]) for w in words}
    got = spelling.forms(spark.createDataFrame(list(counts.items()), "word string, n long"), limit).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_forms(counts)
    assert len(got) == len(counts)


def test_pairs_come_once(spark):
    words = ["aaaaa", "aaaa", "aaaaaa", "abaaa", "aabaa", "ababab", "bababa", "babab"]
    for limit in (1, 48):
        got = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), limit).collect()
        pairs = [frozenset((r.word_a, r.word_b)) for r in got]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}


def test_spelling_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = brute_counts(docs)
    got = QUERIES["op12_spelling_variants"](spark, SF).collect()
    assert {r.word: r.n for r in got} == counts
    some = sorted(counts)[::17]
    pool = set(counts)
    for r in got:
        if r.word in some:
            near = [v for v in pool if one_edit(r.word, v)]
            best = min(near, key=lambda v: (-counts[v], v), default=None)
            form = best if best is not None and counts[best] >= 2 * r.n else None
            assert (r.n_near, r.form, r.form_n) == (len(near), form, counts[form] if form else None)


def test_spelling_odd_rows(spark, strange):
    docs = [("" if r.doc_id is None else r.doc_id, r.text) for r in strange.collect()]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.report(strange).collect()}
    assert got == brute_forms(brute_counts(docs)) and got
    assert spelling.report(strange.limit(0)).count() == 0


# --- periodic runs ---------------------------------------------------------------------------------------------------


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(words):
    runs = brute_runs(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *(top if top else (None, None, None)), 1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def tampered(key, text):
    words, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), crc32(str(key).encode())
    n, g = len(words), h // 10
    if key is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def fields(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def test_runs_equal_brute_force(spark):
    rng, texts = random.Random(4), []
    for i in range(400):
        words = [rng.choice("abc"[: 2 + i % 2]) for _ in range(rng.randrange(0, 12))]
        for _ in range(rng.randrange(0, 4)):
            root = [rng.choice("ab") for _ in range(rng.randrange(1, 14))]
            words += (root * 6)[: rng.randrange(1, 6 * len(root))] + [rng.choice("abc") for _ in range(rng.randrange(0, 3))]
        texts.append(words)
    texts += [["x"] * 500, ["x", "y"] * 3 + ["x"], list("abababab"), list("abababa"), ["a"] * 6, ["a"] * 5, list("aab" * 4 + "aabaab" + "aac") * 5]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").coalesce(2)
    got = {r["__row"].doc_id: r for r in periods.periodic_runs(docs).collect()}
    for i, words in enumerate(texts):
        runs = brute_runs(words)
        assert [tuple(x) for x in got[i].runs] == runs, words
        drop = {j for s, m, q in runs for j in range(s + q, s + m)}
        assert got[i].collapsed == " ".join(w for j, w in enumerate(words) if j not in drop)


def test_runs_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for key, text in docs.items():
        words = tampered(key, text)
        if len(words) < 1500:
            assert fields(got[key]) == brute_row(words), key


def test_runs_odd_rows(spark, strange):
    rows = periods.report(strange).collect()
    assert len(rows) == strange.count()
    texts = {r.doc_id: r.text for r in strange.collect()}
    for r in rows:
        if r.doc_id != 203:
            assert fields(r) == brute_row(tampered(r.doc_id, texts[r.doc_id]))
    out = periods.collapse(strange)
    assert out.columns == strange.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[200] is None and kept[201] == "" and kept[207] == " \t\n" and kept[206] == "a b c"
    assert periods.report(strange.limit(0)).count() == 0
