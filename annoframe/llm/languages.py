"""Language identification by a string kernel: blended-spectrum presence, Nyström landmarks, kernel ridge regression.

1. Kernel. A text's lower-cased letters (each run of anything else is one blank) give the set S of its character n-grams of
   1 to ``ORDER`` characters; k(x, y) = |S(x) & S(y)| / sqrt(|S(x)| |S(y)|). A gram is named by a 52-bit hash.
2. Landmarks. Up to ``LANDMARKS`` training texts, equally many per language, stand for the whole feature space: the
   Nyström features of x are k(x, landmarks) times the inverse root of the landmarks' own kernel matrix.
3. Fit. One-versus-rest ridge regression on those features over a sample of at most ``FIT_ROWS`` training rows (equally many
   per language, weighted to count alike). Tasks add up the landmark-by-landmark moments; only those few small matrices
   reach the driver, whatever the size of the table.
4. Scoring. Kernel values times weights are a product of three matrices: texts by grams, grams by landmarks, landmarks by
   languages. The last two are multiplied once (its size is bounded by the landmarks), so that a batch of texts is scored
   by one product of its sparse gram matrix. The largest value names the language (ties: the first in code-point order);
   cut to 0 .. 1 it is the score.

The sample is the only bound: its rows are those of least text hash among the distinct (text, language) pairs of a
language. Predictions read every text whole, long ones alone, short ones packed together. A landmark has at most
``LANDMARK_CHARS`` code points while a language has enough such texts in its sample.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing can be learnt.
Rows without language or letters are not learnt from. Null keys are never learnt from and are not held out. Repeated rows
are learnt from once and predicted alike. Other columns pass through whatever their names. An empty table gives an empty
result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.llm.shingles import MIX, mixed
from annoframe.session import cut

ORDER = 4
LANDMARKS = 256
LANDMARK_CHARS = 20_000
#: Rows of the fit over all languages.
FIT_ROWS = 8_000
RIDGE = 1e-4
#: Characters a task lays side by side.
HELD = 1 << 17
UNKNOWN = "und"
_GRAM_BITS = np.uint64(52)
_MOST_TEXTS = 1 << 11


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter; is it part of a word (a letter or a mark on one)."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    mark = np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)
    return letter, letter | mark


def spelled(text: str | None) -> np.ndarray:
    """The characters of a text with one blank for each run of others, one before and one after; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letter, part = _letters()
    if not letter[codes].any():
        return np.empty(0, np.uint32)
    codes = np.where(part[codes], codes, 32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    return codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]


def gram_sets(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, gram) of the distinct grams of each spelled text, by text, then gram."""
    sizes = np.array([len(t) for t in texts])
    codes = np.concatenate(texts).astype(np.uint64)
    own = np.repeat(np.arange(len(texts)), sizes)
    keys, h = [], np.zeros(len(codes), np.uint64)
    for n in range(1, ORDER + 1):
        # h[i] stands for the n characters from i on.
        h = mixed(h[: len(codes) - n + 1] * MIX[0] + codes[n - 1 :] + np.uint64(n))
        whole = own[: len(h)] == own[n - 1 :]
        keys.append((own[: len(h)][whole].astype(np.uint64) << _GRAM_BITS) | (h[whole] >> np.uint64(12)))
    found = np.sort(np.concatenate(keys))
    found = found[np.append(True, found[1:] != found[:-1])] if len(found) else found
    return (found >> _GRAM_BITS).astype(np.int64), found & np.uint64((1 << 52) - 1)


@dataclass(frozen=True)
class Landmarks:
    """Which landmarks hold a gram, as rows of a sparse matrix, and how many grams each has."""

    grams: np.ndarray
    starts: np.ndarray
    holders: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(texts: list[np.ndarray]) -> Landmarks:
        owners, grams = [], []
        for i, text in enumerate(texts):
            own = gram_sets([text])[1]
            owners.append(np.full(len(own), i, np.int64))
            grams.append(own)
        owner, gram = np.concatenate(owners), np.concatenate(grams)
        order = np.lexsort((owner, gram))
        names, first = np.unique(gram[order], return_index=True)
        return Landmarks(names, np.append(first, len(gram)), owner[order].astype(np.int32), np.bincount(owner, minlength=len(texts)))

    def placed(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The known grams of texts as (number of the text, row here), by text, and how many grams each text has at all."""
        own, gram = gram_sets(texts)
        counts = np.bincount(own, minlength=len(texts))
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[at] == gram
        return own[known], at[known], counts

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Grams by languages: this matrix times ``weights`` (landmarks by languages), landmarks scaled by their sizes."""
        scaled = weights / np.sqrt(self.sizes)[:, None]
        return np.add.reduceat(scaled[self.holders], self.starts[:-1], axis=0) if len(self.grams) else np.empty((0, weights.shape[1]))

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts by landmarks. No text may be empty."""
        m = len(self.sizes)
        own, at, counts = self.placed(texts)
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - lengths), lengths)
        shared = np.bincount(np.repeat(own * m, lengths) + self.holders[place], minlength=len(texts) * m).reshape(-1, m)
        return shared / np.sqrt(counts[:, None] * self.sizes[None, :].astype(float))


def _packs(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts with a letter, by number and spelled, in packs of about ``HELD`` characters."""
    at, held, size = [], [], 0
    for i, text in enumerate(texts):
        codes = spelled(text)
        if len(codes):
            at.append(i)
            held.append(codes)
            size += len(codes)
            if size >= HELD or len(held) >= _MOST_TEXTS:
                yield at, held
                at, held, size = [], [], 0
    if held:
        yield at, held


def _moments(marks: Landmarks, languages: list[str], weight: dict[str, float]):
    """Per task one row: weighted sums of k kT, k yT, k and y over its texts."""
    m, c = len(marks.sizes), len(languages)
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kk, ky, k1, y1 = np.zeros((m, m)), np.zeros((m, c)), np.zeros(m), np.zeros(c)
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, held in _packs(batch.column("text").to_pylist()):
                k = marks.kernel(held)
                w = np.array([weight[langs[i]] for i in at])
                y = np.zeros((len(at), c))
                y[np.arange(len(at)), [number[langs[i]] for i in at]] = 1
                kw = k * w[:, None]
                kk, ky, k1, y1 = kk + kw.T @ k, ky + kw.T @ y, k1 + kw.sum(0), y1 + (y * w[:, None]).sum(0)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.concatenate([kk.ravel(), ky.ravel(), k1, y1]).tobytes()], pa.binary())})

    return run


@dataclass(frozen=True)
class Classifier:
    languages: list[str]
    marks: Landmarks | None
    #: Grams by languages, and one constant per language.
    weights: np.ndarray
    constants: np.ndarray

    def values(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts by languages."""
        own, at, counts = self.marks.placed(texts)
        known = np.bincount(own, minlength=len(texts))
        sums = np.zeros((len(texts), len(self.languages)))
        some = np.flatnonzero(known)
        if len(some):
            sums[some] = np.add.reduceat(self.weights[at], (np.cumsum(known) - known)[some], axis=0)
        return sums / np.sqrt(counts)[:, None] + self.constants

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if self.languages:
            for at, held in _packs(texts):
                values = self.values(held)
                best = values.argmax(1)
                scores[at] = np.clip(values[np.arange(len(at)), best], 0, 1)
                for i, b in zip(at, best.tolist()):
                    names[i] = self.languages[b]
        return names, scores

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``__row`` (the columns of ``docs``, packed), ``lang_pred`` and ``score``. Only the text decides."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, scores = self.label(batch.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__row"), pa.array(names, pa.string()), pa.array(scores)], ["__row", "lang_pred", "score"]
                )

        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text).alias("__text"))
        kind = rows.schema["__row"].dataType.simpleString()
        return rows.mapInArrow(run, f"__row {kind}, lang_pred string, score double")


def sample(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(``lang``, ``text``, ``h``, ``place``): per language at most its share of ``fit_rows`` distinct texts, by text hash.

    Languages are counted first, so that a fitting share of the hashes can be read before rows are ranked: no language's
    rows are ever gathered. The number of languages is taken to be small.
    """
    rows = labelled.select("lang", "text", F.xxhash64("text").alias("h")).where("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    seen = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not seen:
        return rows.withColumn("place", F.lit(0))
    each = max(2, fit_rows // len(seen))
    share = F.create_map(*[F.lit(x) for r in seen for x in (r["lang"], min(1.0, 2.0 * each / max(r["n"], 1)))])
    drawn = rows.where(F.pmod("h", F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)).dropDuplicates(["lang", "h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return drawn.withColumn("place", place).where(F.col("place") <= each)


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Classifier:
    """Learn from the ``text`` and ``lang`` of a table."""
    drawn = cut(sample(labelled, fit_rows))
    sizes = {r["lang"]: r["n"] for r in drawn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Classifier([], None, np.empty((0, 0)), np.empty(0))
    each = max(2, landmarks // len(languages))
    short_first = Window.partitionBy("lang").orderBy(F.length("text") > LANDMARK_CHARS, "place")
    chosen = drawn.withColumn("r", F.row_number().over(short_first)).where(F.col("r") <= each).select("lang", "text", "place")
    texts = [spelled(r["text"]) for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["place"]))]
    marks = Landmarks.of(texts)
    among = np.concatenate([marks.kernel([t]) for t in texts])
    m, c = len(marks.sizes), len(languages)
    weight = {x: 1 / (n * c) for x, n in sizes.items()}
    parts = drawn.select("lang", "text").coalesce(8).mapInArrow(_moments(marks, languages, weight), "sums binary").collect()
    total = np.sum([np.frombuffer(r["sums"]) for r in parts], axis=0)
    kk, ky = total[: m * m].reshape(m, m), total[m * m : m * (m + c)].reshape(m, c)
    k1, y1 = total[m * (m + c) : m * (m + c + 1)], total[-c:]
    return _solved(languages, marks, among, kk, ky, k1, y1, ridge)


def _solved(languages: list[str], marks: Landmarks, among: np.ndarray, kk, ky, k1, y1, ridge: float) -> Classifier:
    """Ridge regression on the Nyström features, from weighted moments that sum to one and the kernel among the landmarks."""
    values, vectors = np.linalg.eigh(among)
    solid = values > 1e-8 * values[-1]
    root = vectors[:, solid] / np.sqrt(values[solid])
    cov = root.T @ (kk - np.outer(k1, k1)) @ root
    cross = root.T @ (ky - np.outer(k1, y1))
    weights = root @ np.linalg.solve(cov + ridge * np.eye(cov.shape[0]), cross)
    return Classifier(languages, marks, marks.times(weights), y1 - k1 @ weights)


def remainder(key: Column) -> Column:
    """The fold of a row; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % 5


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Learn from four fifths of the rows, predict every row."""
    fold = remainder(F.col(key))
    model = fit(docs.where(fold != 0).select(F.col(text).alias("text"), F.col(label).alias("lang")))
    rows = model.predict(docs.select(F.col(key).alias("key"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.col(text).alias("text")), "text")
    return rows.select(F.col("__row.key").alias(key), F.col("__row.held_out").alias("held_out"), "lang_pred", "score")
