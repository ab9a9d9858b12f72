"""Periodic runs of words: seeds on same-document diagonals are extended once each, and the maximal ones are the runs.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least ``max(6, 4 q)`` words
long, that no neighbouring word extends keeping period q.

1. Guaranteed overlap. Laid over itself with lag q, a run matches on at least ``max(6, 4 q) - q`` words: 5 for q = 1, else
   3 q. Lags are taken in levels 1, 2, 3-4, 5-8 ...; a level's grams have the least overlap of its lags, which is at
   least the largest of its lags.
2. Index. The grams of a level are named exactly by prefix doubling over word numbers (no hashes): only places whose shorter
   gram occurs again go on, so ordinary text is left after two or three words.
3. Occurrence pairs. A gram at least q long that lies in a run of smallest period q cannot occur there at a lag below q (two
   periods would give a smaller one), so the pairs of neighbouring occurrences hold the lag of every run; their number is
   at most that of the words. Grams never reach over the end of a document.
4. Extension. Seeds go by lag and place. A table holds per lag how far the diagonal has been covered; a seed inside it is
   passed over, any other is extended to both sides, in steps that double. So each diagonal is walked once.
5. A diagonal of m matches at lag q is a run of m + q words if that is long enough. Its later periods are superfluous: the
   collapsed text drops every word that lies in some run after that run's first q words.

Documents are laid end to end up to ``HELD`` words, so that short ones share the array work; a longer one is taken alone,
whole. Work is n log n in a document's words.

Defined cases: a null or empty text has no words, no run, and an empty collapsed text. Null keys and repeated rows
are rows of their own. Other columns pass through whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.llm.common import let, words_of

MIN_WORDS, MIN_PERIODS = 6, 4
HELD = 1 << 16
RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def shortest_run(period: int) -> int:
    return max(MIN_WORDS, MIN_PERIODS * period)


def levels(words: int) -> Iterator[tuple[int, int, int]]:
    """(least lag, largest lag, gram length) for documents of at most ``words`` words."""
    low, high = 1, 1
    while shortest_run(low) <= words:
        yield low, high, shortest_run(low) - low
        low, high = high + 1, high * 2


def _names(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal values get equal numbers from 0; and how often each number stands."""
    _, names, times = np.unique(pairs, return_inverse=True, return_counts=True)
    return names, times


class _Grams:
    """Names of the grams of length 1, 2, 4 ... at the places where they occur more than once (-1 elsewhere)."""

    def __init__(self, words: np.ndarray, left: np.ndarray):
        #: ``left``: words from a place to the end of its document.
        self.size, self.left = len(words), left
        self.doubled = [self._kept(np.arange(self.size), words)]

    def _kept(self, at: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        out = np.full(self.size, -1, np.int64)
        if len(at):
            names, times = _names(pairs)
            again = times[names] > 1
            out[at[again]] = names[again]
        return out

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (ascending) whose gram of ``length`` words may occur again, and the gram's name."""
        while 2 << (len(self.doubled) - 1) <= length:
            half, step = self.doubled[-1], 1 << (len(self.doubled) - 1)
            at, names = self._joined(half, step, 2 * step)
            self.doubled.append(self._kept(at, names))
        power = len(self.doubled) - 1
        while 1 << power > length:
            power -= 1
        return self._joined(self.doubled[power], length - (1 << power), length)

    def _joined(self, names: np.ndarray, shift: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero((names >= 0) & (self.left >= length))
        at = at[names[at + shift] >= 0]
        return at, names[at] * self.size + names[at + shift]


def _seeds(grams: _Grams, low: int, high: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of the neighbouring occurrences of a gram, by lag, then place."""
    at, names = grams.of(length)
    order = np.argsort(names, kind="stable")
    at, names = at[order], names[order]
    lag = np.diff(at)
    seed = np.flatnonzero((names[1:] == names[:-1]) & (lag >= low) & (lag <= high))
    place, lag = at[seed], lag[seed]
    inside = grams.left[place] >= lag + length  # both occurrences in one document
    place, lag = place[inside], lag[inside]
    order = np.lexsort((place, lag))
    return lag[order], place[order]


def _reach(same: np.ndarray, other: np.ndarray) -> int:
    """How many leading elements are equal, looked at in steps that double."""
    done, step = 0, 16
    while done < len(same):
        differ = np.flatnonzero(same[done : done + step] != other[done : done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = min(done + step, len(same)), 2 * step
    return done


def find_runs(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs by start, then period. ``words`` are numbers; document i ends before
    ``ends[i]``, and places count over all documents."""
    if not len(words):
        return []
    sizes = np.diff(ends, prepend=0)
    end_of = np.repeat(ends, sizes)
    begin_of = np.repeat(ends - sizes, sizes)
    grams = _Grams(words, end_of - np.arange(len(words)))
    out = []
    for low, high, length in levels(int(sizes.max())):
        lags, places = _seeds(grams, low, high, length)
        # Of seeds side by side on one diagonal the first is enough: the others are inside what it covers.
        first = np.ones(len(lags), bool)
        first[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        covered: dict[int, int] = {}
        for lag, place in zip(lags[first].tolist(), places[first].tolist()):
            if place < covered.get(lag, 0):
                continue
            begin, end = max(int(begin_of[place]), covered.get(lag, 0)), int(end_of[place])
            right = place + _reach(words[place : end - lag], words[place + lag : end])
            left = place - _reach(words[begin:place][::-1], words[begin + lag : place + lag][::-1])
            covered[lag] = right
            if right - left + lag >= shortest_run(lag):
                out.append((left, right - left + lag, lag))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs: list[list[tuple[int, int, int]]] = []
        texts: list[bytes] = []
        held: list[list[bytes]] = []
        size = 0

        def flush():
            number: dict[bytes, int] = {}
            ids = np.array([number.setdefault(w, len(number)) for words in held for w in words], dtype=np.int64)
            ends = np.cumsum([len(words) for words in held])
            found, at = find_runs(ids, ends), 0
            for words, end in zip(held, ends.tolist()):
                own, start = [], end - len(words)
                while at < len(found) and found[at][0] < end:
                    own.append((found[at][0] - start, *found[at][1:]))
                    at += 1
                runs.append(own)
                texts.append(_collapsed(words, own))

        for text in batch.column("__text"):
            # bytes.split parts at exactly the six blanks between words.
            words = (text.as_py() or "").encode().split()
            held.append(words)
            size += len(words)
            if size >= HELD:
                flush()
                held, size = [], 0
        if held:
            flush()
        offsets = np.cumsum([0, *map(len, runs)], dtype=np.int32)
        flat = np.array([r for own in runs for r in own], dtype=np.int64).reshape(-1, 3)
        structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
        yield pa.RecordBatch.from_arrays(
            [batch.column("__row"), pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["__row", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, text: str | Column = "text", carry: list[str] | None = None) -> DataFrame:
    """``__row`` (the columns ``carry`` of ``docs``, default all, packed), ``runs`` (start, length, period by start, then period) and
    ``collapsed``, the words of the text without the later periods of its runs, joined by one space."""
    names = docs.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = docs.select(row.alias("__row"), (F.col(text) if isinstance(text, str) else text).alias("__text"))
    kind = rows.schema["__row"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"__row {kind}, runs {RUNS}, collapsed string")


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the later periods of every run taken out; texts without a run, nulls too, stay to the letter."""
    found = periodic_runs(docs, text)
    new = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("__row").getField(text))
    return found.select(*[(new if c == text else F.col("__row").getField(c)).alias(c) for c in docs.columns])


def planted(key: Column, text: Column) -> Column:
    """The texts of the registered query: in a tenth of the documents, drawn by key, the words from some place on repeat a
    stretch drawn by key; the others stay."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")

        def from_place(a: Column) -> Column:
            def with_period(p: Column) -> Column:
                at = F.sequence(F.lit(0).cast("long"), n - 1)
                return F.array_join(
                    F.transform(at, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " "
                )

            return let(1 + F.floor((n - a) / (3 + g % 8)), with_period)

        return F.when(n > 0, let(g % n, from_place)).otherwise(F.lit(""))

    return F.when(h % 10 == 0, let(words_of(text), repeated)).otherwise(text)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the number of runs, the longest, and digests of all runs and of the collapsed text."""
    rows = periodic_runs(docs, planted(F.col(key), F.col(text)), [key])
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    )
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    spelled = F.array_join(F.transform("runs", line), "")
    rows = rows.withColumn("top", longest)
    return rows.select(
        F.col("__row").getField(key).alias(key),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        (-F.col("top.less")).alias("length"),
        F.col("top.period").alias("period"),
        F.floor(-1000 * F.col("top.less") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(spelled.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
