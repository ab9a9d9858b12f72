"""Personal data: sure matches seed lexical patterns, patterns and instances score each other, sure patterns find more.

1. One pass over each whole text finds the base spans (emails, IP addresses, card and phone numbers by the patterns
   below) and looser candidates of each kind that are no base span, each with the words around it.
2. Distinct (pattern, instance) pairs form a graph. A pattern is one or two words before, or the words on both sides. In
   every round a pattern's confidence in a kind is the share of its instances' scores for that kind (one is added to
   their number, so a pattern needs several instances), and an instance that is no seed takes the best confidence of its
   patterns; seeds keep 1.
3. Patterns with at least ``SUPPORT`` seeds of a kind and a confidence of at least ``SURE`` mark the candidates of that
   kind that they hold as added spans. Base spans always stay.

Pairs are made distinct and counted map-side before any shuffle, so copies and hot patterns weigh little; nothing is
gathered on the driver.

Defined cases: a null or empty text has no span. Null keys are kept as rows of their own, repeated rows give equal
rows. Other columns are not read. An empty table gives an empty result. All searches are linear in the text.
Context is taken from the ``AROUND`` characters on each side.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.session import cut

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the base (fixed values). Possessive where giving back cannot help, so that search is linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Looser shapes that only a sure pattern turns into spans.
LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"),
    "ip": re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._/-]?[0-9])++"),
    "phone": re.compile(r"(?<![0-9+(])\(?[0-9](?:[ ().-]{0,2}[0-9])++"),
}
LOOSE_DIGITS = {"card": (12, 19), "phone": (7, 13)}
AROUND = 120
ROUNDS = 3
SUPPORT, SURE = 4, 0.8


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) by start, then kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0]) if len(m[0]) <= 40 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that overlap no base span."""
    taken, out = sorted((s, e) for s, _, e in base), []
    for k, kind in enumerate(KINDS):
        i = 0
        for m in LOOSE[kind].finditer(text):
            lo, hi = LOOSE_DIGITS.get(kind, (0, 1 << 30))
            if kind in LOOSE_DIGITS and (len(m[0]) > 60 or not lo <= len(_digits(m[0])) <= hi):
                continue
            while i < len(taken) and taken[i][1] <= m.start():
                i += 1
            if not any(s < m.end() and m.start() < e for s, e in taken[i : i + 4]):
                out.append((m.start(), k, m.end()))
    return sorted(out)


_NUMBER = re.compile(r"[0-9]+")


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span."""
    plain = lambda words: [_NUMBER.sub("0", w.lower()) for w in words]
    left = plain(text[max(0, start - AROUND) : start].split()[-2:])
    right = plain(text[end : end + AROUND].split()[:1])
    out = []
    if left:
        out.append(f"{left[-1]} _")
    if len(left) == 2:
        out.append(f"{left[0]} {left[1]} _")
    if left and right:
        out.append(f"{left[-1]} _ {right[0]}")
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("what", pa.string()), ("patterns", pa.list_(pa.string()))])
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            spans = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in loose_spans(text, base)]
            rows.append(
                [{"kind": k, "start": s, "end": e, "seed": seed, "what": text[s:e].lower(), "patterns": patterns(text, s, e)} for s, k, e, seed in spans]
            )
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, pa.list_(span))], ["key", "spans"])


SPANS = "array<struct<kind:int,start:int,end:int,seed:boolean,what:string,patterns:array<string>>>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``__row``, ``key`` and all base spans and candidates with their patterns."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return cut(rows.mapInArrow(_scan, f"key long, spans {SPANS}").withColumn("__row", F.monotonically_increasing_id()))


def sure_patterns(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, sure: float = SURE) -> DataFrame:
    """(``pattern``, ``kind``, ``confidence``) of the patterns that may add spans."""
    edges = cut(
        found.select(F.explode("spans").alias("s"))
        .select(F.explode("s.patterns").alias("pattern"), "s.kind", "s.what", "s.seed")
        .groupBy("pattern", "kind", "what")
        .agg(F.max("seed").alias("seed"))
    )
    size = edges.groupBy("pattern").agg(F.count_distinct("what").alias("size"))
    scores = edges.groupBy("kind", "what").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for i in range(rounds):
        trust = (
            edges.join(scores, ["kind", "what"])
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("sum"), F.sum(F.col("seed").cast("int")).alias("seeds"))
            .join(size, "pattern")
            .withColumn("confidence", F.col("sum") / (F.col("size") + 1))
        )
        trust = cut(trust.select("pattern", "kind", "seeds", "confidence"))
        if i + 1 < rounds:
            held = edges.join(trust.where(F.col("seeds") >= support), ["pattern", "kind"], "left")
            scores = cut(
                held.groupBy("kind", "what").agg(
                    F.greatest(F.max(F.col("seed").cast("double")), F.coalesce(F.max("confidence"), F.lit(0.0))).alias("score")
                )
            )
    return trust.where((F.col("seeds") >= support) & (F.col("confidence") >= sure)).select("pattern", "kind", "confidence")


def _spelled(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``key``, ``base`` and ``added`` (arrays of kind, start, end)."""
    found = scan(docs, key, text)
    sure = sure_patterns(found)
    loose = found.select("__row", F.explode("spans").alias("s")).where("NOT s.seed")
    held = loose.select("__row", "s.kind", "s.start", "s.end", F.explode("s.patterns").alias("pattern"))
    more = (
        held.join(sure, ["pattern", "kind"], "left_semi")
        .groupBy("__row")
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    )
    slim = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.transform(F.filter("spans", lambda s: s["seed"]), slim)
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return found.join(more, "__row", "left").select(F.col("key").alias(key), base.alias("base"), F.coalesce("added", none).alias("added"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digest of the base spans, and all spans."""
    rows = find(docs, key, text)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        key,
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _spelled(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def base_digest(text: str | None) -> str:
    """What ``base_sha256`` is for one text."""
    spelled = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base_spans(text or ""))
    return hashlib.sha256(spelled.encode()).hexdigest()
