"""Fingerprints, edited texts and likenesses against a plain version of the same rule."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash

from annoframe.llm import sketch


def kept(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    runs = [words[i : i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    hashes = set()
    for run in runs:
        h = 42
        for word in run:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        hashes.add(h - (1 << 64) if h >> 63 else h)
    low = {h for h in hashes if h < -(1 << 63) + (1 << 64) // sketch.FRACTION}
    return low or ({min(hashes)} if hashes else set())


def spelled(hashes):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in sorted(hashes))


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("range_chars", [16_000_000, 900])
def test_fingerprints_equal_a_plain_version(spark, monkeypatch, range_chars):
    monkeypatch.setattr(sketch, "RANGE_CHARS", range_chars)
    rng = random.Random(7)
    words = ["alpha", "é", "日本", "x", "y,", "longer-word", "z"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 5, 6, 40, 90]))) for _ in range(60)]
    texts += ["", None, " \n\t ", "one", texts[3], texts[3] + " more", "a b c d e " * 200]
    keys = rng.sample(range(-50, 5000), len(texts) - 1) + [None]
    docs = spark.createDataFrame(list(zip(keys, texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in sketch.report(docs).collect()}
    order = sorted(zip(keys, texts), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(order)
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == spelled(kept(text)) and r.edited_fingerprint == spelled(kept(edited))
        assert r.near_edited == pytest.approx(likeness(kept(text), kept(edited)))
        assert r.near_next == pytest.approx(likeness(kept(text), kept(after)))
