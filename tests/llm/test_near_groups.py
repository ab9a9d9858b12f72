"""Large groups of near copies: no link inside a bucket is lost, and recall near the threshold."""

import random
from itertools import combinations

import pytest

from annoframe.llm import near
from annoframe.llm.shingles import shingles


def edited(words, rng, at):
    out = list(words)
    for i in at:
        out[i] = f"e{rng.randrange(10**9)}"
    return out


def least_of_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def star(seed):
    """Copies of one text with few or many edits of their own, and families that share edits and have few more: the
    members of a family are near each other, but many are not near the text all come from."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        texts.append(edited(base, rng, rng.sample(range(150), rng.randrange(0, 7))))
    for _ in range(6):
        head = edited(base, rng, rng.sample(range(150), rng.randrange(3, 7)))
        texts += [edited(head, rng, rng.sample(range(150), rng.randrange(0, 4))) for _ in range(5)]
    for _ in range(8):  # added and missing passages
        cut = rng.randrange(100)
        texts.append(base[:cut] + base[cut + rng.randrange(5, 25) :])
        texts.append(base[:cut] + [f"x{rng.randrange(3)}" for _ in range(rng.randrange(5, 25))] + base[cut:])
    other = [f"o{i}" for i in range(300)]
    texts += [[*rng.sample(other, 120), *base[:30]] for _ in range(40)]
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize(("seed", "plain"), [(1, True), (2, False), (3, True)])
def test_no_link_inside_a_bucket_is_lost(spark, seed, plain):
    texts = star(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = near.Classes(docs, plain=plain)
    bands = {r.fp: set(r.bands) for r in classes.signed.collect()}
    of = {r.fp: shingles(r.text) for r in classes.rows.collect()}
    edges, met = [], 0
    for a, b in combinations(sorted(bands), 2):
        if bands[a] & bands[b]:
            met += 1
            if classes.weights.nearest(of[a], of[b]) >= near.THRESHOLD:
                edges.append((a, b))
    want = least_of_components(bands, edges)
    got = {n: n for n in bands} | {r.node: r.comp for r in classes.labels.collect()}
    assert got == want
    assert len(set(want.values())) > 40 and met > 4 * len(edges) > 0


def test_recall_just_over_the_threshold(spark):
    rng = random.Random(5)
    rows = []
    for k in range(400):
        words = [f"d{k}w{i}" for i in range(250)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(edited(words, rng, range(10, 250, 50))))]
    pair = [shingles(rows[i][1]) for i in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = near.Classes(docs, plain=True)
    assert near.THRESHOLD <= classes.weights.nearest(*pair) < 0.84
    found = classes.report().where("class_size = 2").count() / 2
    assert found >= 0.97 * 400
