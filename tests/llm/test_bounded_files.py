"""Archives and token files of bounded size, and pages of any depth."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from annoframe.llm import tokens, warc, wrappers


def test_archives_are_closed_at_their_size(spark):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", "".join(rng.choice("ab é\r\n") for _ in range(rng.randrange(300)))) for i in range(200)]
    rows += [(1000 + i, "u", rows[i][2]) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    home = warc.new_home(spark)
    index = warc.write(pages, home, archive_bytes=2000)
    # Records fill each archive without gaps, and every archive but one of a task was closed at its size.
    ends = index.groupBy("archive").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert len(ends) > 20 and all(r.n == r.end for r in ends) and sum(r.n < 2000 for r in ends) <= 3
    texts = {key: text for key, _, text in rows}
    got = warc.read(spark, home).collect()
    assert sorted(r.key for r in got) == sorted(texts)
    for r in got:
        assert r.payload_bytes == len(texts[r.key].encode())
        if r.record_type == "response":
            assert r.payload == texts[r.key]
        else:
            assert texts[r.refers_to] == texts[r.key] and r.refers_to > r.key


def test_token_files_are_closed_at_their_size(spark):
    rows = [(i, "word and more " * (i % 7)) for i in range(300)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = tokens.new_home(spark), tokens.new_home(spark)
    tokens.write(docs, one)
    files = tokens.write(docs, many, file_tokens=1).collect()
    assert max(f.tokens for f in files) > 1 and sum(f.docs for f in files) == 301
    assert sorted(map(str, tokens.read(spark, one).collect())) == sorted(map(str, tokens.read(spark, many).collect()))


def test_pages_of_any_depth(spark):
    deep = 5000
    rows = [
        (1, "<div>" * deep + "x" + "</div>" * deep),
        (2, "<div>" * deep + "one<p>two<div>three</div>four" + "</div>" * deep + "five"),
        (3, "<article>" + "<div>" * deep + "story<div class=sidebar>no<div>no</div>no</div>goes on</article>end"),
        (4, "<ul><li>" * deep + "item"),
    ]
    pages = spark.createDataFrame([(i, "http://deep.example/", h) for i, h in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    assert got == {1: "x", 2: "one\ntwo\nthree\nfour\nfive", 3: "story\ngoes on", 4: "item"}


def test_depth_changes_no_text_of_shallow_pages(monkeypatch):
    page = "<body><div>a<ul><li>b<li>c</ul><div id=menu>m<div>n</div></div>d</div><section><article><p>e</article></section></body>"
    whole = wrappers.extract(wrappers.parse(page), ["page", False, False, []])
    monkeypatch.setattr(wrappers, "DEPTH", 4)
    assert wrappers.extract(wrappers.parse(page), ["page", False, False, []]) == whole == "e"
