"""Personal data, web archives, byte pairs, pages and token files on small tables with every odd case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from annoframe.llm import bpe, pii, tokens, warc, wrappers

SF = "/root/testdata/sf0.001"
WORDS = "doc_id long, text string, key string, ids string, spans string"


@pytest.fixture(scope="module")
def strange(spark):
    rows = [(1, "Hello <|endoftext|> wörld 日本\n\n  x"), (2, None), (3, ""), (None, "null key"), (4, "a" * 30000), (4, "a" * 30000), (5, "it's 12.5 ΑΣ\x00!")]
    return spark.createDataFrame([(i, t, "k", "i", "s") for i, t in rows], WORDS)


# --- personal data


def naive(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and pii._luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(0)
    for _ in range(20000):
        text = "".join(rng.choice("ab.@-+ 1234567890.()_%\n") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == naive(text)
    assert pii._luhn("4539578763621486") and not pii._luhn("4539578763621487")


def test_pii_on_documents_and_odd_rows(spark, strange):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.report(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spelled = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in naive(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert set(spelled) <= set(r.spans.split(","))
    assert pii.report(strange).count() == strange.count()
    assert pii.report(strange.limit(0)).count() == 0


def test_a_sure_pattern_finds_what_the_base_misses(spark):
    rows = [(i, f"please call us at +1 201-555-{1000 + i} today") for i in range(12)]
    rows += [(20, "please call us at 201-555-9999 today"), (21, "the part number is 201-555-8888 there")]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20].n_added == 1 and got[20].spans == "phone:18:30" and got[20].n_phone == 0
    assert got[21].n_added == 0 and got[3].spans == "phone:18:33"


# --- byte pairs


def test_encoding_equals_the_library():
    library, codec = Tokenizer.from_file(bpe.default_path()), bpe.Codec(bpe.default_path())
    rng = random.Random(1)
    texts = ["", " ", "  a", "\n\n x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "ab" * 3000, " " * 3000 + "x", "\x1c a\x85b\xa0c"]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x7F), rng.randint(0, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(60)) for _ in range(100)]
    texts += ["".join(rng.choice("abcdefgh \n'1.") for _ in range(200)) for _ in range(100)]
    for text, got in zip(texts, codec.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert codec.decode(got) == text == library.decode(ids, skip_special_tokens=False)
    assert 0 < codec.merged < codec.proposed  # both ways are walked


def test_pair_check_equals_exact_merging():
    codec = bpe.Codec(bpe.default_path())
    rng = np.random.default_rng(4)
    own = [t for t in rng.integers(0, len(codec.bytes), 3000).tolist() if codec.exact(codec.bytes[t]) == [t]]
    a, b = np.array(own[:1200]), np.array(own[1200:2400])
    want = [codec.exact(codec.bytes[x] + codec.bytes[y]) == [x, y] for x, y in zip(a, b)]
    assert codec.compatible(a, b).tolist() == want


def test_bpe_tables(spark, strange):
    library = Tokenizer.from_file(bpe.default_path())
    back = bpe.decode(bpe.encode(strange)).collect()
    assert sorted(r.text for r in back) == sorted(r.text or "" for r in strange.collect())
    rows = {r.doc_id: r for r in bpe.round_trip(strange).collect()}
    ids = library.encode(strange.first().text, add_special_tokens=False).ids
    assert rows[1].n_tokens == len(ids) and rows[1].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert rows[2].n_tokens == rows[3].n_tokens == 0 and rows[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip(strange.limit(0)).count() == 0


# --- token files


@pytest.mark.parametrize("high", [2, 255, 60_000, 2**32 - 1])
def test_any_token_of_a_file(tmp_path, high):
    rng = np.random.default_rng(high)
    ids = rng.integers(0, high, 2600, dtype=np.int64)
    (tmp_path / "x.dac").write_bytes(tokens.pack([7, None, 9], ids, np.array([100, 0, 2500])))
    file = tokens.Reader(str(tmp_path / "x.dac"))
    assert file.keys() == [7, None, 9] and file.starts().tolist() == [0, 100, 100, 2600]
    assert [file.token(i) for i in range(0, 2600, 61)] == ids[::61].tolist()
    for _ in range(40):
        lo, hi = sorted(rng.integers(0, 2601, 2).tolist())
        assert (file.slice(lo, hi) == ids[lo:hi]).all()
    with pytest.raises(IndexError):
        file.token(2600)


def test_token_files_of_documents(spark, strange):
    library = Tokenizer.from_file(tokens.default_path())
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), strange.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        at = 0
        texts = sorted((r.doc_id, r.text or "") for r in docs.collect())
        for (key, text), r in zip(texts, tokens.report(docs).orderBy("doc_id").collect()):
            ids = library.encode(text, add_special_tokens=False).ids + [tokens.END_ID]
            assert tuple(r) == (key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
    assert tokens.report(strange).count() == strange.count()
    assert tokens.report(strange.limit(0)).count() == 0


def test_pieces_encode_as_whole_texts():
    library, encoder = Tokenizer.from_file(tokens.default_path()), tokens.Encoder(tokens.default_path())
    rng = random.Random(3)
    texts = ["", "<|STARTOFTEXT|> A", "x<|endoftext|>", "İstanbul ΑΣ \x00 a\x00b é"]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x7F), rng.randint(0, 0x2FF), rng.randint(0x300, 0x1FFF), 32, 0x301])) for _ in range(60)) for _ in range(200)]
    flat, counts = encoder.encode(pa.array(texts), 1)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert flat[at : at + n].tolist() == library.encode(text, add_special_tokens=False).ids + [1]
        at += n


# --- archives


def test_archives_round_trip(spark):
    rows = [
        (1, "u v\n", "same"), (5, None, "same"), (None, "u", "same"), (2, "x", None), (3, "y", ""),
        (9, "z", "a\r\n\r\nb é"), (9, "z", "a\r\n\r\nb é"), (4, "z", "a\r\n\r\nb é"), (6, "z", "long " * 20000),
    ]
    pages = spark.createDataFrame([(*r, "d", "t", 0) for r in rows], "page_id long, url string, html string, digest string, type string, offset int")
    home = warc.new_home(spark)
    index = warc.write(pages, home)
    got = {(r.key, r.record_type): r for r in warc.read(spark, home).collect()}
    assert got[1, "revisit"].refers_to == 5 and got[None, "revisit"].refers_to == 5 and got[2, "revisit"].refers_to == 3
    assert got[9, "response"].payload == "a\r\n\r\nb é" and got[4, "revisit"].payload_bytes == 10 - 1 + 1 - 1
    assert got[6, "response"].payload_bytes == 100_000 and got[1, "revisit"].url == "u%20v%20"
    some = warc.read(spark, home, index.where("key in (3, 6)")).collect()
    assert sorted(r.key for r in some) == [3, 6]
    assert warc.report(pages.limit(0)).count() == 0
    few = {r.key: r for r in warc.read(spark, _written(spark, pages, 5)).collect()}
    assert few[1].record_type == "response" and few[4].record_type == "revisit"


def _written(spark, pages, min_bytes):
    home = warc.new_home(spark)
    warc.write(pages, home, min_bytes=min_bytes)
    return home


# --- pages

PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav>m</nav><main><article><header><h1>Head</h1>
</header><p>One &lt;b&gt; <b>two</b><br>three</p><div class="ad-box">buy</div><ul><li>x<li>y</ul><aside>side</aside>
<section class="comments"><p>c1</p></section><form>f</form><table><tr><td>1<td>2</table><script>if(a<b){"</p>"}</script>tail
</article></main><div class='cookie-notice'>ck</div><footer>f</footer></body>"""


def test_pages_of_every_kind(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, None, None), (3, "http://b.example", ""), (None, "c", "just text &amp; more\n\n x")]
    rows += [(10 + i, "http://D.example/", f"<div id=menu>m</div><div><p>fixed</p></div><p>story {i}<p>more {i}") for i in range(6)]
    rows += [(20, "http://d.example/", "<div><p>fixed</p></div><p>story")]
    pages = spark.createDataFrame([(*r, "h", "w") for r in rows], "page_id long, url string, html string, host string, wrapper string")
    got = {r.page_id: r for r in wrappers.main_text(pages).collect()}
    assert got[1].text == "Head\nOne <b> two three\nx\ny\n1\n2\ntail" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[None].text == "just text & more x"
    assert got[12].text == "story 2\nmore 2" and got[20].text == "story"  # what all pages share is the template's
    assert wrappers.main_text(pages.limit(0)).count() == 0


def test_alignment_finds_optional_and_repeated_groups():
    shape = lambda page: wrappers.generalise(wrappers.parse(page))[0]
    whole = wrappers.align(shape("<div><h1>a</h1><p>b</p></div>"), shape("<div><p>b</p><p>c</p><ul><li>x</ul></div>"))
    div = whole[3][0]
    assert [(p[0], p[1], p[2]) for p in div[3]] == [("h1", True, False), ("p", False, True), ("ul", True, False)]


def main_texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrappers.main_text(pages).collect()}


def test_texts_of_one_page_are_content(spark):
    page = lambda body: f"<body><h6>banner</h6>{body}<address>imprint</address></body>"
    odd = page("<p>a</p><h2>first</h2><p>b</p><h2>second</h2><p>c</p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table><blockquote>said</blockquote>")
    rows = [(i, "http://p.example/", page(f"<p>story {i}</p><p>more {i}</p>")) for i in range(8)]
    rows += [(20 + i, "http://p.example/", odd) for i in range(6)]  # copies are one page
    rows += [(30 + i, "http://p.example/", page(f"<p>tale {i}</p><h3>Read on</h3>")) for i in range(5)]
    got = main_texts(spark, rows)
    assert got[3] == "story 3\nmore 3" and got[31] == "tale 1"  # five pages share the heading
    assert all(got[20 + i] == "a\nfirst\nb\nsecond\nc\nx\ny\n1\n2\nsaid" for i in range(6))


def test_articles_are_found_per_page(spark):
    rows = [(i, "http://p.example/", f"<div><p>story {i}</p></div><address>imprint</address>") for i in range(6)]
    rows += [(10, "http://p.example/", "<address>imprint</address><article><p>essay</p></article><p>beside</p>")]
    rows += [(11, "http://p.example/", "<main></main><div><p>below</p></div>")]
    rows += [(20 + i, url, f"<div><p>loose</p><p>{i}</p></div>") for i, url in enumerate([None, "x/y", "/z", "a", "b", "c"])]
    rows += [(30, None, "<article>alone</article>")]
    got = main_texts(spark, rows)
    assert [got[i] for i in range(6)] == [f"story {i}" for i in range(6)]
    assert got[10] == "essay" and got[11] == "below" and got[30] == "alone"
    assert [got[20 + i] for i in range(6)] == [f"loose\n{i}" for i in range(6)]


def test_layout_names_drop_nothing(spark):
    text = "<p>the whole story of this page</p>"
    kept = [
        f'<body class="has-sidebar"><div>{text}</div></body>', f'<main class="no-sidebar">{text}</main>', f'<article class="post comment-open">{text}</article>',
        f'<article id="ad-review">{text}</article>', f'<div id="content" class="with-sidebar">{text}</div>', f'<html class="menu"><body id="widget">{text}</body></html>',
        f'<div class="shop-widget">{text}</div>', f'<div class="menu-planning">{text}</div>',
    ]
    gone = ["sidebar", "left-sidebar", "comment-list", "ad-box", "acme-footer", "cookie_notice", "site-nav menu"]
    rows = [(i, f"http://h{i}.example/", f'{k}<div class="{g}">other</div>') for i, (k, g) in enumerate((k, g) for k in kept for g in gone)]
    got = main_texts(spark, rows)
    assert all(got[i] == "the whole story of this page" for i, _, _ in rows), got


def test_main_text_of_given_pages(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


# --- pipeline


def test_pipeline_runs_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    texts = [r.text for r in kept.collect()]
    library = Tokenizer.from_file(bpe.default_path())
    want = sorted(len(library.encode(t, add_special_tokens=False).ids) for t in texts)
    assert sorted(r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()) == want
    assert 50 < len(want) < 300
