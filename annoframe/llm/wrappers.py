"""Main text of web pages by wrappers, one union-free regular expression per host.

A page's stream of tags and texts is read as nested groups. Equal neighbours fold into a repeated group, every text is
a slot. The pages of a host are then aligned group by group: what only some have becomes optional, what one has once and
another several times becomes repeated, a slot whose text differs becomes variable, any other keeps the hash of its text
and the number of distinct pages that have it. The result, the wrapper, matches every page of the host. Only a text that
at least ``ENOUGH`` distinct pages have in its slot, and no page another one, is part of the template. The content slots
of a page are all those inside its article or main groups, or if it has no text there, the slots of its body but the
template's, less groups that the tag, class, id or role names as menu, header, footer, sidebar, notice, advert,
form, script, style or reader comments. Classes and ids are read as whole names (``sidebar``, ``left-sidebar``), never as
layouts (``has-sidebar``) and never on html, body, main or article; a name with unknown words (``shop-banner``) is not
believed of a group that holds most of the page's text outside the template. Pages are matched against their wrapper, and the texts in content slots make
the main text.

Pages are reduced to shapes, and shapes with equal text slots are combined map-side, so a host with a third of all pages
brings few rows to the alignment. That is done in two steps, salted by shape. Wrappers are as long as a template, not as
a page.

Defined cases: a null or empty page has an empty text. A null or relative url is host ``""``, which is
unknown; pages of an unknown or one-page host have their own wrapper, in which all slots count as variable. Rows with equal keys each give a row. Unclosed and
stray tags are read as browsers do for paragraphs, list items and cells; a stray end tag is dropped. Groups nested deeper
than ``DEPTH`` keep their texts as groups of their own at that depth, in page order. Other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.session import scratch_dir

#: Names that mark what is not the article (fixed lists).
TAGS = frozenset("nav footer aside form script style noscript template iframe svg math button select textarea head title dialog object audio video canvas menu".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner sidebar side menu nav navbar navigation topnav breadcrumb breadcrumbs comment comments respond reply replies discussion disqus notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations widget footer masthead toolbar pagination pager skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Parts that may stand beside those in a name without changing what it names, and parts that turn it into a layout's.
PLACES = frozenset("left right top bottom upper lower inner outer first second third primary secondary mobile desktop site page global box bar area wrapper wrap container inside section block list item items links link slot unit group panel row col column form title text".split())
LAYOUTS = frozenset("has no with without is not non hide show".split())
#: Tags that no class or id makes an aside.
KEPT = frozenset("page html body main article".split())
#: Tags inside a block's text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br picture source input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg".split())
#: What a start tag ends when it is still open.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
KEEPS_P = INLINE | {"script", "style", "noscript", "template", "iframe", "svg"}
SCOPES = frozenset("html body article main section div ul ol dl table nav footer header aside form blockquote td th".split())
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|(?=<)|\Z)", re.S)
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SALTS = 32
#: Levels of groups; browsers bound theirs too, and no step here then nests deeper.
DEPTH = 200
#: Distinct pages that must have a text in the same slot before it counts as part of the template.
ENOUGH = 5


def label_of(tag: str, attributes: str) -> str:
    """Tag, classes, id and role, without digits, as one name."""
    if "=" not in attributes:
        return tag
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in NAMED.finditer(attributes)}
    parts = [tag]
    for key, mark in (("class", "."), ("id", "#"), ("role", "@")):
        parts += [mark + re.sub(r"[0-9()+?,|]+", "", w.lower()) for w in sorted(found.get(key, "").split())]
    return "".join(parts)


_label_words = re.compile(r"[.#@]([^.#@]*)")


SURE, LIKELY = 2, 1


def is_aside(label: str, in_article: bool) -> int:
    """Whether a group's name says that it is not the article: SURE, or LIKELY where a class or id has a word of
    ``NAMES`` among others that are not known, and ends in one or in a word for contents."""
    tag = re.match(r"[^.#@]*", label)[0]
    if tag in TAGS or (tag == "header" and not in_article):
        return SURE
    said = 0
    for m in _label_words.finditer(label):
        if m[0][0] == "@":
            if m[1] in ROLES and tag not in KEPT:
                return SURE
            continue
        parts = [p for p in re.split(r"[-_:]+", m[1]) if p]
        if tag in KEPT or not LAYOUTS.isdisjoint(parts) or NAMES.isdisjoint(parts):
            continue
        if all(p in NAMES or p in PLACES for p in parts):
            return SURE
        if parts[-1] in NAMES or parts[-1] in ("body", "content", "main"):
            said = LIKELY
    return said


class Node:
    """A group of a page: its name and its parts, groups and texts in page order."""

    __slots__ = ("label", "parts")

    def __init__(self, label: str):
        self.label = label
        self.parts: list[Node | str] = []


def parse(page: str) -> Node:
    root = Node("page")
    stack: list[tuple[str, Node]] = [("page", root)]
    at, n = 0, len(page)
    text: list[str] = []

    def flush():
        if text:
            words = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if words and len(stack) <= DEPTH:
                stack[-1][1].parts.append(words)
            elif words:
                leaf = Node(stack[-1][1].label)
                leaf.parts.append(words)
                stack[DEPTH - 1][1].parts.append(leaf)

    while at < n:
        m = MARKUP.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            if tag not in ("input",):
                continue
        flush()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        ended = ENDS.get(tag, set()) if tag in KEEPS_P else ENDS.get(tag, set()) | {"p"}
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in ended:
                del stack[i:]
                break
            if stack[i][0] in SCOPES:
                break
        if tag in VOID or m[3].endswith("/"):
            continue
        node = Node(label_of(tag, m[3]))
        if len(stack) < DEPTH:
            stack[-1][1].parts.append(node)
        elif len(stack) > DEPTH and is_aside(stack[-1][1].label, True) == SURE:
            node.label = stack[-1][1].label  # what is inside an aside stays so
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        stack.append((tag, node))
    flush()
    return root


# --- wrappers: [label, optional, repeated, parts]; a text slot is ["", optional, text, []], where text is [hash of what
# all pages with the slot say there, number of these pages], or True where they differ ----------------------------------------------------------------------


def generalise(node: Node) -> tuple[list, list[str]]:
    """The page's own wrapper and the text of each of its slots, in order."""

    def walk(part: Node | str) -> tuple[list, list[list[str]]]:
        if isinstance(part, str):
            return ["", False, False, []], [[part]]
        out: list[list] = []
        texts: list[list[list[str]]] = []
        for p in part.parts:
            w, t = walk(p)
            if out and out[-1][0] == w[0]:
                if w[0]:
                    merged, t = _merge_texts(out[-1], texts[-1], w, t)
                    merged[2] = True
                    out[-1], texts[-1] = merged, t
                else:
                    texts[-1][0] += t[0]
            else:
                out.append(w)
                texts.append(t)
        return [part.label, False, False, out], [s for t in texts for s in t]

    wrapper, slots = walk(node)
    return wrapper, ["\n".join(s) for s in slots]


def _slots(w: list) -> int:
    return 1 if not w[0] else sum(_slots(p) for p in w[3])


def _align(a: list[list], b: list[list]) -> list[tuple[int | None, int | None]]:
    """Longest common subsequence of group names."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def _said(a: list | bool, b: list | bool) -> list | bool:
    """What is known of a slot that two wrappers share: pages with one text add up."""
    if a is True or b is True:
        return True
    if not a or not b:  # not counted yet
        return a or b
    return [a[0], a[1] + b[1]] if a[0] == b[0] else True


def _merge_texts(a: list, ta: list[list[str]], b: list, tb: list[list[str]]) -> tuple[list, list[list[str]]]:
    """Align two wrappers of one name, with the texts of their slots side by side."""
    if not a[0]:
        return ["", a[1] or b[1], _said(a[2], b[2]), []], [ta[0] + tb[0]]
    parts, texts = [], []
    ia = ib = 0
    for i, j in _align(a[3], b[3]):
        if i is not None and j is not None:
            na, nb = _slots(a[3][i]), _slots(b[3][j])
            w, t = _merge_texts(a[3][i], ta[ia : ia + na], b[3][j], tb[ib : ib + nb])
            ia, ib = ia + na, ib + nb
        else:
            side, at, have, start = (a, i, ta, ia) if j is None else (b, j, tb, ib)
            k = _slots(side[3][at])
            w, t = [side[3][at][0], True, *side[3][at][2:]], have[start : start + k]
            ia, ib = (ia + k, ib) if j is None else (ia, ib + k)
        parts.append(w)
        texts += t
    return [a[0], a[1] or b[1], a[2] or b[2], parts], texts


def align(a: list, b: list) -> list:
    """The wrapper that matches what either matches."""
    blank = lambda w: [[] for _ in range(_slots(w))]
    return _merge_texts(a, blank(a), b, blank(b))[0]


def with_slots(wrapper: list, flags: list) -> list:
    """Put what is known of the slots, in order."""
    rest = iter(flags)

    def walk(w: list) -> list:
        return ["", w[1], next(rest), []] if not w[0] else [w[0], w[1], w[2], [walk(p) for p in w[3]]]

    return walk(wrapper)


def _tag(label: str) -> str:
    return re.match(r"[^.#@]*", label)[0]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def extract(page: Node, wrapper: list) -> str:
    """The texts of the page in the wrapper's content slots, a line each."""
    slots: dict[int, list] = {}  # of each group, the slots of its own texts
    said: dict[int, list[str]] = {}  # of each slot, the page's texts

    def match(node: Node, w: list | None) -> None:
        at, own = 0, slots.setdefault(id(node), [])
        for part in node.parts:
            name = "" if isinstance(part, str) else part.label
            found = None
            if w is not None:
                k = next((k for k in range(at, len(w[3])) if w[3][k][0] == name), None)
                if k is not None:
                    found, at = w[3][k], k
            if isinstance(part, str):
                own.append(found)
                if found is not None:
                    said.setdefault(id(found), []).append(part)
            else:
                match(part, found)

    match(page, wrapper)
    shared: dict[int, bool] = {}

    def is_template(slot: list | None) -> bool:
        if slot is None or not slot[2] or slot[2] is True or slot[2][1] < ENOUGH:
            return False
        if id(slot) not in shared:
            shared[id(slot)] = _hash("\n".join(said[id(slot)])) == slot[2][0]
        return shared[id(slot)]

    weights: dict[int, int] = {}  # characters of each group that are neither the template's nor in a sure aside

    def weigh(node: Node, inside: bool, aside: bool) -> int:
        own = iter(slots[id(node)])
        total = 0
        for part in node.parts:
            if isinstance(part, str):
                slot = next(own)
                total += 0 if aside or is_template(slot) else len(part)
            else:
                total += weigh(part, inside or _tag(part.label) in ("article", "main"), aside or is_aside(part.label, inside) == SURE)
        weights[id(node)] = total
        return total

    weigh(page, False, False)

    def dropped(node: Node, in_article: bool) -> bool:
        said = is_aside(node.label, in_article)
        # A likely name is not believed of a group that holds most of the page's own text.
        return said == SURE or (said == LIKELY and 2 * weights[id(node)] <= weights[id(page)])

    def texts(whole: bool) -> list[str]:
        """Of the whole page, what is not the template's, or else what is inside its articles."""
        sure: list[str] = []
        all_texts: list[str] = []

        def walk(node: Node, inside: bool) -> None:
            own = iter(slots[id(node)])
            for part in node.parts:
                if isinstance(part, str):
                    slot = next(own)
                    if inside:
                        all_texts.append(part)
                        if not whole or not is_template(slot):
                            sure.append(part)
                elif not dropped(part, inside and not whole):
                    walk(part, inside or _tag(part.label) in ("article", "main"))

        walk(page, whole)
        return sure or all_texts

    return "\n".join(texts(False) or texts(True))


# --- Spark -----------------------------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes, hashes = [], []
        for page in batch.column("html").to_pylist():
            wrapper, slots = generalise(parse(page or ""))
            shapes.append(json.dumps(wrapper, separators=(",", ":")))
            hashes.append([_hash(s) for s in slots])
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(shapes), pa.array(hashes, pa.list_(pa.int64()))], ["host", "shape", "hashes"])


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Align the wrappers of a host, one after the other."""
    whole = None
    for text in sorted(rows["wrapper"]):
        w = json.loads(text)
        whole = w if whole is None else align(whole, w)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [json.dumps(whole, separators=(",", ":"))]})


def _marked(shapes: pd.Series, hashes: pd.Series, pages: pd.Series) -> pd.Series:
    own = lambda s, f, n: with_slots(json.loads(s), [True if x is None or x != x else [int(x), int(n)] for x in f])
    return pd.Series([json.dumps(own(s, f, n), separators=(",", ":")) for s, f, n in zip(shapes, hashes, pages)])


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(``host``, ``wrapper``) from all pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    # Copies of a page say nothing about a template, so each page text of a host counts once.
    shaped = rows.where("host <> ''").mapInArrow(_shapes, "host string, shape string, hashes array<long>").distinct()
    # One row per host, shape and slot: the hash of its text where all pages have the same. Hashes go as text, since
    # a column of numbers with gaps would lose digits in pandas.
    slots = (
        shaped.select("host", "shape", F.posexplode_outer("hashes").alias("slot", "h"))
        .groupBy("host", "shape", "slot")
        .agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("n"))
    )
    same = F.struct("slot", F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).alias("h"))
    known = slots.groupBy("host", "shape").agg(
        F.transform(F.sort_array(F.collect_list(same)), lambda s: s["h"]).alias("hashes"), F.max("n").alias("n")
    )
    mark = F.pandas_udf(_marked, "string")
    salt = F.pmod(F.xxhash64("shape"), F.lit(SALTS)).alias("salt")
    own = known.select("host", mark("shape", "hashes", "n").alias("wrapper"), salt)
    schema = "host string, wrapper string"
    some = own.groupBy("host", "salt").applyInPandas(_fold, schema)
    return some.groupBy("host").applyInPandas(_fold, schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parsed: dict[str, list] = {}
    for batch in batches:
        texts = []
        for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
            if len(parsed) > 1000:
                parsed.clear()
            if wrapper not in parsed:
                parsed[wrapper] = json.loads(wrapper) if wrapper else ["page", False, False, []]
            texts.append(extract(parse(page or ""), parsed[wrapper]))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())], ["key", "url", "text"])


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(``key``, ``url``, ``text``, ``n_chars``) of every page."""
    import uuid

    spark = pages.sparkSession
    home = f"{scratch_dir(spark)}/wrappers-{uuid.uuid4().hex}"
    infer(pages, url, html).write.parquet(home)
    wrappers = spark.read.schema("host string, wrapper string").parquet(home)  # its file size decides how it is joined
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn("host", host_of(F.col("url")))
    joined = rows.join(wrappers, "host", "left").select("key", "url", "html", "wrapper")
    out = joined.mapInArrow(_texts, "key long, url string, text string")
    return out.select(F.col("key").alias(key), "url", "text", F.length("text").cast("long").alias("n_chars"))
