"""Mixing sources to target weights over a domain, language, source tree.

Budgets go from the root down. Siblings share their parent's budget by weight, but none gets more than its subtree can
give (its words times ``max_epochs``); what one cannot take is shared among its siblings by their weights, so a
shortage leaves a subtree only when the whole subtree is used up. Shares are whole words, rounded down.

A leaf's budget is spent in epochs. Every full epoch takes each document of the leaf once; the last, part epoch takes the
documents in a seeded order of that epoch, as long as the words fit. The order is a hash, so a leaf is cut without
sorting it: words are added up per hash range (4,096 per leaf, combined before the shuffle) and only the range in which
the budget ends is ranked.

Defined cases: a null in domain, language or source is the value ``(none)``; unknown values have weight 1, weight 0
takes nothing. A null or empty text has no words: it costs nothing and is taken in each full epoch and wherever the part
epoch reaches it. Rows equal in key and text follow each other. Other columns pass through. An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.llm.common import keyed, unpacked
from annoframe.session import cut

NONE = "(none)"
RANGES = 4096
LEAF = ["domain", "lang", "source"]


@dataclass(frozen=True)
class Plan:
    """Weights are whole numbers. ``share`` percent of all words is the budget; no document is taken more often than ``max_epochs``."""

    #: SQL over the documents that gives the domain.
    domain: str = "CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) = 4 THEN 'reference' ELSE 'forum' END"
    domains: dict[str, int] = field(default_factory=lambda: {"crawl": 5, "reference": 4, "forum": 3})
    langs: dict[str, int] = field(default_factory=lambda: {"en": 6, "de": 2, "fr": 2, "es": 1})
    sources: dict[str, int] = field(default_factory=dict)
    share: int = 100
    max_epochs: int = 2
    seed: int = 7


DEFAULT = Plan()


def _case(name: str, weights: dict[str, int]) -> str:
    known = " ".join(f"WHEN '{v}' THEN {w}" for v, w in weights.items())
    return f"CAST(CASE {name} {known} ELSE 1 END AS BIGINT)" if known else "CAST(1 AS BIGINT)"


def _share(nodes: DataFrame, parent: list[str], weight: str, order: str) -> DataFrame:
    """``nodes`` (parent's ``budget``, own ``cap``) with their own ``budget``.

    In the order of capacity per weight, a node is full if its weight's part of what is left exceeds its capacity.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ordered = by.orderBy(F.col("cap") / F.col("w"), order)
    rows = nodes.withColumn("w", F.expr(weight)).where("w > 0")
    rows = rows.withColumns(
        {
            "spent": F.sum("cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
            "rest": F.sum("w").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    ).withColumn("spent", F.coalesce("spent", F.lit(0)))
    rows = rows.withColumn("full", F.expr("cap * rest <= w * (budget - spent)"))
    rows = rows.withColumns(
        {
            "used": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0)),
            "open": F.sum(F.when(~F.col("full"), F.col("w"))).over(by),
        }
    )
    return rows.withColumn("budget", F.expr("CASE WHEN full THEN cap ELSE w * (budget - used) DIV open END")).drop(
        "w", "spent", "rest", "full", "used", "open"
    )


def budgets(leaves: DataFrame, plan: Plan = DEFAULT) -> DataFrame:
    """Per leaf (``words``): the words to take, ``budget``."""
    leaves = leaves.withColumn("cap", F.col("words") * plan.max_epochs)
    total = leaves.agg((F.floor(F.sum("words") * plan.share / 100)).cast("long").alias("budget")).first()[0] or 0
    tops = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("budget", F.lit(total).cast("long"))
    tops = _share(tops, [], _case("domain", plan.domains), "domain").select("domain", "budget")
    mids = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(tops, "domain")
    mids = _share(mids, ["domain"], _case("lang", plan.langs), "lang").select("domain", "lang", "budget")
    ends = leaves.join(mids, ["domain", "lang"])
    return _share(ends, ["domain", "lang"], _case("source", plan.sources), "source").drop("cap")


def _draw(seed: int, epoch: Column, key: Column) -> Column:
    """60 seeded bits for a document in an epoch."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def selection(docs: DataFrame, plan: Plan = DEFAULT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows taken at least once: document, leaf, ``n_words`` and ``copies``."""
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("__id"),
        F.xxhash64(F.col(key), F.col(text)).alias("__fp"),
        F.col(key).alias("__key"),
        F.coalesce(F.expr(plan.domain), F.lit(NONE)).alias("domain"),
        F.coalesce("lang", F.lit(NONE)).alias("lang"),
        F.coalesce("source", F.lit(NONE)).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_words"),
    )
    rows = cut(rows)
    leaves = cut(rows.groupBy(*LEAF).agg(F.sum("n_words").alias("words")))
    quota = cut(
        budgets(leaves, plan)
        .withColumn("full", F.expr("CASE WHEN words = 0 THEN 0 ELSE budget DIV words END"))
        .withColumn("part", F.expr("budget - full * words"))
        .select(*LEAF, "full", "part")
    )
    drawn = rows.join(quota, LEAF).withColumn("draw", _draw(plan.seed, F.col("full"), F.col("__key")))
    drawn = drawn.withColumn("range", F.shiftright("draw", 48))
    sums = drawn.groupBy(*LEAF, "range").agg(F.sum("n_words").alias("w"), F.first("part").alias("part"))
    before = F.sum("w").over(Window.partitionBy(*LEAF).orderBy("range")) - F.col("w")
    ends = (
        sums.withColumn("before", before)
        .where("before + w > part")
        .groupBy(*LEAF)
        .agg(F.min(F.struct("range", "before")).alias("e"))
        .select(*LEAF, F.col("e.range").alias("end"), F.col("e.before").alias("before"))
    )
    placed = drawn.join(cut(ends), LEAF, "left")
    inside = Window.partitionBy(*LEAF).orderBy("draw", "__id", "__fp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.where("range = end").withColumn("__upto", F.col("before") + F.sum("n_words").over(inside))
    last = last.withColumn("__in", F.col("__upto") <= F.col("part")).drop("__upto")
    rest = placed.where("range <> end OR end IS NULL").withColumn("__in", F.expr("end IS NULL OR range < end"))
    taken = rest.unionAll(last.select(*rest.columns)).withColumn("copies", F.col("full") + F.col("__in").cast("long"))
    return taken.where("copies > 0").select("__id", "__fp", "__key", *LEAF, "n_words", "copies")


def mix(docs: DataFrame, plan: Plan = DEFAULT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The chosen rows with their own columns, each as often as it was taken."""
    chosen = selection(docs, plan, key, text)
    rows = keyed(docs, key, text)
    chosen = chosen.groupBy("__id", "__fp").agg(F.sum("copies").alias("__total"))
    same = rows.groupBy("__id", "__fp").agg(F.count(F.lit(1)).alias("__rows"))
    times = cut(chosen.join(same, ["__id", "__fp"]))
    copies = F.expr("CAST(__total DIV __rows + CASE WHEN __n <= __total % __rows THEN 1 ELSE 0 END AS INT)")
    out = rows.join(times.where("__rows = 1"), ["__id", "__fp"]).withColumn("__n", F.lit(1))
    several = times.where("__rows > 1")
    if not several.isEmpty():
        turn = F.row_number().over(Window.partitionBy("__id", "__fp").orderBy(F.lit(0)))
        out = out.unionAll(rows.join(several, ["__id", "__fp"]).withColumn("__n", turn))
    out = out.withColumn("__copies", copies).where("__copies > 0")
    return unpacked(out.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies")))))


def report(docs: DataFrame, plan: Plan = DEFAULT) -> DataFrame:
    return selection(docs, plan).select(F.col("__key").alias("doc_id"), *LEAF, "n_words", "copies")


def sql(plan: Plan = DEFAULT) -> str:
    def level(name: str, nodes: str, parent: str, weight: str) -> str:
        over = f"PARTITION BY {parent}" if parent else ""
        return f"""
{name}0 AS (SELECT * FROM (SELECT *, {weight} AS w FROM ({nodes})) WHERE w > 0),
{name}1 AS (SELECT *, coalesce(sum(cap) OVER ({over} ORDER BY cap / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
  sum(w) OVER ({over} ORDER BY cap / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM {name}0),
{name}2 AS (SELECT *, cap * rest <= w * (budget - spent) AS is_full FROM {name}1),
{name}3 AS (SELECT *, coalesce(sum(cap) FILTER (is_full) OVER ({over}), 0) AS used, sum(w) FILTER (NOT is_full) OVER ({over}) AS opened FROM {name}2),
{name}_budget AS (SELECT * EXCLUDE (budget), CASE WHEN is_full THEN cap ELSE (w * (budget - used) // opened)::BIGINT END AS budget FROM {name}3)"""

    return rf"""
WITH r AS MATERIALIZED (
  SELECT doc_id, coalesce({plan.domain}, '{NONE}') AS domain, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_words
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_words)::BIGINT AS words, (sum(n_words) * {plan.max_epochs})::BIGINT AS cap FROM r GROUP BY ALL),
top AS (SELECT floor(sum(words) * {plan.share} / 100)::BIGINT AS budget FROM leaf),
{level("domain", "SELECT domain, sum(cap)::BIGINT AS cap, any_value(budget) AS budget FROM leaf, top GROUP BY domain", "", _case("domain", plan.domains))},
{level("lang", "SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, any_value(b.budget) AS budget FROM leaf l JOIN domain_budget b USING (domain) GROUP BY ALL", "domain", _case("lang", plan.langs))},
{level("source", "SELECT l.*, b.budget FROM leaf l JOIN lang_budget b USING (domain, lang)", "domain, lang", _case("source", plan.sources))},
quota AS (SELECT domain, lang, source, full_n, budget - full_n * words AS part FROM (SELECT *, CASE WHEN words = 0 THEN 0 ELSE budget // words END AS full_n FROM source_budget)),
drawn AS (SELECT r.*, q.full_n, q.part, ('0x' || substr(md5('{plan.seed}:' || q.full_n || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS draw
  FROM r JOIN quota q USING (domain, lang, source)),
upto AS (SELECT *, sum(n_words) OVER (PARTITION BY domain, lang, source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM drawn)
SELECT doc_id, domain, lang, source, n_words, (full_n + CASE WHEN upto <= part THEN 1 ELSE 0 END)::BIGINT AS copies
FROM upto WHERE full_n + CASE WHEN upto <= part THEN 1 ELSE 0 END > 0
"""
