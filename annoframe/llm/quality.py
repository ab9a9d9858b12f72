"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at counts of one document and votes *good*, votes *bad* or abstains. The votes of all documents are
counted by vote pattern (at most 3^rules rows, combined before the shuffle), and a two-class model with one
"says good" rate per rule and class is fitted to the pattern counts on the driver. A document is kept when its posterior
probability of being good is at least one half and no base limit fails.

Defined cases: a null or empty text has no words, so every count is 0, ``base_failed`` is true and it is not kept.
Null values in other columns and extra columns pass through untouched. Repeated rows each count and get equal
verdicts. An empty table gives an empty result. Work per document is linear but for one sort of its windows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoframe.llm.common import BLANKS, let, unpacked, words_of
from annoframe.session import cut

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, else bad where ``bad`` holds, else abstains. Both are SQL over the counts."""

    name: str
    good: str
    bad: str
    #: Expected share of good votes among its votes on good and on bad documents. One failing kind of junk passes
    #: most rules, so a good vote says little and a bad one much.
    on_good: float
    on_bad: float


#: Conditions are products of whole numbers, so that every engine decides them alike.
RULES = (
    Rule("length", "n_words >= 80", "n_words < 50", 0.97, 0.7),
    Rule("word_length", "word_chars >= 3 * n_words AND word_chars <= 9 * n_words", "word_chars > 12 * n_words", 0.99, 0.8),
    Rule("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words", 0.995, 0.6),
    Rule("lines", "20 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines", 0.93, 0.7),
    Rule("repeats", "10 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words", 0.97, 0.6),
    Rule("capitals", "10 * n_capitals <= word_chars", "2 * n_capitals > word_chars", 0.995, 0.7),
    Rule("stops", "2 * n_stops <= n_words", "10 * n_stops > 8 * n_words", 0.995, 0.7),
)
ROUNDS = 20
#: Expected share of good documents.
PRIOR = 0.7
#: Weight of the expected rates against 1 for what the votes of all documents say.
EXPECTED = 3.0
#: Bounds of the fitted rates.
FLOOR, CEIL = 0.002, 0.998


def _repeats(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, all occurrences counted."""
    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            pairs,
            lambda p: F.filter(
                F.transform(
                    p,
                    lambda x, n: F.when(
                        (F.get(p, n - 1)["h"] == x["h"]) | (F.get(p, n + 1)["h"] == x["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        spread = F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))
        return F.size(F.array_distinct(spread))

    return let(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )


def counts(text: Column) -> Column:
    """One struct of whole-text counts."""
    t = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        solid = F.length(F.translate(t, BLANKS, ""))
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
        whole = {
            "n_words": F.size(words),
            "word_chars": solid,
            "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeats(words),
            "n_capitals": F.length(t) - F.length(F.translate(t, CAPITALS, "")),
            "n_stops": F.length(t) - F.length(F.translate(t, ".!?", "")),
        }
        return F.struct(*[v.cast("long").alias(k) for k, v in whole.items()])

    return let(words_of(text), of_words)


BASE_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"


def _vote(rule: Rule) -> str:
    return f"CASE WHEN {rule.good} THEN 1 WHEN {rule.bad} THEN 0 END"


def votes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the struct ``__q`` of counts, ``__base`` and one vote column ``__v0``, ``__v1`` ... per rule."""
    counted = docs.withColumn("__q", counts(F.col(text)))
    within = lambda sql: F.expr(_inside(sql))
    return counted.withColumns(
        {"__base": within(BASE_FAILED)} | {f"__v{j}": within(_vote(r)).cast("int") for j, r in enumerate(RULES)}
    )


def _inside(sql: str) -> str:
    """The same condition over the fields of ``__q``."""
    for name in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_stops"):
        sql = sql.replace(name, f"__q.{name}")
    return sql


def _logit(prior: float, good: list[float], bad: list[float], vote) -> Column:
    """Log odds of good given the votes."""
    total = F.lit(math.log(prior / (1 - prior)))
    for j, (a, b) in enumerate(zip(good, bad)):
        total = total + (
            F.when(vote(j) == 1, F.lit(math.log(a / b)))
            .when(vote(j) == 0, F.lit(math.log((1 - a) / (1 - b))))
            .otherwise(F.lit(0.0))
        )
    return total


@dataclass(frozen=True)
class Model:
    """Prior of good, and each rule's rate of voting good on good and on bad documents."""

    prior: float
    good: list[float]
    bad: list[float]

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-_logit(self.prior, self.good, self.bad, lambda j: F.col(f"__v{j}"))))

    def of_pattern(self, pattern: tuple[int, ...]) -> float:
        """The posterior of one vote pattern (-1: abstained)."""
        odds = math.log(self.prior / (1 - self.prior))
        for vote, a, b in zip(pattern, self.good, self.bad):
            odds += math.log(a / b) if vote == 1 else math.log((1 - a) / (1 - b)) if vote == 0 else 0.0
        return 1 / (1 + math.exp(-odds))


def fit(voted: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the pattern counts of all documents: at most 3^rules rows, which the driver holds, so that
    no round starts a job of its own."""
    names = [f"__v{j}" for j in range(len(RULES))]
    patterns = sorted(
        (tuple(r[:-1]), r[-1]) for r in voted.groupBy(*[F.coalesce(n, F.lit(-1)).alias(n) for n in names]).agg(F.count(F.lit(1))).collect()
    )
    model = Model(PRIOR, [r.on_good for r in RULES], [r.on_bad for r in RULES])
    clip = lambda x: min(CEIL, max(FLOOR, x))
    for _ in range(rounds if patterns else 0):
        weighed = [(v, n * p, n * (1 - p)) for v, n in patterns for p in (model.of_pattern(v),)]

        def rate(side: int, j: int, start: float) -> float:
            good = math.fsum(w[side] for w in weighed if w[0][j] == 1)
            seen = math.fsum(w[side] for w in weighed if w[0][j] != -1)
            return clip(((good / seen if seen else start) + EXPECTED * start) / (1 + EXPECTED))

        share = math.fsum(w[1] for w in weighed) / sum(n for _, n in patterns)
        model = Model(
            clip((share + EXPECTED * PRIOR) / (1 + EXPECTED)),
            [rate(1, j, r.on_good) for j, r in enumerate(RULES)],
            [rate(2, j, r.on_bad) for j, r in enumerate(RULES)],
        )
    return model


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``__q`` (counts), ``__base`` (base limits fail), ``__quality`` (posterior) and ``__kept``."""
    return _judged(votes(docs, text))


def _judged(voted: DataFrame) -> DataFrame:
    model = fit(voted)
    return voted.withColumn("__quality", model.posterior()).withColumn(
        "__kept", ~F.col("__base") & (F.col("__quality") >= 0.5)
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows judged good, with the columns they came with."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text).alias("__text"))
    return unpacked(judge(rows, "__text").where("__kept"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts, base verdict, posterior and verdict per document."""
    # The texts are counted once: the fit and the verdicts read the counts and votes, which are short.
    return _judged(cut(votes(docs.select(key, text), text).drop(text))).select(
        key,
        *[F.col(f"__q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__base").alias("base_failed"),
        F.col("__kept").alias("kept"),
        F.round("__quality", 6).alias("quality"),
    )


def sql() -> str:
    """The same in DuckDB, with the rounds of the fit written out."""
    k = range(len(RULES))
    steps = [f"m0 AS (SELECT {PRIOR}::DOUBLE AS prior, " + ", ".join(f"{r.on_good}::DOUBLE AS a{j}, {r.on_bad}::DOUBLE AS b{j}" for j, r in enumerate(RULES)) + ")"]
    logit = "ln(prior / (1 - prior)) + " + " + ".join(
        f"CASE v{j} WHEN 1 THEN ln(a{j} / b{j}) WHEN 0 THEN ln((1 - a{j}) / (1 - b{j})) ELSE 0 END" for j in k
    )
    clip = lambda x: f"least({CEIL}, greatest({FLOOR}, {x}))"
    for i in range(1, ROUNDS + 1):
        steps.append(f"e{i} AS MATERIALIZED (SELECT p.*, 1 / (1 + exp(-({logit}))) AS post FROM pat p, m{i - 1})")
        rates = ", ".join(
            clip(
                f"(coalesce(coalesce(sum(n * {w}) FILTER (v{j} = 1), 0) / nullif(sum(n * {w}) FILTER (v{j} IS NOT NULL), 0), {start}) + {EXPECTED * start}) / {1 + EXPECTED}"
            )
            + f" AS {tag}{j}"
            for j, r in enumerate(RULES)
            for tag, w, start in (("a", "post", r.on_good), ("b", "(1 - post)", r.on_bad))
        )
        steps.append(f"m{i} AS MATERIALIZED (SELECT {clip(f'(sum(n * post) / sum(n) + {EXPECTED * PRIOR}) / {1 + EXPECTED}')} AS prior, {rates} FROM e{i})")
    vote = ", ".join(f"{_vote(r)} AS v{j}" for j, r in enumerate(RULES))
    pat = ", ".join(f"v{j}" for j in k)
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM words, unnest(generate_series(1, len(w) - 2)) AS s(i)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1
), reps AS (
  SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS q(o) GROUP BY rid
), cnt AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{blank}', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::BIGINT AS n_lines,
    len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))::BIGINT AS n_unique,
    length(t) - length(translate(t, '{CAPITALS}', '')) AS n_capitals,
    length(t) - length(translate(t, '.!?', '')) AS n_stops
  FROM words
), q AS (
  SELECT rid, doc_id, n_words, word_chars, n_symbols, n_lines, n_lines - n_unique AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_capitals, n_stops
  FROM cnt LEFT JOIN reps USING (rid)
), v AS MATERIALIZED (SELECT *, ({BASE_FAILED}) AS base_failed, {vote} FROM q),
pat AS MATERIALIZED (SELECT {pat}, count(*) AS n FROM v GROUP BY ALL),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 1 / (1 + exp(-({logit}))) >= 0.5 AS kept, round(1 / (1 + exp(-({logit}))), 6) AS quality
FROM v, m{ROUNDS}
"""
