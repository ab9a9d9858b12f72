"""Line dedup: repeated runs of lines, found by prefix doubling over line ids, lose their later copies.

The lines of a document that hold a word form a sequence of line ids (a 64-bit hash of the line). The suffixes of all
sequences are grouped by their first 1, 2, 4 ... lines: the name of a group of 2^(k+1) lines is made from the names of
two groups of 2^k, and only suffixes that still share a group go on. Going back down the levels, each suffix that has
an earlier equal start is stretched by powers of two: the groups met are the longest-common-prefix intervals, and
a suffix takes the longest one of which it is not the first. A group's name stands for its place in the suffix array;
the order inside a group is never needed, so nothing is sorted over the whole table, and a hot line is only ever
counted, combined before the shuffle.

A run is a copy if the same lines start at an earlier place (by key, then line). Copies of at least ``min_chars``
characters (code points, without line ends) are deleted.

Defined cases: a null or empty text has no lines and stays as it is. Lines without a word are never part of a run, are
not counted and stay, unless the whole document goes. A document all of whose lines with a word are deleted goes.
Null keys come first. Rows equal in key and text are one document: they are cleaned alike. Other columns, whatever
their names and nulls, pass through. An empty table gives an empty result. A document's lines are held in one row, as
its text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.llm.common import BLANKS, keyed, let
from annoframe.session import cut

MIN_CHARS = 40

DOC = ["__id", "__fp"]


def positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line with a word: document, ``key``, ``pos`` among those lines, ``line`` among all, ``h``, ``chars``."""
    lines = F.filter(
        F.transform(
            F.split(F.col("__text"), "\n"),
            lambda x, i: F.struct(
                i.alias("line"),
                F.xxhash64(x).alias("h"),
                F.length(x).alias("chars"),
                (F.btrim(x, F.lit(BLANKS)) != "").alias("solid"),
            ),
        ),
        lambda x: x["solid"],
    )
    rows = keyed(docs, key, text)
    return rows.select(*DOC, "__key", F.posexplode(lines).alias("pos", "__x")).select(
        *DOC, "__key", "pos", F.col("__x.line").alias("line"), F.col("__x.h").alias("h"), F.col("__x.chars").alias("chars")
    )


def _place() -> Column:
    """Where a suffix starts: comparable over the whole table."""
    return F.struct("__key", "__fp", "pos")


def _shared(suffixes: DataFrame, name: str) -> DataFrame:
    """The suffixes whose group ``name`` has two members or more, with ``first`` of the group."""
    groups = suffixes.groupBy(name).agg(F.count(F.lit(1)).alias("__n"), F.min(_place()).alias("first")).where("__n > 1")
    return suffixes.join(groups.drop("__n"), name)


def _levels(lines: DataFrame) -> list[DataFrame]:
    """Level k: suffixes whose first 2^k lines occur elsewhere too, as (document, place, ``r`` the group's name)."""
    keep = [*DOC, "__key", "pos", "r"]
    level = cut(_shared(lines.withColumn("r", F.col("h")), "r").select(*keep))
    levels, k = [], 0
    while not level.isEmpty():
        levels.append(level)
        ahead = level.select(*DOC, (F.col("pos") - (1 << k)).alias("pos"), F.col("r").alias("r2"))
        doubled = level.join(ahead, [*DOC, "pos"]).withColumn("r", F.xxhash64("r", "r2")).drop("r2")
        level = cut(_shared(doubled, "r").select(*keep))
        k += 1
    return levels


def copied_runs(lines: DataFrame) -> DataFrame | None:
    """(document, ``pos``, ``len``): the longest run that starts here and starts at an earlier place too."""
    levels = _levels(lines)
    if not levels:
        return None
    # A row says: this suffix belongs to group ``g``, whose members share ``len`` lines. It asks if it may stretch. Rows that do
    # not ask are the first of their group, and so of every smaller group they are in.
    state = levels[0].select(*DOC, "__key", "pos", F.lit(0).alias("len"), F.lit(0).cast("long").alias("g"), F.lit(True).alias("asks"))
    for k in reversed(range(len(levels))):
        next_lines = levels[k].select(*DOC, F.col("pos").alias("__at"), F.col("r").alias("r2"))
        grown = (
            state.withColumn("__at", F.col("pos") + F.col("len"))
            .join(next_lines, [*DOC, "__at"], "left")
            .withColumn("g2", F.when(F.col("r2").isNotNull(), F.xxhash64("g", "r2")))
        )
        # Only groups with an asker that is not their first are met; no other join tells who goes on.
        groups = (
            grown.where("g2 IS NOT NULL")
            .groupBy("g2")
            .agg(F.min(_place()).alias("first"), F.max(F.when(F.col("asks"), _place())).alias("last"))
            .where("last > first")
        )
        # Suffixes without such a group get join keys of their own, or all of them would go to the one task of the null.
        spread = grown.drop("__at", "r2").withColumn("__to", F.coalesce("g2", F.xxhash64(*DOC, "pos")))
        found = groups.select(F.col("g2").alias("__to"), F.col("first").alias("__first"))
        met = cut(
            spread.join(found, "__to", "left")
            .withColumn("first", F.when(F.col("g2").isNotNull(), F.col("__first")))
            .withColumn("longer", F.coalesce(F.col("asks") & (F.col("first") < _place()), F.lit(False)))
            .drop("__to", "__first")
        )
        common = [*DOC, "__key", "pos"]
        wider = met.where("first IS NOT NULL").select(
            *common, (F.col("len") + (1 << k)).alias("len"), F.col("g2").alias("g"), F.col("longer").alias("asks")
        )
        # A suffix that has grown is not needed here any more: what it grew from holds an earlier one.
        same = met.where("NOT longer").select(*common, "len", "g", "asks")
        state = wider.unionAll(same)
    return state.where("asks AND len > 0").select(*DOC, "pos", "len")


def deleted_lines(lines: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame | None:
    """(document, ``gone``): the numbers of the lines to delete."""
    lines = cut(lines.dropDuplicates([*DOC, "pos"]))
    runs = copied_runs(lines)
    if runs is None:
        return None
    doc = Window.partitionBy(*DOC).orderBy("pos")
    # Only documents with a run matter; their lines are laid side by side to add up characters.
    laid = lines.join(runs.select(*DOC).distinct(), DOC, "left_semi").withColumn("upto", F.sum("chars").over(doc))
    starts = runs.join(laid.select(*DOC, "pos", (F.col("upto") - F.col("chars")).alias("before")), [*DOC, "pos"])
    ends = laid.select(*DOC, F.col("pos").alias("__last"), "upto")
    long_enough = (
        starts.withColumn("__last", F.col("pos") + F.col("len") - 1)
        .join(ends, [*DOC, "__last"])
        .where(F.col("upto") - F.col("before") >= min_chars)
        .select(*DOC, "pos", (F.col("__last") + 1).alias("end"))
    )
    reach = F.max("end").over(doc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        laid.join(long_enough, [*DOC, "pos"], "left")
        .withColumn("__reach", reach)
        .where("__reach > pos")
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_list("line")).alias("gone"))
    )


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Packed rows plus ``__left`` (the text, null where nothing is left), ``__lines`` (with a word), ``__gone`` (deleted)."""
    gone = deleted_lines(positions(docs, key, text), min_chars)
    rows, none = keyed(docs, key, text), F.array().cast("array<int>")
    if gone is None:
        marked = rows.withColumn("__dels", none)
    else:
        marked = rows.join(gone.withColumnRenamed("gone", "__dels"), DOC, "left").withColumn("__dels", F.coalesce("__dels", none))
    solid = F.size(F.filter(F.split(F.coalesce("__text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    left = let(
        F.col("__dels"),
        lambda d: F.array_join(F.filter(F.split(F.col("__text"), "\n"), lambda x, i: ~F.array_contains(d, i)), "\n"),
    )
    return (
        marked.withColumn("__lines", solid)
        .withColumn("__gone", F.size("__dels"))
        .withColumn(
            "__left",
            F.when(F.col("__gone") == 0, F.col("__text")).when(F.col("__gone") < F.col("__lines"), left),
        )
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without later copies of repeated line runs; a document with nothing left goes."""
    rows = cleaned(docs, key, text, min_chars).where("__gone = 0 OR __left IS NOT NULL")
    return rows.select(*[F.col("__left").alias(text) if c == text else F.col("__row").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: lines with a word, lines deleted, what is left of the text (null if nothing)."""
    return cleaned(docs, key, text).select(
        F.col("__key").alias(key),
        F.col("__lines").cast("long").alias("n_lines"),
        F.col("__gone").cast("long").alias("n_deleted"),
        F.col("__left").alias("text"),
    )


def sql() -> str:
    """The same in DuckDB: equal lines are paired and consecutive pairs joined into runs."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id, text) AS rid, text FROM documents),
raw AS (SELECT rid, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM d),
lines AS (SELECT rid, line, l, row_number() OVER (PARTITION BY rid ORDER BY line) AS pos FROM raw WHERE trim(l, {blank}) <> ''),
pairs AS (
  SELECT a.rid, a.pos, b.rid AS rid2, a.pos - b.pos AS diag, length(a.l) AS chars
  FROM lines a JOIN lines b ON a.l = b.l AND (b.rid < a.rid OR b.rid = a.rid AND b.pos < a.pos)
), isles AS (
  SELECT *, pos - row_number() OVER (PARTITION BY rid, rid2, diag ORDER BY pos) AS isle FROM pairs
), runs AS (
  SELECT rid, min(pos) AS lo, max(pos) AS hi FROM isles GROUP BY rid, rid2, diag, isle HAVING sum(chars) >= {MIN_CHARS}
), gone AS (
  SELECT DISTINCT l.rid, l.line FROM lines l JOIN runs r ON r.rid = l.rid AND l.pos BETWEEN r.lo AND r.hi
), left_over AS (
  SELECT raw.rid, string_agg(l, chr(10) ORDER BY raw.line) AS text
  FROM raw LEFT JOIN gone g ON g.rid = raw.rid AND g.line = raw.line WHERE g.rid IS NULL GROUP BY raw.rid
), n AS (
  SELECT rid, count(*) AS n_lines, count(g.line) AS n_deleted FROM lines LEFT JOIN gone g USING (rid, line) GROUP BY rid
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted,
  CASE WHEN coalesce(n_deleted, 0) = 0 THEN d.text WHEN n_deleted < n_lines THEN o.text END AS text
FROM d LEFT JOIN n USING (rid) LEFT JOIN left_over o USING (rid)
"""
