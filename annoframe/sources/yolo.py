"""YOLO label text, class lists and label folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annoframe.functions.geometry import box, enclosing_box, points_from_flat
from annoframe.functions.text import base_name

# Class files in the order they are looked for.
CLASS_FILES = ("data.yaml", "data.yml", "classes.txt", "obj.names")
LINE_BREAKS = "\r\n|\r|\n"


def read_texts(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """``path, text`` of every file with the suffix under a folder, class files and readmes left out."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    name = F.lower(base_name(F.col("path")))
    return rows.where(~name.isin(*CLASS_FILES) & ~name.startswith("readme"))


def check_unique_names(files: DataFrame) -> DataFrame:
    """Label files keyed by ``name``; a name held by two folders is refused with the rows unread."""
    named = files.withColumn("name", base_name(F.col("path")))
    shared = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = named.join(shared, "name", "left")
    refused = F.raise_error(F.concat(F.lit("label file name in more than one folder: "), F.col("name")))
    return marked.withColumn("path", F.when(F.col("n") > 1, refused).otherwise(F.col("path"))).drop("n")


def lines_of(files: DataFrame, *keys: str) -> DataFrame:
    """``keys, pos, line``."""
    rows = files.select(*keys, F.posexplode(F.split("text", LINE_BREAKS)).alias("pos", "line"))
    return rows.withColumn("line", F.trim("line"))


def _tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def from_yolo(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """``pos, name, type, bbox, rings`` of box lines (four numbers) and polygon lines (six or more, even).

    ``lines`` carries ``line`` and the image's ``width, height``; ``classes`` is ``idx, name``. Blank
    lines, bad tokens, unknown class numbers and sizes that are not positive are skipped.
    """
    t = F.col("_t")
    parsed = (
        lines.where(F.trim("line") != "")
        .withColumn("_t", _tokens(F.col("line")))
        .withColumn("idx", F.when(t[0].rlike(r"^[+-]?[0-9]+$"), t[0].try_cast("int")))
        .withColumn("_v", F.transform(F.slice("_t", 2, F.size("_t") - 1), lambda s: s.try_cast("double")))
        .where(F.col("idx").isNotNull() & F.forall("_v", lambda v: v.isNotNull()))
        .join(F.broadcast(classes.select("idx", "name")), "idx")
    )
    v, w, h = F.col("_v"), F.col("width").cast("double"), F.col("height").cast("double")
    pw, ph = v[2] * w, v[3] * h
    boxed = F.when((F.size(v) == 4) & (pw > 0) & (ph > 0), box(v[0] * w - pw / 2, v[1] * h - ph / 2, pw, ph))
    scaled = F.transform(v, lambda c, i: c * F.when(i % 2 == 0, w).otherwise(h))
    ring = F.when((F.size(v) >= 6) & (F.size(v) % 2 == 0), points_from_flat(scaled))
    out = parsed.withColumns({"_b": boxed, "_r": ring}).where("_b is not null or _r is not null")
    return out.withColumns(
        {
            "type": F.when(F.col("_r").isNotNull(), F.lit("polygon")).otherwise(F.lit("bbox")),
            "bbox": F.coalesce("_b", enclosing_box(F.col("_r"))),
            "rings": F.when(F.col("_r").isNotNull(), F.array("_r")),
        }
    ).drop("_t", "_v", "_b", "_r", "idx", "line")


def check_class_numbers(lines: DataFrame, class_count: int) -> DataFrame:
    """One row when a label numbers a class past the list: the highest number and a file using it."""
    first = _tokens(F.col("line"))[0]
    numbers = lines.select("path", F.when(first.rlike("^[0-9]+$"), first.try_cast("bigint")).alias("n"))
    top = numbers.agg(F.max(F.struct("n", "path")).alias("m"))
    return top.where(F.col("m.n") >= class_count).select(F.col("m.n").alias("highest"), F.col("m.path").alias("path"))


def _unquoted(value: Column) -> Column:
    """A YAML scalar: what stands inside quotes, else the text before a comment."""
    quoted = F.regexp_extract(F.trim(value), r"""^(["'])(.*?)\1""", 2)
    return F.when(F.trim(value).rlike(r"""^(["']).*\1"""), quoted).otherwise(F.trim(F.regexp_replace(F.trim(value), r" #.*$", "")))


def yaml_names(text: Column) -> Column:
    """The ``names`` of a data file: ``[a, b]``, a ``- a`` block, or a ``0: a`` block by number."""
    inline = F.regexp_extract(text, r"(?m)^names:[ \t]*\[([^\]]*)\]?", 1)
    flat = F.filter(F.transform(F.split(inline, ","), _unquoted), lambda n: n != "")
    block = F.regexp_extract(text, r"(?m)^names:[ \t]*(?:#[^\n]*)?\r?\n((?:[ \t]*(?:#[^\n]*)?\r?\n|[ \t]*- [^\n]*(?:\n|\z)|[ \t]+[0-9]+[ \t]*:[^\n]*(?:\n|\z))+)", 1)
    items = F.transform(F.regexp_extract_all(block, F.lit(r"(?m)^[ \t]*- ([^\n]*)$"), F.lit(1)), _unquoted)
    numbered = F.transform(
        F.regexp_extract_all(block, F.lit(r"(?m)^[ \t]+([0-9]+[ \t]*:[^\n]*)$"), F.lit(1)),
        lambda s: F.struct(
            F.regexp_extract(s, "^([0-9]+)", 1).cast("int").alias("n"), _unquoted(F.regexp_extract(s, "^[0-9]+[ \t]*:(.*)$", 1)).alias("name")
        ),
    )
    by_number = F.transform(F.array_sort(numbered), lambda s: s["name"])
    return (
        F.when(F.size(flat) > 0, flat).when(F.size(numbered) > 0, by_number).when(F.size(items) > 0, items)
    )


def read_class_lists(spark: SparkSession, path: str) -> DataFrame:
    """``folder, rank, names`` of every class file under a folder."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "{data.yaml,data.yml,classes.txt,obj.names}")
    rows = files.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return class_lists(rows)


def class_lists(files: DataFrame) -> DataFrame:
    """Class files ``path, text`` as ``folder, rank, names``; rank is the order they are looked for."""
    name = base_name(F.col("path"))
    plain = F.filter(F.transform(F.split("text", LINE_BREAKS), lambda s: F.trim(s)), lambda s: s != "")
    rank = F.array_position(F.array(*map(F.lit, CLASS_FILES)), name)
    return files.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        rank.alias("rank"),
        F.when(name.rlike("ya?ml$"), yaml_names(F.col("text"))).otherwise(plain).alias("names"),
    )


def nearest_class_list(folders: DataFrame, lists: DataFrame) -> DataFrame:
    """Each label folder's class list: its own, its parent's or its grandparent's, the nearest first."""
    up = lambda p, n: F.regexp_replace(p, "(/[^/]*){%d}$" % n, "")
    steps = F.array(*[F.struct(F.lit(n).alias("up"), up(F.col("label_folder"), n).alias("folder")) for n in range(3)])
    asked = folders.select("label_folder", F.inline(steps))
    return asked.join(lists, "folder").groupBy("label_folder").agg(F.min_by("names", F.struct("up", "rank")).alias("names"))


def class_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """An inline class list as ``idx, name``."""
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")
