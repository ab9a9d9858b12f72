"""Small pieces the operators share. A table's own columns travel packed in one, so that they may have any name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annoframe.session import prepare

#: Characters between words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    found = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), BLANK_RUN)
    return F.filter(found, lambda w: w != "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``__row`` (all columns of ``docs``, packed), ``__key``, ``__text``, and ``__id`` (the key, 0 for null) and ``__fp``
    (hash of key and text), which together name a row. ``unpacked`` gives the columns back."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(key).alias("__key"),
        F.col(text).alias("__text"),
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("__id"),
        F.xxhash64(F.col(key), F.col(text)).alias("__fp"),
    )


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("__row.*")


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
