"""Session settings the jobs rely on, and where lineage may be cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles a method of over 8,000 bytes; Spark's own limit lets it run such ones interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build(master: str | None = None, app: str = "annoframe", **extra: str) -> SparkSession:
    """A session with the settings above. Cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime-changeable settings on a session somebody else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where that is unset, a temporary one, and only in local mode."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(shared)
        return shared
    if sc.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so a lost executor costs no recompute."""
    scratch_dir(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """Like ``cut``, in columns and packed: for wide rows that are read several times, each time a few of their columns."""
    path = f"{scratch_dir(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
