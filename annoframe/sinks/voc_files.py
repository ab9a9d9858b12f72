"""Whole Pascal VOC documents, one per image, written with a commit (S20, S25): files, or entries of bounded zip archives.

Millions of small files take a disk block each and as many moves; archives take what the documents need.

Each task writes the documents of its images into a folder of its own under a hidden job folder. Only when all tasks are
done are the files of the attempts that Spark accepted moved to their names, and the manifest of what was written beside
them; a job that fails leaves nothing.
"""

from __future__ import annotations

import itertools
import json
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from annoframe.functions.text import stem
from annoframe.sinks.labels import to_voc, voc_heads

TAIL = "</annotation>"
MANIFEST = "manifest.json"
#: Files moved at a time when the job is committed.
MOVERS = 32
#: An archive is closed at so many documents or bytes.
ARCHIVE_DOCUMENTS, ARCHIVE_BYTES = 20_000, 64 << 20
BATCH = 1024


@dataclass
class Written(WriterCommitMessage):
    """What one task attempt wrote, all of it under ``folder``."""

    folder: str
    images: int
    objects: int


class _Writer(DataSourceWriter):
    def __init__(self, path: str, documents: int = 0):
        self.path, self.documents, self.job = path, documents, f".job-{uuid.uuid4().hex}"

    def _home(self) -> tuple[fs.FileSystem, str]:
        system, home = fs.FileSystem.from_uri(self.path)
        return system, home.rstrip("/")

    def write(self, rows: Iterator[Row]) -> Written:
        system, home = self._home()
        done = Written(f"{home}/{self.job}/{uuid.uuid4().hex}", 0, 0)
        system.create_dir(done.folder, recursive=True)
        if self.documents:
            self._pack(system, rows, done)
            return done
        for name, parts in itertools.groupby(rows, key=lambda r: r["name"]):
            with system.open_output_stream(f"{done.folder}/{name}.xml") as out:
                self._document(out, parts, done)
        return done

    @staticmethod
    def _document(out, parts: Iterator[Row], done: Written) -> None:
        for part in parts:  # the head, then the objects in their order
            out.write(part["text"].encode())
            done.objects += part["place"] is not None
        out.write(TAIL.encode())
        done.images += 1

    def _pack(self, system: fs.FileSystem, rows: Iterator[Row], done: Written) -> None:
        groups = itertools.groupby(rows, key=lambda r: r["name"])
        ahead = next(groups, None)
        while ahead is not None:
            with (
                system.open_output_stream(f"{done.folder}/{uuid.uuid4().hex}.zip") as out,
                zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
            ):
                full = done.images + self.documents
                while ahead is not None and done.images < full and out.tell() < ARCHIVE_BYTES:
                    # The date is left at zip's first, so that equal documents give equal entries.
                    entry = zipfile.ZipInfo(f"{ahead[0]}.xml")
                    entry.compress_type = zipfile.ZIP_DEFLATED
                    with archive.open(entry, "w", force_zip64=True) as document:
                        self._document(document, ahead[1], done)
                    ahead = next(groups, None)

    def commit(self, messages: list[Written | None]) -> None:
        system, home = self._home()
        written = [m for m in messages if m is not None]
        with ThreadPoolExecutor(MOVERS) as pool:
            for task in written:
                files = system.get_file_info(fs.FileSelector(task.folder))
                list(pool.map(lambda f: system.move(f.path, f"{home}/{f.base_name}"), files))
        counts = {"images": sum(m.images for m in written), "annotations": sum(m.objects for m in written)}
        with system.open_output_stream(f"{home}/{MANIFEST}") as out:
            out.write(json.dumps(counts).encode())
        system.delete_dir(f"{home}/{self.job}")

    def abort(self, messages: list[Written | None]) -> None:
        system, home = self._home()
        if system.get_file_info(f"{home}/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{home}/{self.job}")


class VocFiles(DataSource):
    """Sink for rows ``name, place, text`` that come by name, then place (null: the head)."""

    @classmethod
    def name(cls) -> str:
        return "voc_files"

    def schema(self) -> str:
        return "name string, place bigint, text string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], int(self.options.get("documents", 0)))


def voc_parts(annotations: DataFrame, images: DataFrame) -> DataFrame:
    """``name, place, text``: the head of every image, and the objects of those images."""
    names = images.select("image_id", stem(F.col("filename")).alias("name"))
    heads = voc_heads(images).join(names, "image_id").select("name", F.lit(None).cast("long").alias("place"), F.col("head").alias("text"))
    objects = to_voc(annotations).join(names, "image_id").select("name", F.col("pos").cast("long").alias("place"), F.col("line").alias("text"))
    return heads.unionAll(objects)


def write_voc(annotations: DataFrame, images: DataFrame, folder: str, packed: bool = False) -> None:
    """One document per image: head, objects by ``pos``, tail. Images without objects get one too; two images of one name
    are refused before anything is written. ``packed`` puts the documents into zip archives of at most
    ``ARCHIVE_DOCUMENTS`` each, for more images than a folder should hold files."""
    spark = images.sparkSession
    spark.dataSource.register(VocFiles)
    twice = images.groupBy(stem(F.col("filename")).alias("name")).count().where("count > 1").select("name").limit(3).collect()
    if twice:
        raise ValueError(f"images share a document name: {[r['name'] for r in twice]}")
    ready = voc_parts(annotations, images).repartition("name").sortWithinPartitions("name", F.col("place").asc_nulls_first())
    documents = ARCHIVE_DOCUMENTS if packed else 0
    ready.write.format("voc_files").mode("append").option("path", folder).option("documents", documents).save()


def read_packed(spark: SparkSession, folder: str) -> DataFrame:
    """``path, text`` of the documents in the archives of ``write_voc``; a task holds some of an archive's documents."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            system, name = fs.FileSystem.from_uri(path)
            with system.open_input_file(name) as source, zipfile.ZipFile(source) as archive:
                for entries in itertools.batched(archive.namelist(), BATCH):
                    texts = [archive.read(e).decode() for e in entries]
                    yield pa.RecordBatch.from_pydict({"path": [f"{path}/{e}" for e in entries], "text": texts})

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path")
    return archives.mapInArrow(unpack, "path string, text string")
