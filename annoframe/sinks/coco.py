"""Annotation rows to COCO tables and files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoframe.functions.geometry import annotation_box, box, flatten_ring, rings_area
from annoframe.functions.keypoints import MIN_SIDE, coco_triplets, floor_sides, labelled, other_attributes, trainable_box, visibility
from annoframe.members import MEMBER_BYTES, member
from annoframe.operators.poses import OBJECT, slotted
from annoframe.scale import global_rank, running_sums
from annoframe.session import kept

#: Bytes that are copied at a time into one document.
BLOCK = 4 << 20


def _numbers(b: Column) -> Column:
    return F.array(b["x"], b["y"], b["w"], b["h"])


def _shapes(annotations: DataFrame) -> DataFrame:
    rows = annotations.where(F.col("type").isin("bbox", "polygon")).withColumn(
        "b", annotation_box(F.col("type"), F.col("bbox"), F.col("rings"), F.col("path"))
    )
    polygon = F.col("type") == "polygon"
    return rows.where("b is not null").select(
        "image_id",
        F.lit(0).alias("part"),
        F.col("pos").alias("place"),
        F.lit(0).cast("bigint").alias("sub"),
        F.col("name").alias("category"),
        F.lit(None).cast("array<double>").alias("keypoints"),
        F.lit(None).cast("int").alias("num_keypoints"),
        _numbers(F.col("b")).alias("bbox"),
        F.when(polygon, rings_area(F.col("rings"))).otherwise(F.col("b.w") * F.col("b.h")).alias("area"),
        F.when(polygon, F.transform("rings", flatten_ring)).alias("segmentation"),
        "attributes",
    )


def _poses(annotations: DataFrame, images: DataFrame, templates: DataFrame) -> DataFrame:
    """One entry per matched object and one per point that took no slot."""
    points = annotations.where("type = 'keypoint'").select(
        "image_id", "ann_id", "pos", F.col("name").alias("joint"), F.col("point.x").alias("px"), F.col("point.y").alias("py"),
        "instance_id", "attributes",
    )
    placed = slotted(points, templates)
    won, loose = placed.where("slot is not null"), placed.where("slot is null")
    # Objects with an id come first by id, single points after them by position.
    order = F.coalesce(F.col("instance_id").cast("bigint"), F.lit(1 << 40) + F.col("pos"))
    entry = F.struct("slot", F.struct(F.col("px").alias("x"), F.col("py").alias("y"), visibility(F.col("attributes")).alias("v")))
    held = won.groupBy(*OBJECT, "class").agg(
        F.map_from_entries(F.collect_list(entry)).alias("slots"),
        F.min(order).alias("place"),
        F.min("px").alias("x0"), F.max("px").alias("x1"), F.min("py").alias("y0"), F.max("py").alias("y1"),
        F.min_by("attributes", "pos").alias("attributes"),
    )
    sizes = templates.select("class", F.size("joints").alias("size"))
    objects = held.join(F.broadcast(sizes), "class").select(
        "image_id", "place", F.lit(0).cast("bigint").alias("sub"), F.col("class").alias("category"),
        coco_triplets(F.col("slots"), F.col("size")).alias("keypoints"), "x0", "x1", "y0", "y1", "attributes",
    )
    v = visibility(F.col("attributes")).cast("double")
    singles = loose.select(
        "image_id", order.alias("place"), (F.col("pos") + 1).alias("sub"), F.col("joint").alias("category"),
        F.array("px", "py", v).alias("keypoints"), F.col("px").alias("x0"), F.col("px").alias("x1"),
        F.col("py").alias("y0"), F.col("py").alias("y1"), "attributes",
    )
    both = objects.unionByName(singles).join(images.select("image_id", "width", "height"), "image_id", "left")
    hull = floor_sides(box(F.col("x0"), F.col("y0"), F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), F.lit(MIN_SIDE))
    size = [F.coalesce(c, F.lit(0)).cast("double") for c in ("width", "height")]
    boxed = both.withColumn("b", trainable_box(hull, *size))
    return boxed.select(
        "image_id", F.lit(1).alias("part"), "place", "sub", "category", "keypoints",
        labelled(F.col("keypoints")).alias("num_keypoints"), _numbers(F.col("b")).alias("bbox"),
        (F.col("b.w") * F.col("b.h")).alias("area"), F.array().cast("array<array<double>>").alias("segmentation"),
        other_attributes(F.col("attributes")).alias("attributes"),
    )


def to_coco(annotations: DataFrame, images: DataFrame, templates: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(images, annotations, categories)`` tables with 1-based ids.

    Polylines have no COCO form. Ids are ranks over a full order: an entry's place in its image behind the entries of the
    images before, so that rows are dealt once, by image, for the rank and for the image's number. Only the class list,
    which is small, is numbered in one place.
    """
    spark = annotations.sparkSession
    if templates is None:
        templates = spark.createDataFrame([], "class string, place int, joints array<string>, edges array<struct<i:int,j:int>>")
    # Three tables and a rank read the entries, so they are worked out once.
    entries = kept(_shapes(annotations).unionByName(_poses(annotations, images, templates)))
    lone = entries.where("part = 1").select("category").distinct().join(
        templates.select(F.col("class").alias("category")), "category", "left_anti"
    ).withColumn("lone", F.lit(True))
    names = entries.select("category").distinct()
    numbered = names.select("category", F.row_number().over(Window.orderBy("category")).alias("category_id"))
    joints = templates.select(F.col("class").alias("category"), "joints", "edges")
    categories = (
        numbered.join(joints, "category", "left")
        .join(lone, "category", "left")
        .select(
            F.col("category_id").alias("id"),
            F.col("category").alias("name"),
            F.coalesce("joints", F.when(F.col("lone"), F.array("category"))).alias("keypoints"),
            F.coalesce(
                F.transform("edges", lambda e: F.array(e["i"] + 1, e["j"] + 1)), F.when(F.col("lone"), F.array().cast("array<array<int>>"))
            ).alias("skeleton"),
        )
    )
    files = global_rank(images.select("image_id", "filename", "width", "height"), [F.col("image_id")], "id")
    counts = entries.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    starts = running_sums(counts, [], [F.col("image_id")], {"upto": F.col("n")}).select("image_id", (F.col("upto") - F.col("n")).alias("before"))
    ranked = global_rank(entries, [F.col(c) for c in ("part", "place", "sub")], "nth", ["image_id"]).join(starts, "image_id")
    out = ranked.join(files.select("image_id", F.col("id").alias("coco_image")), "image_id").join(F.broadcast(numbered), "category").select(
        (F.col("before") + F.col("nth")).alias("id"), F.col("coco_image").alias("image_id"), "category_id", F.lit(0).alias("iscrowd"),
        "bbox", "area", "segmentation", "keypoints", "num_keypoints", F.when(F.size("attributes") > 0, F.col("attributes")).alias("attributes"),
    )
    return files.select("id", F.col("filename").alias("file_name"), "width", "height"), out, categories


def write_coco(tables: tuple[DataFrame, DataFrame, DataFrame], path: str, compression: str = "none") -> None:
    """JSON-lines parts under ``images``, ``annotations`` and ``categories``; nothing is merged into one file."""
    for name, table in zip(("images", "annotations", "categories"), tables):
        table.write.mode("overwrite").json(f"{path}/{name}", compression=compression)


def _packer(name: str, parts: str, member_bytes: int):
    """Records to the members of a file for each task that has some; gives the file's name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        file = f"{name}-{context.partitionId():08d}-{context.taskAttemptId()}"
        system, home = fs.FileSystem.from_uri(parts)
        out, held, size = None, [], 0

        def flush() -> None:
            nonlocal out, held, size
            text = b",\n".join(held)
            if out is None:
                system.create_dir(home)
                out = system.open_output_stream(f"{home}/{file}", compression=None)
            else:
                text = b",\n" + text
            out.write(member(text))
            held, size = [], 0

        for batch in batches:
            for record in batch.column(0).cast(pa.binary()).to_pylist():
                held.append(record)
                size += len(record)
                if size >= member_bytes:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [file]})

    return run


def write_packed_document(tables: tuple[DataFrame, DataFrame, DataFrame], path: str, member_bytes: int = MEMBER_BYTES) -> None:
    """One JSON document at ``path``, which ends in ``.gz``, in gzip members that tell their sizes. All tasks pack their records;
    a single task then puts the files of accepted attempts one behind the other."""
    if not path.endswith(".gz"):
        raise ValueError("a packed document's name ends in .gz")
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    spark, files = tables[0].sparkSession, {}
    for name, table in zip(("images", "annotations", "categories"), tables):
        records = table.select(F.to_json(F.struct(*table.columns)).alias("record"))
        files[name] = sorted(r["file"] for r in records.mapInArrow(_packer(name, parts, member_bytes), "file string").collect())

    def join(rows: Iterator) -> None:
        for _ in rows:
            system, home = fs.FileSystem.from_uri(parts)
            target = fs.FileSystem.from_uri(path)[1]
            system.create_dir(home)
            with system.open_output_stream(f"{home}/document", compression=None) as out:
                for i, name in enumerate(("images", "categories", "annotations")):
                    out.write(member(f"{',' if i else '{'}\"{name}\":[".encode()))
                    for j, file in enumerate(files[name]):
                        if j:
                            out.write(member(b",\n"))
                        with system.open_input_stream(f"{home}/{file}", compression=None) as packed:
                            while block := packed.read(BLOCK):
                                out.write(block)
                    out.write(member(b"]"))
                out.write(member(b"}"))
            system.move(f"{home}/document", target)
            system.delete_dir(home)

    spark.range(1).coalesce(1).foreachPartition(join)


def write_coco_document(tables: tuple[DataFrame, DataFrame, DataFrame], path: str) -> None:
    """One JSON document at ``path``, for tools that want one. The records are written in packed parts by all tasks; a single
    task then streams the parts into the file, block by block, and renames it when it is whole."""
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    write_coco(tables, parts, "gzip")
    spark = tables[0].sparkSession

    def join(rows: Iterator) -> None:
        for _ in rows:
            system, home = fs.FileSystem.from_uri(parts)
            target = fs.FileSystem.from_uri(path)[1]
            with system.open_output_stream(f"{home}/document") as out:
                for i, name in enumerate(("images", "categories", "annotations")):
                    out.write(f"{',' if i else '{'}\"{name}\":[".encode())
                    held = b""  # the line break behind what was written, a comma's place once more follows
                    files = system.get_file_info(fs.FileSelector(f"{home}/{name}"))
                    for file in sorted(f.path for f in files if f.base_name.startswith("part-")):
                        with system.open_input_stream(file, compression="gzip") as lines:
                            while block := lines.read(BLOCK):
                                block = held + block
                                held = b"\n" if block.endswith(b"\n") else b""
                                out.write(block[: len(block) - len(held)].replace(b"\n", b",\n"))
                    out.write(b"]")
                out.write(b"}")
            system.move(f"{home}/document", target)
            system.delete_dir(home)

    spark.range(1).coalesce(1).foreachPartition(join)
