"""what the COCO queries keep on disk is packed, and ids stay ranks over all entries."""

from __future__ import annotations

import gzip
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annoframe import members
from annoframe.plans import files
from annoframe.plans.tables import Tables
from annoframe.session import scratch_dir
from annoframe.sinks import coco as coco_sink
from annoframe.sources import coco_document


def size(path):
    return sum(os.path.getsize(os.path.join(at, n)) for at, _, names in os.walk(path) for n in names)


def tables(spark, path, n):
    i = F.col("id")
    spark.range(n).select(
        (i / 5).cast("long").alias("l_orderkey"), (i % 5).cast("int").alias("l_linenumber"), (i * 37 % 991).alias("l_partkey"),
        (i * 11 % 97).alias("l_suppkey"), (i % 50).cast("double").alias("l_quantity"), (i * 1.5).alias("l_extendedprice"),
        F.date_add(F.lit("1995-01-01").cast("date"), (i % 900).cast("int")).alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(n // 5).select(
        i.alias("o_orderkey"), (i % 100).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (i * 1.5).alias("o_totalprice"),
        F.lit("1995-01-01").cast("date").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{path}/orders.parquet")
    return Tables(spark, str(path))


def test_round_trip_keeps_little_on_disk(spark, tmp_path):
    t = tables(spark, tmp_path, 40_000)
    coco_sink.write_coco(coco_sink.to_coco(files.annotations(t), t.images), str(tmp_path / "plain"))
    plain, before = size(tmp_path / "plain"), size(scratch_dir(spark))
    assert files.coco_round_trip(t).count() == 32_000
    # Checkpoints of whole rows and plain text took more than the text alone.
    assert size(scratch_dir(spark)) - before < plain / 2


def test_ids_count_entries_without_a_known_image(spark):
    box = "named_struct('x', 1D, 'y', 1D, 'w', 2D, 'h', 2D)"
    rows = spark.createDataFrame(
        [(i, p, "bbox") for p, i in enumerate((3, 1, None, 2, 1, 9, 3, None, 5))], "image_id long, pos long, type string"
    ).selectExpr(
        "image_id", "cast(pos as string) ann_id", "pos", "'c' name", "type", f"{box} bbox", "cast(null as struct<x:double,y:double>) point",
        "cast(null as array<array<struct<x:double,y:double>>>) rings", "cast(null as array<struct<x:double,y:double>>) path",
        "cast(null as int) instance_id", "1D confidence", "map('pos', cast(pos as string)) attributes",
    )
    images = spark.createDataFrame([(i, f"{i}.jpg", 9, 9) for i in (1, 2, 3, 5)], "image_id long, filename string, width int, height int")
    _, out, _ = coco_sink.to_coco(rows, images)
    # Two entries without an image come first; that of image 9, which is not known, comes last.
    assert sorted((r.id, r.image_id, r.attributes["pos"]) for r in out.collect()) == [
        (3, 1, "1"), (4, 1, "4"), (5, 2, "3"), (6, 3, "0"), (7, 3, "6"), (8, 4, "8"),
    ]


def test_packed_document_is_one_valid_file_and_read_by_ranges(spark, tmp_path):
    names = ['a"b', "c\\", "[{", "日本", "]}"]
    images = spark.createDataFrame([(i, f"{names[i % 5]}{i}.jpg", 4, 4) for i in range(300)], "id long, file_name string, width int, height int")
    anns = images.selectExpr("cast(id as string) id", "id image_id", "1L category_id", "map('note', file_name) attributes").repartition(4, "id")
    cats = spark.createDataFrame([(1, "x")], "id long, name string")
    path = str(tmp_path / "out.json.gz")
    for size in (1, 700, 1 << 20):
        coco_sink.write_packed_document((images, anns, cats.limit(0) if size == 700 else cats), path, size)
        doc = json.loads(gzip.decompress((tmp_path / "out.json.gz").read_bytes()))
        assert [len(doc[k]) for k in ("images", "annotations", "categories")] == [300, 300, 0 if size == 700 else 1]
        assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out.json.gz"]
        back = coco_document.read_coco_document(spark, path, 900)
        assert back[2].rdd.getNumPartitions() > 3
        assert sorted((r.id, r.file_name) for r in back[0].collect()) == sorted((r.id, r.file_name) for r in images.collect())
        assert [(r.id, r.attributes["note"]) for r in back[2].orderBy("pos").collect()] == [(a["id"], a["attributes"]["note"]) for a in doc["annotations"]]
        assert back[1].count() == len(doc["categories"])


def test_text_of_members_from_any_place():
    rng = random.Random(1)
    text = bytes(rng.randrange(256) for _ in range(5000))
    cuts = sorted(rng.sample(range(1, 5000), 30))
    file = b"".join(members.member(text[a:b]) for a, b in zip([0, *cuts], [*cuts, 5000]))
    assert gzip.decompress(file) == text
    stream = pa.BufferReader(file)
    places = members.Members(stream).places()
    assert places[-1] == (5000, len(file)) and len(places) == 32
    for _ in range(300):
        lo, n = rng.randrange(5000), rng.randrange(1, 900)
        assert members.Members(stream, places[rng.randrange(32)]).read_at(n, lo) == text[lo : lo + n]
    with pytest.raises(ValueError):
        members.Members(pa.BufferReader(gzip.compress(text))).places()


def test_one_document_is_kept_packed(spark, tmp_path):
    t = tables(spark, tmp_path, 40_000)
    coco_sink.write_coco(coco_sink.to_coco(files.annotations(t), t.images), str(tmp_path / "plain"))
    plain, before = size(tmp_path / "plain"), size(scratch_dir(spark))
    assert files.coco_document(t).count() == 32_000
    assert size(scratch_dir(spark)) - before < plain / 2


def test_a_record_is_parsed_once_whatever_is_asked_of_it(spark, tmp_path):
    doc = {"images": [], "categories": [], "annotations": [{"id": str(i), "image_id": i, "category_id": 1, "bbox": [1, 2, 3, 4]} for i in range(9)]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    rows = coco_document.read_coco_document(spark, str(tmp_path / "d.json"))[2].where("image_id > 3 and category_id = 1 and size(bbox) = 4")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted(r.id for r in rows.select("id").collect()) == ["4", "5", "6", "7", "8"]
