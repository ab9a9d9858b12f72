"""Sources and sinks on hand-written files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from annoframe.operators import masks, transforms
from annoframe.sinks import labels
from annoframe.sources import coco, files, yolo


def test_coco_file_rules(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "file_name": "a.jpg", "width": 10, "height": 10}],
        "categories": [
            {"id": 2, "name": "dog"},
            {"id": 1, "name": "person", "keypoints": ["nose", "tail", "dog"], "skeleton": [[1, 2], [2, 2], [3, 9]]},
        ],
        "annotations": [
            {"id": 1, "image_id": 1, "category_id": 2, "bbox": [1, 2, 3, 4], "score": 0.5, "attributes": {"c": "red"}},
            {"id": 2, "image_id": 1, "category_id": 2, "bbox": [0, 0, 5, 5], "segmentation": [[0, 0, 4, 0, 4, 4], [1, 1]]},
            {"id": 3, "image_id": 1, "category_id": 2, "bbox": [0, 0, 5, 5], "segmentation": [[0, 0, 4, 0]]},
            {"id": 4, "image_id": 1, "category_id": 2, "bbox": [0, 0, 5, 5], "segmentation": {"size": [4, 4], "counts": "0`0"}},
            {"id": 5, "image_id": 1, "category_id": 1, "keypoints": [1, 1, 2, 0, 0, 0, 3, 3, 1], "bbox": [0, 0, 5, 5]},
            {"id": 6, "image_id": 1, "category_id": 1, "keypoints": [1, 1, 0, 0, 0, 0, 3, 3, 0], "bbox": [0, 0, 5, 6]},
            {"id": 7, "image_id": 9, "category_id": 1, "bbox": [0, 0, 5, 5]},
            {"id": 8, "image_id": 1, "category_id": 7, "bbox": [0, 0, 5, 5]},
            {"id": 9, "image_id": 1, "category_id": 2, "bbox": [0, 0, 0, 5]},
            {"id": 10, "image_id": 1, "category_id": 2, "keypoints": [4, 5, 2]},
        ],
    }
    path = tmp_path / "coco.json"
    path.write_text(json.dumps(doc))
    images, categories, annotations = coco.read_coco(spark, str(path))
    rows, unconverted = coco.from_coco(images, categories, annotations)
    got = {r.ann_id: r for r in rows.collect()}
    assert set(got) == {"1", "2", "3", "5-0", "5-1", "6", "10-0"}
    assert (got["1"].confidence, got["1"].attributes, got["1"].bbox.w) == (0.5, {"c": "red"}, 3.0)
    assert (got["2"].type, len(got["2"].rings), got["2"].bbox.w) == ("polygon", 1, 4.0)
    assert got["3"].type == "bbox" and got["6"].bbox.h == 6.0
    assert (got["5-0"].name, got["5-1"].name, got["5-1"].attributes) == ("nose", "dog", {"occluded": "true"})
    assert got["5-0"].instance_id == got["5-1"].instance_id == 1 and got["10-0"].instance_id is None
    assert [r.ann_id for r in unconverted.collect()] == ["4"]
    names = [r.name for r in coco.class_list(categories).orderBy("place").collect()]
    assert names == ["person", "nose", "tail", "dog", "dog"]
    assert [tuple(e) for e in coco.pose_templates(categories).first().edges] == [(0, 1)]


def test_yolo_folder(spark, tmp_path):
    folder = tmp_path / "set" / "labels" / "train"
    folder.mkdir(parents=True)
    (tmp_path / "set" / "data.yaml").write_text("nc: 2\nnames: ['car', \"bus\"]\n")
    (folder / "a.txt").write_text("0 0.5 0.5 0.2 0.4\r\n1 0 0 1 0 1 1\n\nx 1 2 3 4\n5 0.5 0.5 1 1\n0 0.5 0.5 0 1\n1.0 0.5 0.5 1 1\n0 1 2 3")
    (folder / "README.txt").write_text("0 0.5 0.5 1 1")
    texts = yolo.read_texts(spark, str(tmp_path), ".txt")
    named = yolo.check_unique_names(texts)
    assert [r.name for r in named.select("name").collect()] == ["a.txt"]
    folders = texts.select(F.regexp_replace("path", "/[^/]*$", "").alias("label_folder")).distinct()
    found = yolo.nearest_class_list(folders, yolo.read_class_lists(spark, str(tmp_path))).first()
    assert found.names == ["car", "bus"]
    lines = yolo.lines_of(texts, "path").withColumns({"width": F.lit(100), "height": F.lit(50)})
    rows = yolo.from_yolo(lines, yolo.class_table(spark, found.names)).orderBy("pos").collect()
    assert [(r.name, r.type) for r in rows] == [("car", "bbox"), ("bus", "polygon")]
    assert (rows[0].bbox.x, rows[0].bbox.y, rows[0].bbox.w, rows[0].bbox.h) == (40.0, 15.0, 20.0, 20.0)
    assert yolo.check_class_numbers(lines, 2).first().highest == 5


def test_label_name_in_two_folders_is_refused(spark):
    paths = spark.createDataFrame([("/a/x.txt",), ("/b/x.txt",)], "path string")
    with pytest.raises(Exception, match="more than one folder"):
        yolo.check_unique_names(paths).select("path").collect()


def test_voc_reading(spark):
    doc = """<annotation><filename> a.jpg </filename><object><name> car </name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>4.5</xmax>
    <ymax>6</ymax></bndbox></object><object><name></name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>4</xmax><ymax>6</ymax></bndbox></object>
    <object><name>flat</name><bndbox><xmin>4</xmin><ymin>2</ymin><xmax>4</xmax><ymax>6</ymax></bndbox></object></annotation>"""
    rows = files.from_voc(spark.createDataFrame([("p", doc)], "path string, text string")).collect()
    assert [(r.image_name, r.name, r.bbox.w, r.bbox.h) for r in rows] == [("a.jpg", "car", 3.5, 4.0)]


def test_compressed_counts(spark):
    texts = [("0`0",), ("2342",), ("`",), ("2",)]
    got = [r.c for r in spark.createDataFrame(texts, "t string").select(masks.counts_from_text(F.col("t")).alias("c")).collect()]
    assert got == [[0, 16], [2, 3, 4, 5], None, [2]]


def test_label_files_are_written_in_order(spark, tmp_path):
    lines = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "image_id long, pos long, line string")
    images = spark.createDataFrame([(1, "one.jpg"), (2, "two.png")], "image_id long, filename string")
    labels.write_label_files(lines, images, str(tmp_path / "out"), ".txt")
    assert (tmp_path / "out" / "one.txt").read_text() == "a\nb" and (tmp_path / "out" / "two.txt").read_text() == "c"


def test_specs_become_ranges():
    ops = transforms.build_ops([{"op": "rotate", "degrees": 5}, {"op": "crop"}, {"op": "brightness", "factor": [0.5, 0.9]}, {"op": "blur"}])
    assert [(o.low, o.high) for o in ops] == [(-5.0, 5.0), (0.8, 1.0), (0.5, 0.9), (0.0, 2.0)]
    with pytest.raises(ValueError):
        transforms.build_ops([{"op": "melt"}])
    with pytest.raises(KeyError):
        transforms.build_ops([{"op": "resize", "width": 3}])


def test_flip_twice_and_four_turns_change_nothing(spark):
    images = spark.createDataFrame([(1, 100, 60)], "image_id long, width int, height int")
    row = [(1, 1, "polygon", [[(0.0, 0.0), (10.0, 0.0), (10.0, 20.0)]])]
    shape = "image_id long, ann_id long, type string, rings array<array<struct<x:double,y:double>>>"
    anns = spark.createDataFrame(row, shape).withColumns(
        {c: F.lit(None).cast(k) for c, k in transforms.PARTS.items() if c != "rings"}
    )
    for specs in ([{"op": "flip", "p": 1.0}] * 2, [{"op": "rotate90", "k": 1}] * 4, [{"op": "vflip", "p": 1.0}] * 2):
        ops = transforms.build_ops(specs)
        out = transforms.augment_annotations(anns, transforms.plan_variants(images, ops, 1, 7), ops).first()
        assert [[tuple(p) for p in r] for r in out.rings] == row[0][3]


def test_clip_ring_against_a_plain_clip(spark):
    import random

    from annoframe.functions.geometry import clip_ring

    def clip(ring, w, h):
        for axis, bound, sign in ((0, 0, 1), (0, w, -1), (1, 0, 1), (1, h, -1)):
            out = []
            for a, b in zip([ring[-1], *ring[:-1]] if ring else [], ring):
                ina, inb = sign * (a[axis] - bound) >= 0, sign * (b[axis] - bound) >= 0
                if ina != inb:
                    t = (bound - a[axis]) / (b[axis] - a[axis])
                    out.append((a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t))
                if inb:
                    out.append(b)
            ring = out
        return ring

    rnd = random.Random(5)
    rings = [[(rnd.uniform(-20, 60), rnd.uniform(-20, 60)) for _ in range(rnd.randrange(3, 8))] for _ in range(60)]
    df = spark.createDataFrame([(r,) for r in rings], "r array<struct<x:double,y:double>>")
    got = df.select(clip_ring(F.col("r"), F.lit(40.0), F.lit(30.0)).alias("c")).collect()
    for ring, row in zip(rings, got):
        want = clip(ring, 40, 30)
        assert len(want) == len(row.c)
        assert all(abs(p.x - q[0]) < 1e-9 and abs(p.y - q[1]) < 1e-9 for p, q in zip(row.c, want))


def test_canonical_objects_are_read_once(spark):
    import annoframe.plans  # noqa: F401
    from annoframe.plans.registry import PLANS
    from annoframe.plans.tables import Tables

    df = PLANS["S11_canonical_round_trip"](Tables(spark, "/root/testdata/sf0.001"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
