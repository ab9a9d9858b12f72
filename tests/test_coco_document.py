"""One COCO document by byte ranges: equal to the JSON library wherever the cuts fall."""

from __future__ import annotations

import json
import random

import pytest

from annoframe.sinks import coco as coco_sink
from annoframe.sources import coco, coco_document

NASTY = ['"', "\\", '\\"', "{", "}", "[", "]", '"annotations": [', ', {"id": 7}', "é", "\\\\", "plain", "\n", "日本"]


def document(rng, n):
    word = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randrange(0, 5)))
    return {
        "info": {"description": word(), "list": [[1, 2], {"images": [1]}]},
        "licenses": [{"id": 1, "name": word()}, {"id": 2, "annotations": [{"id": 9}]}],
        "images": [{"id": i, "file_name": f"{word()}{i}.jpg", "width": 10, "height": 20} for i in range(n)],
        "empty": [],
        "annotations": [
            {
                "id": str(i), "image_id": i % n, "category_id": 1, "bbox": [i, 2.5, 3, 4], "attributes": {"note": word()},
                "segmentation": [[1, 2, 3, 4, 5, 6]] if i % 2 else {"size": [2, 2], "counts": word()},
            }
            for i in range(2 * n)
        ],
        "categories": [{"id": 1, "name": word() or "x", "keypoints": ["a", "b"], "skeleton": [[1, 2]]}],
    }


@pytest.mark.parametrize("size", [50, 333, 4000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_give_every_record_once(tmp_path, size, indent):
    """The reader alone, without Spark: states are chained by hand as ``ranges`` does."""
    rng = random.Random(size)
    doc = document(rng, 12)
    path = tmp_path / "d.json"
    path.write_text(json.dumps(doc, indent=indent, ensure_ascii=size % 2 == 0), encoding="utf-8")
    n = path.stat().st_size
    parts = [coco_document.Range(str(path), lo, min(n, lo + size)) for lo in range(0, n, size)]
    quoted, depth, array, got = False, 0, "", {"images": [], "annotations": [], "categories": []}
    for p in parts:
        true = coco_document.Range(p.path, p.lo, p.hi, quoted, depth, array)
        for name in got:
            got[name] += [json.loads(v) for _, v in coco_document._records(true, name)]
        found = coco_document._summary(p)[quoted]
        array = next((name for at, name in reversed(found["opened"]) if depth + at == 1), array)
        depth, quoted = depth + found["gain"], found["quoted"]
    assert (depth, quoted) == (0, False)
    assert got == {name: doc[name] for name in got}


def test_document_equals_whole_read(spark, tmp_path):
    doc = document(random.Random(7), 40)
    path = tmp_path / "d.json"
    path.write_text(json.dumps(doc, separators=(",", ":"), ensure_ascii=False), encoding="utf-8")  # masks stay as their text, which Spark writes without blanks
    rows = lambda df: sorted(map(str, df.collect()))
    whole, ranged = coco.read_coco(spark, str(path)), coco_document.read_coco_document(spark, str(path), 500)
    assert ranged[2].rdd.getNumPartitions() > 10
    assert rows(ranged[0]) == rows(whole[0]) and rows(ranged[1]) == rows(whole[1])
    assert rows(ranged[2].drop("pos")) == rows(whole[2].drop("pos"))
    assert [r.id for r in ranged[2].orderBy("pos").collect()] == [a["id"] for a in doc["annotations"]]


def test_broken_documents_are_refused(spark, tmp_path):
    text = json.dumps(document(random.Random(1), 5))
    for broken in (text[:-1], text[: len(text) // 2], ""):
        path = tmp_path / "b.json"
        path.write_text(broken)
        with pytest.raises(ValueError):
            coco_document.ranges(spark, str(path), 100)


def test_written_document_is_one_valid_file(spark, tmp_path):
    images = spark.createDataFrame([(1, 'a"b.jpg', 4, 4), (2, "c.jpg", 4, 4)], "id long, file_name string, width int, height int")
    anns = spark.createDataFrame([(i, 1 + i % 2) for i in range(50)], "id long, image_id long").repartition(4)
    cats = spark.createDataFrame([(1, "x")], "id long, name string").limit(0)
    coco_sink.write_coco_document((images, anns, cats), str(tmp_path / "out.json"))
    doc = json.loads((tmp_path / "out.json").read_text())
    assert [len(doc[k]) for k in ("images", "annotations", "categories")] == [2, 50, 0]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out.json"]


def test_short_ranges_share_tasks_and_arrays_read_their_own_ranges(spark, tmp_path):
    doc = document(random.Random(3), 400)
    path = tmp_path / "d.json"
    path.write_text(json.dumps(doc, separators=(",", ":")), encoding="utf-8")
    parts = coco_document.ranges(spark, str(path), 200)
    images, categories, annotations = coco_document.read_coco_document(spark, str(path), 200)
    assert len(parts) > 300
    # One task a range, for each of the three arrays, before.
    assert images.rdd.getNumPartitions() < 200 and annotations.rdd.getNumPartitions() < 200 and categories.rdd.getNumPartitions() < 5
    assert [r.id for r in annotations.orderBy("pos").collect()] == [a["id"] for a in doc["annotations"]]
    assert sorted(r.file_name for r in images.collect()) == sorted(i["file_name"] for i in doc["images"])
    assert categories.count() == 1


def test_blocks_of_any_size_join_to_one_document(spark, tmp_path, monkeypatch):
    images = spark.createDataFrame([(i, f"{i}.jpg") for i in range(9)], "id long, file_name string").repartition(3)
    for block in (1, 7, 1 << 20):
        monkeypatch.setattr(coco_sink, "BLOCK", block)
        coco_sink.write_coco_document((images, images.limit(0), images), str(tmp_path / f"{block}.json"))
        doc = json.loads((tmp_path / f"{block}.json").read_text())
        assert [len(doc[k]) for k in ("images", "annotations", "categories")] == [9, 0, 9]
