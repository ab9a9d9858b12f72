"""Whole VOC documents: one per image, readable by any XML library, all or none."""

from __future__ import annotations

import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from annoframe.schemas import ANNOTATIONS
from annoframe.sinks import voc_files
from annoframe.sources import files


def annotation(image, pos, name, kind="bbox", box=(1.0, 2.0, 10.4, 20.6), rings=None):
    return (image, f"a{pos}", pos, name, kind, box, None, rings, None, None, None, 1.0, {})


@pytest.fixture(scope="module")
def tables(spark):
    images = spark.createDataFrame(
        [(1, "a.jpg", 640, 480, "/x & y"), (2, "b.c.png", 10, 20, "/"), (3, "none.jpg", 5, 5, None)],
        "image_id long, filename string, width int, height int, directory string",
    )
    rows = [annotation(1, p, f"n{p} <&>") for p in (2, 0, 1)]
    rows += [annotation(2, 5, "poly", "polygon", None, [[(0.0, 0.0), (4.0, 0.0), (4.0, 9.0)]]), annotation(2, 6, "line", "polyline"), annotation(9, 7, "lost")]
    return images, spark.createDataFrame(rows, ANNOTATIONS)


def test_one_document_per_image(spark, tables, tmp_path):
    images, annotations = tables
    voc_files.write_voc(annotations, images, str(tmp_path))
    docs = {p.stem: ElementTree.parse(p).getroot() for p in tmp_path.glob("*.xml")}
    assert sorted(docs) == ["a", "b.c", "none"]
    assert [o.findtext("name") for o in docs["a"].findall("object")] == ["n0 <&>", "n1 <&>", "n2 <&>"]
    assert (docs["a"].findtext("filename"), docs["a"].findtext("size/width"), docs["a"].findtext("directory")) == ("a.jpg", "640", "/x & y")
    box = docs["b.c"].find("object/bndbox")
    assert [box.findtext(k) for k in ("xmin", "ymin", "xmax", "ymax")] == ["0", "0", "4", "9"]
    assert len(docs["b.c"].findall("object")) == 1 and not docs["none"].findall("object")
    assert json.loads((tmp_path / voc_files.MANIFEST).read_text()) == {"images": 3, "annotations": 4}
    assert not [p for p in tmp_path.iterdir() if p.is_dir()]


def test_written_documents_read_back(spark, tables, tmp_path):
    images, annotations = tables
    voc_files.write_voc(annotations, images, str(tmp_path))
    docs = spark.read.option("pathGlobFilter", "*.xml").text(str(tmp_path), wholetext=True)
    rows = files.from_voc(docs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
    got = {(r.image_name, r.pos, r.name, r.bbox.x, r.bbox.y, r.bbox.w, r.bbox.h) for r in rows.collect()}
    assert got == {("a.jpg", p, f"n{p} <&>", 1.0, 2.0, 10.0, 21.0) for p in range(3)} | {("b.c.png", 0, "poly", 0.0, 0.0, 4.0, 9.0)}


def test_a_failed_job_leaves_nothing(spark, tables, tmp_path):
    images, annotations = tables
    broken = annotations.withColumn("name", F.when(F.col("pos") == 5, F.raise_error(F.lit("broken row"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="broken row"):
        voc_files.write_voc(broken, images, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").rglob("*"))


def test_an_aborted_job_takes_its_files_away(tmp_path):
    writer = voc_files._Writer(str(tmp_path))
    done = writer.write(iter([{"name": "a", "place": None, "text": "<annotation>"}, {"name": "a", "place": 0, "text": "<object/>"}]))
    assert (done.images, done.objects) == (1, 1) and list(tmp_path.rglob("a.xml"))
    writer.abort([done, None])
    assert not list(tmp_path.rglob("*"))


def test_a_lost_attempt_is_not_committed(tmp_path):
    writer = voc_files._Writer(str(tmp_path))
    row = lambda text: iter([{"name": "a", "place": None, "text": text}])
    writer.write(row("<annotation>lost"))
    writer.commit([writer.write(row("<annotation>kept"))])
    assert (tmp_path / "a.xml").read_text() == "<annotation>kept</annotation>"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.xml", voc_files.MANIFEST]


def test_images_of_one_document_name_are_refused(spark, tables, tmp_path):
    images, annotations = tables
    with pytest.raises(ValueError, match="share"):
        voc_files.write_voc(annotations, images.withColumn("filename", F.lit("same.jpg")), str(tmp_path))


def test_packed_documents_are_the_files(spark, tables, tmp_path, monkeypatch):
    images, annotations = tables
    voc_files.write_voc(annotations, images, str(tmp_path / "files"))
    monkeypatch.setattr(voc_files, "ARCHIVE_DOCUMENTS", 2)
    voc_files.write_voc(annotations.coalesce(1), images.coalesce(1), str(tmp_path / "packed"), packed=True)
    got = {r.path.rsplit("/", 1)[1]: r.text for r in voc_files.read_packed(spark, str(tmp_path / "packed")).collect()}
    assert got == {p.name: p.read_text() for p in (tmp_path / "files").glob("*.xml")} and len(got) == 3
    assert (tmp_path / "packed" / voc_files.MANIFEST).read_text() == (tmp_path / "files" / voc_files.MANIFEST).read_text()
    assert {p.suffix for p in (tmp_path / "packed").iterdir()} == {".zip", ".json"}  # no file per image


def test_an_archive_is_closed_when_full(tmp_path):
    writer = voc_files._Writer(str(tmp_path), documents=2)
    done = writer.write(iter([{"name": f"n{i}", "place": None, "text": "<annotation>"} for i in range(5)]))
    writer.commit([done])
    assert done.images == 5 and len(list(tmp_path.glob("*.zip"))) == 3
