"""Schemas of the canonical tables and of the files read and written."""

from __future__ import annotations

BOX = "struct<x:double,y:double,w:double,h:double>"
OBB = "struct<cx:double,cy:double,w:double,h:double,angle:double>"
POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"

# One row per annotation; ``pos`` is its place in its image's list.
ANNOTATIONS = (
    f"image_id bigint, ann_id string, pos bigint, name string, type string, bbox {BOX}, obb {OBB}, rings array<{RING}>, "
    f"path {RING}, point {POINT}, instance_id int, confidence double, attributes map<string,string>"
)

# A segmentation is a list of rings or a run-length object, so it is kept as its JSON text.
COCO_IMAGES = "array<struct<id:bigint,file_name:string,width:int,height:int>>"
COCO_CATEGORIES = "array<struct<id:bigint,name:string,keypoints:array<string>,skeleton:array<array<int>>>>"
COCO_ANNOTATION = (
    "struct<id:string,image_id:bigint,category_id:bigint,bbox:array<double>,segmentation:string,keypoints:array<double>,"
    "score:double,attributes:map<string,string>>"
)
COCO = f"images {COCO_IMAGES}, categories {COCO_CATEGORIES}, annotations array<{COCO_ANNOTATION}>"

# The stored annotation object; geometry fields of other kinds stay null.
CANONICAL = (
    f"id string, name string, type string, bounding_box {BOX}, oriented_box {OBB}, polygon struct<paths:array<{RING}>>, "
    f"polyline struct<path:{RING}>, keypoint {POINT}, instance_id int, confidence double, created_by string, "
    "attributes map<string,string>"
)
VOC = (
    "filename string, size struct<width:int,height:int,depth:int>, "
    "object array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>"
)
