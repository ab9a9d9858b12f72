"""rows are not dealt by the few names of a class list or a template."""

from __future__ import annotations

import re

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from annoframe.operators import poses

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["S26_detection_targets", "J11_slotted_joints", "S22_yolo_pose_lines", "J12_limbs", "S19_yolo_lines"])
def test_no_task_gets_all_rows_of_a_name(spark, name):
    # Small test tables would be broadcast themselves; larger ones are not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan)
    assert [j for j in joins if re.match(r"(name|class|joint|idx)#", j)] == []
    assert compare(df, connect(SF), entry.oracle_sql()[name]) is None


def test_matched_template_of_ties_and_repeats(spark):
    templates = spark.createDataFrame(
        [("late", 2, ["a", "b"]), ("early", 1, ["b", "c"]), ("other", 3, ["a", "b", "d"])], "class string, place int, joints array<string>"
    )
    points = [("one", "b"), ("one", "b"), ("two", "a"), ("two", "b"), ("three", "d"), ("three", "a"), ("three", "b"), ("none", "x")]
    keypoints = spark.createDataFrame(
        [(o, i, i, j, 1.0, 1.0, 1) for i, (o, j) in enumerate(points)],
        "image_id string, ann_id bigint, pos bigint, joint string, px double, py double, instance_id int",
    )
    found = {r["image_id"]: r["class"] for r in poses.match_templates(keypoints, templates).collect()}
    assert found == {"one": "early", "two": "late", "three": "other"}
