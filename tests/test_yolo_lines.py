"""The lines of boxes and polygons, query against SQL."""

from __future__ import annotations

from compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_yolo_lines_equal_their_sql(spark):
    df = entry.queries()["S19_yolo_lines"](spark, SF)
    assert compare(df, connect(SF), entry.oracle_sql()["S19_yolo_lines"]) is None
