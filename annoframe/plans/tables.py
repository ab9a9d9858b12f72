"""Annotation, image, log and ledger tables derived from the given tables by exact arithmetic.

Each table exists twice: as a DataFrame and as a DuckDB common table expression with the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annoframe.session import cut

KINDS = {"view": "frame", "click": "event", "purchase": "capture", "error": "stats", "signup": "status"}


class Tables:
    """The given tables under ``sf_dir`` and what is derived from them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def gt(self) -> DataFrame:
        # Every row is a box; its place among the rows of its order makes its id.
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
        return self.raw("lineitem").withColumn("line", place).selectExpr(
            "l_orderkey as image_id",
            "l_orderkey * 1000 + line as ann_id",
            "concat('class_', l_suppkey % 6) as name",
            "cast(l_partkey % 400 as double) as x",
            "cast(l_partkey * 7 % 300 as double) as y",
            "20 + l_quantity as w",
            "cast(20 + l_suppkey % 60 as double) as h",
            "line",
        )

    @cached_property
    def pred(self) -> DataFrame:
        return self._predicted(self.gt)

    @cached_property
    def boxes(self) -> tuple[DataFrame, DataFrame]:
        """``pred`` and ``gt`` for queries that read both several times: made once and kept."""
        gt = cut(self.gt)
        return self._predicted(gt), gt

    def _predicted(self, gt: DataFrame) -> DataFrame:
        moved = gt.where("ann_id % 9 <> 0").selectExpr(
            "image_id",
            "ann_id",
            "case when ann_id % 11 = 0 then 'class_0' else name end as name",
            "x + (ann_id % 7 - 3) as x",
            "y + (ann_id % 5 - 2) as y",
            "w",
            "h + ann_id % 4 as h",
            "1 - (ann_id % 97) / 100 as confidence",
        )
        second = gt.where("ann_id % 6 = 0").selectExpr(
            "image_id",
            "ann_id + 1000000000000 as ann_id",
            "name",
            "x + 2 as x",
            "y + 1 as y",
            "w",
            "h",
            "(ann_id % 89) / 100 as confidence",
        )
        return moved.unionByName(second)

    @cached_property
    def images(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey as image_id",
            "concat('img_', o_orderkey, '.jpg') as filename",
            "concat('/', substr(o_orderpriority, 1, 1), '/', lower(substr(o_orderpriority, 3))) as directory",
            "cast(640 + 320 * (o_orderkey % 4) as int) as width",
            "cast(480 + 240 * (o_orderkey % 3) as int) as height",
            "case o_orderstatus when 'F' then 'complete' when 'O' then 'new' else 'review' end as status",
            "case o_orderkey % 5 when 0 then 'val' when 1 then 'test' when 2 then null else 'train' end as split",
            "o_orderkey % 20 = 0 as is_archived",
            "cast(floor(o_totalprice) as bigint) as file_size",
            "cast(o_orderdate as timestamp) as created_at",
            "o_custkey % 20 as dataset_id",
        )

    @cached_property
    def keypoints(self) -> DataFrame:
        return self.gt.selectExpr(
            "image_id",
            "ann_id",
            "ann_id as pos",
            "case when ann_id % 7 = 0 then null else line % 2 + 1 end as instance_id",
            "name as object",
            "element_at(array('nose', 'eye', 'ear', 'tail'), cast(ann_id % 4 as int) + 1) as joint",
            "x + w / 2 as px",
            "y + h / 2 as py",
            "case when ann_id % 5 = 0 then map('occluded', ' Yes ', 'color', 'red') "
            "when ann_id % 5 = 1 then map('color', 'blue') else map() end as attributes",
        )

    @cached_property
    def polygons(self) -> DataFrame:
        outer = (
            "array(struct(x as x, y as y), struct(x + w as x, y as y), struct(x + w as x, y + h - 5 as y), "
            "struct(x + w - 5 as x, y + h as y), struct(x as x, y + h as y))"
        )
        hole = (
            "array(struct(x + 4 as x, y + 4 as y), struct(x + 12 as x, y + 4 as y), "
            "struct(x + 12 as x, y + 12 as y), struct(x + 4 as x, y + 12 as y))"
        )
        return self.gt.selectExpr(
            "image_id",
            "ann_id",
            "name",
            f"case when ann_id % 3 = 0 then array({outer}, {hole}) else array({outer}) end as rings",
            "x",
            "y",
            "w",
            "h",
        )

    @cached_property
    def templates(self) -> DataFrame:
        """Pose templates as a user would pass them: class, place in the list, joints, 0-indexed edges."""
        return self.spark.createDataFrame(
            [
                ("bird", 0, ["nose", "eye", "tail"], [(0, 1), (1, 2)]),
                ("cat", 1, ["nose", "eye", "ear", "tail"], [(0, 1), (0, 2), (2, 3)]),
                ("post", 2, ["ear"], []),
            ],
            "class string, place int, joints array<string>, edges array<struct<i:int,j:int>>",
        )

    @cached_property
    def log(self) -> DataFrame:
        kind = F.create_map(*[F.lit(v) for kv in KINDS.items() for v in kv])
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            F.col("user_id").alias("session"),
            F.col("ts").cast("timestamp").alias("time"),
            F.col("event_id").alias("identity"),
            kind[F.col("event_type")].alias("kind"),
            k.alias("k"),
            F.concat(F.lit("class_"), (k % 6).cast("string")).alias("name"),
            (k / 100).alias("confidence"),
            F.col("value").alias("latency_ms"),
            F.col("event_id").alias("frame"),
        )

    @cached_property
    def tracks(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            F.col("user_id").alias("session"),
            (k % 5).alias("track"),
            F.concat(F.lit("class_"), (F.col("event_id") % 3).cast("string")).alias("name"),
            (F.floor(F.col("value")) % 100).cast("double").alias("x"),
            ((F.floor(F.col("value")) * 7) % 100).cast("double").alias("y"),
            F.col("ts").cast("timestamp").alias("time"),
            F.col("event_id").alias("frame"),
        )

    @cached_property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").selectExpr("vec_id", "embedding", "label as cluster")

    @cached_property
    def logits(self) -> DataFrame:
        return self.raw("embeddings").selectExpr(
            "vec_id as image_id",
            "transform(embedding, v -> cast(v as double) * 10) as logits",
            "cast(label % 10 as int) as truth",
        )

    @cached_property
    def ledger(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey as id",
            "o_custkey % 20 as org",
            "lower(o_orderpriority) as operation",
            "case when o_orderstatus = 'P' then 1 else -1 end * cast(round(o_totalprice * 10000) as bigint) as amount",
            "cast(o_orderdate as timestamp) as created_at",
        )

    @cached_property
    def tags(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey as image_id",
            "split(p_name, ' ') as objects",
            "array(p_type) as scenes",
            "array(p_brand) as attributes",
            "concat('/', p_type, '/', p_brand) as directory",
            "cast(p_size as bigint) * 1000 as file_size",
        )

    @cached_property
    def work(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_suppkey as user_id",
            "l_orderkey as image_id",
            "cast(l_quantity as bigint) as seconds",
            "cast(l_shipdate as timestamp) as saved_at",
            "l_returnflag = 'R' as completed",
        )


#: Names a row of ``lineitem`` within its order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "gt": (
        (),
        f"""SELECT l_orderkey AS image_id, l_orderkey * 1000 + line AS ann_id,
        'class_' || (l_suppkey % 6) AS name, (l_partkey % 400)::DOUBLE AS x, (l_partkey * 7 % 300)::DOUBLE AS y,
        20 + l_quantity AS w, (20 + l_suppkey % 60)::DOUBLE AS h, line
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) AS line FROM lineitem)""",
    ),
    "pred": (
        ("gt",),
        """SELECT image_id, ann_id, CASE WHEN ann_id % 11 = 0 THEN 'class_0' ELSE name END AS name,
        x + (ann_id % 7 - 3) AS x, y + (ann_id % 5 - 2) AS y, w, h + ann_id % 4 AS h,
        1 - (ann_id % 97) / 100 AS confidence FROM gt WHERE ann_id % 9 <> 0
        UNION ALL SELECT image_id, ann_id + 1000000000000, name, x + 2, y + 1, w, h, (ann_id % 89) / 100
        FROM gt WHERE ann_id % 6 = 0""",
    ),
    "images": (
        (),
        """SELECT o_orderkey AS image_id, 'img_' || o_orderkey || '.jpg' AS filename,
        '/' || substr(o_orderpriority, 1, 1) || '/' || lower(substr(o_orderpriority, 3)) AS directory,
        (640 + 320 * (o_orderkey % 4))::INT AS width, (480 + 240 * (o_orderkey % 3))::INT AS height,
        CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'new' ELSE 'review' END AS status,
        CASE o_orderkey % 5 WHEN 0 THEN 'val' WHEN 1 THEN 'test' WHEN 2 THEN NULL ELSE 'train' END AS split,
        o_orderkey % 20 = 0 AS is_archived, floor(o_totalprice)::BIGINT AS file_size,
        o_orderdate AS created_at, o_custkey % 20 AS dataset_id FROM orders""",
    ),
    "keypoints": (
        ("gt",),
        """SELECT image_id, ann_id, ann_id AS pos,
        CASE WHEN ann_id % 7 = 0 THEN NULL ELSE line % 2 + 1 END AS instance_id, name AS object,
        (['nose', 'eye', 'ear', 'tail'])[(ann_id % 4)::INT + 1] AS joint, x + w / 2 AS px, y + h / 2 AS py,
        CASE WHEN ann_id % 5 = 0 THEN ' Yes ' END AS occluded,
        CASE ann_id % 5 WHEN 0 THEN 'red' WHEN 1 THEN 'blue' END AS color FROM gt""",
    ),
    "templates": (
        (),
        """SELECT 'bird' AS class, 0 AS place, ['nose', 'eye', 'tail'] AS joints, [{'i': 0, 'j': 1}, {'i': 1, 'j': 2}] AS edges
        UNION ALL SELECT 'cat', 1, ['nose', 'eye', 'ear', 'tail'], [{'i': 0, 'j': 1}, {'i': 0, 'j': 2}, {'i': 2, 'j': 3}]
        UNION ALL SELECT 'post', 2, ['ear'], []""",
    ),
    "polygons": (
        ("gt",),
        """SELECT image_id, ann_id, name, x, y, w, h,
        [{'x': x, 'y': y}, {'x': x + w, 'y': y}, {'x': x + w, 'y': y + h - 5}, {'x': x + w - 5, 'y': y + h},
         {'x': x, 'y': y + h}] AS outer_ring,
        CASE WHEN ann_id % 3 = 0 THEN [{'x': x + 4, 'y': y + 4}, {'x': x + 12, 'y': y + 4},
         {'x': x + 12, 'y': y + 12}, {'x': x + 4, 'y': y + 12}] END AS hole_ring FROM gt""",
    ),
    "log": (
        (),
        """SELECT user_id AS session, ts AS time, event_id AS identity,
        CASE event_type WHEN 'view' THEN 'frame' WHEN 'click' THEN 'event' WHEN 'purchase' THEN 'capture'
          WHEN 'error' THEN 'stats' WHEN 'signup' THEN 'status' END AS kind,
        k, 'class_' || (k % 6) AS name, k / 100 AS confidence, value AS latency_ms, event_id AS frame
        FROM (SELECT *, (props->>'$.k')::INT AS k FROM events)""",
    ),
    "tracks": (
        (),
        """SELECT user_id AS session, k % 5 AS track, 'class_' || (event_id % 3) AS name,
        (floor(value)::BIGINT % 100)::DOUBLE AS x, (floor(value)::BIGINT * 7 % 100)::DOUBLE AS y,
        ts AS time, event_id AS frame FROM (SELECT *, (props->>'$.k')::INT AS k FROM events)""",
    ),
    "vectors": ((), "SELECT vec_id, embedding, label AS cluster FROM embeddings"),
    "logits": (
        (),
        """SELECT vec_id AS image_id, [v::DOUBLE * 10 FOR v IN embedding] AS logits,
        (label % 10)::INT AS truth FROM embeddings""",
    ),
    "ledger": (
        (),
        """SELECT o_orderkey AS id, o_custkey % 20 AS org, lower(o_orderpriority) AS operation,
        CASE WHEN o_orderstatus = 'P' THEN 1 ELSE -1 END * round(o_totalprice * 10000)::BIGINT AS amount,
        o_orderdate AS created_at FROM orders""",
    ),
    "tags": (
        (),
        """SELECT p_partkey AS image_id, string_split(p_name, ' ') AS objects, [p_type] AS scenes,
        [p_brand] AS attributes, '/' || p_type || '/' || p_brand AS directory,
        p_size::BIGINT * 1000 AS file_size FROM part""",
    ),
    "work": (
        (),
        """SELECT l_suppkey AS user_id, l_orderkey AS image_id, l_quantity::BIGINT AS seconds,
        l_shipdate AS saved_at, l_returnflag = 'R' AS completed FROM lineitem""",
    ),
}


def sql(body: str, *names: str, recursive: bool = False, more: str = "") -> str:
    """A DuckDB query over derived tables: the needed CTEs, then ``more`` CTEs, then ``body``."""
    seen: dict[str, str] = {}

    def add(name: str) -> None:
        needs, text = CTES[name]
        for n in needs:
            add(n)
        seen.setdefault(name, f"{name} AS MATERIALIZED ({text})")

    for name in names:
        add(name)
    parts = list(seen.values()) + ([more] if more else [])
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ", ".join(parts) + " " if parts else "") + body
