"""Queries over batch hierarchies and field review, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import hierarchy as H
from folioforge.operators import review as V
from folioforge.plans import adapters as R
from folioforge.session import table


def _objects(spark: SparkSession, folder: str) -> DataFrame:
    """One row an order: its lines with flag A, N and R as personnel, materials and equipment."""
    line = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_returnflag").alias("flag"),
        F.struct(
            F.col("l_partkey").cast("string").alias("name"),
            F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (("status", F.col("l_linestatus")), ("quantity", F.floor("l_quantity").cast("string")))]).alias("attributes"),
        ).alias("o"),
    )
    rows = line.groupBy("l_orderkey").agg(*[F.array_sort(F.collect_list(F.when(F.col("flag") == f, F.col("o")))).alias(c) for f, c in zip("ANR", H.CATEGORIES, strict=False)])
    rows = rows.withColumn("environment", F.lit(None).cast(rows.schema["personnel"].dataType))
    return rows.join(table(spark, folder, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))


def form_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as forms of their customers' steps, by market segment and nation, as flat rows: nothing gathers a batch."""
    text = lambda c: F.col(c).cast("string")
    return _objects(spark, folder).select(text("c_nationkey").alias("batch"), F.col("c_mktsegment").alias("process"), F.lit("main").alias("subprocess"), text("c_custkey").alias("step"), text("o_orderkey").alias("form"), *[H.distinct_objects(F.col(c)).alias(c) for c in H.CATEGORIES])


def nested_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer as one nested record, as a batch's file is: the orders are forms of one step."""
    rows = _objects(spark, folder)
    form = F.struct(F.col("o_orderkey").cast("string").alias("name"), *H.CATEGORIES)
    forms = rows.groupBy("c_custkey", "c_mktsegment").agg(F.collect_list(form).alias("form"))
    step = F.array(F.struct(F.lit("only").alias("name"), "form"))
    process = F.array(F.struct(F.col("c_mktsegment").alias("name"), F.array(F.struct(F.lit("main").alias("name"), step.alias("step"))).alias("subprocess")))
    return forms.select(F.col("c_custkey").cast("string").alias("batch"), process.alias("process"))


_FORMS = """
SELECT CAST(c_nationkey AS VARCHAR) AS batch, c_mktsegment AS process, 'main' AS subprocess, CAST(c_custkey AS VARCHAR) AS step, CAST(o_orderkey AS VARCHAR) AS form, l_returnflag AS flag,
       CAST(l_partkey AS VARCHAR) AS name, l_linestatus AS status, CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""


def forms_flat(spark: SparkSession, folder: str) -> DataFrame:
    return H.category_counts(form_rows(spark, folder))


FORMS_FLAT = f"""
SELECT batch, process, subprocess, step, form, {', '.join(f"count(DISTINCT CASE WHEN flag = '{f}' THEN name || ':' || status || ':' || quantity END)::INT AS {c}" for f, c in zip('ANR', H.CATEGORIES, strict=False))}, 0::INT AS environment
FROM ({_FORMS}) GROUP BY ALL
"""


def forms_nested(spark: SparkSession, folder: str) -> DataFrame:
    rows = H.category_counts(H.forms(nested_batches(spark, folder)))
    return rows.select("batch", "process", "step", "form", *H.CATEGORIES)


FORMS_NESTED = f"SELECT step AS batch, process, 'only' AS step, form, {', '.join(H.CATEGORIES)} FROM ({FORMS_FLAT})"


def hierarchy_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = H.long(form_rows(spark, folder))
    return rows.groupBy("batch", "category", "key").agg(F.count("*").alias("n"), F.countDistinct("value").alias("values"))


HIERARCHY_LONG = f"""
WITH d AS (SELECT DISTINCT * FROM ({_FORMS})),
a AS (SELECT batch, flag, 'status' AS key, status AS value FROM d UNION ALL SELECT batch, flag, 'quantity', quantity FROM d)
SELECT batch, CASE flag WHEN 'A' THEN 'personnel' WHEN 'N' THEN 'materials' ELSE 'equipment' END AS category, key, count(*)::BIGINT AS n, count(DISTINCT value)::BIGINT AS values FROM a GROUP BY ALL
"""


def category_wide(spark: SparkSession, folder: str) -> DataFrame:
    rows = H.wide(form_rows(spark, folder), "materials", ["status", "quantity", "absent"])
    return rows.select("batch", "step", "form", "name", "status", "quantity", "absent")


CATEGORY_WIDE = f"SELECT DISTINCT batch, step, form, name, status, quantity, CAST(NULL AS VARCHAR) AS absent FROM ({_FORMS}) WHERE flag = 'N'"


def merge_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select(F.floor(F.col("o_orderkey") / 500).alias("sheet"), "c_mktsegment", "c_custkey", "o_orderkey", "o_orderdate")
    return H.merge_runs(rows, "sheet", ["o_orderdate", "o_orderkey"], ["c_mktsegment"])


MERGE_RUNS = """
WITH r AS (SELECT o_orderkey // 500 AS sheet, c_mktsegment, row_number() OVER w AS row, lag(c_mktsegment) OVER w AS before FROM orders JOIN customer ON o_custkey = c_custkey WINDOW w AS (PARTITION BY o_orderkey // 500 ORDER BY o_orderdate, o_orderkey)),
g AS (SELECT *, sum(CASE WHEN row > 1 AND before = c_mktsegment THEN 0 ELSE 1 END) OVER (PARTITION BY sheet ORDER BY row) AS run FROM r)
SELECT sheet, run::BIGINT AS run, c_mktsegment, min(row)::INT AS first_row, max(row)::INT AS last_row FROM g GROUP BY sheet, run, c_mktsegment
"""


def _boxes(spark: SparkSession, folder: str, page: str = "floor(vec_id / 60)") -> DataFrame:
    def corner(k: int):
        return (F.col("embedding")[k].cast("double") + 0.6) * 500

    x0, y0 = corner(0), corner(1)
    return table(spark, folder, "embeddings").select("vec_id", F.expr(page).alias("page"), F.array(x0, y0, x0 + F.abs(corner(2)) / 4, y0 + F.abs(corner(3)) / 4).alias("box"), (F.col("embedding")[4].cast("double") + 0.6).alias("score"))


_BOX_SQL = "(SELECT vec_id, vec_id // 60 AS page, x0, y0, x0 + abs(a) / 4 AS x1, y0 + abs(b) / 4 AS y1, score FROM (SELECT vec_id, {0} AS x0, {1} AS y0, {2} AS a, {3} AS b, embedding[5]::DOUBLE + 0.6 AS score FROM embeddings))".format(*[f"(embedding[{k}]::DOUBLE + 0.6) * 500" for k in range(1, 5)])


def review_select(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that a low-scored block of their page overlaps, on fifty pages of all boxes."""
    boxes = _boxes(spark, folder, "vec_id % 50")
    blocks = boxes.where("vec_id % 2 = 0").where("score < 0.55")
    fields = boxes.where("vec_id % 2 = 1").withColumn("page", F.col("page") - 1)
    return V.overlapping(fields, blocks, "page", 64.0).select("vec_id", "page")


_PAGED = _BOX_SQL.replace("vec_id // 60", "vec_id % 50")
REVIEW = f"""
SELECT f.vec_id, f.page - 1 AS page FROM {_PAGED} f WHERE f.vec_id % 2 = 1 AND EXISTS (
  SELECT 1 FROM {_PAGED} b WHERE b.vec_id % 2 = 0 AND b.page = f.page - 1 AND b.score < 0.55 AND least(f.x1, b.x1) > greatest(f.x0, b.x0) AND least(f.y1, b.y1) > greatest(f.y0, b.y0))
"""


def local_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return _boxes(spark, folder).select("vec_id", V.local_box(F.col("box"), F.lit(560.0), F.lit(560.0)).alias("local"))


LOCAL_BOXES = f"""
SELECT vec_id, x0 >= 0 AND x0 < x1 AND x1 <= 560 AND y0 >= 0 AND y0 < y1 AND y1 <= 560
  AND (least(560, x1 + 40) - greatest(0, x0 - 40)) * (least(560, y1 + 40) - greatest(0, y0 - 40)) < 560.0::DOUBLE * 560 * 0.90::DOUBLE AS local FROM {_BOX_SQL}
"""


def reply_valid(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    rows = events.select("event_id", F.when(F.col("event_id") % 5 > 0, F.col("event_type")).alias("value"), (F.col("value") / 100).alias("confidence"), F.when(F.col("event_id") % 7 > 0, F.col("event_id") % 2 == 0).alias("needs_review"), F.lit("seen").alias("reason"))
    return V.reply_valid(rows).select("event_id", "valid")


REPLY = "SELECT event_id, event_id % 5 > 0 AND value IS NOT NULL AND value / 100 BETWEEN 0 AND 1 AND event_id % 7 > 0 AS valid FROM events"

#: Lines of orders as fields that name a part of a date, or none.
DATE_FIELDS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus AS prefix, CASE WHEN l_partkey % 10 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'year' WHEN l_returnflag = 'N' THEN 'month' ELSE 'day' END AS unit,
       CASE l_returnflag WHEN 'A' THEN CAST(1990 + l_partkey % 40 AS STRING) WHEN 'N' THEN CAST(1 + l_partkey % 12 AS STRING) ELSE CAST(1 + l_suppkey % 33 AS STRING) END AS value FROM {lineitem}
"""


def date_islands(spark: SparkSession, folder: str) -> DataFrame:
    """Dates whose parts stand next to each other and name no day."""
    fields = R.frame(spark, folder, DATE_FIELDS)
    return V.invalid_dates(V.date_groups(fields, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"]), "l_orderkey")


QUERIES = {
    "date_islands": (date_islands, None),
    "forms_flat": (forms_flat, FORMS_FLAT),
    "forms_nested": (forms_nested, FORMS_NESTED),
    "hierarchy_long": (hierarchy_long, HIERARCHY_LONG),
    "category_wide": (category_wide, CATEGORY_WIDE),
    "merge_runs": (merge_runs, MERGE_RUNS),
    "review_select": (review_select, REVIEW),
    "local_boxes": (local_boxes, LOCAL_BOXES),
    "reply_valid": (reply_valid, REPLY),
}
