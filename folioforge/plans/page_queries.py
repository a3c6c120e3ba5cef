"""Queries over pages and lines of the documents, each with its DuckDB text.

The relation inserts a page marker after every fifth line of a document; the DuckDB
texts count lines instead of reading markers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import pages as P
from folioforge.session import table

EVERY = 5


def marked(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id`` and its marked-up ``text``; ids that divide by 9 hold a fallback on their first page."""
    docs = table(spark, folder, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    total = F.floor(F.size("lines") / EVERY).cast("string")

    def line(x, i):
        mark = F.concat(x, F.lit("\n% PAGE_COMPLETED: "), ((i + 1) / EVERY).cast("int").cast("string"), F.lit("/"), total)
        return F.when((i + 1) % EVERY == 0, mark).otherwise(x)

    text = F.array_join(F.transform("lines", line), "\n")
    return docs.select("doc_id", F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit("% RECOGNITION_FALLBACK\n"), text)).otherwise(text).alias("text"))


#: Lines of the marked-up text: content lines, markers and the fallback line, numbered as they stand.
_LINES = f"""
d AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, len(parts) AS n, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM d),
m AS (SELECT doc_id, n, i, 0 AS k, line FROM l UNION ALL
      SELECT doc_id, n, i, 1, '% PAGE_COMPLETED: ' || (i // {EVERY}) || '/' || (n // {EVERY}) FROM l WHERE i % {EVERY} = 0 UNION ALL
      SELECT DISTINCT doc_id, n, 0, 0, '% RECOGNITION_FALLBACK' FROM l WHERE doc_id % 9 = 0),
x AS (SELECT doc_id, n // {EVERY} AS total, line, k, row_number() OVER (PARTITION BY doc_id ORDER BY i, k) AS place,
             CASE WHEN i = 0 THEN 1 ELSE (i - 1) // {EVERY} + 1 END AS block, count(*) OVER (PARTITION BY doc_id) AS lines FROM m)
"""


def page_split(spark: SparkSession, folder: str) -> DataFrame:
    pages = marked(spark, folder).select("doc_id", F.posexplode(P.split_pages(F.col("text"))).alias("place", "p"))
    return pages.select("doc_id", "place", "p.page", "p.total", "p.first_line", "p.last_line", F.md5("p.text").alias("text_md5"))


PAGE_SPLIT = f"""
WITH {_LINES},
p AS (SELECT *, CASE WHEN total = 0 THEN 1 ELSE least(block, total) END AS page FROM x)
SELECT doc_id, (page - 1)::INT AS place, page::INT AS page, greatest(any_value(total), 1)::INT AS total, min(place)::INT AS first_line, max(place)::INT AS last_line,
       md5(string_agg(line, chr(10) ORDER BY place) || CASE WHEN max(place) < any_value(lines) THEN chr(10) ELSE '' END) AS text_md5
FROM p GROUP BY doc_id, page
"""


def page_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = marked(spark, folder).select("doc_id", F.explode(P.page_of_lines(F.col("text"))).alias("page"))
    return rows.groupBy("doc_id", "page").agg(F.count("*").alias("lines"))


PAGE_MAP = f"WITH {_LINES} SELECT doc_id, (CASE WHEN total = 0 THEN 1 ELSE block END)::INT AS page, count(*)::BIGINT AS lines FROM x GROUP BY ALL"


def page_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = marked(spark, folder).select("doc_id", F.explode(P.group_pages(P.split_pages(F.col("text")), 3)).alias("g"))
    return rows.select("doc_id", "g.first", "g.last", "g.total", F.length("g.text").alias("chars"))


PAGE_GROUPS = f"""
WITH {_LINES},
p AS (SELECT *, CASE WHEN total = 0 THEN 1 ELSE least(block, total) END AS page FROM x)
SELECT doc_id, min(page)::INT AS first, max(page)::INT AS last, greatest(any_value(total), 1)::INT AS total,
       (sum(length(line)) + count(*) - CASE WHEN max(place) = any_value(lines) THEN 1 ELSE 0 END)::INT AS chars
FROM p GROUP BY doc_id, (page - 1) // 3
"""


def page_acceptance(spark: SparkSession, folder: str) -> DataFrame:
    """Markers against one page more than there are, so the last is missing everywhere."""
    docs = marked(spark, folder).withColumn("found", P.completed(F.col("text")))
    rows = docs.select("doc_id", P.acceptance(F.concat("found", F.slice("found", 1, 1)), F.size("found") + 1).alias("a"))
    return rows.select("doc_id", *[F.array_join(f"a.{c}", ",").alias(c) for c in ("missing", "repeated", "unexpected")], "a.ordered")


PAGE_ACCEPTANCE = f"""
SELECT doc_id, (t + 1)::VARCHAR AS missing, CASE WHEN t > 0 THEN '1' ELSE '' END AS repeated, '' AS unexpected, false AS ordered
FROM (SELECT doc_id, len(string_split(text, chr(10))) // {EVERY} AS t FROM documents)
"""


def placeholder_pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = marked(spark, folder).select("doc_id", F.explode(P.split_pages(F.col("text"))).alias("p"))
    return rows.where(P.has_fallback(F.col("p.text"))).select("doc_id", "p.page")


PLACEHOLDERS = "SELECT doc_id, 1::INT AS page FROM documents WHERE doc_id % 9 = 0"


def page_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    rows = marked(spark, folder)
    return rows.select("doc_id", P.last_checkpoint(F.col("text")).alias("c"), F.length(P.completed_prefix(F.col("text"))).alias("kept")).select("doc_id", "c.page", "c.total", "kept")


CHECKPOINT = f"""
WITH {_LINES}
SELECT doc_id, CASE WHEN any_value(total) > 0 THEN any_value(total)::INT END AS page, CASE WHEN any_value(total) > 0 THEN any_value(total)::INT END AS total,
       coalesce(sum(length(line) + 1) FILTER (WHERE total > 0 AND block <= total), 0)::INT
         - CASE WHEN any_value(total) > 0 AND max(block) <= any_value(total) THEN 1 ELSE 0 END AS kept
FROM x GROUP BY doc_id
"""


def issue_hints(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with a currency sign, by page and the page's own line number."""
    docs = marked(spark, folder)
    issues = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line_text")).where(F.col("line_text").contains("$")).select("doc_id", (F.col("i") + 1).alias("line"))
    pages = docs.select("doc_id", F.explode(P.split_pages(F.col("text"))).alias("p")).select("doc_id", "p.page", "p.first_line", "p.last_line")
    return P.hints(issues, pages, "doc_id").select("doc_id", "page", "line", "local_line")


ISSUE_HINTS = f"""
WITH {_LINES},
p AS (SELECT *, CASE WHEN total = 0 THEN 1 ELSE least(block, total) END AS page FROM x),
f AS (SELECT *, min(place) OVER (PARTITION BY doc_id, page) AS first_line FROM p)
SELECT doc_id, page::INT AS page, place::INT AS line, (place - first_line + 1)::INT AS local_line FROM f WHERE contains(line, '$')
"""

QUERIES = {
    "page_split": (page_split, PAGE_SPLIT),
    "page_map": (page_map, PAGE_MAP),
    "page_groups": (page_groups, PAGE_GROUPS),
    "page_acceptance": (page_acceptance, PAGE_ACCEPTANCE),
    "placeholder_pages": (placeholder_pages, PLACEHOLDERS),
    "page_checkpoint": (page_checkpoint, CHECKPOINT),
    "issue_hints": (issue_hints, ISSUE_HINTS),
}
