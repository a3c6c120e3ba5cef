"""Queries over lines of documents and glyphs of pages, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import layout as Y
from folioforge.operators import lines as L
from folioforge.plans import adapters as R

DOCS = "SELECT doc_id, text FROM {documents}"
_LINES = "(SELECT doc_id, generate_subscripts(parts, 1)::INT AS line_no, unnest(parts) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"
_SHORT = "length(line) < 120"
_WIN = "(PARTITION BY doc_id ORDER BY line_no)"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return L.lines_of(R.frame(spark, folder, DOCS), "doc_id")


def headings(spark: SparkSession, folder: str) -> DataFrame:
    rows = L.headed(_lines(spark, folder), "doc_id", F.expr(_SHORT))
    return rows.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count("heading").alias("headed"), F.countDistinct("heading").alias("headings"), F.sum(F.length("heading")).alias("chars"))


HEADINGS = f"""
SELECT doc_id, count(*)::BIGINT AS lines, count(h)::BIGINT AS headed, count(DISTINCT h)::BIGINT AS headings, sum(length(h))::BIGINT AS chars FROM (
  SELECT doc_id, last_value(CASE WHEN length(line) < 120 THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h FROM {_LINES}) GROUP BY doc_id
"""


def markers_above(spark: SparkSession, folder: str) -> DataFrame:
    rows = L.marked_above(_lines(spark, folder), "doc_id", F.expr(_SHORT), F.length("line") > 400, 3)
    return rows.select("doc_id", "line_no", "marker_line").where("marker_line is not null")


MARKERS = f"""
WITH p AS (SELECT doc_id, line_no, line, sum(CASE WHEN length(line) > 400 THEN 1 ELSE 0 END) OVER {_WIN} AS part FROM {_LINES}),
m AS (SELECT doc_id, line_no, max(CASE WHEN length(line) < 120 THEN line_no END) OVER (PARTITION BY doc_id, part ORDER BY line_no) AS marker_line FROM p)
SELECT * FROM m WHERE line_no - marker_line <= 3
"""


def captions(spark: SparkSession, folder: str) -> DataFrame:
    rows = L.captioned(_lines(spark, folder), "doc_id", F.col("line").endswith("is.") | (F.length("line") < 30), 12, 36)
    return rows.groupBy("doc_id").agg(F.count("caption_line").alias("captioned"), F.sum("caption_line").alias("places"))


CAPTIONS = f"""
SELECT doc_id, count(c)::BIGINT AS captioned, sum(c)::BIGINT AS places FROM (
  SELECT doc_id, min(CASE WHEN suffix(line, 'is.') OR length(line) < 30 THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 12 PRECEDING AND 36 FOLLOWING) AS c FROM {_LINES}) GROUP BY doc_id
"""


def page_tracker(spark: SparkSession, folder: str) -> DataFrame:
    """Short lines are breaks; every ninth line of even documents is a marker that names its page."""
    marker = F.when((F.col("doc_id") % 2 == 0) & (F.col("line_no") % 9 == 0), F.col("line_no") * 10)
    rows = L.paged(_lines(spark, folder), "doc_id", marker, F.expr(_SHORT))
    return rows.groupBy("doc_id", "page").agg(F.count("*").alias("lines"), F.min("line_no").alias("first_line"))


TRACKER = f"""
WITH b AS (SELECT doc_id, line_no, sum(CASE WHEN length(line) < 120 THEN 1 ELSE 0 END) OVER {_WIN} + 1 AS page,
  last_value(CASE WHEN doc_id % 2 = 0 AND line_no % 9 = 0 THEN line_no * 10 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS marker FROM {_LINES})
SELECT doc_id, coalesce(marker, page)::BIGINT AS page, count(*)::BIGINT AS lines, min(line_no) AS first_line FROM b GROUP BY 1, 2
"""


def short_runs(spark: SparkSession, folder: str) -> DataFrame:
    return L.runs(_lines(spark, folder), "doc_id", F.length("line") < 200, 2)


RUNS = f"""
SELECT doc_id, min(line_no) AS first_line, max(line_no) AS last_line FROM (
  SELECT doc_id, line_no, line_no - row_number() OVER {_WIN} AS run FROM {_LINES} WHERE length(line) < 200) GROUP BY doc_id, run HAVING count(*) >= 2
"""


def overflow_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The longest run of long lines of each document that has one."""
    found = L.runs(_lines(spark, folder), "doc_id", F.length("line").between(300, 600), 1)
    return found.groupBy("doc_id").agg(F.max(F.col("last_line") - F.col("first_line") + 1).alias("longest"), F.count("*").alias("runs"))


OVERFLOW_RUNS = f"""
SELECT doc_id, max(n)::INT AS longest, count(*)::BIGINT AS runs FROM (SELECT doc_id, run, count(*) AS n FROM (
  SELECT doc_id, line_no, line_no - row_number() OVER {_WIN} AS run FROM {_LINES} WHERE length(line) BETWEEN 300 AND 600) GROUP BY doc_id, run) GROUP BY doc_id
"""


def legacy_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, "SELECT p_partkey, p_size AS page, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS own FROM {part}")
    return L.legacy_ids(rows, ["page"], ["p_partkey"], F.col("page"), F.col("own")).select("p_partkey", "field_id")


LEGACY = """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_name IS NOT NULL THEN p_name ELSE printf('LEX-P%04d-V%04d', p_size, (sum(CASE WHEN p_partkey % 3 = 0 AND p_name IS NOT NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p_size ORDER BY p_partkey))::INT) END AS field_id FROM part
"""


def error_excerpts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines around the middle line of every document."""
    rows = _lines(spark, folder)
    errors = rows.groupBy("doc_id").agg(F.ceil(F.max("line_no") / 2).cast("int").alias("error_line"))
    return L.excerpts(rows, errors, "doc_id", 2, 2).select("doc_id", "error_line", F.md5("excerpt").alias("excerpt_md5"))


EXCERPTS = f"""
WITH l AS (SELECT * FROM {_LINES}), e AS (SELECT doc_id, ceil(max(line_no) / 2.0)::INT AS error_line FROM l GROUP BY doc_id)
SELECT e.doc_id, error_line, md5(string_agg(line_no || ': ' || line, chr(10) ORDER BY line_no)) AS excerpt_md5 FROM e JOIN l ON l.doc_id = e.doc_id AND line_no BETWEEN error_line - 2 AND error_line + 2 GROUP BY ALL
"""
#: Vectors as glyphs: a page, and a box in points.
GLYPHS = """
SELECT vec_id AS glyph, CAST(floor(vec_id / 20) AS BIGINT) AS page, CAST(embedding[0] AS DOUBLE) * 900 + 280 AS x0, CAST(embedding[1] AS DOUBLE) * 900 + 400 AS y0,
       CAST(embedding[0] AS DOUBLE) * 900 + 292 AS x1, CAST(embedding[1] AS DOUBLE) * 900 + 409 AS y1 FROM {embeddings}
"""
_GLYPHS = "(SELECT vec_id AS glyph, vec_id // 20 AS page, embedding[1]::DOUBLE * 900 + 280 AS x0, embedding[2]::DOUBLE * 900 + 400 AS y0, embedding[1]::DOUBLE * 900 + 292 AS x1, embedding[2]::DOUBLE * 900 + 409 AS y1 FROM embeddings)"


def _overflow(spark: SparkSession, folder: str) -> DataFrame:
    glyphs = R.frame(spark, folder, GLYPHS).withColumn("box", F.array("x0", "y0", "x1", "y1"))
    return Y.overflow(glyphs, 460.0, 640.0, 1.0, 8)


def layout_overflow(spark: SparkSession, folder: str) -> DataFrame:
    rows = _overflow(spark, folder)
    return rows.select("page", "clipped", *[F.round(s, 6).alias(s) for s in Y.SIDES], "samples")


_OVER = f"(SELECT * FROM (SELECT glyph, page, greatest(-x0, 0) AS l, greatest(-y0, 0) AS t, greatest(x1 - 460, 0) AS r, greatest(y1 - 640, 0) AS b FROM {_GLYPHS}) WHERE greatest(l, t, r, b) > 1)"
OVERFLOW = f"""
SELECT page, count(*)::BIGINT AS clipped, round(max(l), 6) AS "left", round(max(t), 6) AS top, round(max(r), 6) AS "right", round(max(b), 6) AS bottom, array_to_string(list(glyph ORDER BY glyph)[1:8], ',') AS samples FROM {_OVER} GROUP BY page
"""
PAGE_MAP = "SELECT n_nationkey AS source_page, CAST(n_nationkey * 2 AS BIGINT) AS start, CAST(n_nationkey * 2 + n_nationkey % 2 AS BIGINT) AS end FROM {nation}"


def clipped_sources(spark: SparkSession, folder: str) -> DataFrame:
    return Y.clipped_sources(R.frame(spark, folder, PAGE_MAP), _overflow(spark, folder))


CLIPPED = f'SELECT DISTINCT n_nationkey AS source_page FROM nation JOIN {_OVER} ON page BETWEEN n_nationkey * 2 AND n_nationkey * 2 + n_nationkey % 2'


def source_pages(spark: SparkSession, folder: str) -> DataFrame:
    return Y.source_pages(R.frame(spark, folder, PAGE_MAP), R.frame(spark, folder, GLYPHS).select("glyph", "page"))


SOURCE_PAGES = f"SELECT page, glyph, n_nationkey AS source_page FROM {_GLYPHS} LEFT JOIN nation ON page BETWEEN n_nationkey * 2 AND n_nationkey * 2 + n_nationkey % 2"


def content_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Documents against copies of which some lost a word, some only changed white space, and some are gone."""
    docs = R.frame(spark, folder, DOCS)
    copy = docs.where("doc_id % 19 <> 0").withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.substr("text", F.lit(9))).when(F.col("doc_id") % 5 == 0, F.replace("text", F.lit(" "), F.lit("  "))).otherwise(F.col("text")))
    return Y.content_changes(docs, copy, ["doc_id"])


CONTENT = r"""
WITH p AS (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS old, trim(regexp_replace(substr(text, 9), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS cut FROM documents)
SELECT doc_id, CASE WHEN doc_id % 19 = 0 THEN 'lost' ELSE 'changed' END AS change FROM p WHERE doc_id % 19 = 0 OR (doc_id % 7 = 0 AND old <> cut)
"""


def geometry_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Glyphs against a copy in which some pages moved and some glyphs changed."""
    words = R.frame(spark, folder, GLYPHS).select("page", "glyph", (F.col("glyph") % 97).alias("word"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    moved = words.select("page", "glyph", F.when(F.col("glyph") % 101 == 0, F.lit(-1)).otherwise(F.col("word")).alias("word"), (F.col("x") + F.when(F.col("page") % 4 == 0, 0.75).otherwise(0.0)).alias("x"), "y")
    rows = Y.displacement(words, moved, ["page", "glyph"], "page", 0.5)
    return rows.withColumn("shift", F.round("shift", 6))


GEOMETRY = f"""
SELECT page, count(*) FILTER (WHERE glyph % 101 = 0)::BIGINT AS reordered, CASE WHEN page % 4 = 0 AND count(*) FILTER (WHERE glyph % 101 <> 0) > 0 THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END AS shift,
       count(*) FILTER (WHERE glyph % 101 = 0) = 0 AND page % 4 <> 0 AS ok FROM {_GLYPHS} GROUP BY page
"""

QUERIES = {
    "headings": (headings, HEADINGS),
    "markers_above": (markers_above, MARKERS),
    "captions": (captions, CAPTIONS),
    "page_tracker": (page_tracker, TRACKER),
    "short_runs": (short_runs, RUNS),
    "overflow_runs": (overflow_runs, OVERFLOW_RUNS),
    "legacy_ids": (legacy_ids, LEGACY),
    "error_excerpts": (error_excerpts, EXCERPTS),
    "layout_overflow": (layout_overflow, OVERFLOW),
    "clipped_sources": (clipped_sources, CLIPPED),
    "source_pages": (source_pages, SOURCE_PAGES),
    "content_diff": (content_diff, CONTENT),
    "geometry_diff": (geometry_diff, GEOMETRY),
}
