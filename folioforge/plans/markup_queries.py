"""Queries over marked-up pages that are written from the tables, so that DuckDB tells from the tables what the readers must find.

Each order is a page and each of its lines a row of it: a table row, a form field, a
line with or without a fault.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import hierarchy as H
from folioforge.operators import jobs as J
from folioforge.operators import markup as M
from folioforge.operators import review as V
from folioforge.plans import adapters as R
from folioforge.session import table

_K = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)"


def _pages(spark: SparkSession, folder: str, row: str, begin: str = "", end: str = "") -> DataFrame:
    """``id`` and ``text`` of each order: its rows, as the SQL expression ``row`` writes them, in order; a row knows its place as ``k``."""
    rows = table(spark, folder, "lineitem").withColumn("k", F.expr(_K)).selectExpr("l_orderkey AS id", "k", f"{row} AS line")
    lines = rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    return lines.select("id", F.concat(F.lit(begin), "lines", F.lit(end)).alias("text"))


_LINES = f"(SELECT *, {_K} AS k FROM lineitem)"
#: A table's rows: two cells (the first over two columns), too few, too many, or three with marks inside.
_ROW = r"""CASE WHEN l_partkey % 11 = 0 THEN concat(l_partkey, ' & short \\\\') WHEN l_partkey % 11 = 1 THEN concat(l_partkey, ' & b & c & d \\\\ \\hline')
  WHEN l_partkey % 11 < 5 THEN concat('\\multicolumn{2}{l}{', l_partkey, '} & ', l_suppkey, ' \\\\') ELSE concat(l_partkey, ' & {q & r} & x\\&', l_suppkey, ' \\\\[2pt]') END"""
_TABULAR = ("\\begin{tabular}{|l|*{2}{c}|}\n", "\n\\end{tabular}")


def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    return M.rows_of(_pages(spark, folder, _ROW, *_TABULAR), "cells", "id")


_CELLS = r"""CASE WHEN l_partkey % 11 = 0 THEN [{'t': l_partkey::VARCHAR, 's': 1}, {'t': 'short', 's': 1}]
  WHEN l_partkey % 11 = 1 THEN [{'t': l_partkey::VARCHAR, 's': 1}, {'t': 'b', 's': 1}, {'t': 'c', 's': 1}, {'t': 'd', 's': 1}]
  WHEN l_partkey % 11 < 5 THEN [{'t': '\multicolumn{2}{l}{' || l_partkey || '}', 's': 2}, {'t': l_suppkey::VARCHAR, 's': 1}]
  ELSE [{'t': l_partkey::VARCHAR, 's': 1}, {'t': '{q & r}', 's': 1}, {'t': 'x\&' || l_suppkey, 's': 1}] END"""
CELLS = f"""
SELECT id, 1 AS table_no, 'tabular' AS env, 3 AS columns, k::INT AS row_no, place::INT AS cell_no, x.t AS text, x.s::INT AS span FROM (
  SELECT l_orderkey AS id, k, unnest(c) AS x, generate_subscripts(c, 1) AS place FROM (SELECT *, {_CELLS} AS c FROM {_LINES}))
"""


def table_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = M.rows_of(_pages(spark, folder, _ROW, *_TABULAR), "row_issues", "id")
    return found.groupBy("id", "severity", "code").agg(F.count("*").alias("n"))


ALIGNMENT = """
SELECT l_orderkey AS id, CASE l_partkey % 11 WHEN 0 THEN 'warning' ELSE 'error' END AS severity, CASE l_partkey % 11 WHEN 0 THEN 'ROW_TOO_SHORT' ELSE 'ROW_TOO_WIDE' END AS code, count(*)::BIGINT AS n
FROM lineitem WHERE l_partkey % 11 < 2 GROUP BY ALL
"""

#: Lines of even orders have closings too many, those of odd ones openings; comments, verbatim text and escapes hide others.
_FAULTY = r"""CASE l_partkey % 7 WHEN 0 THEN CASE WHEN l_orderkey % 2 = 0 THEN 'x }' ELSE '{ y' END WHEN 1 THEN '% {' WHEN 2 THEN '\\verb|{| z' WHEN 3 THEN '\\{ w'
  WHEN 4 THEN '\\begin{center}v\\end{center}' ELSE concat('{', l_partkey, '} u') END"""
_OPENED = "\n\\begin{center}"


def markup_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Braces and environments that don't match; every fifth order ends with an environment that nothing closes."""
    pages = _pages(spark, folder, _FAULTY).withColumn("text", F.concat("text", F.when(F.col("id") % 5 == 0, F.lit(_OPENED)).otherwise("")))
    return M.rows_of(pages, "issues", "id")


ISSUES = f"""
SELECT l_orderkey AS id, 'error' AS severity, CASE l_orderkey % 2 WHEN 0 THEN 'UNMATCHED_CLOSE_BRACE' ELSE 'UNCLOSED_BRACE' END AS code, k::INT AS line FROM {_LINES} WHERE l_partkey % 7 = 0
UNION ALL SELECT l_orderkey, 'error', 'UNCLOSED_ENVIRONMENT', (count(*) + 1)::INT FROM lineitem WHERE l_orderkey % 5 = 0 GROUP BY l_orderkey
"""


def brace_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of every order's braces, counted by page."""
    return M.rows_of(_pages(spark, folder, _FAULTY), "issues", "id").groupBy("id", "code").agg(F.count("*").alias("n"))


BALANCE = "SELECT l_orderkey AS id, CASE l_orderkey % 2 WHEN 0 THEN 'UNMATCHED_CLOSE_BRACE' ELSE 'UNCLOSED_BRACE' END AS code, count(*)::BIGINT AS n FROM lineitem WHERE l_partkey % 7 = 0 GROUP BY ALL"


def unmatched_closings(spark: SparkSession, folder: str) -> DataFrame:
    """Pages without the closings that nothing opens."""
    pages = _pages(spark, folder, "CASE WHEN l_partkey % 3 = 0 THEN concat('a} {', l_partkey, '}} c') ELSE concat('{a ', l_suppkey, '} \\\\}') END")
    return pages.select("id", F.md5(M.text_of("closed")("text")).alias("result_md5"))


CLOSED = rf"SELECT l_orderkey AS id, md5(string_agg(CASE WHEN l_partkey % 3 = 0 THEN 'a {{' || l_partkey || '}} c' ELSE '{{a ' || l_suppkey || '}} \}}' END, chr(10) ORDER BY k)) AS result_md5 FROM {_LINES} GROUP BY l_orderkey"

#: Fields of a form: plain, over two lines and by hand, or a box that is checked.
_FIELD = r"""concat('% #VALUE_ID: F-P0001-V', lpad(CAST(k AS STRING), 4, '0'), '\n', CASE l_partkey % 3
  WHEN 0 THEN concat('% #FIELD_VALUE: Part ', l_suppkey, '\n\\fieldvalue{\\textbf{', l_partkey, '} kg}')
  WHEN 1 THEN concat('% #TODO #HANDWRITTEN: check ', l_suppkey, '\n\\fieldvalue{two\n', l_partkey, '}')
  ELSE concat('% #FIELD_VALUE: ok?\n\\fieldvalue{\\checkboxfield{', CASE WHEN l_suppkey % 2 = 0 THEN 'checked' ELSE 'unclear' END, '} ', l_partkey, '}') END)"""


def extract_fields(spark: SparkSession, folder: str) -> DataFrame:
    return M.rows_of(_pages(spark, folder, _FIELD, end="\n% PAGE_COMPLETED: 1/1"), "fields", "id")


FIELDS = f"""
SELECT l_orderkey AS id, 'F-P0001-V' || lpad(k::VARCHAR, 4, '0') AS field_id, CASE l_partkey % 3 WHEN 0 THEN 'Part ' || l_suppkey WHEN 1 THEN '' ELSE 'ok?' END AS label,
       CASE l_partkey % 3 WHEN 0 THEN l_partkey || ' kg' WHEN 1 THEN 'two ' || l_partkey ELSE l_partkey::VARCHAR END AS value, 1 AS page, 1 AS total,
       (1 + coalesce(sum(CASE l_partkey % 3 WHEN 1 THEN 4 ELSE 3 END) OVER (PARTITION BY l_orderkey ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INT AS line,
       l_partkey % 3 = 1 AS handwritten, CASE l_partkey % 3 WHEN 1 THEN 'check ' || l_suppkey ELSE '' END AS todo,
       CASE l_partkey % 3 WHEN 2 THEN 'checkbox' ELSE 'text' END AS kind, CASE WHEN l_partkey % 3 = 2 AND l_suppkey % 2 = 0 THEN true END AS checked
FROM {_LINES}
"""

_SOURCE = "SELECT l_orderkey AS id, l_linenumber AS line, l_partkey, l_suppkey, concat(l_partkey, ' ＫＧ & ', l_suppkey, '% #ß') AS source FROM {lineitem}"


def text_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, _SOURCE)
    slug = T.slug(M.text_of("ascii")("source"), named=F.col("source"))
    return rows.select("id", "line", "source", *[M.text_of(k)("source").alias(k) for k in ("normal", "escaped")], slug.alias("slug"))


VALUES = rf"""
SELECT id, line, source, l_partkey || 'kg&' || l_suppkey || '%#ss' AS normal, l_partkey || ' ＫＧ \& ' || l_suppkey || '\% \#ß' AS escaped, l_partkey || '_kg_' || l_suppkey AS slug FROM {R.duck(_SOURCE)}
"""

#: A line for each of the rules, and what they make of it.
_RULE_LINE = r"""concat(CASE l_linenumber % 7 WHEN 0 THEN concat('a\\nB', l_partkey) WHEN 1 THEN concat('A37\\\\', l_partkey) WHEN 2 THEN concat('\\handwritten{10^', l_partkey % 10, '}')
  WHEN 3 THEN concat('  \\%  #VALUE_ID: ', l_partkey) WHEN 4 THEN concat('x\\中\\\\文', l_partkey) WHEN 5 THEN concat('a\n  \\newline  \nb', l_partkey) ELSE concat('plain ', l_partkey) END, '.')"""


def rules_regex(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").selectExpr("l_orderkey AS id", "l_linenumber AS line", f"{_RULE_LINE} AS source")
    result, finds = T.normalize(F.col("source"))
    return rows.select("id", "line", result.alias("result"), F.aggregate(F.map_values(finds), F.lit(0), lambda a, b: a + b).cast("int").alias("finds"))


RULES = r"""
SELECT l_orderkey AS id, l_linenumber AS line, CASE l_linenumber % 7 WHEN 0 THEN 'a' || chr(10) || 'B' || l_partkey WHEN 1 THEN 'A37\textbackslash{}' || l_partkey WHEN 2 THEN '\handwritten{10\textsuperscript{' || l_partkey % 10 || '}}'
  WHEN 3 THEN '  % #VALUE_ID: ' || l_partkey WHEN 4 THEN 'x\textbackslash{}中\textbackslash{}文' || l_partkey WHEN 5 THEN 'a' || chr(10) || '\par' || chr(10) || 'b' || l_partkey ELSE 'plain ' || l_partkey END || '.' AS result,
  CASE l_linenumber % 7 WHEN 4 THEN 2 WHEN 6 THEN 0 ELSE 1 END AS finds FROM lineitem
"""

#: Days and times of orders, written in the ways of the records; every seventh day's month is none.
_TIME = """
SELECT o_orderkey AS id, o_orderkey % 6 AS way, year(o_orderdate) AS y, month(o_orderdate) + CASE WHEN o_custkey % 7 = 0 THEN 12 ELSE 0 END AS m, day(o_orderdate) AS d, o_custkey % 24 AS h, o_orderkey % 60 AS n, o_custkey % 60 AS s FROM {orders}
"""
_WRITTEN = """
SELECT *, CASE way WHEN 0 THEN concat(y, '年', m, '月', d, '日') WHEN 1 THEN concat(y, '.', m, '.', d) WHEN 2 THEN concat(y, '/', m, '/', d, ' ', h, ':', lpad(CAST(n AS STRING), 2, '0'))
  WHEN 3 THEN concat(y, '-', lpad(CAST(m AS STRING), 2, '0'), '-', lpad(CAST(d AS STRING), 2, '0'), 'T', lpad(CAST(h AS STRING), 2, '0'), ':', lpad(CAST(n AS STRING), 2, '0'), ':', lpad(CAST(s AS STRING), 2, '0'))
  WHEN 4 THEN concat(h, '时', lpad(CAST(n AS STRING), 2, '0'), '分') ELSE concat(y, '年', m, '月') END AS source FROM ({0})
"""


def temporal_normalize(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, _WRITTEN.replace("{0}", _TIME))
    return rows.select("id", "source", H.normalize_temporal(F.col("source")).alias("t")).select("id", "source", "t.value", "t.kind")


TEMPORAL = f"""
WITH w AS ({_WRITTEN.replace('{0}', R.duck(_TIME))}), z AS (SELECT *, printf('%04d-%02d-%02d', y, m, d) AS day, m <= 12 AS known FROM w)
SELECT id, source, CASE WHEN way < 2 AND known THEN day WHEN way = 2 AND known THEN printf('%s-%02d:%02d', day, h, n) WHEN way = 3 AND known THEN printf('%s-%02d:%02d:%02d', day, h, n, s) WHEN way = 4 THEN printf('%02d:%02d', h, n) ELSE source END AS value,
       CASE WHEN way < 2 AND known THEN 'date' WHEN way < 4 AND known THEN 'datetime' WHEN way = 4 THEN 'time' ELSE 'text' END AS kind FROM z
"""

#: Fields of lines whose labels ask for a form of the value, right or wrong by the part's number.
_LABELLED = """
SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, CASE l_linenumber WHEN 1 THEN '生产日期' WHEN 2 THEN 'Start date day' WHEN 3 THEN '生产日期:月' WHEN 4 THEN 'Batch No' WHEN 5 THEN '数量' WHEN 6 THEN '生产日期 年' ELSE 'Name' END AS label,
       CASE l_linenumber WHEN 1 THEN concat('2024', CASE WHEN l_suppkey % 2 = 0 THEN '-' ELSE '/' END, 1 + l_partkey % 14, CASE WHEN l_suppkey % 2 = 0 THEN '-' ELSE '/' END, 1 + l_partkey % 28) WHEN 2 THEN CAST(l_partkey % 40 AS STRING) WHEN 3 THEN CAST(l_partkey % 20 AS STRING)
         WHEN 4 THEN concat('A', CASE WHEN l_partkey % 3 = 0 THEN ' ' ELSE '-' END, l_partkey) WHEN 5 THEN concat(CASE WHEN l_partkey % 3 = 0 THEN 'about ' ELSE '-' END, l_partkey, '.5 kg') WHEN 6 THEN CAST(1990 + l_partkey % 9000 AS STRING) ELSE 'anything' END AS value
FROM {lineitem}
"""


def critical_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, _LABELLED)
    return rows.select("id", "line", "label", "value", V.critical_invalid(F.col("label"), F.col("value")).alias("invalid"))


CRITICAL = f"""
SELECT id, line, label, value, CASE line WHEN 1 THEN part % 14 > 11 WHEN 2 THEN part % 40 NOT BETWEEN 1 AND 31 WHEN 3 THEN part % 20 NOT BETWEEN 1 AND 12 WHEN 4 THEN part % 3 = 0 WHEN 5 THEN part % 3 = 0 WHEN 6 THEN part % 9000 > 8009 ELSE false END AS invalid FROM {R.duck(_LABELLED)}
"""

#: Codes of customers' batches: long and short years, months that are none, lines that are known or not.
_CODE = """
SELECT c_custkey AS id, c_custkey % 4 AS way, 1 + c_custkey % 14 AS m, lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') AS n, lpad(CAST(c_nationkey AS STRING), 2, '0') AS b FROM {customer}
"""
_CODES = """
SELECT *, concat('B', b, CASE way WHEN 0 THEN 'X12' WHEN 1 THEN 'PA' WHEN 2 THEN 'P1' ELSE 'P' END, CASE way WHEN 3 THEN '24' ELSE '2023' END, lpad(CAST(m AS STRING), 2, '0'), n, CASE WHEN id % 5 = 0 THEN '-2' WHEN id % 5 = 1 THEN '_skip' ELSE '' END) AS code FROM ({0})
"""


def batch_code_parse(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, _CODES.replace("{0}", _CODE))
    return rows.select("id", "code", J.batch_code(F.col("code")).alias("p")).select("id", "code", "p.*")


BATCH_CODES = f"""
SELECT id, code, 'B' || b AS batch, CASE WHEN m > 12 THEN '' ELSE CASE way WHEN 0 THEN 'X' WHEN 1 THEN '' WHEN 2 THEN 'P1' ELSE 'P' END END AS process, CASE WHEN m <= 12 AND way = 0 THEN '12' ELSE '' END AS line,
       CASE WHEN m <= 12 THEN CASE way WHEN 3 THEN '2024' ELSE '2023' END || '-' || lpad(m::VARCHAR, 2, '0') END AS month, CASE WHEN m <= 12 THEN n ELSE '' END AS sequence,
       CASE WHEN m > 12 THEN '{J.NO_MONTH}' WHEN way = 1 THEN '{J.NO_LINE}' WHEN way = 3 THEN '{J.SHORT_YEAR}' ELSE '' END AS notes FROM ({_CODES.replace('{0}', R.duck(_CODE))})
"""

QUERIES = {
    "table_cells": (table_cells, CELLS),
    "table_alignment": (table_alignment, ALIGNMENT),
    "markup_issues": (markup_issues, ISSUES),
    "brace_balance": (brace_balance, BALANCE),
    "unmatched_closings": (unmatched_closings, CLOSED),
    "extract_fields": (extract_fields, FIELDS),
    "text_values": (text_values, VALUES),
    "rules_regex": (rules_regex, RULES),
    "temporal_normalize": (temporal_normalize, TEMPORAL),
    "critical_fields": (critical_fields, CRITICAL),
    "batch_code_parse": (batch_code_parse, BATCH_CODES),
}
