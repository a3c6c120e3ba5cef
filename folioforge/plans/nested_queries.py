"""Queries over nested records, unique names, merged pages and progress, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import nested as N
from folioforge.operators import resume as P
from folioforge.operators import suffixes as U
from folioforge.plans import adapters as R
from folioforge.session import new_folder, table
from folioforge.streaming import progress as S

_K = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)"
#: A line's objects: right, no array, attributes with forbidden keys, with a nested value.
_THINGS = """CASE l_partkey % 12 WHEN 2 THEN '5' WHEN 3 THEN concat('[{', {head}, '"name":"m","attributes":{"form_index":1,"Big":2,"ok":null}}]')
  WHEN 4 THEN concat('[{', {head}, '"name":"m","attributes":{"a":[1]}}]') ELSE concat('[{', {head}, '"name":"m","attributes":{"lot":"', l_suppkey, '","kg":1.5}}]') END"""
_FLAT = (
    """concat('{"subprocess":"s","step":[{', CASE l_partkey % 12 WHEN 0 THEN '' WHEN 5 THEN '"id":"dup",' WHEN 7 THEN '"id":" ",' ELSE concat('"id":"L', k, '",') END, CASE WHEN l_partkey % 12 = 1 THEN '"stage":7,' ELSE '"stage":"a",' END,
  CASE WHEN l_partkey % 12 = 6 THEN '"note":"n",' ELSE '' END, '"form":"f","materials":', """
    + _THINGS.replace("{head}", """'"id":"O', k, '",'""")
    + ", '}]}')"
)
_DEEP = (
    """concat('{"name":"p","subprocess":[{"name":"s","step":[{"name":"t","form":[{', CASE l_partkey % 12 WHEN 0 THEN '' WHEN 1 THEN '"name":7,' ELSE '"name":"f",' END,
  CASE WHEN l_partkey % 12 = 6 THEN '"note":"n",' ELSE '' END, '"equipment":', """
    + _THINGS.replace("{head}", "''")
    + ", '}]}]}]}')"
)


def _records(spark: SparkSession, folder: str, line: str) -> DataFrame:
    """Each order as a nested record of its lines; those of every 97th customer are cut off."""
    rows = table(spark, folder, "lineitem").withColumn("k", F.expr(_K)).selectExpr("l_orderkey AS id", "k", f"{line} AS line")
    lines = rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), ",").alias("lines"))
    text = F.concat(F.lit('{"batch":"b","process":['), "lines", F.when(F.col("id") % 97 != 0, F.lit("]}")).otherwise(""))
    return lines.select("id", F.try_parse_json(text).alias("value"))


def hierarchy_flat_faults(spark: SparkSession, folder: str) -> DataFrame:
    return N.validate(_records(spark, folder, _FLAT), N.FLAT)


def hierarchy_faults(spark: SparkSession, folder: str) -> DataFrame:
    return N.validate(_records(spark, folder, _DEEP), N.DEEP)


def _fault_sql(base: str, things: str, cases: list[tuple[int, str, str]], dup: bool) -> str:
    parts = [f"SELECT id, '$.process[' || k || ']{base}{path}' AS path, '{fault}' AS fault FROM l WHERE c = {c}" for c, path, fault in cases]
    parts += [f"SELECT id, '$.process[' || k || ']{base}.{things}{path}', '{fault}' FROM l WHERE c = {c}" for c, path, fault in ((2, "", "expected an array"), (3, "[0].attributes.form_index", "unsupported field"), (3, "[0].attributes.Big", "unsupported field"), (4, "[0].attributes.a", "not a scalar"))]
    if dup:
        parts.append(f"SELECT id, '$.process[' || k || ']{base}.id', 'duplicate id' FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS n FROM l WHERE c = 5) WHERE n > 1")
    parts.append("SELECT DISTINCT l_orderkey, '$', 'not a record' FROM lineitem WHERE l_orderkey % 97 = 0")
    return f"WITH l AS (SELECT l_orderkey AS id, l_partkey % 12 AS c, {_K} - 1 AS k FROM lineitem WHERE l_orderkey % 97 <> 0)\n" + "\nUNION ALL ".join(parts)


FLAT_FAULTS = _fault_sql(".step[0]", "materials", [(0, "", "missing id"), (1, ".stage", "expected a string"), (6, "", "unsupported note"), (7, ".id", "blank")], True)
FAULTS = _fault_sql(".subprocess[0].step[0].form[0]", "equipment", [(0, "", "missing name"), (1, ".name", "expected a string"), (6, "", "unsupported note")], False)

#: Parts as fields of their brand's table; names are few, and some look like suffixed ones.
FIELD = """
SELECT p_brand AS tbl, p_partkey AS place, concat(split_part(p_type, ' ', 1), CASE p_partkey % 9 WHEN 0 THEN '_2' WHEN 1 THEN '_3' WHEN 2 THEN '_2_2' ELSE '' END) AS base FROM {part}
"""


def unique_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return U.unique_names(R.frame(spark, folder, FIELD), "tbl", "place", "base").select("tbl", "place", "base", "name")


SUFFIXES = f"""
WITH RECURSIVE f AS (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY place) AS k FROM {R.duck(FIELD)}),
a AS (
  SELECT tbl, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS BIGINT) AS place, CAST(NULL AS VARCHAR) AS base, CAST(NULL AS VARCHAR) AS name FROM f GROUP BY tbl
  UNION ALL
  SELECT tbl, k, list_append(used, name), place, base, name FROM (
    SELECT f.tbl, f.k, a.used, f.place, f.base, list_filter(list_transform(range(1, f.k + 1), lambda i: CASE WHEN i = 1 THEN f.base ELSE f.base || '_' || i END), lambda n: NOT list_contains(a.used, n))[1] AS name
    FROM a JOIN f ON f.tbl = a.tbl AND f.k = a.k + 1))
SELECT tbl, place, base, name FROM a WHERE k > 0
"""

#: Lines as pages of pieces of their order: piece 0 is the base.
PIECE = """
SELECT l_orderkey AS doc, CAST(l_suppkey % 4 AS INT) AS piece, CAST(l_linenumber + l_partkey % 9 AS INT) AS page, l_returnflag <> 'N' AS complete, MIN(l_partkey) AS words FROM {lineitem} GROUP BY 1, 2, 3, 4
"""


def merged_pages(spark: SparkSession, folder: str) -> DataFrame:
    return P.merged_pages(R.frame(spark, folder, PIECE)).select("doc", "page", "piece", "words")


_MERGED = f"""
WITH p AS (SELECT * FROM {R.duck(PIECE)} WHERE complete), e AS (SELECT doc, piece, max(page) AS last FROM p GROUP BY ALL),
c AS (SELECT a.doc, a.piece FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.doc = a.doc AND b.piece < a.piece AND b.last >= a.last)),
m AS (SELECT p.doc, p.page, p.piece, p.words FROM p JOIN c USING (doc, piece) WHERE NOT EXISTS (SELECT 1 FROM p q JOIN c d USING (doc, piece) WHERE q.doc = p.doc AND q.page = p.page AND q.piece < p.piece))
"""
MERGED = _MERGED + "SELECT * FROM m"


def merge_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that merged orders lack, through page 12."""
    return P.gaps(P.merged_pages(R.frame(spark, folder, PIECE)), F.lit(12))


GAPS = (
    _MERGED
    + """, x AS (SELECT doc, unnest(range(1, greatest(12, max(page)) + 1)) AS page FROM m GROUP BY doc), g AS (SELECT doc, page, page - row_number() OVER (PARTITION BY doc ORDER BY page) AS island FROM x ANTI JOIN m USING (doc, page))
SELECT doc, min(page)::INT AS first, max(page)::INT AS last FROM g GROUP BY doc, island"""
)

#: Events of a stage: some begin it anew, the others say what was done to a page.
STAGE_EVENT = """
SELECT user_id AS doc, event_id AS seq, CASE WHEN event_id % 31 = 0 THEN 'reset' WHEN event_type IN ('view', 'click') THEN 'checked' WHEN event_type = 'purchase' THEN 'upgraded' ELSE 'unresolved' END AS kind,
       CASE WHEN event_id % 10 = 3 THEN NULL ELSE CAST(floor(value * 700) AS BIGINT) % 90000 END AS page FROM {events}
"""
_KINDS = ("checked", "upgraded", "unresolved")


def progress_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of each kind since the last attempt, by a stream that gets the log in four parts."""
    place = new_folder(spark, "progress")
    events = R.frame(spark, folder, STAGE_EVENT)
    edge = events.agg(F.max("seq")).first()[0] or 0
    for part in range(4):
        events.where(F.floor(F.col("seq") * 4 / (edge + 1)) == part).write.mode("append").parquet(f"{place}/log")
        S.append_progress(spark.readStream.schema(events.schema).parquet(f"{place}/log"), _KINDS, place)
    return S.progress(spark, place, _KINDS)


PROGRESS = f"""
WITH e AS (SELECT *, max(CASE WHEN kind = 'reset' THEN seq END) OVER (PARTITION BY doc) AS reset FROM {R.duck(STAGE_EVENT)})
SELECT doc, count(*) FILTER (WHERE kind = 'reset')::BIGINT AS attempts, max(seq) AS last, {', '.join(f"count(DISTINCT page) FILTER (WHERE kind = '{k}' AND (reset IS NULL OR seq > reset))::BIGINT AS {k}" for k in _KINDS)} FROM e GROUP BY doc
"""

QUERIES = {
    "hierarchy_flat_faults": (hierarchy_flat_faults, FLAT_FAULTS),
    "hierarchy_faults": (hierarchy_faults, FAULTS),
    "unique_suffixes": (unique_suffixes, SUFFIXES),
    "merged_pages": (merged_pages, MERGED),
    "merge_gaps": (merge_gaps, GAPS),
    "progress_sets": (progress_sets, PROGRESS),
}
