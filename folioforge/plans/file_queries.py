"""Queries over files, catalogues and publications, each with its DuckDB text.

Documents and pages stand for files: their text is the content, and paths are made of their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import files as P
from folioforge.plans import adapters as R

FILES = """
SELECT doc_id, concat(source, '/', lang, '/', CASE WHEN doc_id % 40 = 0 THEN '.cache/' WHEN doc_id % 41 = 0 THEN 'build/' ELSE '' END, 'doc_', CAST(doc_id AS STRING), CASE WHEN doc_id % 13 = 0 THEN '.log' ELSE '.tex' END) AS path,
       source, n_chars, md5(text) AS digest FROM {documents}
"""
_FILES = R.duck(FILES)
FOLDERS, ENDINGS = (".cache", "build"), (".log", ".aux")
#: Prefixes of remote paths and what they are here: fixed values of the query.
PREFIXES = (("src1", "/data/one", "u1"), ("src1/en", "/data/one-en", "u2"), ("src2/de", "/data/two-de", "u3"), ("src", "/never", "u4"), ("src11/fr/.cache", "/data/cache", "u5"), ("src3", "", "u6"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return R.frame(spark, folder, FILES)


def _prefixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PREFIXES, "prefix string, local string, unit string")


_PREFIX_SQL = f"(VALUES {', '.join(str(p) for p in PREFIXES)}) AS t(prefix, local, unit)"


def safe_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Urls of pages and pieces of them as paths."""
    pages = R.frame(spark, folder, "SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN substr(url, 9) WHEN 2 THEN concat('/', substr(url, 9)) WHEN 3 THEN concat(substr(url, 12), '/../x') ELSE '' END AS path FROM {pages}")
    return pages.select("page_id", P.safe_relative(F.col("path")).alias("safe"))


SAFE = """
SELECT page_id, coalesce(path <> '' AND NOT starts_with(path, '/') AND NOT list_contains(string_split(path, '/'), '..') AND NOT contains(path, '\\') AND NOT contains(path, ':'), false) AS safe FROM (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN substr(url, 9) WHEN 2 THEN '/' || substr(url, 9) WHEN 3 THEN substr(url, 12) || '/../x' ELSE '' END AS path FROM pages)
"""


def path_prefix(spark: SparkSession, folder: str) -> DataFrame:
    rows = P.longest_prefix(_files(spark, folder), _prefixes(spark))
    return rows.select("doc_id", "unit", P.rewritten(F.col("path"), F.col("prefix"), F.col("local")).alias("local_path"))


PREFIX = f"""
WITH m AS (SELECT f.doc_id, arg_max(unit, length(prefix)) AS unit, arg_max(local || substr(path, length(prefix) + 1), length(prefix)) AS local_path FROM {_FILES} f JOIN {_PREFIX_SQL} ON path = prefix OR starts_with(path, prefix || '/') GROUP BY f.doc_id)
SELECT f.doc_id, m.unit, coalesce(m.local_path, f.path) AS local_path FROM {_FILES} f LEFT JOIN m USING (doc_id)
"""


def publish_files(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder).where(P.publishable(F.col("path"), FOLDERS, ENDINGS)).select("doc_id", "path")


PUBLISH_FILES = f"SELECT doc_id, path FROM {_FILES} WHERE NOT regexp_matches(path, '(^|/)(\\.cache|build)/|\\.(log|aux)$')"


def _target(spark: SparkSession, folder: str) -> DataFrame:
    """What was published before: two thirds of the files, a fifth of them changed since, and some that are gone."""
    changed = F.when(F.col("doc_id") % 5 == 0, F.md5(F.concat("digest", F.lit("old")))).otherwise(F.col("digest"))
    files = _files(spark, folder).where("doc_id % 3 <> 0").withColumn("digest", changed)
    return files.withColumn("path", F.when(F.col("doc_id") % 17 == 0, F.concat("path", F.lit(".old"))).otherwise(F.col("path")))


_TARGET = f"(SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN path || '.old' ELSE path END AS path, CASE WHEN doc_id % 5 = 0 THEN md5(digest || 'old') ELSE digest END AS digest FROM {_FILES} WHERE doc_id % 3 <> 0)"


def publish_diff(spark: SparkSession, folder: str) -> DataFrame:
    return P.difference(_files(spark, folder), _target(spark, folder))


DIFF = f"""
SELECT path, CASE WHEN o.digest IS NULL THEN 'add' WHEN n.digest IS NULL THEN 'kept' WHEN o.digest = n.digest THEN 'unchanged' ELSE 'conflict' END AS change FROM (SELECT path, digest FROM {_FILES}) n FULL JOIN (SELECT path, digest FROM {_TARGET}) o USING (path)
"""


def publish_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Sources whose publication stops, and the first path at which it differs."""
    both = P.difference(_files(spark, folder), _target(spark, folder)).where("change = 'conflict'")
    return both.groupBy(F.substring_index("path", "/", 1).alias("source")).agg(F.count("*").alias("conflicts"), F.min("path").alias("first"))


COLLISIONS = f"""
SELECT string_split(path, '/')[1] AS source, count(*)::BIGINT AS conflicts, min(path) AS first FROM (SELECT path, digest FROM {_FILES}) n JOIN (SELECT path, digest FROM {_TARGET}) o USING (path) WHERE o.digest <> n.digest GROUP BY 1
"""


def vanished_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files known from before that are not there any more."""
    return _target(spark, folder).join(_files(spark, folder).select("path"), "path", "left_anti").select("doc_id", "path")


VANISHED = f"SELECT doc_id, path FROM {_TARGET} WHERE path NOT IN (SELECT path FROM {_FILES})"


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder).select(P.catalog_id(F.col("source"), F.col("path"), F.col("doc_id") % 1000, F.col("n_chars")).alias("id"), "doc_id", F.regexp_extract("path", r"^([^/]+/[^/]+)/", 1).alias("batch"))


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    return _catalog(spark, folder)


CATALOG = f"SELECT left(sha256(concat_ws(':', source, path, (doc_id % 1000)::VARCHAR, n_chars::VARCHAR)), 32) AS id, doc_id, regexp_extract(path, '^([^/]+/[^/]+)/', 1) AS batch FROM {_FILES}"


def catalog_entry(spark: SparkSession, folder: str) -> DataFrame:
    """The entry of one name."""
    wanted = _files(spark, folder).agg(F.min(P.catalog_id(F.col("source"), F.col("path"), F.col("doc_id") % 1000, F.col("n_chars"))).alias("id"))
    return _catalog(spark, folder).join(F.broadcast(wanted), "id")


ENTRY = f"SELECT * FROM ({CATALOG}) WHERE id = (SELECT min(id) FROM ({CATALOG}))"


def export_plan(spark: SparkSession, folder: str) -> DataFrame:
    files = _files(spark, folder).withColumn("target", F.concat("source", F.lit("/"), F.col("doc_id") % 200))
    return P.export_plan(files.withColumn("digest", F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(F.col("digest"))))


EXPORT = f"""
WITH f AS (SELECT path, source || '/' || (doc_id % 200) AS target, CASE WHEN doc_id % 3 = 0 THEN source ELSE digest END AS digest FROM {_FILES}),
g AS (SELECT target, count(DISTINCT digest) AS contents, min(path) AS first FROM f GROUP BY target)
SELECT path, target, CASE WHEN contents > 1 THEN 'conflict' WHEN path = first THEN 'move' ELSE 'drop' END AS action FROM f JOIN g USING (target)
"""


def batch_digest(spark: SparkSession, folder: str) -> DataFrame:
    return P.digests(_files(spark, folder), "source")


DIGESTS = f"SELECT source, count(*)::BIGINT AS files, sha256(string_agg(length(path) || ':' || path || digest, chr(10) ORDER BY path)) AS digest FROM {_FILES} GROUP BY source"


def natural_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _files(spark, folder).select("path", P.natural_key(F.col("path")).alias("key"))


NATURAL = f"""
SELECT path, array_to_string(list_transform(regexp_extract_all(lower(path), '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(ltrim(x, '0'), 12, '0') ELSE x END), '') AS key FROM {_FILES}
"""


def text_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Digests by which texts, cells and requests are told apart."""
    docs = R.frame(spark, folder, "SELECT doc_id, source, lang, n_chars, text FROM {documents}")
    cell = F.left(F.sha2(F.concat_ws("|", "doc_id", "source", "lang", "text"), 256), F.lit(16))
    request = F.left(F.sha2(F.to_json(F.struct("lang", "n_chars", "source")), 256), F.lit(20))
    return docs.select("doc_id", F.sha2("text", 256).alias("text_sha256"), cell.alias("cell"), request.alias("request"))


TEXT_DIGESTS = """
SELECT doc_id, sha256(text) AS text_sha256, left(sha256(concat_ws('|', doc_id::VARCHAR, source, lang, text)), 16) AS cell,
       left(sha256('{"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}'), 20) AS request FROM documents
"""

QUERIES = {
    "safe_paths": (safe_paths, SAFE),
    "path_prefix": (path_prefix, PREFIX),
    "publish_files": (publish_files, PUBLISH_FILES),
    "publish_diff": (publish_diff, DIFF),
    "publish_collisions": (publish_collisions, COLLISIONS),
    "vanished_files": (vanished_files, VANISHED),
    "catalog": (catalog, CATALOG),
    "catalog_entry": (catalog_entry, ENTRY),
    "export_plan": (export_plan, EXPORT),
    "batch_digest": (batch_digest, DIGESTS),
    "natural_keys": (natural_keys, NATURAL),
    "text_digests": (text_digests, TEXT_DIGESTS),
}
