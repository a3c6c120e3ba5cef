"""Views of jobs, logs, texts and publications, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import hierarchy as H
from folioforge.operators import pages as G
from folioforge.operators import views as W
from folioforge.operators.order import natural, ranked
from folioforge.plans import adapters as R
from folioforge.session import new_folder

_JOBS = R.duck(R.PIPELINE_JOB)


def jobs_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """All jobs with their place in the queue."""
    return ranked(R.frame(spark, folder, R.PIPELINE_JOB).select("id", "position", "status"), [F.col("position"), F.col("id")])


IN_ORDER = f"SELECT id, position, status, row_number() OVER (ORDER BY position, id) AS rank FROM {_JOBS}"


def frontend_recent(spark: SparkSession, folder: str) -> DataFrame:
    """The eight newest jobs."""
    return R.frame(spark, folder, R.PIPELINE_JOB).select("id", "stage", "status").orderBy(F.desc("id"), "stage").limit(8)


FRONTEND = f"SELECT id, stage, status FROM {_JOBS} ORDER BY id DESC, stage LIMIT 8"


def frontend_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs that wait for another try, and the sources that any of them has."""
    rows = R.frame(spark, folder, R.PIPELINE_JOB).where("status = 'retry'")
    return rows.groupBy("source").agg(F.count("*").alias("waiting"))


FRONTEND_PAGES = f"SELECT source, count(*)::BIGINT AS waiting FROM {_JOBS} WHERE status = 'retry' GROUP BY source"


def batch_labels(spark: SparkSession, folder: str) -> DataFrame:
    return R.frame(spark, folder, "SELECT coalesce(nullif(lang, 'en'), 'none') AS label FROM {documents}").distinct()


BATCH_LABELS = "SELECT DISTINCT coalesce(nullif(lang, 'en'), 'none') AS label FROM documents"
BATCHES = "SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('2024-0', CAST(c_custkey % 9 + 1 AS STRING)) END AS month, CAST(c_custkey % 50 AS INT) AS sequence, c_name AS code FROM {customer}"


def batches_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Batches, newest month first; those without one last."""
    return ranked(R.frame(spark, folder, BATCHES), [F.coalesce("month", F.lit("")).desc(), F.desc("sequence"), F.desc("code")])


BATCH_ORDER = f"SELECT *, row_number() OVER (ORDER BY coalesce(month, '') DESC, sequence DESC, code DESC) AS rank FROM {R.duck(BATCHES)}"

#: Names that differ in case, accents and numbers.
NAMES = "SELECT p_partkey, concat(CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN replace(p_type, 'E', 'É') ELSE p_type END, ' ', p_size, CASE WHEN p_partkey % 2 = 0 THEN ' x0' ELSE ' X' END, p_partkey) AS name FROM {part}"


def natural_order(spark: SparkSession, folder: str) -> DataFrame:
    """Parts by their names as a reader orders them."""
    return ranked(R.frame(spark, folder, NAMES), [natural(F.col("name")), F.col("p_partkey")])


NATURAL_ORDER = f"""
SELECT p_partkey, name, row_number() OVER (ORDER BY array_to_string(list_transform(regexp_extract_all(lower(strip_accents(name)), '[0-9]+|[^0-9]+'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(ltrim(x, '0'), 20, '0') ELSE x END), ''), p_partkey) AS rank FROM {R.duck(NAMES)}
"""
_KEYS = ("date", "batch_date", "valid_until", "dates", "update", "time_of_day", "shift_time", "effective_until", "x_validity", "name")


def temporal_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by the kind of key that their part's number stands for."""
    keys = F.element_at(F.array(*map(F.lit, _KEYS)), (F.col("l_partkey") % len(_KEYS) + 1).cast("int"))
    rows = R.frame(spark, folder, "SELECT l_partkey FROM {lineitem}").select(keys.alias("key"))
    return rows.groupBy("key", H.temporal_field(F.col("key")).alias("temporal")).agg(F.count("*").alias("n"))


TEMPORAL_KEYS = f"""
SELECT key, key IN ('date', 'time', 'datetime', 'valid_until', 'effective_until', 'validity') OR regexp_matches(key, '_(date|time|datetime|valid_until|validity)$') AS temporal, count(*)::BIGINT AS n
FROM (SELECT ({list(_KEYS)})[l_partkey % {len(_KEYS)} + 1] AS key FROM lineitem) GROUP BY 1, 2
"""


def redact_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with secrets written around them, which are hidden again."""
    docs = R.frame(spark, folder, "SELECT doc_id, text FROM {documents}")
    log = F.concat(F.lit("authorization =  BEARER t"), "doc_id", F.lit(",sk-short x.olp_12345678"), "doc_id", F.lit(" "), "text", F.lit(" a bearer 'no' bearer "), "doc_id", F.lit("'s"))
    return docs.select("doc_id", F.md5(T.redact(T.redact_sensitive(log))).alias("hidden_md5"))


REDACT_TEXTS = f"""
SELECT doc_id, md5('authorization =  BEARER {T.HIDDEN} x.{T.HIDDEN} ' || text || ' a bearer ''no'' bearer {T.HIDDEN}''s') AS hidden_md5 FROM documents
"""


def fenced_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in fences of several kinds, taken out again, and as a cell of a Markdown table."""
    docs = R.frame(spark, folder, "SELECT doc_id, trim(text) AS text FROM {documents}")
    fenced = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("```latex\n"), "text", F.lit("\n```"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("  ```\n"), "text", F.lit("```"))).otherwise(F.col("text"))
    return docs.select("doc_id", F.md5(T.code_fence_removed(fenced)).alias("text_md5"), F.md5(T.markdown_cell(F.col("text"))).alias("cell_md5"))


FENCED = "SELECT doc_id, md5(t) AS text_md5, md5(replace(replace(t, '|', '\\|'), chr(10), ' ')) AS cell_md5 FROM (SELECT doc_id, trim(text) AS t FROM documents)"


def valid_publications(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the begin or end of a document, or a mark of a page that was not recognised, put around some."""
    parts = [F.when(F.col("doc_id") % 5 != 0, r"\begin{document}").otherwise(""), F.col("text"), F.when(F.col("doc_id") % 7 == 0, "% RECOGNITION_FALLBACK").otherwise(""), F.when(F.col("doc_id") % 11 != 0, r"\end{document}").otherwise("")]
    docs = R.frame(spark, folder, "SELECT doc_id, text FROM {documents}")
    return docs.select("doc_id", G.valid_publication(F.concat_ws("\n", *parts)).alias("valid"))


VALID = "SELECT doc_id, doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS valid FROM documents"


def display_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in which commas and periods stand for glyphs that fonts lack."""
    docs = R.frame(spark, folder, "SELECT doc_id, translate(text, ',.;', '≥µ×') AS text FROM {documents}")
    return docs.select("doc_id", F.md5(W.symbols_shown(F.col("text"))).alias("shown_md5"))


DISPLAY = r"SELECT doc_id, md5(replace(replace(replace(translate(text, ',.;', '≥µ×'), '≥', '\ensuremath{\geq}'), '×', '\ensuremath{\times}'), 'µ', '\ensuremath{\mu}')) AS shown_md5 FROM documents"


def service_pauses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose log has an error beyond the place that was read before, and the first of these."""
    rows = R.frame(spark, folder, R.CALL_EVENT).where("status = 'error' AND seq > doc_id * 50")
    return rows.groupBy("doc_id").agg(F.min("seq").alias("first"), F.count("*").alias("pauses"))


PAUSES = f"SELECT doc_id, min(seq) AS first, count(*)::BIGINT AS pauses FROM {R.duck(R.CALL_EVENT)} WHERE status = 'error' AND seq > doc_id * 50 GROUP BY doc_id"


def ledger_contains(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of documents of which a ledger has a pushed row with the same digest."""
    docs = R.frame(spark, folder, "SELECT doc_id, source AS unit, lang AS batch, md5(text) AS digest FROM {documents}")
    ledger = docs.where("doc_id % 3 = 0").select("unit", "batch", "digest", F.when(F.col("doc_id") % 2 == 0, "pushed").otherwise("failed").alias("status"))
    return W.published(docs, ledger, ["unit", "batch", "digest"]).groupBy("unit").agg(F.count_if("published").alias("published"), F.count_if(~F.col("published")).alias("open"))


CONTAINS = """
WITH d AS (SELECT doc_id, source AS unit, lang AS batch, md5(text) AS digest FROM documents), p AS (SELECT DISTINCT unit, batch, digest FROM d WHERE doc_id % 6 = 0)
SELECT d.unit, count(p.unit)::BIGINT AS published, (count(*) - count(p.unit))::BIGINT AS open FROM d LEFT JOIN p USING (unit, batch, digest) GROUP BY d.unit
"""


def completed_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' orders as queues of jobs; those that are all done make their batches complete."""
    jobs = R.frame(spark, folder, "SELECT o_custkey % 400 AS queue, o_orderpriority AS unit, CAST(o_custkey AS STRING) AS batch, CASE WHEN o_totalprice < 470000 THEN 'done' ELSE 'failed' END AS status, CAST(o_orderdate AS TIMESTAMP) AS at FROM {orders}")
    queues = jobs.groupBy("queue").agg(F.collect_list(F.struct("unit", "batch", "status")).alias("jobs"), F.max("at").alias("finished_at"))
    return W.completed_batches(queues, F.lit("1998-07-15").cast("timestamp"))


COMPLETED = """
WITH j AS (SELECT o_custkey % 400 AS queue, o_orderpriority AS unit, CAST(o_custkey AS VARCHAR) AS batch, o_totalprice < 470000 AS done, CAST(o_orderdate AS TIMESTAMP) AS at_ FROM orders),
q AS (SELECT queue FROM j GROUP BY queue HAVING bool_and(done) AND max(at_) > TIMESTAMP '1998-07-15')
SELECT DISTINCT unit, batch FROM j WHERE queue IN (SELECT queue FROM q)
"""


def log_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The last line of each document's log and the progress that it tells."""
    line = F.when(F.col("seq") % 3 == 0, F.format_string("step [%d/9] running", F.col("seq") % 9)).when(F.col("seq") % 3 == 1, F.format_string("Page %d of 40 read", F.col("seq") % 40)).otherwise(F.col("stage"))
    last = R.frame(spark, folder, R.CALL_EVENT).groupBy("doc_id").agg(F.max_by(line, "seq").alias("line"))
    return last.select("doc_id", W.log_progress(F.col("line")).alias("progress"))


LOG_PROGRESS = f"""
SELECT doc_id, CASE seq % 3 WHEN 0 THEN printf('[%d/9]', seq % 9) WHEN 1 THEN printf('Page %d of 40', seq % 40) ELSE stage END AS progress FROM (SELECT doc_id, max(seq) AS seq, arg_max(stage, seq) AS stage FROM {R.duck(R.CALL_EVENT)} GROUP BY doc_id)
"""


def artifact_paths(spark: SparkSession, folder: str) -> DataFrame:
    docs = R.frame(spark, folder, "SELECT doc_id, concat(source, '/', lang, '/doc.', CAST(doc_id AS STRING), '.pdf') AS path FROM {documents}")
    return docs.select("doc_id", *[c.alias(name) for name, c in W.artifact_paths(F.col("path")).items()])


ARTIFACTS = "SELECT doc_id, source || '/' || lang || '/doc.' || doc_id || '.tex' AS tex, source || '/' || lang || '/fields/doc.' || doc_id || '.json' AS fields, source || '/' || lang || '/.state/doc.' || doc_id AS state FROM documents"


def recompile_sources(spark: SparkSession, folder: str) -> DataFrame:
    """What a job is compiled from again: its last artefact, or what was sent in."""
    rows = R.frame(spark, folder, R.PIPELINE_JOB)
    last = F.max_by("id", F.when(F.col("status") == "completed", F.struct("attempts", "id")))
    return rows.groupBy("source").agg(F.when(F.count_if(F.col("status") == "completed") > 0, last).alias("artifact"), F.count("*").alias("jobs")).withColumn("from", F.when(F.col("artifact").isNull(), "uploads").otherwise("artifact"))


RECOMPILE = f"""
SELECT source, arg_max(id, (attempts, id)) FILTER (WHERE status = 'completed') AS artifact, count(*)::BIGINT AS jobs, CASE WHEN bool_or(status = 'completed') THEN 'artifact' ELSE 'uploads' END AS "from" FROM {_JOBS} GROUP BY source
"""


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events appended to a log by two writers, counted from it."""
    path = new_folder(spark, "event-log")
    rows = R.frame(spark, folder, R.CALL_EVENT).select("call_id", "doc_id", "stage", "event")
    for event in ("start", "finish"):
        rows.where(F.col("event") == event).write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).groupBy("stage", "event").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents"))


EVENT_LOG = f"SELECT stage, event, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS documents FROM {R.duck(R.CALL_EVENT)} GROUP BY ALL"

QUERIES = {
    "jobs_in_order": (jobs_in_order, IN_ORDER),
    "frontend_recent": (frontend_recent, FRONTEND),
    "frontend_pages": (frontend_pages, FRONTEND_PAGES),
    "batch_labels": (batch_labels, BATCH_LABELS),
    "batches_in_order": (batches_in_order, BATCH_ORDER),
    "natural_order": (natural_order, NATURAL_ORDER),
    "temporal_keys": (temporal_keys, TEMPORAL_KEYS),
    "redact_texts": (redact_texts, REDACT_TEXTS),
    "fenced_texts": (fenced_texts, FENCED),
    "valid_publications": (valid_publications, VALID),
    "display_symbols": (display_symbols, DISPLAY),
    "service_pauses": (service_pauses, PAUSES),
    "ledger_contains": (ledger_contains, CONTAINS),
    "completed_batches": (completed_batches, COMPLETED),
    "log_progress": (log_progress, LOG_PROGRESS),
    "artifact_paths": (artifact_paths, ARTIFACTS),
    "recompile_sources": (recompile_sources, RECOMPILE),
    "event_log": (event_log, EVENT_LOG),
}
