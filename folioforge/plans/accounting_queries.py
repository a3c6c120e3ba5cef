"""Queries over calls, costs, completions and ledgers, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import accounting as A
from folioforge.plans import adapters as R



def _calls(spark: SparkSession, folder: str) -> DataFrame:
    return A.first_calls(R.frame(spark, folder, R.BILLING_CALL), "call_id", R.CALL_ORDER)


def _priced(spark: SparkSession, folder: str, threshold: int | None = A.THRESHOLD) -> DataFrame:
    return A.price_calls(_calls(spark, folder), A.price_book(spark), threshold)


_CALLS_SQL = f"SELECT * FROM {R.duck(R.BILLING_CALL)} QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY {', '.join(R.CALL_ORDER)}) = 1"
_RATES = ", ".join(f"max(CASE WHEN tier = '{t}' THEN {c} END) AS {t[0]}_{c}" for t in ("short", "long") for c in "icwo")
_AMOUNT = "((input_tokens - cached_input_tokens - cache_write_tokens) * {0}_i + cached_input_tokens * {0}_c + cache_write_tokens * {0}_w + output_tokens * {0}_o)"
_PRICED_SQL = f"""
SELECT c.*, b.s_i IS NOT NULL AND cached_input_tokens + cache_write_tokens <= input_tokens AS priced,
       {_AMOUNT.format('s')}::BIGINT AS short_e8, {_AMOUNT.format('l')}::BIGINT AS long_e8
FROM ({_CALLS_SQL}) c LEFT JOIN (SELECT model, {_RATES} FROM (VALUES {A.price_rows()}) AS p(model, tier, i, c, w, o) GROUP BY model) b USING (model)
"""


def _cost_sql(low: str, high: str, unresolved: str = "0") -> str:
    def total(x: str) -> str:
        return f"coalesce(sum(CASE WHEN priced THEN {x} END), 0)::BIGINT"

    return f"""count(*) FILTER (WHERE priced)::BIGINT AS priced_calls, count(*) FILTER (WHERE NOT priced)::BIGINT AS unpriced_calls,
       {unresolved}::BIGINT AS tier_unresolved_calls, count(*) FILTER (WHERE priced AND cache_usage_unreported)::BIGINT AS cache_usage_unreported_calls,
       {total('input_tokens - cached_input_tokens - cache_write_tokens')} AS ordinary_input_tokens, {total('cached_input_tokens')} AS cached_input_tokens,
       {total('cache_write_tokens')} AS cache_write_tokens, {total('output_tokens')} AS output_tokens, {total(low)} AS low_e8, {total(high)} AS high_e8"""


_TIER = f"CASE WHEN input_tokens > {A.THRESHOLD} THEN long_e8 ELSE short_e8 END"


def cost_by_model(spark: SparkSession, folder: str) -> DataFrame:
    return _priced(spark, folder).groupBy("model").agg(*A.cost_columns())


COST_BY_MODEL = f"SELECT model, {_cost_sql(_TIER, _TIER)} FROM ({_PRICED_SQL}) GROUP BY model"


def cost_range_no_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _priced(spark, folder, None).groupBy("doc_id").agg(*A.cost_columns(None)).withColumn("label", A.cost_label())


def _dollar_sql(x: str) -> str:
    units = f"(({x}) // 10000 + CASE WHEN ({x}) % 10000 > 5000 OR (({x}) % 10000 = 5000 AND ({x}) // 10000 % 2 = 1) THEN 1 ELSE 0 END)"
    return f"printf('$%d.%04d', {units} // 10000, {units} % 10000)"


def _span_sql(low: str, high: str) -> str:
    return f"CASE WHEN {low} = {high} THEN {_dollar_sql(low)} ELSE {_dollar_sql(low)} || ' - ' || {_dollar_sql(high)} END"


_LABEL = f"CASE WHEN priced_calls = 0 AND unpriced_calls > 0 THEN '未计价' ELSE {_span_sql('low_e8', 'high_e8')} || CASE WHEN unpriced_calls > 0 THEN '（部分）' ELSE '' END END"
COST_RANGE = f"""
SELECT *, {_LABEL} AS label FROM (
  SELECT doc_id, {_cost_sql('least(short_e8, long_e8)', 'greatest(short_e8, long_e8)', 'count(*) FILTER (WHERE priced)')} FROM ({_PRICED_SQL}) GROUP BY doc_id)
"""


def page_surcharge(spark: SparkSession, folder: str) -> DataFrame:
    costs = _priced(spark, folder).groupBy(F.col("doc_id").alias("id")).agg(*A.cost_columns())
    pages = R.frame(spark, folder, R.COMPLETION).select("id", "source_pages")
    return pages.join(costs, "id").select("id", "source_pages", A.cost_label(F.col("source_pages")).alias("label"))


_EXTRA = "source_pages * 3000000"
PAGE_SURCHARGE = f"""
SELECT id, source_pages, CASE WHEN priced_calls = 0 AND unpriced_calls > 0 THEN {_LABEL} || ' + ' || {_dollar_sql(_EXTRA)}
       ELSE {_LABEL} || ' + ' || {_dollar_sql(_EXTRA)} || ' = ' || {_span_sql('(low_e8 + ' + _EXTRA + ')', '(high_e8 + ' + _EXTRA + ')')} END AS label
FROM (SELECT id, source_pages FROM {R.duck(R.COMPLETION)}) JOIN (SELECT doc_id AS id, {_cost_sql(_TIER, _TIER)} FROM ({_PRICED_SQL}) GROUP BY doc_id) USING (id)
"""


def daily_cost_by_date(spark: SparkSession, folder: str) -> DataFrame:
    costs = _priced(spark, folder).groupBy("doc_id").agg(*A.cost_columns())
    return A.daily_rows(R.frame(spark, folder, R.COMPLETION), costs.select("doc_id", "priced_calls", "unpriced_calls", "low_e8"), "2001-08-01")


DAILY_COST = f"""
WITH c AS (SELECT * FROM {R.duck(R.COMPLETION)} a LEFT JOIN (SELECT doc_id AS id, {_cost_sql(_TIER, _TIER)} FROM ({_PRICED_SQL}) GROUP BY doc_id) b USING (id)),
d AS (SELECT day, count(*) AS completed, sum(source_pages) AS source_pages, sum(elapsed_seconds) AS elapsed_seconds, sum(priced_calls) AS priced_calls,
             sum(unpriced_calls) AS unpriced_calls, sum(low_e8) AS low_e8, count(*) FILTER (WHERE missing_logs) AS with_missing_logs,
             count(*) FILTER (WHERE elapsed_seconds IS NULL) AS with_unknown_elapsed FROM c GROUP BY day),
k AS (SELECT CAST(unnest(generate_series((SELECT min(day)::TIMESTAMP FROM c), (SELECT max(day)::TIMESTAMP FROM c), INTERVAL 1 DAY)) AS DATE) AS day)
SELECT k.day AS day, sum(coalesce(completed, 0))::BIGINT AS completed, sum(coalesce(source_pages, 0))::BIGINT AS source_pages,
       sum(coalesce(elapsed_seconds, 0))::DOUBLE AS elapsed_seconds, sum(coalesce(priced_calls, 0))::BIGINT AS priced_calls,
       sum(coalesce(unpriced_calls, 0))::BIGINT AS unpriced_calls, sum(coalesce(low_e8, 0))::BIGINT AS low_e8,
       sum(coalesce(with_missing_logs, 0))::BIGINT AS with_missing_logs, sum(coalesce(with_unknown_elapsed, 0))::BIGINT AS with_unknown_elapsed,
       grouping(k.day)::INT AS cumulative, coalesce(k.day = DATE '2001-08-01', false) AS provisional
FROM k LEFT JOIN d USING (day) GROUP BY ROLLUP (k.day)
"""

_TOKENS = ("input_tokens", "output_tokens")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return R.frame(spark, folder, R.CALL_EVENT)


def _totals_sql(keys: str) -> str:
    per = ", ".join(f"CASE WHEN count({t}) = count(*) THEN sum({t})::BIGINT END AS total_{t}, coalesce(sum({t}), 0)::BIGINT AS known_{t}, (count(*) - count({t}))::BIGINT AS missing_{t}" for t in _TOKENS)
    return f"""SELECT {keys + ',' if keys else ''} count(*)::BIGINT AS calls, round(sum(greatest(0, coalesce(seconds, 0))), 6) AS model_seconds,
       count(*) FILTER (WHERE attempt > 1)::BIGINT AS retries, count(*) FILTER (WHERE status = 'error')::BIGINT AS failed_calls, {per}
       FROM {R.duck(R.CALL_EVENT)} WHERE event = 'finish' {'GROUP BY ' + keys if keys else ''}"""


def call_summary_by_doc(spark: SparkSession, folder: str) -> DataFrame:
    return A.call_totals(_events(spark, folder), ["doc_id"], _TOKENS).withColumn("model_seconds", F.round("model_seconds", 6))


def token_totals_nullable(spark: SparkSession, folder: str) -> DataFrame:
    return A.call_totals(_events(spark, folder), ["stage"], _TOKENS).withColumn("model_seconds", F.round("model_seconds", 6))


def monitor_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of each document's log and its last stage."""
    return _events(spark, folder).groupBy("doc_id").agg(
        F.count_if(F.col("event") == "start").alias("starts"),
        F.count_if((F.col("event") == "finish") & (F.col("status") == "error")).alias("errors"),
        F.count_if((F.col("event") == "start") & (F.col("attempt") > 1)).alias("retries"),
        F.max_by("stage", "seq").alias("last_stage"),
    )


MONITOR_COUNTS = f"""
SELECT doc_id, count(*) FILTER (WHERE event = 'start')::BIGINT AS starts, count(*) FILTER (WHERE event = 'finish' AND status = 'error')::BIGINT AS errors,
       count(*) FILTER (WHERE event = 'start' AND attempt > 1)::BIGINT AS retries, max_by(stage, seq) AS last_stage FROM {R.duck(R.CALL_EVENT)} GROUP BY doc_id
"""


def unmatched_starts(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    return A.abandoned_starts(events, events.where("call_id % 27 = 4")).groupBy("doc_id").agg(F.count("*").alias("unmatched"), F.min("called_at").alias("first_at"))


UNMATCHED = f"""
WITH e AS (SELECT * FROM {R.duck(R.CALL_EVENT)})
SELECT doc_id, count(*)::BIGINT AS unmatched, min(called_at) AS first_at FROM e s WHERE event = 'start' AND s.call_id % 27 <> 4
  AND NOT EXISTS (SELECT 1 FROM e f WHERE f.event = 'finish' AND f.call_id = s.call_id) GROUP BY doc_id
"""


def accounted_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Finished calls that no completion was charged with, by stage."""
    events = _events(spark, folder).where("event = 'finish'")
    charged = R.frame(spark, folder, R.COMPLETION).where("source_pages % 2 = 0").select(F.col("id").alias("call_id"))
    return events.join(charged, "call_id", "left_anti").groupBy("stage").agg(F.count("*").alias("calls"))


ACCOUNTED = f"SELECT stage, count(*)::BIGINT AS calls FROM {R.duck(R.CALL_EVENT)} e WHERE event = 'finish' AND NOT EXISTS (SELECT 1 FROM {R.duck(R.COMPLETION)} c WHERE c.id = e.call_id AND source_pages % 2 = 0) GROUP BY stage"


def last_completed_per_source(spark: SparkSession, folder: str) -> DataFrame:
    jobs = R.frame(spark, folder, R.PIPELINE_JOB).where("stage = 'optimise' AND status = 'completed'")
    return A.last_per(jobs, ["source"], [F.desc("updated_at"), F.desc("id")]).select("source", "id", "updated_at")


LAST_COMPLETED = f"SELECT source, id, updated_at FROM {R.duck(R.PIPELINE_JOB)} WHERE stage = 'optimise' AND status = 'completed' QUALIFY row_number() OVER (PARTITION BY source ORDER BY updated_at DESC, id DESC) = 1"


def stage_latest(spark: SparkSession, folder: str) -> DataFrame:
    jobs = R.frame(spark, folder, R.PIPELINE_JOB)
    return A.last_per(jobs, ["source", "stage"], [F.desc("updated_at"), F.desc("id")]).select("source", "stage", "id", "status")


STAGE_LATEST = f"SELECT source, stage, id, status FROM {R.duck(R.PIPELINE_JOB)} QUALIFY row_number() OVER (PARTITION BY source, stage ORDER BY updated_at DESC, id DESC) = 1"


def first_stage(spark: SparkSession, folder: str) -> DataFrame:
    """The stage of each source's newest job, or pending for sources without jobs."""
    jobs = R.frame(spark, folder, R.PIPELINE_JOB).groupBy("source").agg(F.max_by("stage", F.struct("updated_at", "id")).alias("stage"))
    customers = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_custkey").alias("source"))
    return customers.join(jobs, "source", "left").select("source", F.coalesce("stage", F.lit("pending")).alias("stage"))


FIRST_STAGE = f"""
SELECT c_custkey AS source, coalesce(stage, 'pending') AS stage FROM customer
LEFT JOIN (SELECT source, stage FROM {R.duck(R.PIPELINE_JOB)} QUALIFY row_number() OVER (PARTITION BY source ORDER BY updated_at DESC, id DESC) = 1) j ON c_custkey = source
"""


def previous_completion(spark: SparkSession, folder: str) -> DataFrame:
    return A.previous_completion(R.frame(spark, folder, R.COMPLETION)).select("id", "source", "completed_at", "previous_at", (F.col("completed_at") > F.coalesce("previous_at", F.lit("1970-01-01").cast("timestamp"))).alias("advances"))


PREVIOUS = f"""
SELECT *, completed_at > coalesce(previous_at, TIMESTAMP '1970-01-01') AS advances FROM (
  SELECT id, source, completed_at, max(completed_at) OVER (PARTITION BY source ORDER BY completed_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_at FROM {R.duck(R.COMPLETION)})
"""


def ledger_merge_cutover(spark: SparkSession, folder: str) -> DataFrame:
    """Two ledgers that overlap for two years, together of every order, cut over in between."""
    rows = R.frame(spark, folder, R.COMPLETION).select("id", "day", "completed_at")
    local, remote = rows.where("day < DATE '1999-01-01'").withColumn("origin", F.lit("local")), rows.where("day >= DATE '1997-01-01'").withColumn("origin", F.lit("remote"))
    return A.merge_ledgers(local, remote, "1998-06-01")


LEDGER_MERGE = f"SELECT id, day, completed_at, CASE WHEN day < DATE '1998-06-01' THEN 'local' ELSE 'remote' END AS origin FROM {R.duck(R.COMPLETION)}"


def ledger_merge_all(spark: SparkSession, folder: str) -> DataFrame:
    """Two ledgers that each hold every order, split by the cutover day alone."""
    rows = R.frame(spark, folder, R.COMPLETION).select("id", "day", "completed_at")
    return A.merge_ledgers(rows.withColumn("origin", F.lit("local")), rows.withColumn("origin", F.lit("remote")), "1998-06-01")


LEDGER_MERGE_ALL = f"SELECT id, day, completed_at, CASE WHEN day < DATE '1998-06-01' THEN 'local' ELSE 'remote' END AS origin FROM {R.duck(R.COMPLETION)} WHERE day IS NOT NULL"
_BAD_ROWS = "VALUES (-1, DATE '1999-01-01'), (-1, DATE '1999-01-02'), (NULL, DATE '1999-01-03'), (-2, NULL)"


def ledger_validate(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, R.COMPLETION).select("id", "day")
    return A.ledger_faults(rows.unionByName(spark.sql(f"SELECT CAST(id AS BIGINT) id, day FROM {_BAD_ROWS} AS t(id, day)")))


LEDGER_VALIDATE = f"""
WITH l AS (SELECT id, day FROM {R.duck(R.COMPLETION)} UNION ALL SELECT id::BIGINT, day FROM ({_BAD_ROWS}) AS t(id, day))
SELECT id, 'duplicate id' AS fault, count(*)::BIGINT AS n FROM l WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, 'missing id or day', count(*)::BIGINT FROM l WHERE id IS NULL OR day IS NULL GROUP BY id
"""


def published_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Published documents that the ledger doesn't hold."""
    published = spark.read.parquet(f"{folder}/lineitem.parquet").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("id")).distinct()
    return published.join(R.frame(spark, folder, R.COMPLETION).where("source_pages > 45").select("id"), "id", "left_anti")


PUBLISHED = f"SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT id FROM {R.duck(R.COMPLETION)} WHERE source_pages > 45)"


def web_daily_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.frame(spark, folder, R.COMPLETION)
    return rows.groupBy("day").agg(F.count("*").alias("converted"), F.count_if(F.col("elapsed_seconds").isNotNull()).alias("compiled"), F.sum("source_pages").alias("pages"), F.count_if("missing_logs").alias("unreported"))


WEB_DAILY = f"SELECT day, count(*)::BIGINT AS converted, count(elapsed_seconds)::BIGINT AS compiled, sum(source_pages)::BIGINT AS pages, count(*) FILTER (WHERE missing_logs)::BIGINT AS unreported FROM {R.duck(R.COMPLETION)} GROUP BY day"


def duration_text(spark: SparkSession, folder: str) -> DataFrame:
    s = F.bround("elapsed_seconds").cast("long")
    text = F.coalesce(F.format_string("%d时%02d分%02d秒", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60), F.lit("未知"))
    return R.frame(spark, folder, R.COMPLETION).select("id", F.when(F.col("elapsed_seconds").isNull(), "未知").otherwise(text).alias("elapsed"))


DURATION = f"SELECT id, CASE WHEN elapsed_seconds IS NULL THEN '未知' ELSE printf('%d时%02d分%02d秒', s // 3600, s % 3600 // 60, s % 60) END AS elapsed FROM (SELECT id, elapsed_seconds, round_even(elapsed_seconds, 0)::BIGINT AS s FROM {R.duck(R.COMPLETION)})"

QUERIES = {
    "daily_cost_by_date": (daily_cost_by_date, DAILY_COST),
    "cost_by_model": (cost_by_model, COST_BY_MODEL),
    "cost_range_no_threshold": (cost_range_no_threshold, COST_RANGE),
    "page_surcharge": (page_surcharge, PAGE_SURCHARGE),
    "call_summary_by_doc": (call_summary_by_doc, _totals_sql("doc_id")),
    "token_totals_nullable": (token_totals_nullable, _totals_sql("stage")),
    "monitor_counts": (monitor_counts, MONITOR_COUNTS),
    "unmatched_starts": (unmatched_starts, UNMATCHED),
    "accounted_anti": (accounted_anti, ACCOUNTED),
    "last_completed_per_source": (last_completed_per_source, LAST_COMPLETED),
    "stage_latest": (stage_latest, STAGE_LATEST),
    "first_stage": (first_stage, FIRST_STAGE),
    "previous_completion": (previous_completion, PREVIOUS),
    "ledger_merge_cutover": (ledger_merge_cutover, LEDGER_MERGE),
    "ledger_merge_all": (ledger_merge_all, LEDGER_MERGE_ALL),
    "ledger_validate": (ledger_validate, LEDGER_VALIDATE),
    "published_anti": (published_anti, PUBLISHED),
    "web_daily_rollup": (web_daily_rollup, WEB_DAILY),
    "duration_text": (duration_text, DURATION),
}
