"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import audit, chunks, decontam, lines, mixing, neardup, quality, spelling, token_counts, tokens, toxicity, urls, vectors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grade(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components_of(_table(spark, sf_dir, "documents"), k=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.links_of(_table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(_table(spark, sf_dir, "documents"))


def op9_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.drop_repeated(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("_line_count").alias("n_lines"), F.col("_line_dropped").alias("n_dropped"), F.sha2("_line_text", 256).alias("kept_sha256"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.count_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", F.col("_token_bytes").alias("n_bytes"), F.col("_token_count").alias("n_tokens"), F.col("_token_over").alias("over_limit"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports the operators in turn

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (op1_token_ids, op2_quality, op3_decontamination, op4_near_duplicates, op5_toxicity, op6_near_vectors, op7_mixing, op8_repeated_passages, op9_repeated_lines, op10_url_filters, op11_token_counts, op12_filter_audit, op13_spelling_variants, pipeline)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS total FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (SELECT *, 2.0::DOUBLE * total AS cap, 2.0::DOUBLE * total / weight AS at_cap, 1.5::DOUBLE * sum(total) OVER () AS budget FROM w),
c AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY at_cap, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / sum(weight) OVER (ORDER BY at_cap, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM l),
t AS (SELECT source, total, least(cap, weight * (SELECT min_by(level, at_cap) FROM c WHERE level <= at_cap)) AS target FROM c),
p AS (SELECT d.doc_id, d.size, t.total, t.target,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS before,
             CASE WHEN t.total > 0 THEN CAST(floor(t.target / t.total) AS BIGINT) ELSE 0 END AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, total AS source_size, target,
       CAST(whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * total - before)) AS BIGINT) AS taken
FROM p
"""

OP9 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM d),
k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, s.keeper IS NOT NULL AND k.doc_id <> s.keeper AS lost FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE lost)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


OP12 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
c AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
g AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
          'C': 100 * (length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) > 3 * length(d.text),
          'D': regexp_matches(d.text, '[#$%&*|]'), 'E': coalesce(d.doc_id > c.least, false)} AS fails
  FROM d JOIN c ON d.text = c.text LEFT JOIN g ON d.doc_id = g.doc_id),
k AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
o AS (
  SELECT '' AS made UNION ALL
  SELECT made || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(made, x)),
p AS (SELECT made AS filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o WHERE length(made) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS x, filter_order[:step - 1] AS earlier FROM p),
t AS (
  SELECT part, filter_order, step, x, n, good, toxic,
         CASE x WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END AS fail,
         (contains(earlier, 'A') AND fails.A) OR (contains(earlier, 'B') AND fails.B) OR (contains(earlier, 'C') AND fails.C)
           OR (contains(earlier, 'D') AND fails.D) OR (contains(earlier, 'E') AND fails.E) AS gone,
         fails.A::INT + fails.B::INT + fails.C::INT + fails.D::INT + fails.E::INT AS failures
  FROM k, s),
r AS (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fail), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE fail AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE fail AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fail AND failures = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (WHERE fail AND NOT gone AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (WHERE fail AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM t GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_mixing": OP7, "op9_repeated_lines": OP9, "op12_filter_audit": OP12}
