"""Queries over texts, each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.session import table


def redacted(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that show a secret, before and after it is hidden."""
    pages = table(spark, folder, "pages").select("page_id", F.concat(F.lit("Authorization: Bearer abc.def "), "url", F.lit(" sk-12345678zz")).alias("log"))
    return pages.select("page_id", T.redact_sensitive(F.col("log")).alias("hidden"), T.redact(F.col("log"), ["12345678"]).alias("known"))


REDACTED = "SELECT page_id, 'Authorization: Bearer [REDACTED] ' || url || ' [REDACTED]' AS hidden, 'Authorization: Bearer [REDACTED] ' || url || ' sk-[REDACTED]zz' AS known FROM pages"


def library_search(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return parts.where(F.contains(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")), F.lit("brand#1"))).select("p_partkey", "p_name")


LIBRARY = "SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'brand#1')"


def slug_names(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", F.concat_ws(" / ", "p_name", "p_type").alias("name"))
    return parts.select("p_partkey", T.slug(F.col("name")).alias("slug"))


SLUGS = """
SELECT p_partkey, CASE WHEN s = '' THEN 'field' ELSE s END AS slug FROM (
  SELECT p_partkey, regexp_replace(substr(lower(regexp_replace(regexp_replace(p_name || ' / ' || p_type, '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), 1, 40), '_+$', '') AS s FROM part)
"""


def log_tail(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.md5(T.last_lines(F.col("text"), 3, 400)).alias("tail_md5"))


LOG_TAIL = """
SELECT doc_id, md5(right(array_to_string(parts[greatest(len(parts) - 2, 1):], chr(10)), 400)) AS tail_md5
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
"""


def plain_words(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's whole text, after some markup, as visible words."""
    marked = F.concat(F.lit(r"\textbf{Lead} \emph{in} $x_1$ & "), "text")
    plain = T.tex_to_plain(marked)
    return table(spark, folder, "documents").select("doc_id", F.length(plain).alias("chars"), F.md5(plain).alias("plain_md5"))


_WIDE = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_PLAIN = rf"""
SELECT doc_id, length(p)::INT AS chars, md5(p) AS plain_md5 FROM (
  SELECT doc_id, trim(regexp_replace(translate(regexp_replace(@TEXT@, '{T.MACRO}', ' ', 'g'), '{T.MARKS}', repeat(' ', {len(T.MARKS)})), '{_WIDE}', ' ', 'g'), ' ') AS p FROM documents)
"""
PLAIN = _PLAIN.replace("@TEXT@", "'Lead in x 1 ' || text")
PLAIN_TEXTS = _PLAIN.replace("@TEXT@", "text")


def plain_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's whole text as visible words."""
    plain = T.tex_to_plain(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.length(plain).alias("chars"), F.md5(plain).alias("plain_md5"))


#: What each rule finds, written around whole documents, and what it makes of it.
_BEFORE = r"x\nB A37\\2605 \handwritten{10^3} y\中\\文 "
_AFTER = "\n  \\%  #VALUE_ID: v\n  \\newline  \nend"


def rules_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The built rules over every whole document with markup around it: its digest after them, and the finds of each rule."""
    result, finds = T.normalize(F.concat(F.lit(_BEFORE), "text", F.lit(_AFTER)))
    return table(spark, folder, "documents").select("doc_id", F.md5(result).alias("result_md5"), *[finds[name].alias(name) for name, _, _ in T.REGEX_RULES])


RULES_TEXTS = r"""
SELECT doc_id, md5('x' || chr(10) || 'B A37\textbackslash{}2605 \handwritten{10\textsuperscript{3}} y\textbackslash{}中\textbackslash{}文 ' || text || chr(10) || '  % #VALUE_ID: v' || chr(10) || '\par' || chr(10) || 'end') AS result_md5,
       1 AS literal_newlines, 1 AS numeric_backslashes, 1 AS raw_superscripts, 1 AS metadata_comments, 2 AS cjk_backslashes, 1 AS standalone_newlines FROM documents
"""

QUERIES = {
    "redact": (redacted, REDACTED),
    "library_search": (library_search, LIBRARY),
    "slug_names": (slug_names, SLUGS),
    "log_tail": (log_tail, LOG_TAIL),
    "plain_words": (plain_words, PLAIN),
    "plain_texts": (plain_texts, PLAIN_TEXTS),
    "rules_texts": (rules_texts, RULES_TEXTS),
}
