"""Pages and lines of marked-up text.

A page ends with a comment line ``% ..._PAGE_COMPLETED: n/N``; a page that was not
recognised holds ``% ..._RECOGNITION_FALLBACK``. Everything here is a column of the
text itself, so no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.columns import let

_MARK = r"(?m)^[ \t]*%[ \t]*[A-Z]*_?PAGE_COMPLETED:[ \t]*(\d+)[ \t]*/[ \t]*(\d+)"
_MARK_LINE = r"(?m)(^[ \t]*%[ \t]*[A-Z]*_?PAGE_COMPLETED:[ \t]*\d+[ \t]*/[ \t]*\d+[^\n]*\n)"
_CUT = "\x1e"
_FALLBACK = r"(?m)^\s*%\s*[A-Z]*_?RECOGNITION_FALLBACK\b"


def completed(text: Column) -> Column:
    """The page numbers of all markers, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(_MARK), F.lit(1)), lambda x: x.cast("int"))


def totals(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(_MARK), F.lit(2)), lambda x: x.cast("int"))


def last_checkpoint(text: Column) -> Column:
    """The last marker's page and total, or nulls."""
    return F.struct(F.try_element_at(completed(text), F.lit(-1)).alias("page"), F.try_element_at(totals(text), F.lit(-1)).alias("total"))


def has_fallback(text: Column) -> Column:
    return text.rlike(_FALLBACK)


def valid_publication(text: Column) -> Column:
    """Whole document without a fallback mark anywhere, in a comment or not."""
    return text.contains(r"\begin{document}") & text.contains(r"\end{document}") & ~text.rlike(r"RECOGNITION_FALLBACK")


def split_pages(text: Column) -> Column:
    """The pages as ``array<struct<page, total, text, first_line, last_line>>``.

    Text after the last marker belongs to the last page; text without markers is page 1 of 1.
    """
    def closed(parts: Column) -> Column:
        n = F.size(parts)
        tail = F.element_at(parts, -1)
        return F.when((n < 2) | tail.rlike(_MARK), parts).otherwise(F.concat(F.slice(parts, 1, F.greatest(n - 2, F.lit(0))), F.array(F.concat(F.try_element_at(parts, n - 1), tail))))

    parts = F.filter(F.split(F.regexp_replace(F.replace(text, F.lit(_CUT), F.lit(" ")), _MARK_LINE, f"$1{_CUT}"), _CUT, -1), lambda x: x != "")
    whole = let(F.when(F.size(parts) == 0, F.array(F.lit(""))).otherwise(parts), closed)

    def describe(chunk: Column) -> Column:
        found = chunk.rlike(_MARK)
        lines = F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + F.when(chunk.endswith("\n"), 0).otherwise(1)
        return F.struct(
            F.when(found, F.regexp_extract(chunk, _MARK, 1).cast("int")).otherwise(1).alias("page"),
            F.when(found, F.regexp_extract(chunk, _MARK, 2).cast("int")).otherwise(1).alias("total"),
            chunk.alias("text"),
            lines.alias("lines"),
        )

    described = F.transform(whole, describe)
    start = F.struct(F.lit(0).alias("line"), F.array().cast("array<struct<page:int,total:int,text:string,first_line:int,last_line:int>>").alias("out"))
    return F.aggregate(
        described,
        start,
        lambda at, p: F.struct(
            (at["line"] + F.greatest(p["lines"], F.lit(1))).alias("line"),
            F.array_append(at["out"], F.struct(p["page"].alias("page"), p["total"].alias("total"), p["text"].alias("text"), (at["line"] + 1).alias("first_line"), (at["line"] + F.greatest(p["lines"], F.lit(1))).alias("last_line"))).alias("out"),
        ),
        lambda at: at["out"],
    )


def group_pages(pages: Column, size: int) -> Column:
    """Batches of consecutive pages: first and last page, total, text."""
    size = max(1, size)

    def batch(group: Column) -> Column:
        last = F.element_at(group, -1)
        return F.struct(F.element_at(group, 1)["page"].alias("first"), last["page"].alias("last"), last["total"].alias("total"), F.array_join(F.transform(group, lambda p: p["text"]), "").alias("text"))

    def batches(all_pages: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(all_pages) - 1, F.lit(0)), F.lit(size)), lambda at: at < F.size(all_pages))
        return F.transform(F.transform(starts, lambda at: F.slice(all_pages, at + 1, F.lit(size))), batch)

    return let(pages, batches)


def page_of_lines(text: Column, start: int = 1) -> Column:
    """The page of every line: that of the next marker at or after it, else the last marker's page and one; ``start`` without markers."""
    lines = F.split(text, "\n", -1)
    last = F.coalesce(F.try_element_at(completed(text), F.lit(-1)) + 1, F.lit(start))
    found = F.transform(lines, lambda x, at: F.when(x.rlike(_MARK), F.struct(at.alias("at"), F.regexp_extract(x, _MARK, 1).cast("int").alias("page"))))

    def through(marks: Column) -> Column:
        """Each mark's page once for every line since the mark before, then the page of the lines behind the last one."""
        until = F.transform(marks, lambda m, k: F.array_repeat(m["page"], m["at"] - F.coalesce(F.get(marks, k - 1)["at"], F.lit(-1))))
        behind = F.size(lines) - 1 - F.coalesce(F.try_element_at(marks, F.lit(-1))["at"], F.lit(-1))
        return F.concat(F.flatten(until), F.array_repeat(last, behind))

    return let(F.filter(found, lambda m: m.isNotNull()), through)


def acceptance(found: Column, expected: Column) -> Column:
    """Missing, repeated and unexpected pages, and whether they are exactly 1 to ``expected`` in order."""
    wanted = F.when(expected > 0, F.sequence(F.lit(1), expected)).otherwise(F.array().cast("array<int>"))
    repeated = F.array_sort(F.array_distinct(F.filter(found, lambda p: F.size(F.filter(found, lambda q: q == p)) > 1)))
    ordered = found == wanted
    return F.struct(F.array_except(wanted, found).alias("missing"), repeated.alias("repeated"), F.array_sort(F.array_except(found, wanted)).alias("unexpected"), ordered.alias("ordered"))


def hints(issues: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Issues with their page and its own line number: ``pages`` has one row a page with its line range."""
    span = F.col("line").between(F.col("first_line"), F.col("last_line"))
    return issues.join(pages, key).where(span).withColumn("local_line", F.col("line") - F.col("first_line") + 1)


def completed_prefix(text: Column) -> Column:
    """The text through the last marker's line; empty without one."""
    return F.regexp_extract(text, r"(?s)^(?:.*\n)?[ \t]*%[ \t]*[A-Z]*_?PAGE_COMPLETED:[^\n]*\n?", 0)
