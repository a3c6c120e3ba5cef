"""Names of tables and columns, labels and the sentences of reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as T


def table_name(hint: Column, label: Column, caption: Column, heading: Column, ordinal: Column) -> Column:
    """The first of hint, label, caption and heading that gives a name, else the table's number."""
    named = [F.when(F.btrim(c) != "", T.slug(c)) for c in (hint, label, caption, heading)]
    return F.coalesce(*[F.when((n != "field") & ~T.is_hashed_slug(n), n) for n in named], F.format_string("tab%02d", ordinal.cast("int")))


def positional_names(table: Column, row: Column, column: Column) -> Column:
    return F.format_string("%s_r%02d_c%02d", table, row.cast("int"), column.cast("int"))


def labelled(key: Column, labels: Mapping[str, str]) -> Column:
    """The label of a key, or the key with spaces."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), key)
    return F.coalesce(found, F.replace(key, F.lit("_"), F.lit(" ")))


def progress_text(stage: Column, done: Column, total: Column, unresolved: Column) -> Column:
    """What a stage's progress is, in words; unknown parts are left out."""
    return F.concat_ws(", ", stage, F.when(total > 0, F.format_string("%d of %d pages", done, total)), F.when(unresolved > 0, F.format_string("%d unresolved", unresolved)))


def mail_body(subject: Column, details: Column, log: Column, budget: int) -> Column:
    """An alert and the end of its log, without secrets, within a number of characters."""
    return F.left(F.concat_ws("\n\n", subject, details, T.redact_sensitive(T.last_chars(log, budget // 2))), F.lit(budget))


def request_payload(cells: DataFrame, key: str, order: list[str], rows: int) -> DataFrame:
    """One request a table: its headers and the first ``rows`` rows of values as JSON, by place."""
    first = cells.where(F.col("row") <= rows).groupBy(key, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "value"))), lambda x: x["value"]), " | ").alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"])
    return first.groupBy(key).agg(F.to_json(F.struct(lines.alias("rows"))).alias("payload"))
