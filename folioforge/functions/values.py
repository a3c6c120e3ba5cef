"""Times, sizes and JSON values as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The zone of the record's clocks, and the longest text and number that a sheet's cell holds: fixed values of the record format.
ZONE, OFFSET = "Asia/Shanghai", "+08:00"
CELL_CHARS, CELL_DIGITS = 32_767, 15


def stamp(at: Column) -> Column:
    """An instant as local ISO seconds with its offset."""
    return F.concat(F.date_format(F.from_utc_timestamp(at, ZONE), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(OFFSET))


def parse_stamp(text: Column) -> Column:
    """The instant of an ISO time; null without a zone, as a time without one is not an instant."""
    return F.when(text.rlike(r"(?:[zZ]|[+-]\d{2}:?\d{2})\z"), F.try_to_timestamp(text))


def epoch(at: Column) -> Column:
    return F.unix_micros(at) / 1e6


def elapsed(seconds: Column) -> Column:
    """Seconds, or minutes and seconds, or hours and minutes."""
    whole = F.floor(seconds).cast("long")
    hours, minutes = whole / 3600, whole % 3600 / 60
    return (
        F.when(seconds < 60, F.format_string("%ds", F.bround(seconds).cast("long")))
        .when(seconds < 3600, F.format_string("%dm %ds", F.floor(minutes), whole % 60))
        .otherwise(F.format_string("%dh %dm", F.floor(hours), F.floor(minutes)))
    )


def remaining(spent: Column, done: Column, total: Column) -> Column:
    """The time that the rest takes at the speed so far; null before the first or after the last step."""
    return F.when((done > 0) & (total > done), F.concat(F.lit("~"), elapsed(spent / done * (total - done)), F.lit(" remaining")))


def cell_problem(text: Column) -> Column:
    """Why a text can't be a cell of a sheet, or null."""
    return F.when(F.length(text) > CELL_CHARS, "long").when(text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"), "control")


def cell_kind(text: Column) -> Column:
    """How a value is kept in a cell: long whole numbers as text, others as numbers, and everything else as text."""
    whole = text.rlike(r"\A-?\d+\z")
    digits = F.length(F.regexp_replace(text, r"\A-?0*", ""))
    return F.when(whole & (digits > CELL_DIGITS), "text").when(whole, "integer").when(text.rlike(r"\A-?\d+\.\d+\z"), "number").otherwise("text")


def object_of(text: Column) -> Column:
    """A JSON object found in a text, between its first and last brace, as a variant; null if there is none or it can't be read."""
    found = F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")))
    return F.when(F.schema_of_variant(found).startswith("OBJECT"), found)


def count_of(value: Column, path: str) -> Column:
    """A whole number of 0 or more at a path of a variant, else null; truth values are not numbers."""
    found, number = F.try_variant_get(value, path, "variant"), F.try_variant_get(value, path, "long")
    return F.when((F.schema_of_variant(found) == "BIGINT") & (number >= 0), number)
