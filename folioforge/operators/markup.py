"""Functions over marked-up text as columns: each text is scanned once, in Arrow batches, into rows."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import tex

_KINDS = {
    "issues": (tex.issues, "severity string, code string, line int"),
    "row_issues": (tex.row_issues, "severity string, code string, line int"),
    "fields": (None, "field_id string, label string, value string, page int, total int, line int, handwritten boolean, todo string, kind string, checked boolean"),
    "cells": (None, "table_no int, env string, columns int, row_no int, cell_no int, text string, span int"),
}


def _cells(text: str) -> list[tuple]:
    return [(n, t["env"], t["columns"], r, c, cell, span) for n, t in enumerate(tex.tables(text), 1) for r, row in enumerate(t["rows"], 1) for c, (cell, span) in enumerate(row, 1)]


def rows_of(docs: DataFrame, kind: str, key: str, text_col: str = "text") -> DataFrame:
    """Rows that ``kind`` finds in each text, with the document's ``key``; null texts give none."""
    found, fields = _KINDS[kind]
    found = found or _cells
    add = tex.add_fields if kind == "fields" else None
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {fields}"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        for batch in batches:
            arrow = arrow or pa.schema([batch.schema.field(0), *(pa.field(n, {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[f.split()[1]]) for n, f in zip(names, fields.split(", "), strict=True))])
            keys, rows, out = [], [], [[] for _ in names]
            for place, text in enumerate(batch.column(1).to_pylist()):
                if text is None:
                    continue
                if add:
                    keys += [place] * add(text, out)
                else:
                    told = found(text)
                    keys += [place] * len(told)
                    rows += told
            if rows:
                out = zip(*rows, strict=True)
            told = [pa.array(c, f.type) for c, f in zip(out, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), *told], schema=arrow)

    return docs.select(key, text_col).mapInArrow(run, schema)


#: What begins a run of raised or lowered digits and signs, by the Unicode decomposition of its characters.
_RAISED = {"<super>": "^", "<sub>": "_"}
_DIGITS = frozenset("0123456789+\u2212-")


def _normal(value: str | None) -> str | None:
    """A value for comparison: scripts written out, width and case ignored, no white space."""
    if value is None:
        return None
    out, now = [], ""
    for c in value:
        plain = unicodedata.normalize("NFKC", c)
        sign = _RAISED.get(unicodedata.decomposition(c).partition(" ")[0], "") if plain in _DIGITS else ""
        if sign != now:
            out.append(sign)
        now = sign
        out.append("^" if c == "\u02c6" else c if plain.isspace() else plain)
    whole = unicodedata.normalize("NFKC", "".join(out)).replace("\u2212", "-")
    return "".join(whole.split()).casefold()


_ESCAPED = {"\\": r"\textbackslash{}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"} | {c: "\\" + c for c in "&%$#_{}"}
_MATH = re.compile(r"(\$(?:\\.|[^$])*\$)")


def _escaped(value: str | None) -> str | None:
    """Math fragments stay as they are."""
    if value is None:
        return None
    return "".join(part if k % 2 else "".join(_ESCAPED.get(c, c) for c in part) for k, part in enumerate(_MATH.split(value)))


def _ascii(value: str | None) -> str | None:
    """Characters written in ASCII where Unicode decomposes them so, others left out."""
    return None if value is None else unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()


def _closed(value: str | None) -> str | None:
    return None if value is None else tex.without_unmatched_closings(value)[0]


_TEXTS = {"normal": _normal, "escaped": _escaped, "ascii": _ascii, "closed": _closed}


def text_of(kind: str):
    """A function of a string column that needs Unicode tables or a scan: ``normal``, ``escaped``, ``ascii`` or ``closed``."""
    made = _TEXTS[kind]

    @F.pandas_udf("string")
    def run(values):
        return values.map(made, na_action="ignore")

    return run
