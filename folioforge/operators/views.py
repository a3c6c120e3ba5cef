"""Small views of jobs, logs and publications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completed_batches(queues: DataFrame, after: Column) -> DataFrame:
    """Units and batches of queues that finished after an instant with every job done; a queue has ``jobs`` of unit, batch and status."""
    done = queues.where((F.size("jobs") > 0) & F.forall("jobs", lambda j: j["status"] == "done") & (F.col("finished_at") > after))
    return done.select(F.explode("jobs").alias("j")).select("j.unit", "j.batch").distinct()


def published(batches: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``published``: whether the ledger has a pushed row with the same keys."""
    pushed = ledger.where("status = 'pushed'").select(*keys, F.lit(True).alias("_pushed")).distinct()
    return batches.join(pushed, keys, "left").withColumn("published", F.coalesce("_pushed", F.lit(False))).drop("_pushed")


def log_progress(line: Column) -> Column:
    """What a log's line says of progress: a step ``[n/m]``, else a page of pages, else the line."""
    step = F.regexp_extract(line, r"\[(\d+)/(\d+)\]", 0)
    page = F.regexp_extract(line, r"(?i)page (\d+) of (\d+)", 0)
    return F.coalesce(F.nullif(step, F.lit("")), F.nullif(page, F.lit("")), line)


def artifact_paths(path: Column) -> dict[str, Column]:
    """Where the artefacts of a source file lie, by its path without the ending."""
    stem = F.regexp_replace(path, r"\.[^./]+\z", "")
    name = F.element_at(F.split(stem, "/"), -1)
    folder = F.regexp_replace(stem, r"[^/]+\z", "")
    return {"tex": F.concat(stem, F.lit(".tex")), "fields": F.concat(folder, F.lit("fields/"), name, F.lit(".json")), "state": F.concat(folder, F.lit(".state/"), name)}


#: Glyphs that text fonts lack and the macros that show them: fixed values of the text format.
SYMBOLS = {"≥": r"\geq", "≤": r"\leq", "≠": r"\neq", "≈": r"\approx", "±": r"\pm", "×": r"\times", "÷": r"\div", "μ": r"\mu", "µ": r"\mu", "Ω": r"\Omega", "∞": r"\infty"}


def symbols_shown(text: Column) -> Column:
    """Each such glyph as its macro in math."""
    for glyph, macro in SYMBOLS.items():
        text = F.replace(text, F.lit(glyph), F.lit(rf"\ensuremath{{{macro}}}"))
    return text
