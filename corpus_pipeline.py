"""The corpus pipeline: quality, near duplicates, decontamination, mixing, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes it as
Parquet in the shared folder and hands it, read back, to the next. Every stage but
the last returns the columns of ``documents``; the last returns one row a document of
the token file. Tables that a stage wrote for itself are deleted once its result is
written.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import decontam, mixing, neardup, quality, tokens
from folioforge.llm._store import Scratch, recorded, release
from folioforge.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: list = []


def _stage(spark: SparkSession, work: Callable[[], DataFrame]) -> DataFrame:
    """What ``work`` returns; what the stage before wrote for itself goes first."""
    ship(spark)
    release(_made)
    with recorded() as made:
        out = work()
    _made.extend(made)
    return out


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rejected grade is less likely than a wanted one.

    Null and empty texts are judged by the model's constant alone; rows that share an id are judged
    each; without labels all stay; an equal chance of both counts as wanted. Long texts are scored
    whole (only fitting leaves them out); an empty table gives an empty result; columns of any other
    name pass through.
    """
    return _stage(spark, lambda: quality.select(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 on five-word shingles.

    Texts without words and rows without an id stay; rows that repeat an id and its text count once.
    The least id of a group stays, so there are no ties; texts of any length are compared whole; an
    empty table gives an empty result; columns of any other name pass through.
    """
    return _stage(spark, lambda: neardup.drop_duplicates(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none, and ids don't matter: rows that repeat are judged each. A
    similarity just at the threshold counts as held; texts of any length are searched whole; an empty
    table, of documents or items, drops nothing; columns of any other name pass through.
    """
    return _stage(spark, lambda: decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, by whole repeats and a cut.

    A null source is one of its own; documents without words stay once; the cut document ends after
    the word that fills its source's target. Documents alike in source, id and text tie, and any of
    them is repeated or cut; long texts are cut like others; an empty table gives an empty result;
    columns of any other name pass through, but for those beginning with ``_mix_``.
    """
    return _stage(spark, lambda: mixing.apply(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file, one row a document.

    Null and empty texts have the end id alone; repeats are all written, those that tie by id in the
    order of their texts; long texts are encoded whole; an empty table gives an empty file; other
    columns are not read.
    """
    return _stage(spark, lambda: tokens.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", select_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("token ids", token_ids),
]

#: Training a classifier and encoding text are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = Scratch(spark, f"stage{k}").keep(out, "documents")
    release(_made)
    return docs
