"""The corpus pipeline: each stage works on what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns rows with the columns of ``docs``, but for
the last, which returns packed pieces. Null and empty texts, ties, repeated rows, empty tables
and further columns are treated as the operators' docstrings say; further columns stay as they
are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfledger.llm import jaccard, languages, mixing, packing, personal
from shelfledger.llm.common import cleared, documents, noted, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts that are null or have no letter are rejected."""
    return languages.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, likeness 0.8 or more.

    The one with the least doc_id stays, of equal ids the one with the least text. A group's
    rows without doc_id go unless it has no others.
    """
    return jaccard.distinct_documents(docs, jaccard.Likeness(width=5, num=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each personal datum replaced by its kind in brackets."""
    return personal.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, which may be never."""
    return mixing.copies_of(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in training sequences."""
    return packing.digest(packing.pack(docs))


#: Intermediate tables of the stage that ran last.
_LEFT: list[str] = []


def tidy(stage: Callable) -> Callable:
    """The stage, clearing what the one before it wrote on the way to its result.

    That result has been written and read again by the time the next stage is called.
    """
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        cleared(spark, _LEFT)
        with noted(_LEFT):
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", tidy(language)),
    ("near_duplicates", tidy(near_duplicates)),
    ("personal_data", tidy(personal_data)),
    ("mixture", tidy(mixture)),
    ("packing", tidy(packed)),
]

#: SQL expresses neither a trained classifier nor a packing; tests compare the stages with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
