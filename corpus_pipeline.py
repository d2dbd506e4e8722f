"""From documents to training sequences: five stages, each one of the operators in llm/.

Quality rules, one of each group of near duplicates, removal of repeated passages, removal
of personal data, packing. Every stage takes all that the one before it has kept; all but
the last return the columns of documents, with ``n_chars`` of the text as it is then.

The result of a stage has to be written before the next stage is called, which then deletes the
intermediate tables of the one before, unless the documents that it is given still read them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemirror.llm import jaccard, pii, quality, suffixes
from tablemirror.llm.common import delete_tables, scratch_of, stored
from tablemirror.llm.queries import packed


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast("long"))


_left_behind: list[str] = []  # intermediate tables of the stage that was called last


def _stage(stage: Callable) -> Callable:
    @wraps(stage)
    def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = delete_tables(spark, _left_behind, docs)
        made, tables = scratch_of(lambda: stage(spark, docs, sf_dir))
        _left_behind[:] = [*held, *tables]
        return made

    return clean


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees fitted on ``labels``."""
    forest = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, forest)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return jaccard.one_of_each(docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages, of over 50 words or of 400 bytes, that occur elsewhere too."""
    return _recounted(suffixes.without_passages(docs))


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with entities masked and the terms that reveal them generalised or removed."""
    return _recounted(pii.sanitise(docs))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packed(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL cannot express the fitted trees; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
