"""From raw documents to token ids: quality, exact and near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet to the shared scratch
folder and reads it back as the next stage's documents. All stages but the last return the columns of documents.

Null texts count as empty in all stages; rows without an id and rows that repeat in full are documents like others; an empty
table gives an empty one; further columns, whatever their names, are carried to the last stage, which returns ids alone.

A stage gets documents that are stored, so it first deletes the scratch tables of the stages before it. Each list of stages
has a list of its own of such tables: runs beside each other, and results that other callers hold, are never touched. STAGES,
used by hand, is one such run: a stage's result must be stored before the next stage of it is called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import bpe, exact_dedup, mixing, quality, simhash
from tidewright.llm.common import released, scope, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; without labels all of them."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; all null, empty and blank texts are one group."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; ties are settled by the text."""
    return simhash.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each whole pass over a document and one for the part of a pass. Documents without words
    have none."""
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row of the mix, with their hashes; an empty text has no ids."""
    return bpe.coded(docs, *bpe.public_vocabulary(), with_ids=True)


ORDER = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]


def stages() -> list[tuple[str, Stage]]:
    """The stages of one run, which share a list of scratch tables."""
    paths: list[str] = []

    def tidy(stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            released(spark, paths)
            with scope(paths):
                return stage(spark, docs, sf_dir)

        return run_stage

    return [(name, tidy(stage)) for name, stage in ORDER]


STAGES = stages()

#: SQL cannot express the classifier, the fingerprints' components or BPE; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the documents table of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages():
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
