"""Corpus pipeline: quality, line dedup, near duplicates, decontamination, mixing.

Each stage takes what its predecessor kept and writes Parquet, from which the next one reads. Tables that
a stage stages on its way are removed when the next one begins, since by then its result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millwright.llm import decontaminate, importance, jaccard, line_dedup, mixing
from millwright.llm.shared import noted_folders, release, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, which first removes what earlier ones left behind; a folder that ``docs`` reads stays."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(docs, _left)
        with noted_folders() as folders:
            out = stage(spark, docs, sf_dir)
        _left.extend(folders)
        return out

    return run_stage


@_tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling against labelled good texts keeps."""
    return importance.resampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_tidy
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line; ``n_chars`` follows the text."""
    from pyspark.sql import functions as F

    out = line_dedup.deduplicated(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard.one_of_each(docs)


@_tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: one row per document and round, with the words it gives."""
    return mixing.curriculum(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]

# The near-duplicate and classifier stages have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
