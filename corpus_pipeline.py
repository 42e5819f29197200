"""A corpus from raw documents: language, repeated lines, near copies, benchmark leaks, token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bandsaw.llm import stages
from bandsaw.llm.shards import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", stages.language),
    ("lines", stages.lines),
    ("near_copies", stages.near_copies),
    ("benchmark", stages.benchmark),
    ("tokens", stages.tokens),
]

# Trained classifiers, signatures and merges are beyond SQL; tests/llm compares the rows with plain computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each saved as Parquet in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
