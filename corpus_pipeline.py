"""Documents to packed training sequences, stage by stage. Each stage is written as Parquet and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ladderweek.llm import stages
from ladderweek.llm.common import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", stages.quality_rules),
    ("quality classifier", stages.quality_classifier),
    ("near-duplicates", stages.near_duplicates),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

# Model fitting, tokenizing and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
