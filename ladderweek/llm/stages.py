"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ladderweek.llm import cotraining, mixing as cube, near_dedup, packing as residual, perplexity
from ladderweek.llm.common import table

VOCABULARY = "word_bpe_49k.json"
#: An executor that has been through the other stages has less room for words than one that only packs.
WORD_MEMORY = {"most_words": 100_000, "most_stems": 130_000}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the layout rules or the perplexity bands reject."""
    return perplexity.keep_inside(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that both views together score as bad."""
    return cotraining.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints over three words linked at three differing bits or fewer."""
    return near_dedup.keep_first(docs, shingle_words=3, radius=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return cube.repeat_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return residual.pack(docs, public_tokenizers.path(VOCABULARY), **WORD_MEMORY)
