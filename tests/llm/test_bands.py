"""Perplexity bands where bad texts are many."""

import random

import numpy as np
import pytest

from ladderweek.llm import perplexity

from .conftest import FIELDS, prose


def garbled(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 6))) for _ in range(n))


def test_a_third_of_garbled_rows_is_rejected(spark):
    rows = [(i, prose(i, 70 + i % 50), "en", "s") for i in range(600)]
    rows += [(1000 + i, garbled(i, 70 + i % 50), "en", "hot") for i in range(300)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], FIELDS)
    kept = {r.doc_id: r.kept for r in perplexity.judge(docs).collect()}
    assert sum(kept[1000 + i] for i in range(300)) <= 3
    assert sum(kept[i] for i in range(600)) >= 594


@pytest.mark.parametrize("away", [-6, 6])
def test_a_third_of_bad_scores_moves_the_band_little(away):
    rng = np.random.default_rng(1)
    clean, bad = rng.normal(20, 0.4, 4000), rng.normal(20 + away, 0.4, 2000)
    middle, width = perplexity.centre_and_width(*np.unique(np.concatenate((clean, bad)).round(3), return_counts=True))
    assert abs(middle - 20) < 0.15 and 0.4 < width < 0.6
    alone = perplexity.centre_and_width(*np.unique(clean.round(3), return_counts=True))
    assert abs(alone[0] - 20) < 0.15 and 0.4 < alone[1] < 0.6


def test_few_scores():
    assert perplexity.centre_and_width(np.array([3.0]), np.array([1])) == (3.0, 0.01)
    assert perplexity.centre_and_width(np.array([1.0, 2.0, 9.0]), np.array([1, 1, 1]))[1] >= 3
