from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from ladderweek.llm import mixing

from .conftest import FIELDS, edge_rows, prose


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        found = {s: most * sizes[s] if s in capped else left * weight[s] / share for s in names}
        above = {s for s in names if s not in capped and found[s] > most * sizes[s]}
        if not above:
            return found
        capped |= above


def test_targets_sizes_and_taken(edge_docs):
    rows = mixing.mix(edge_docs, block_rows=16).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows())
    sizes = defaultdict(int)
    for r in edge_rows():
        sizes[r[3]] += len((r[1] or "").encode().split())
    expected, taken = plain_targets(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6 * (1 + r.target)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
    for s in ("s0", "s1"):
        assert abs(taken[s] - expected[s]) <= 0.05 * expected[s] + 10
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(edge_docs, block_rows=16).collect()))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    p, size = np.full(500, 0.37), np.sort(rng.integers(0, 3000, 500))[::-1].astype(float)
    out = mixing.flight(p, size, rng.random(500))
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert abs(out.sum() - p.sum()) < 1e-6
    assert abs((out * size).sum() - (p * size).sum()) < 1e-3
    landed = mixing.land(out, size, float((p * size).sum()))
    assert set(landed) <= {0.0, 1.0}
    assert abs((landed * size).sum() - (p * size).sum()) <= 5


def test_every_row_has_its_chance():
    rng, size = np.random.default_rng(1), np.array([50.0, 40, 30, 20, 10, 10, 10, 5])
    hits = sum(mixing.flight(np.full(8, 0.5), size, rng.random(8)) for _ in range(4000)) / 4000
    assert (abs(hits - 0.5) < 0.04).all()


def test_mix_keeps_columns_and_counts(edge_docs):
    mixed = mixing.repeat_rows(edge_docs)
    assert mixed.columns == edge_docs.columns
    due = Counter()
    for r in mixing.mix(edge_docs).collect():
        due[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +due


def test_no_rows(no_docs):
    assert mixing.mix(no_docs).collect() == []
    assert mixing.repeat_rows(no_docs).collect() == []


def test_many_equal_rows_spread_over_all_blocks(spark):
    rows = [(i, prose(i, 5 + i % 40), "en", "s") for i in range(400)] + [(7000, prose(1, 30), "en", "s")] * 500 + [(None, None, "en", "s")] * 300
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], FIELDS)
    numbered = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash")).withColumn("row", F.monotonically_increasing_id())
    drawn = mixing.with_draws(numbered, 64, 1).collect()
    assert len(drawn) == len(rows) and len({r.row for r in drawn}) == len(rows)
    assert len({r.draw for r in drawn if r.doc_id == 7000}) == 500 and len({r.draw for r in drawn if r.doc_id is None}) == 300
    blocks = Counter(int(r.draw * 19) for r in drawn)
    assert max(blocks.values()) < 2 * len(rows) / 19
    mixes = [Counter((r.doc_id, r.copies) for r in mixing.mix(d, block_rows=64).collect()) for d in (docs, docs.repartition(7))]
    assert mixes[0] == mixes[1]
    assert sum(mixes[0].values()) == len(rows)
