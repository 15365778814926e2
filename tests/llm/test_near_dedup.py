from collections import Counter

import numpy as np
import pytest
import xxhash

from ladderweek.llm import near_dedup
from ladderweek.llm.common import components

from .conftest import FIELDS, edge_rows, prose


def plain_fingerprint(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = words.encode().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


def test_fingerprints_and_components_equal_brute_force(edge_docs):
    got = near_dedup.near_components(edge_docs).collect()
    rows = [(r[0], plain_fingerprint(r[1])) for r in edge_rows()]
    groups = plain_components([f for _, f in rows], 3)
    least = {}
    for doc_id, f in rows:
        if doc_id is not None:
            least[groups[f]] = min(least.get(groups[f], doc_id), doc_id)
    expected = Counter((d, f, least.get(groups[f])) for d, f in rows)
    assert Counter((r.id, r.fp[0] & (2**64 - 1), r.component_id) for r in got) == expected


@pytest.mark.parametrize(("radius", "segment_bits"), [(3, 32), (7, 16), (3, 16)])
def test_links_connect_what_brute_force_connects(spark, radius, segment_bits):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63 - 1, 30, dtype=np.int64)
    values = set(base.tolist())
    for b in base.tolist():
        for _ in range(8):
            flips = rng.choice(64, rng.integers(1, radius + 3), replace=False)
            value = (b & (2**64 - 1)) ^ sum(1 << int(f) for f in flips)
            values.add(value - 2**64 if value >> 63 else value)
    rows = spark.createDataFrame([([v],) for v in sorted(values)], "fp array<long>")
    links = near_dedup.near_links(rows, radius, segment_bits).collect()
    plain = plain_components([v & (2**64 - 1) for v in values], radius)
    mine = {v: v for v in plain}

    def find(x):
        while mine[x] != x:
            x = mine[x]
        return x

    for r in links:
        a, b = r.a[0] & (2**64 - 1), r.b[0] & (2**64 - 1)
        mine[find(b)] = find(a)
    same = lambda of: {frozenset(v for v in of if of[v] == r) for r in set(of.values())}
    assert same({v: find(v) for v in plain}) == same(plain)


def test_long_chain_is_one_component(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {v for k, v in got.items() if k <= 300} == {0}
    assert got[1001] == got[1000] == 1000


def test_one_row_of_each_group_stays(edge_docs):
    """Also of rows that are repeated, share an id or have none."""
    extra = [(106, prose(99, 30), "en", "s0"), (None, prose(98, 30), "en", "s0"), (None, prose(98, 30), "fr", "s1"), (None, None, "en", "s0")]
    rows = edge_rows() + [(*r, 9) for r in extra]
    docs = edge_docs.unionByName(edge_docs.sparkSession.createDataFrame([(*r, 9) for r in extra], FIELDS), allowMissingColumns=True)
    groups = plain_components([plain_fingerprint(r[1]) for r in rows], 3)
    best = {}
    for r in rows:
        root = groups[plain_fingerprint(r[1])]
        best.setdefault(root, set()).add((r[0] is None, r[0] or 0))
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in got) == Counter(min(ids) for ids in best.values())
    assert len({groups[plain_fingerprint(r.text)] for r in got}) == len(got) == len(best)


def test_kept_near_copies_under_a_wider_print(edge_docs):
    ids = [r.doc_id for r in near_dedup.keep_first(edge_docs, shingle_words=5, radius=21, segment_bits=16, n_words=2).collect()]
    assert 105 in ids and 106 not in ids  # a near copy of 106 with a smaller id


def test_no_rows(no_docs):
    assert near_dedup.near_components(no_docs).collect() == []
    assert near_dedup.keep_first(no_docs).collect() == []
