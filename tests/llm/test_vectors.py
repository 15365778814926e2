import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from ladderweek.llm import codebooks, projection_passes

NAN, INF = float("nan"), float("inf")
FIELDS = "vec_id long, embedding array<float>, label int, vector int, node string, h1 int, root int, code int, n int, sums int"
CLASH = (1, "x", 2, 3, 4, 5, 6)


def vector_rows(n=300, size=8, groups=12):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((groups, size))
    spread = [0.05, 0.3, 0.7]
    rows = [
        (i, (centres[i % groups] + spread[i % 3] * rng.standard_normal(size)).astype("f4").tolist(), i % 4 or None)
        for i in range(n)
    ]
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [1.0, None] * (size // 2), 1), (1003, [NAN] * size, 2), (1004, [INF] + [0.0] * (size - 1), 2),
        (1005, [0.0] * size, 1), (1006, [-0.0] * size, 3), (1007, [1.0, 2.0], 1), (1008, [1.0] * (2 * size), 1),
        (None, rows[3][1], 3), (None, rows[3][1], None), (7, rows[7][1], 3), (7, rows[7][1], 3), (1009, rows[3][1], 3),
        (1010, (np.array(rows[3][1]) * 1e30).tolist(), 3), (1011, rows[5][1], None), (-4, rows[9][1], 1),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], FIELDS).repartition(6)


def fine(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


# ---- codes --------------------------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if fine(v) and len(v) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])] if kept else []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(cut(v, p), book)[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(book)]
    out, by_label = [], Counter()
    for i, v, label in kept:
        found = [nearest(cut(v, p), book) for p, book in enumerate(books)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    return Counter((i, c, e, by_label[label]) for i, c, e, label in out), books


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 40, 4), (2, 256, 2), (1, 1, 1), (4, 16, 0)])
def test_codes_equal_plain_search(spark, parts, entries, rounds):
    rows = [r for r in vector_rows() if r[0] != 1010]
    coded, books = codebooks.compress(frame(spark, rows), parts, entries, rounds)
    expected, plain = plain_codes(rows, parts, entries, rounds)
    got = coded.collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == expected
    assert [b.tolist() for b in books] == plain
    assert {r.codebooks_sha256 for r in got} == {codebooks.digest(books)}
    back = codebooks.decode(coded.select("vec_id", "code"), books).collect()
    width = len(plain[0][0])
    for r in back:
        wanted = [x for p in range(parts) for x in plain[p][int(r.code[2 * p : 2 * p + 2], 16)]]
        assert [round(x * 1024) for x in r.decoded] == wanted and len(wanted) == parts * width


def test_codes_of_huge_components_stay_exact(spark):
    rows = [(i, [float(f"{(-1) ** i}e{3 * i}")] * 4, i % 2) for i in range(9)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    coded, books = codebooks.compress(frame(spark, rows), 2, 3, 2)
    expected, plain = plain_codes(rows, 2, 3, 2)
    assert [b.tolist() for b in books] == plain
    beyond = lambda e: e if e < 2**63 else None
    assert {(r.vec_id, r.code, r.error) for r in coded.collect()} == {(i, c, beyond(e)) for i, c, e, _ in expected}


def test_codes_of_nothing(spark):
    empty = spark.createDataFrame([], FIELDS)
    coded, books = codebooks.compress(empty)
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert coded.count() == 0 and books == []
    assert codebooks.compress(frame(spark, [(1, None, 1), (2, [NAN] * 4, None)]))[0].count() == 0


@pytest.mark.parametrize("size", [1, 2, 16])
def test_search_is_exact_with_ties(size):
    rng = np.random.default_rng(size)
    entries, points = rng.integers(-5, 5, (200, size)), rng.integers(-6, 6, (500, size))
    full = ((points[:, None] - entries) ** 2).sum(2)
    for kind in (np.int64, object):
        at, apart = codebooks.Neighbours(entries.astype(kind)).nearest(points.astype(kind))
        assert (at == full.argmin(1)).all() and (apart == full.min(1)).all()


# ---- near duplicates ----------------------------------------------------------------------------------------


def plain_links(rows, threshold):
    units = []
    for _, v, label in rows:
        usable = fine(v) and any(v) and label is not None
        v = np.array(v, float) / max(map(abs, v)) if usable else None
        units.append(v / np.linalg.norm(v) if usable else None)
    n, root = len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i + 1, n):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return Counter((rows[i][0], links[i], least.get(find(i)), rows[i][0] == least.get(find(i))) for i in range(n))


@pytest.mark.parametrize(("threshold", "window", "block"), [(0.93, 32, 1024), (0.93, 2, 5), (0.8, 3, 4)])
def test_links_equal_brute_force(spark, threshold, window, block):
    rows = vector_rows()
    found = projection_passes.dedup(frame(spark, rows), threshold=threshold, window=window, missed=1e-6, block=block)
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect()) == plain_links(rows, threshold)


def test_hot_group_is_counted_without_its_pairs(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.02 * rng.standard_normal(16)).astype("f4").tolist(), 1) for i in range(1500)]
    rows += [(2000 + i, centre.astype("f4").tolist(), 1) for i in range(700)]
    rows += [(5000 + i, rng.standard_normal(16).astype("f4").tolist(), 1) for i in range(300)]
    found = projection_passes.dedup(frame(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in found if r.vec_id < 5000} == {(2199, 0)}
    assert all(r.n_links == 0 and r.kept for r in found if r.vec_id >= 5000)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], FIELDS)
    found = projection_passes.dedup(empty)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"] and found.count() == 0


def test_passes_grow_with_the_table():
    few, many = projection_passes.plan(1_000, 0.93, 32, 0.01), projection_passes.plan(10**9, 0.93, 32, 0.01)
    assert few[0] < many[0] and few[1] < many[1] <= 10
