"""Fingerprints, perplexity rules and the classifier on whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladderweek.llm import cotraining, fingerprints, perplexity

from .conftest import FIELDS, edge_rows, prose


def test_edited_texts_and_neighbours(edge_docs):
    got = fingerprints.fingerprint_pairs(edge_docs).collect()
    order = lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or "")
    rows = sorted(edge_rows(), key=order)
    want = Counter()
    for r, after in zip(rows, rows[1:] + rows[:1], strict=True):
        text, other = r[1] or "", after[1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        want[r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert len({r.fp for r in by_id[106]}) == 1 == len({r.fp for r in (*by_id[-5], *by_id[None])})
    assert {r.fp for k in (100, 101, 102) for r in by_id[k]} == {0}
    assert by_id[0][0].next_fp == by_id[-5][0].fp and by_id[None][0].next_fp == by_id[107][0].fp


def test_votes_equal_a_plain_count(spark):
    texts = ["one", " two  words ", prose(2, 20_000), "x " * 30_000, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = dict(map(tuple, fingerprints.votes(rows, "text", ["k"]).collect()))
    terms = spark.createDataFrame(
        [(k, a, b) for k, t in enumerate(texts) for w in [t.split()] for a, b in zip(w, [*w[1:], None][: len(w)], strict=True)],
        "k int, a string, b string",
    )
    from pyspark.sql import functions as F

    hashed = terms.select("k", "a", "b", F.xxhash64("a", "b").alias("h")).distinct().collect()
    times = Counter((k, a, b) for k, t in enumerate(texts) for w in [t.split()] for a, b in zip(w, [*w[1:], None][: len(w)], strict=True))
    ones, total = np.zeros((len(texts), 64)), np.zeros(len(texts))
    for r in hashed:
        weight = min(8, -(-(len(r.a) + len(r.b or "")) // 4)) * times[r.k, r.a, r.b]
        total[r.k] += weight
        ones[r.k] += weight * np.array([r.h >> b & 1 for b in range(64)])
    for k in range(len(texts)):
        assert got[k] & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * ones[k, b] > total[k])


@pytest.mark.parametrize("n", [4_096, 4_097, 8_001, 20_000])
def test_votes_of_a_long_word_said_very_often(spark, n):
    words = [f"{c * 15}{i}" for i, c in enumerate("abcdefgh")]  # 32 characters a pair, the largest weight
    rows = spark.createDataFrame([(w, " ".join([w] * n)) for w in words], "k string, text string")
    got = dict(map(tuple, fingerprints.votes(rows, "text", ["k"]).collect()))
    assert got == dict(map(tuple, rows.select("k", F.xxhash64("k", "k")).collect()))


@pytest.mark.parametrize(("radius", "equal"), [(3, 2), (5, 1)])
def test_radius_search_finds_all(spark, radius, equal):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 20)]
    prints = set(base)
    for b in base:
        for n in range(1, 8):
            flipped = (b & (2**64 - 1)) ^ sum(1 << int(f) for f in rng.choice(64, n, replace=False))
            prints.add(flipped - 2**64 if flipped >> 63 else flipped)
    rows = spark.createDataFrame([(p,) for p in prints], "fp long")
    asked = rows.where("pmod(fp, 3) = 0")
    got = Counter(map(tuple, fingerprints.within_radius(asked, rows, radius, equal).collect()))
    mask = 2**64 - 1
    far = lambda a, b: ((a & mask) ^ (b & mask)).bit_count()
    assert got == Counter((q, p, far(q, p)) for q in prints if q % 3 == 0 for p in prints if far(q, p) <= radius)


def plain_layout(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    n = len(words)
    signs = sum((text or "").count(c) for c in "#*$%&|<>")
    chars = sum(len(w.decode()) for w in words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, chars, signs, len(lines) - len(set(lines)), len(covered), failed


def test_layout_rules_equal_brute_force(edge_docs):
    got = perplexity.judge(edge_docs).collect()
    want = Counter((r[0], *plain_layout(r[1])) for r in edge_rows())
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    tricky = ["a b c d e f g h " * 5, "x\nx\n\n \nx\ny", "#*$%&|<> é 漢", None, "w " * 7, "p q r s t u v w p q r s t u v w"]
    found = perplexity.layout(tricky)
    assert [tuple(found[n][i].item() for n in names[1:]) for i in range(len(tricky))] == [plain_layout(t) for t in tricky]


def plain_discounts(counts):
    n = [max(1, sum(c == k for c in counts.values())) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), 0.95 * k) for k in (1, 2, 3)]


def plain_model(texts):
    """Probability of a symbol after three, by the textbook formula, from strings."""
    counts = [Counter("\0\0\0"[i:] + t[max(0, i - 3) : i + 1] for t in texts for i in range(len(t)))]
    for _ in range(3):
        counts.append(Counter(g[1:] for g in counts[-1]))
    counts.reverse()
    cuts = [plain_discounts(c) for c in counts]
    followers = [defaultdict(list) for _ in counts]
    for k, level in enumerate(counts):
        for g, c in level.items():
            followers[k][g[:-1]].append(c)

    def chance(gram):
        if not gram:
            return 1 / len(counts[0])
        k, cut = len(gram) - 1, cuts[len(gram) - 1]
        after = followers[k].get(gram[:-1])
        if after is None:
            return chance(gram[1:])
        c = counts[k].get(gram, 0)
        held = sum(cut[min(x, 3) - 1] for x in after)
        return ((c - cut[min(c, 3) - 1] if c else 0) + held * chance(gram[1:])) / sum(after)

    return chance, counts


def test_scores_equal_a_plain_model(edge_docs, monkeypatch):
    monkeypatch.setattr(perplexity, "SHARD_GRAMS", 300)
    rows = [r for r in edge_rows() if r[0] != 104] + [
        (300 + i, "".join("\u6f22\u5b57\u304b\u306a\u4ea4 \U0001f642 Z"[(i * j * j + j // 7) % 9] for j in range(150 + i)), "zh", "s") for i in range(12)
    ]
    docs = edge_docs.sparkSession.createDataFrame([(*r[:4], len(r[1] or "")) for r in rows], FIELDS)
    want, seen = {}, defaultdict(list)
    for r in rows:
        if not plain_layout(r[1])[-1]:
            seen[r[2]].append(r[1].translate({0x1F642: chr(perplexity.PRIVATE + 0x1F642 % perplexity.PRIVATE_CODES)}))
    for lang, texts in seen.items():
        chance, counts = plain_model(texts)
        for context in list(followed(counts[-1]))[:5]:
            assert abs(sum(chance(context + s) for s in counts[0]) - 1) < 1e-9
        for r in rows:
            if r[2] == lang and not plain_layout(r[1])[-1]:
                text = r[1].translate({0x1F642: chr(perplexity.PRIVATE + 0x1F642 % perplexity.PRIVATE_CODES)})
                grams = ["\0\0\0"[i:] + text[max(0, i - 3) : i + 1] for i in range(len(text))]
                want[r[0]] = -sum(np.log(chance(g)) for g in grams) / len(text.encode().split())
    for broadcast_bytes in (1 << 20, 2000):
        got = perplexity.judge(docs, broadcast_bytes=broadcast_bytes).collect()
        assert {r.doc_id for r in got if r.score is not None} == set(want)
        assert all(r.score is None or abs(r.score - want[r.doc_id]) < 1e-4 for r in got)


def followed(grams):
    return sorted({g[:-1] for g in grams})


def test_odd_texts_leave_their_band(spark):
    rows = [(i, prose(i, 60 + i % 60), "en", "s") for i in range(400)]
    rows += [(1000 + i, " ".join(w + "***%%" for w in prose(i, 80).split()), "en", "s") for i in range(5)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], FIELDS)
    kept = {r.doc_id: r.kept for r in perplexity.judge(docs).collect()}
    assert not any(kept[1000 + i] for i in range(5))
    assert sum(kept[i] for i in range(400)) >= 395
    alone = {r.doc_id: r.kept for r in perplexity.judge(docs.union(docs.limit(0)), broadcast_bytes=1).collect()}
    assert alone == kept


def test_languages_one_by_one_give_the_same(edge_docs):
    a = perplexity.judge(edge_docs).collect()
    b = perplexity.judge(edge_docs, broadcast_bytes=1).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_kept_rows_keep_their_columns(edge_docs):
    kept = perplexity.keep_inside(edge_docs)
    assert kept.columns == edge_docs.columns
    want = Counter(r.doc_id for r in perplexity.judge(edge_docs).collect() if r.kept)
    assert Counter(r.doc_id for r in kept.collect()) == want


def labelled(spark):
    rows, labels = [], []
    for i in range(600):
        text, quality, toxic = prose(i, 50 + i % 40), 1, 0
        if i % 10 == 1:
            text, toxic = text.replace(" ", " nasty ", 1), 1
        elif i % 10 == 2:
            text, quality = " ".join(w + "%%" for w in text.split()), 0
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        if i % 3:
            labels.append((i, quality, toxic))
    labels += [(9999, 1, 0), (None, 1, 0), (4, None, None), labels[0]]
    return spark.createDataFrame(rows, FIELDS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in cotraining.classify(docs, labels).collect()}
    aside = [i for i in range(600) if i % 3 == 0]
    right = sum(got[i].kept == (i % 10 not in (1, 2)) for i in aside)
    assert right >= 0.97 * len(aside)
    kept = cotraining.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_every_unlabelled_document_is_asked(spark):
    """Pseudo-labels against the plain rule over all documents, repeated ids and NULL ids included."""
    docs, labels = labelled(spark)
    docs = docs.unionByName(docs.where("doc_id % 50 = 0")).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    views = cotraining.both_views_of(docs)
    rng = np.random.default_rng(3)
    text, meta = rng.normal(0, 0.3, (1 << cotraining.TEXT_BITS) + 1), rng.normal(0, 1.5, cotraining.N_META)
    got = cotraining.pseudo_labels(views, labels.where("doc_id < 100"), text, meta).collect()
    want, slots = Counter(), cotraining.WordSlots()
    for r in docs.collect():
        a = text[-1] + text[cotraining.text_view(r.text.encode(), slots)].sum()
        b = cotraining.page_view(r.text.encode(), r.lang, r.source) @ meta
        if r.doc_id is not None and not (r.doc_id < 100 and r.doc_id % 3):
            for by, (x, y) in enumerate(((a, b), (b, a))):
                if (x < -2 and y < 1) or (x > 2 and y > -1):
                    want[r.doc_id, by, int(x > 2)] = 1
    assert Counter(map(tuple, got)) == want and len(want) > 50


def test_rounds_move_labels_between_the_views(spark):
    """The models of the whole run equal those of a plain loop that holds all documents."""
    docs, labels = labelled(spark)
    views = cotraining.both_views_of(docs).cache()
    model = cotraining.fit(views, labels, 150, 10_000, 2)
    good = {r.doc_id: int(r.quality == 1 and not r.toxic) for r in labels.collect() if r.doc_id is not None and r.quality is not None}
    rows = views.where("doc_id is not null").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").toPandas()
    marked = [i for i, d in enumerate(rows.doc_id) if d in good][:150]
    free = [i for i, d in enumerate(rows.doc_id) if d not in good]

    def part(at):
        lens = [len(rows.slots[i]) for i in at]
        owner = np.repeat(np.arange(len(at), dtype=np.int32), lens)
        meta = np.array([rows.meta[i] for i in at], float).reshape(-1, cotraining.N_META)
        return cotraining.Rows(np.concatenate([rows.slots[i] for i in at]), owner, meta)

    def ask(text, meta):
        every = part(free)
        a, b = every.text_scores(text), every.meta @ meta
        given = []
        for label in (cotraining.sure(a, b), cotraining.sure(b, a)):
            at = [k for k in range(len(free)) if label[k] >= 0]
            given.append((part([free[k] for k in at]), label[at]) if at else None)
        return given

    plain = cotraining.co_train(part(marked), np.array([good[rows.doc_id[i]] for i in marked]), 2, ask)
    for mine, theirs in ((model.text, plain.text), (model.meta, plain.meta), (model.combine, plain.combine)):
        assert np.allclose(mine, theirs, atol=1e-6)


def test_edges_are_scored(spark, edge_docs):
    _, labels = labelled(spark)
    some = labels.unionByName(spark.createDataFrame([(i, i % 2, 0) for i in range(700, 730)], labels.schema))
    got = cotraining.classify(edge_docs, some).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows())
    assert all(0 <= r.score <= 1 for r in got)


def test_without_labels_all_stay(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = cotraining.classify(edge_docs, labels).collect()
    assert all(r.kept and r.score == 0.5 for r in got) and len(got) == len(edge_rows())
    assert cotraining.keep_good(edge_docs, labels).count() == len(edge_rows())
    assert cotraining.classify(no_docs, labels).collect() == []


def test_no_rows(no_docs):
    assert fingerprints.fingerprint_pairs(no_docs).collect() == []
    assert perplexity.judge(no_docs).collect() == []
    assert perplexity.keep_inside(no_docs).collect() == []
