from collections import Counter, defaultdict

import pytest

from ladderweek.llm import divergence

from .conftest import edge_rows


def plain_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalpha():
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def plain_audit(rows, least_docs, top):
    docs = [(lang or "", source or "", Counter(plain_terms(text))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, terms in mine for t in terms)
        kept = sorted((t for t, n in held.items() if n >= least_docs), key=str.encode)
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update({t: n for t, n in terms.items() if held[t] >= least_docs})
        whole = sum(counts.values(), Counter())

        def share(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in p:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in p if o != s]
            ahead = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", ahead)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(found, 1) if part == "pair" or k <= top]
    return Counter(out)


@pytest.mark.parametrize(
    ("least_docs", "top", "spill_cells", "block_cells", "width"),
    [(3, 50, 400_000, 65_536, 512), (1, 4, 20, 6, 2), (30, 50, 1, 1, 1), (10_000, 50, 400_000, 65_536, 512)],
)
def test_equals_plain_counts(edge_docs, least_docs, top, spill_cells, block_cells, width):
    found = divergence.audit(edge_docs, least_docs, top, spill_cells, block_cells, width).collect()
    assert Counter(map(tuple, found)) == plain_audit(edge_rows(), least_docs, top)


def test_ranks_and_spilled_stripes_do_not_depend_on_the_layout(edge_docs):
    once = divergence.audit(edge_docs.repartition(1), 2, 5).collect()
    again = divergence.audit(edge_docs.repartition(11), 2, 5, spill_cells=7, block_cells=9).collect()
    assert Counter(map(tuple, once)) == Counter(map(tuple, again))


def test_shares_are_exact_beyond_a_long():
    import numpy as np

    counts, n = np.array([[10**16, 0, 3]]), np.array([[10**17]])
    assert divergence.shares(counts, n, 7).tolist() == [[1 + 10**9 * (c + 5) // (10**17 + 35) for c in (10**16, 0, 3)]]


def test_no_documents(no_docs):
    found = divergence.audit(no_docs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0
