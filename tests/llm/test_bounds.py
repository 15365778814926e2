import tracemalloc

import numpy as np
import public_tokenizers

from ladderweek.llm import cotraining, token_files, tokens


def test_words_are_learned_together(monkeypatch):
    """Words that end with a letter or digit are not searched for signs, and ids are those of the tokenizer itself."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = tokens.WordEncoder(path)
    searched = []

    class Watched:
        def search(self, word, found=tokens.SIGNS.search):
            searched.append(word)
            return found(word)

    monkeypatch.setattr(tokens, "SIGNS", Watched())
    texts = ["Plain words, ÄÖ Straße! 3rd x-ray one\x85two end.", "...", "İstanbul ǅ A1?! (b) ok", ""]
    got = encode.encode([t.encode() for t in texts])
    assert "plain" not in searched and "words," in searched
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_ids_are_greedy_and_come_back():
    rng = np.random.default_rng(5)
    sizes = [1, 2, 59, 60, 61, 3000]
    for bits in (1, 6, 15, 16, 17, 31, 63):
        for n in sizes:
            ids = rng.integers(0, 1 << 63, n, dtype=np.uint64) >> rng.integers(63 - bits, 63, n).astype(np.uint64)
            words = token_files.encode_words(ids)
            assert np.array_equal(token_files.decode_words(words), ids)
    assert len(token_files.encode_words(np.zeros(0, np.uint64))) == 0
    assert len(token_files.encode_words(np.zeros(120, np.uint64))) == 2


def rows_of(n, each, seed):
    rng = np.random.default_rng(seed)
    slots = rng.integers(0, 1 << cotraining.TEXT_BITS, n * each).astype(np.int32)
    slots[::7] %= 50
    return cotraining.Rows(slots, np.repeat(np.arange(n, dtype=np.int32), each), rng.normal(size=(n, cotraining.N_META)))


def test_fitting_the_text_view_makes_no_copies_of_all_slots():
    """A fit holds the rows it is given and little more: one copy of all slots as numbers of 8 bytes is 16 MB here."""
    rows, more = rows_of(2000, 1000, 1), rows_of(100, 1000, 2)
    y = np.arange(2100) % 2.0
    tracemalloc.start()
    w = cotraining.fit_text([rows, more], y, np.ones(2100), steps=2)
    scores = rows.text_scores(w)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 25e6
    assert np.allclose(scores, w[-1] + np.bincount(rows.owner, w[rows.slots], 2000))
