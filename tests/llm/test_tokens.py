import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ladderweek.llm import packing, token_files
from ladderweek.llm.tokens import WordEncoder

from .conftest import edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN, WORDS = Tokenizer.from_file(PATH), WordEncoder(PATH, most_words=50, most_stems=50)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


ODD = st.sampled_from(["'s", "'T", "<|endoftext|>", "<|STARTOFTEXT|>", "İ", "ǅ", "K", "é", "é", "́", "½", " ", "\x85"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), ODD, st.sampled_from([" ", ".", "a", "Z", "9", "-"])), max_size=12))
def test_words_give_the_library_ids(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    assert WORDS.encode([text.encode()])[0].tolist() == plain_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_simple8b_round_trip(ids):
    words = token_files.encode_words(np.array(ids, np.uint64))
    assert token_files.decode_words(words).tolist() == ids


def test_blocks_decode_alone():
    docs = [np.arange(n, dtype=np.uint32) % 49_000 for n in (5, 0, 700, 1)]
    data = token_files.write_segment([4, None, 6, 7], docs, 64)
    ids, lens, flat = token_files.read_segment(data)
    assert (ids, lens.tolist()) == ([4, None, 6, 7], [5, 0, 700, 1])
    blocks = [token_files.read_block(data, k) for k in range(-(-706 // 64))]
    assert np.concatenate(blocks).tolist() == flat.tolist() == np.concatenate(docs).tolist()
    with pytest.raises(ValueError, match="segment"):
        token_files.read_segment(b"nope" + data[4:])


def test_files_hold_all_documents_in_order(spark, edge_docs):
    path = token_files.new_folder(spark)
    token_files.write_tokens(edge_docs, path, PATH, segment_ids=3000, block=128)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    rows = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for r, want in zip(got, rows, strict=True):
        ids = np.array([*plain_ids(want[1]), 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (want[0], at, len(ids), zlib.crc32(ids))
        at += len(ids)


@pytest.mark.parametrize(("room", "group", "slack"), [(512, 8, 2), (4096, 8192, 16)])
def test_pieces_fill_sequences(edge_docs, room, group, slack):
    got = packing.pack(edge_docs, PATH, room=room, group=group, slack=slack).collect()
    want = []
    for r in edge_rows():
        ids = np.array([*plain_ids(r[1]), 1], "<u4")
        for n, first in enumerate(range(0, len(ids), room)):
            piece = ids[first : first + room]
            want.append((r[0], n, first, len(piece), zlib.crc32(piece)))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= room
    least = -(-sum(r.length for r in got) // room)
    assert len(sequences) <= least * (1.35 if group == 8 else 1) + 1


def test_best_fit_takes_the_fullest_bin_that_fits():
    assert packing.best_fit(np.array([6, 5, 4, 3, 2]), 10) == [[0, 2], [1, 3, 4]]
    assert packing.best_fit(np.array([], int), 10) == []


def test_no_rows(spark, no_docs):
    assert packing.pack(no_docs, PATH).collect() == []
    path = token_files.new_folder(spark)
    token_files.write_tokens(no_docs, path, PATH)
    assert token_files.read_tokens(spark, path).collect() == []


def test_words_used_often_outlive_a_full_memory():
    """The words of a passage that comes again and again are not learned anew whenever rare ones have filled the memory."""
    words = WordEncoder(PATH, most_words=50, most_stems=50)
    passage, learned, learn = "the river runs low today", [], words.learn
    words.learn = lambda: (learned.extend(words.words.new), learn())
    for at in range(0, 400, 20):
        texts = [passage, *(f"rare{'abcdefghij'[k % 10]}{k}" for k in range(at, at + 20)), passage]
        for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
            assert ids.tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    assert learned.count(b"river") == 1 and learned.count(b"rarea0") == 1
    assert len(words.words) <= 50 + 25 and len(words.word_uses) == len(words.words)


def test_letters_are_asked_of_the_model_and_agree_with_the_library():
    words = WordEncoder(PATH)
    whole, asked = [], words.modelled
    words.modelled = lambda letters: (whole.append(letters), asked(letters))[1]
    texts = ["Rivers RUN low, d'accord", "straße Fluß o's", "'s t 've l'll unaffable##", "x", "É naïve sch"]
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    assert words.direct and {"rivers", "run", "low", "unaffable", "x", "sch"} <= set(whole)
