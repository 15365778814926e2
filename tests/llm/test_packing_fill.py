"""Fill where more bins stay open than a group holds."""

import inspect
from collections import defaultdict

import public_tokenizers

from ladderweek.llm import packing, stages, tokens

from .conftest import FIELDS

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_short_pieces_of_other_partitions_fill_many_open_bins(spark):
    long = [(i, " ".join(["the"] * (33 + i * 5 % 28)), "en", "hot", 0) for i in range(9000)]
    short = [(10_000 + i, " ".join(["the"] * (1 + i * 7 % 25)), "en", "s", 0) for i in range(11_000)]
    frames = [spark.createDataFrame(rows, FIELDS).coalesce(1) for rows in (long, short)]
    got = packing.pack(frames[0].union(frames[1]), PATH, room=64, slack=1).collect()
    assert len(got) == 20_000
    fill = defaultdict(int)
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 64
    assert len(fill) <= 1.02 * max(9000, -(-sum(fill.values()) // 64))


def test_sequences_stay_apart_where_bins_share_their_numbers(spark, edge_docs, monkeypatch):
    """The numbers that order bins within rounds may meet at any count of tasks and groups; sequences never do."""
    apart = len({r.sequence_id for r in packing.pack(edge_docs, PATH, room=512, group=8, slack=2).collect()})
    monkeypatch.setattr(packing, "bin_number", lambda level, group, n: 7)
    for repeat in (1, 3):
        docs = edge_docs.repartition(7 * repeat)
        found = defaultdict(list)
        for r in packing.pack(docs, PATH, room=512, group=8, slack=2).collect():
            found[r.sequence_id].append((r.offset, r.length))
        for members in found.values():
            at = 0
            for offset, length in sorted(members):
                assert offset == at
                at += length
            assert at <= 512
        assert len(found) <= 1.5 * apart


def test_full_bins_leave_their_task(spark):
    """Long and short pieces of one task meet before anything is shuffled."""
    rows = [(i, " ".join(["the"] * (40 if i % 2 else 22)), "en", "s", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, FIELDS).coalesce(1)
    first = packing.pack_documents(docs, PATH, 64, 1, 8192, 1).collect()
    assert sum(r.done for r in first) == 200 and len(first) == 200


def test_the_pipeline_remembers_fewer_words_than_an_encoder_alone(spark, monkeypatch):
    """An executor that has been through the other stages has less room; pieces and ids are the same."""
    asked, pack_documents = [], packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda docs, *how: asked.append(how[-1]) or pack_documents(docs, *how))
    docs = spark.createDataFrame([(k, " ".join(f"word{k * j % 97}" for j in range(40 * k))) for k in range(30)], "doc_id long, text string")
    pieces = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    own = pieces(stages.packing(spark, docs, ""))
    assert own == pieces(packing.pack(docs, PATH)) == pieces(packing.pack(docs, PATH, most_words=8, most_stems=8))
    most = inspect.signature(tokens.encoder).parameters
    assert all(asked[0][name] < most[name].default for name in ("most_words", "most_stems"))
