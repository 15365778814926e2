"""Token ids in Simple-8b coded files, in ascending document order.

A 64-bit word holds a selector in its top four bits and as many equal-wide ids in the other sixty as the selector says;
an id too wide for that is an escape word followed by the plain 64-bit value. A segment is a run of whole
documents. It starts with a header, then come document ids, their lengths, the first word of each block of ids, and
the words; no word crosses a block, so blocks decode on their own, and a segment decodes selector by selector
in whole arrays. Segments are rows of a Parquet table, written by Spark's committer to any store it can reach; part and
number give their order.

Defined results: a NULL or empty text is the end id alone; repeated rows are documents of their own, ordered by text;
NULL ids come first; an empty table has no segment. Other columns of the input are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import shared_dir
from ladderweek.llm.tokens import encoder

# Fixed values of the coding: ids per word by selector; the bits of each are 60 divided by that. 15 escapes.
PER_WORD = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
MAGIC = b"S8B1"
HEAD = "<4sIQQQQ"
#: Rank of the width an id needs, by the id; from the last on it is worked out.
WIDTHS = sorted({60 // p for p in PER_WORD})
RANK = np.searchsorted(1 << np.array(WIDTHS), np.arange(1 << 16), "right").astype(np.uint8)
SEGMENT = "part int, number int, n_ids long, data binary"


def encode_words(ids: np.ndarray) -> np.ndarray:
    """Simple-8b words of the ids (uint64); greedy: each word takes the most ids that fit."""
    n = len(ids)
    if n and ids.max() < len(RANK):
        wide = RANK[ids]
    else:
        wide = np.zeros(n, np.uint8)
        for bits in WIDTHS:
            wide += ids >= np.uint64(1 << bits)  # rank of the width needed
    take, chosen = np.zeros(n, np.uint8), np.full(n, ESCAPE, np.uint8)
    widest, reach = wide, 1  # the greatest rank among so many ids from here on
    for selector in reversed(range(len(PER_WORD))):
        per = PER_WORD[selector]
        if per > n:
            break
        while reach < per:
            widest, reach = np.maximum(widest[:-1], wide[reach:]), reach + 1
        fits = widest <= WIDTHS.index(60 // per)
        if per > 1 and not fits.any():
            break  # nothing wider fits either
        np.copyto(take[: len(fits)], per, where=fits)
        np.copyto(chosen[: len(fits)], selector, where=fits)
    step = np.where(take == 0, 1, take).tolist()
    heads, at = [], 0
    while at < n:
        heads.append(at)
        at += step[at]
    heads = np.array(heads, np.int64)
    selectors = chosen[heads]
    escaped = selectors == ESCAPE
    place = np.arange(len(heads)) + np.concatenate(([0], np.cumsum(escaped)[:-1])) if n else heads
    words = np.zeros(len(heads) + int(escaped.sum()), np.uint64)
    words[place] = selectors.astype(np.uint64) << np.uint64(60)
    words[place[escaped] + 1] = ids[heads[escaped]]
    for selector, per in enumerate(PER_WORD):
        mine = np.flatnonzero(selectors == selector)
        if len(mine):
            shift = (np.arange(per) * (60 // per)).astype(np.uint64)
            values = ids[heads[mine][:, None] + np.arange(per)]
            words[place[mine]] |= np.bitwise_or.reduce(values << shift, axis=1)
    return words


def decode_words(words: np.ndarray) -> np.ndarray:
    """The ids of whole blocks of words."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():  # a plain value may look like an escape itself
        raw[at + 1 : at + 2] = not raw[at]
    selectors[raw] = ESCAPE
    per = np.array([*PER_WORD, 0, 0])[selectors]
    per[raw] = 1
    ends = np.cumsum(per)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    first = ends - per
    for selector, count in enumerate(PER_WORD):
        mine = np.flatnonzero(selectors == selector)
        if len(mine):
            shift = (np.arange(count) * (60 // count)).astype(np.uint64)
            mask = np.uint64((1 << (60 // count)) - 1)
            out[first[mine][:, None] + np.arange(count)] = (words[mine][:, None] >> shift) & mask
    out[first[raw]] = words[raw]
    return out


def write_segment(doc_ids: list[int | None], docs: list[np.ndarray], block: int) -> bytes:
    ids = np.concatenate(docs).astype(np.uint64)
    coded = [encode_words(ids[at : at + block]) for at in range(0, len(ids), block)]
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in coded]))).astype("<u8")
    head = struct.pack(HEAD, MAGIC, block, len(docs), len(ids), int(offsets[-1]), len(coded))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    lens = np.array([len(d) for d in docs], "<u8")
    words = np.concatenate(coded).astype("<u8")
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in (head, known, numbers, lens, offsets, words))


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths, and all token ids."""
    magic, _, n_docs, n_ids, n_words, n_blocks = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = struct.calcsize(HEAD)
    known = np.frombuffer(data, np.uint8, n_docs, at)
    at += n_docs
    numbers = np.frombuffer(data, "<i8", n_docs, at)
    lens = np.frombuffer(data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
    at += 16 * n_docs + 8 * (n_blocks + 1)
    ids = decode_words(np.frombuffer(data, "<u8", n_words, at).astype(np.uint64))
    if len(ids) != n_ids:
        raise ValueError("a token segment is cut short")
    return [d if k else None for d, k in zip(numbers.tolist(), known.tolist(), strict=True)], lens, ids


def read_block(data: bytes, number: int) -> np.ndarray:
    """The ids of one block alone."""
    _, _, n_docs, _, _, n_blocks = struct.unpack_from(HEAD, data)
    at = struct.calcsize(HEAD) + 17 * n_docs
    offsets = np.frombuffer(data, "<u8", n_blocks + 1, at)
    first, last = int(offsets[number]), int(offsets[number + 1])
    at += 8 * (n_blocks + 1) + 8 * first
    return decode_words(np.frombuffer(data, "<u8", last - first, at).astype(np.uint64))


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, segment_ids: int = 1 << 20, block: int = 8192
) -> None:
    """Encodes every text, appends ``end_id`` and writes segments of about ``segment_ids`` ids, sorted by doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number = encoder(tokenizer_path).encode, TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        kept: list[np.ndarray] = []
        size = 0

        def segment() -> pa.RecordBatch:
            nonlocal number, size
            data = pa.array([write_segment(doc_ids, kept, block)], pa.binary())
            row = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()), data]
            number, size = number + 1, 0
            doc_ids.clear()
            kept.clear()
            return pa.RecordBatch.from_arrays(row, ["part", "number", "n_ids", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for doc_id, ids in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist()), strict=True):
                    doc_ids.append(doc_id)
                    kept.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= segment_ids:
                        yield segment()
        if kept:
            yield segment()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(run, SEGMENT)
    segments.write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (little-endian 32-bit ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids, lens, ids = read_segment(data)
                ends = np.cumsum(lens)
                raw = memoryview(ids.astype("<u4")).cast("B")
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()),
                        pa.array([number] * n, pa.int32()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(ends - lens),
                        pa.array(lens),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "number", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(SEGMENT).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_start"))  # one row per task of the writer
    own = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("part", "number", F.coalesce(F.sum("n_ids").over(own), F.lit(0)).alias("own_start"))
    places = places.join(parts, "part").select("part", "number", (F.col("part_start") + F.col("own_start")).alias("first"))
    schema = "part int, number int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    rows = files.select("part", "number", "data").mapInArrow(run, schema)
    placed = rows.join(places, ["part", "number"])
    return placed.select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def new_folder(spark: SparkSession) -> str:
    import uuid

    return f"{shared_dir(spark)}/llm-tokens-{uuid.uuid4().hex}"
