"""Best-fit packing of token sequences by hierarchical residual rounds.

Every task tokenizes its documents, cuts only those longer than a sequence, and packs the pieces, without their ids,
best-fit, largest first, a group of them at a time. Bins that are nearly full leave; all others travel on as single items,
are dealt by hash over as many groups as they need, and packed again, round after round, until one group has held all that was
left or a round has merged too few bins over all groups to go on. Short pieces are what fills the bins of other tasks: in the
first round bins without a piece longer than half a sequence are taken apart again, and their pieces travel. No group grows with the input, and no piece is lost. Rounds run
while the result is being built, each is stored.

Defined results: a NULL or empty text is the end id alone; repeated rows are pieces of their own; a NULL id stays; an
empty table gives no piece. Other columns of the input are not read. Numbers of sequences are unique, not dense.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderweek.llm.common import stored
from ladderweek.llm.tokens import encoder

FIELDS = (("doc_id", "long"), ("piece", "int"), ("start", "long"), ("length", "int"), ("ids_crc32", "long"))
#: Rounds go on while one bin in so many is merged into others.
LEAST_MERGED = 64
ARROW = {"long": pa.int64(), "int": pa.int32()}
BINS = "done boolean, bin long, fill int, place array<int>, " + ", ".join(f"{n} array<{t}>" for n, t in FIELDS)


def best_fit(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Items by bin: largest first, each into the fullest bin it fits in, else into a new one."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(room + 1)]
    some = 0  # bit r is set while a bin with room r is open
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = some >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            chosen = with_room[left].pop()
            if not with_room[left]:
                some &= ~(1 << left)
            bins[chosen].append(item)
        else:
            left, chosen = room, len(bins)
            bins.append([item])
        with_room[left - size].append(chosen)
        some |= 1 << (left - size)
    return bins


def places(lengths: np.ndarray) -> np.ndarray:
    """Where each piece of a bin starts."""
    return (np.cumsum(lengths) - lengths).astype(np.int32)


def bin_number(level: int, group: int, n: int) -> int:
    """Orders and deals the bins of a round, so that reruns agree. Bins may share one; sequences are numbered at the end."""
    return (level << 56 ^ group << 28 ^ n) & (2**63 - 1)


def packed(rows: dict[str, np.ndarray], made: list[list[int]], numbers: list[int], room: int, slack: int) -> pa.RecordBatch:
    """Bins of the pieces in ``rows``, a row each."""
    order = np.concatenate([np.asarray(b, np.int64) for b in made])
    at = np.zeros(len(made) + 1, np.int32)
    np.cumsum([len(b) for b in made], out=at[1:])
    lengths = rows["length"][order]
    fill = np.add.reduceat(lengths, at[:-1])
    place = (np.cumsum(lengths) - lengths) - np.repeat((np.cumsum(fill) - fill), np.diff(at))
    lists = [pa.array(place, pa.int32())]
    lists += [pa.array(rows[n], ARROW[t], from_pandas=False).take(pa.array(order)) for n, t in FIELDS]
    columns = [pa.array(fill >= room - slack), pa.array(numbers, pa.int64()), pa.array(fill, pa.int32())]
    columns += [pa.ListArray.from_arrays(pa.array(at), c) for c in lists]
    return pa.RecordBatch.from_arrays(columns, ["done", "bin", "fill", "place", *[n for n, _ in FIELDS]])


def pack_documents(
    docs: DataFrame, tokenizer_path: str, room: int, end_id: int, group: int, slack: int, memory: dict[str, int] | None = None
) -> DataFrame:
    """Round 0: each task's pieces, packed a group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, **(memory or {})).encode
        task, serial = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def bins() -> pa.RecordBatch:
            nonlocal serial
            columns = dict(zip((n for n, _ in FIELDS), zip(*rows, strict=True), strict=True))
            columns["length"] = np.array(columns["length"], np.int64)
            rows.clear()
            made = []
            for b in best_fit(columns["length"], room):
                made += [b] if columns["length"][b[0]] > room // 2 else [[i] for i in b]
            numbers = [bin_number(0, task, serial + n) for n in range(len(made))]
            serial += len(made)
            return packed(columns, made, numbers, room, slack)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for n, first in enumerate(range(0, len(ids), room)):
                        piece = ids[first : first + room]
                        rows.append((doc_id, n, first, len(piece), zlib.crc32(piece)))
                if len(rows) >= group:
                    yield bins()
        if rows:
            yield bins()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, BINS)


def repack(open_bins: DataFrame, groups: int, level: int, room: int, slack: int) -> DataFrame:
    """One more round: the open bins, as items, in so many groups."""

    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("bin", kind="stable").reset_index(drop=True)
        made = best_fit(items["fill"].to_numpy(np.int64), room)
        out = {"bin": [bin_number(level, int(key[0]), n) for n in range(len(made))]}
        out["fill"] = [int(items["fill"].to_numpy()[b].sum()) for b in made]
        for name, _ in FIELDS:
            column = items[name].tolist()
            out[name] = [np.concatenate([column[i] for i in b]) for b in made]
        out["place"] = [places(x) for x in out["length"]]
        done = np.array(out["fill"]) >= room - slack
        return pd.DataFrame({"done": done, **out})[["done", "bin", "fill", "place", *[n for n, _ in FIELDS]]]

    dealt = open_bins.drop("done").withColumn("at", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)))
    return dealt.groupBy("at").applyInPandas(run, BINS)


def pack(
    docs: DataFrame, tokenizer_path: str, room: int = 4096, end_id: int = 1, group: int = 8192, slack: int = 16, **memory: int
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``room`` is the length of a sequence, ``group`` how many items are packed together, ``slack`` how many tokens a
    nearly full bin may lack. ``memory`` bounds the words a worker remembers (``most_words``, ``most_stems``); ids do not depend on it.
    """
    rounds = [stored(pack_documents(docs, tokenizer_path, room, end_id, group, slack, memory), "bins")]
    while True:
        open_bins = rounds[-1].where("not done")
        waiting = open_bins.count()
        if waiting < 2:
            break
        groups = -(-waiting // group)
        rounds.append(stored(repack(open_bins, groups, len(rounds), room, slack), "bins"))
        merged = waiting - rounds[-1].count()
        if groups == 1 or merged * LEAST_MERGED < waiting:
            break
    full = rounds[-1]  # its open bins found no company
    for one in rounds[:-1]:
        full = full.unionByName(one.where("done"))
    names = [n for n, _ in FIELDS]
    numbered = full.withColumn("sequence_id", F.monotonically_increasing_id())  # a row is a sequence
    members = numbered.select("sequence_id", F.explode(F.arrays_zip(*names, "place")).alias("m"))
    return members.select(
        "m.doc_id",
        "m.piece",
        "m.start",
        F.col("m.length").cast("long").alias("length"),
        "m.ids_crc32",
        "sequence_id",
        F.col("m.place").cast("long").alias("offset"),
    )
