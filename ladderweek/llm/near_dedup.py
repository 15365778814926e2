"""Near duplicates by SimHash fingerprints and one-wildcard segment signatures.

A text becomes a fingerprint of 64 bits or a multiple: word shingles are hashed, and a bit is set if it is set in over
half the hashes. Two fingerprints within radius r, cut into at least (r + 1) / 2 segments, agree in some segment up to
one bit. So every segment is indexed under each of its variants with one bit left out; equal variants meet, and
the whole fingerprints are compared there. With fewer segments than that the search finds most links, not all.

Equal texts are one fingerprint from the start. Fingerprints that share a variant come together sorted, and only
a spanning forest of their links leaves the task, never the pairs of a group; components are then found by rounds of
alternating stars.

Defined results: a NULL or blank text has no shingle and fingerprint zero; a text of fewer words than a shingle is one
shingle; a repeated shingle counts each time; repeated rows get the same values; a NULL id stays, and its component
is the smallest id reachable, NULL if there is none; an empty table gives an empty one. Other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderweek.llm.common import components, release, stored

SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, shingle_words: int, n_words: int, out: list[list[int]]) -> int:
    """Appends the XXH64 of every shingle (one list per fingerprint word, seeds 42, 43, ...) and counts them."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends - 1).tolist()[shingle_words - 1 :] or [len(whole)]
    digest, view = xxhash.xxh64_intdigest, memoryview(whole)
    for k in range(n_words):
        out[k].extend([digest(view[i:j], SEED + k) for i, j in zip(starts, stops, strict=False)])
    return len(stops)


def vote(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit word per text from the hashes of its shingles, laid end to end: bits set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    first = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
    pieces = -(-counts[some] // 255)  # a byte lane counts to 255
    owner = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    within = np.arange(pieces.sum()) - np.repeat(owner, pieces)
    bounds = np.repeat(first, pieces) + within * 255
    lanes, half = np.uint64(0x0101010101010101), counts[some]
    word = np.zeros(len(some), np.uint64)
    for bit in range(8):
        part = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, bounds)
        total = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), owner, axis=0)
        for byte in range(8):
            word |= (2 * total[:, byte] > half).astype(np.uint64) << np.uint64(8 * byte + bit)
    out[some] = word
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", shingle_words: int = 3, n_words: int = 1) -> DataFrame:
    """(id, text_hash, fp array<long> of ``n_words`` words) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                hashes: list[list[int]] = [[] for _ in range(n_words)]
                counts = [shingle_hashes(x or b"", shingle_words, n_words, hashes) for x in part.column(1).to_pylist()]
                counts = np.array(counts, np.int64)
                words = [vote(np.array(h, np.uint64), counts) for h in hashes]
                flat = np.stack(words, 1).ravel().view(np.int64)
                offsets = pa.array(np.arange(len(counts) + 1, dtype=np.int32) * n_words)
                fps = pa.ListArray.from_arrays(offsets, pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), fps], ["id", "text_hash", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash")
    )
    return rows.mapInArrow(run, "id long, text_hash long, fp array<long>")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links a-b among 0..n-1: every linked member and its root."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def links_of_runs(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within runs of equal keys; every two members of a run are compared."""
    n, found, kept = len(keys), [], 0
    alive, step = np.arange(n), 0
    while True:
        step += 1
        alive = alive[alive + step < n]
        alive = alive[keys[alive] == keys[alive + step]]
        if not len(alive):
            break
        near = np.bitwise_count(fps[alive] ^ fps[alive + step]).sum(1) <= radius
        found.append((alive[near], alive[near] + step))
        kept += int(near.sum())
        if kept > 2_000_000:
            found = [forest(*map(np.concatenate, zip(*found, strict=True)), n)]
            kept = len(found[0][0])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(*map(np.concatenate, zip(*found, strict=True)), n)


def variant_rows(fps: DataFrame, segment_bits: int, n_words: int) -> DataFrame:
    """(key, w0, w1, ...): one row per segment and left-out bit, with the fingerprint's words."""
    wide = (1 << segment_bits) - 1
    per_word = 64 // segment_bits
    rows = []
    for s in range(n_words * per_word):
        word = F.element_at("fp", s // per_word + 1)
        segment = F.shiftrightunsigned(word, s % per_word * segment_bits).bitwiseAND(F.lit(wide).cast("long"))
        for j in range(segment_bits):
            rows.append(F.struct(F.lit(s * 64 + j).alias("table"), segment.bitwiseAND(F.lit(~(1 << j)).cast("long")).alias("rest")))
    words = [F.element_at("fp", k + 1).alias(f"w{k}") for k in range(n_words)]
    out = fps.select(*words, F.explode(F.array(*rows)).alias("x"))
    key = F.shiftleft(F.col("x.table").cast("long"), 32).bitwiseOR(F.col("x.rest"))
    return out.select(key.alias("key"), *[f"w{k}" for k in range(n_words)])


def near_links(fps: DataFrame, radius: int, segment_bits: int = 32, n_words: int = 1) -> DataFrame:
    """Links (a, b) between distinct fingerprints (array<long>) within ``radius`` bits, enough to connect them.

    ``segment_bits`` (8, 16 or 32) sets the number of segments, 64 * n_words / segment_bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held_fps = np.zeros(0, np.int64), np.zeros((0, n_words), np.uint64)

        def links(keys, prints):
            a, b = links_of_runs(keys, prints, radius)
            columns = []
            for side in (a, b):
                flat = np.ascontiguousarray(prints[side]).view(np.int64).ravel()
                at = pa.array(np.arange(len(side) + 1, dtype=np.int32) * n_words)
                columns.append(pa.ListArray.from_arrays(at, pa.array(flat)))
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys = np.concatenate((held_keys, columns[0]))
            prints = np.concatenate((held_fps, np.stack(columns[1:], 1).view(np.uint64)))
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last run may go on
            if cut:
                yield links(keys[:cut], prints[:cut])
            held_keys, held_fps = keys[cut:].copy(), prints[cut:].copy()
        if len(held_keys):
            yield links(held_keys, held_fps)

    rows = variant_rows(fps, segment_bits, n_words)
    met = rows.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(run, "a array<long>, b array<long>")


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    shingle_words: int = 3,
    radius: int = 3,
    segment_bits: int = 32,
    n_words: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints (id, text_hash, fp), and the fingerprints (fp, first, root), root equal within a component."""
    found = stored(fingerprints(docs, id_col, shingle_words, n_words), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    links = near_links(classes.select("fp"), radius, segment_bits, n_words)
    if n_words == 1:
        node = lambda c: F.element_at(c, 1)
    else:
        node = F.xxhash64
    joined = components(links.select(node("a").alias("a"), node("b").alias("b")))
    rooted = classes.withColumn("node", node("fp")).join(joined, "node", "left")
    return found, rooted.select("fp", "first", F.coalesce("root", "node").alias("root"))


def near_components(docs: DataFrame, **how) -> DataFrame:
    """(id, fp, component_id): the smallest id reachable over links of ``radius`` bits at most, itself included."""
    found, rooted = near_classes(docs, **how)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = rooted.join(smallest, "root").select("fp", "component_id")
    return found.join(of_class, "fp").select("id", "fp", "component_id")


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """One row of each component, the columns of the input kept: the one with the smallest id, NULL ids last.

    Among rows of that id the smallest hash of the text decides, among equal texts the smallest hash of the whole row.
    Components are reduced to their first key before anything is joined to the documents.
    """
    found, rooted = near_classes(docs, **how)
    keys = found.groupBy("fp", "id", "text_hash").agg(F.count("*").alias("rows")).join(rooted.select("fp", "root"), "fp")
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash", "rows")).alias("k")
    chosen = keys.groupBy("root").agg(first)
    chosen = stored(chosen.select(F.col("k.id").alias("k1"), F.col("k.text_hash").alias("k2"), "k.rows"), "kept")
    whole = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(
        whole.alias("doc"), docs["doc_id"].cast("long").alias("own1"), F.xxhash64(docs["text"]).alias("own2")
    )
    same = F.col("own1").eqNullSafe(F.col("k1")) & (F.col("own2") == F.col("k2"))
    single = keyed.join(chosen.where("rows = 1"), same).select("doc.*")
    several = chosen.where("rows > 1")
    if several.isEmpty():
        return single
    repeated = keyed.join(several, same).groupBy("k1", "k2").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return single.unionByName(repeated.select("doc.*"))
