"""Vector codes by product quantization in whole numbers, the nearest entry found by Orchard's search.

A component x becomes floor(1024 * x); a vector is cut into equal consecutive parts, and each part position has a
codebook. It starts as the first vectors by id and is refined in rounds: every part goes to its nearest entry, and an
entry becomes the componentwise floor(sum / count) of its parts. Tasks add up their sums before the shuffle; the driver
holds the codebooks and their sums only, entries * components numbers.

Orchard's search: every entry has a list of all entries by distance from it. A part starts at the best of a few probed
entries and reads that entry's list; a better entry found there makes it jump to the better one's list, entries seen once
are marked and not compared again, and the list ends where an entry is farther than twice the current distance, for
nothing beyond can be nearer. Whole numbers make this exact, ties included: the lower index wins.

Defined results: rows whose vector is NULL, empty, holds NULL or non-finite components, has a length that is no multiple of
the number of parts, or another length than the first vector by id, are dropped. Equal ids are ordered by their vectors, NULL
ids last. With fewer vectors than entries all vectors are entries. Repeated rows each count. An error beyond a long, possible
only for components beyond 10^7, is NULL. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.llm.common import held, stored

SCALE_BITS = 10
STRIDE = 16  # list places read at once, and entries between two probed ones
ROWS = 2048


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of doubles: longs, or Python's whole numbers where squares of distances might pass a long."""
    width = max(1, vectors.shape[1])
    top = float(np.abs(vectors).max(initial=0.0)) * (1 << SCALE_BITS) + 1
    if 16 * width * top * top < 2.0**62:
        return np.floor(np.ldexp(vectors, SCALE_BITS)).astype(np.int64)
    as_whole = lambda x: int(x) << SCALE_BITS if abs(x) >= 2.0**52 else int(np.floor(np.ldexp(x, SCALE_BITS)))
    return np.array([[as_whole(x) for x in row] for row in vectors.tolist()], dtype=object)


class Neighbours:
    """A codebook with the distance-sorted lists of its entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = np.stack([((entries - e) ** 2).sum(1) for e in entries])
        self.lists = np.stack([np.argsort(row, kind="stable") for row in between])
        self.apart = np.take_along_axis(between, self.lists, 1)
        self.probes = np.arange(0, len(entries), STRIDE)

    beyond = np.iinfo(np.int64).max

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, the lowest of equal ones, and the squared distance."""
        n, k = len(points), len(self.entries)
        rows = np.arange(n)
        probed = np.stack([((points - self.entries[e]) ** 2).sum(1) for e in self.probes], 1)
        best = probed.argmin(1) if n else rows
        now, dist = self.probes[best], probed[rows, best]
        seen = np.zeros((n, k), bool)
        seen[:, self.probes] = True
        at, alive = np.zeros(n, np.int64), rows
        while len(alive):
            entry, d = now[alive], dist[alive]
            place = at[alive][:, None] + np.arange(STRIDE)
            inside = place < k
            place = np.minimum(place, k - 1)
            found = self.lists[entry[:, None], place]
            inside &= (self.apart[entry[:, None], place] <= 4 * d[:, None]).astype(bool)
            r, c = np.nonzero(inside & ~seen[alive[:, None], found])
            which = found[r, c]
            seen[alive[r], which] = True
            apart = points[alive[r]] - self.entries[which]
            table = np.full(found.shape, self.beyond if apart.dtype != object else 1 << 4096, apart.dtype)
            table[r, c] = np.einsum("ij,ij->i", apart, apart) if apart.dtype != object else (apart**2).sum(1)
            nearer = table.min(1)
            other = np.where((table == nearer[:, None]).astype(bool), found, k).min(1)
            better = np.flatnonzero(((nearer < d) | ((nearer == d) & (other < entry))).astype(bool))
            nearer, other = nearer[better], other[better]
            at[alive] += STRIDE
            now[alive[better]], dist[alive[better]], at[alive[better]] = other, nearer, 0
            going = inside[:, -1] & (at[alive] < k)
            going[better] = True
            alive = alive[going]
        return now, dist


def usable(column: str, parts: int) -> Column:
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & (F.size(column) > 0) & (F.size(column) % parts == 0), F.lit(False))


def as_rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def by_part(numbers: np.ndarray, parts: int) -> list[np.ndarray]:
    width = numbers.shape[1] // parts
    return [np.ascontiguousarray(numbers[:, p * width : (p + 1) * width]) for p in range(parts)]


def searcher(books: list[np.ndarray]) -> list[Neighbours]:
    name = "codebooks-" + digest(books)
    return held(name, lambda: [Neighbours(b) for b in books])


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' components by part, entry and position, as decimal numbers with commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def refine(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round over all vectors; an entry that no part went to stays."""
    parts, width = len(books), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searcher(books)
        sums = [np.zeros(b.shape, object) for b in books]
        counts = np.zeros((parts, len(books[0])), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                points = whole(as_rows(batch.slice(at, ROWS).column(0), parts * width))
                for p, own in enumerate(by_part(points, parts)):
                    entry, _ = search[p].nearest(own)
                    order = np.argsort(entry, kind="stable")
                    some, first = np.unique(entry[order], return_index=True)
                    sums[p][some] += np.add.reduceat(own[order], first).astype(object)
                    counts[p] += np.bincount(entry, minlength=counts.shape[1])
        p, e = np.nonzero(counts)
        if len(p):
            columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e])]
            told = pa.array([[str(x) for x in sums[i][j].tolist()] for i, j in zip(p.tolist(), e.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([*columns, told], ["part", "entry", "n", "sums"])

    found = vectors.select("vector").mapInArrow(run, "part int, entry int, n long, sums array<string>")
    # a whole sum may pass 38 digits only where components pass 10^20; such sums are added as they are, in Python
    told = found.select("part", "entry", "n", F.posexplode("sums"))
    short = told.withColumn("number", F.expr("try_cast(col AS decimal(38,0))"))
    totals = short.groupBy("part", "entry", "pos").agg(
        F.sum("n").alias("n"),
        F.try_sum("number").alias("total"),
        F.count("number").alias("known"),
        F.count("*").alias("all"),
    )
    new = [b.astype(object) for b in books]
    rows = totals.collect()  # entries * components
    for r in rows:
        if r["total"] is None or r["known"] < r["all"]:
            wide = told.where((F.col("part") == r["part"]) & (F.col("entry") == r["entry"]) & (F.col("pos") == r["pos"]))
            total = sum(int(x["col"]) for x in wide.toLocalIterator())
        else:
            total = int(r["total"])
        new[r["part"]][r["entry"], r["pos"]] = total // r["n"]
    return [settled(b) for b in new]


def settled(numbers: np.ndarray) -> np.ndarray:
    """Longs where they are small enough for squares of distances, else Python's whole numbers."""
    top = max((abs(x) for x in numbers.ravel().tolist()), default=0) + 1
    return numbers.astype(np.int64 if 16 * numbers.shape[1] * top * top < 2**62 else object)


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of ``vectors`` (vec_id, label, vector)."""
    parts, width = len(books), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searcher(books)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                points = by_part(whole(as_rows(some.column(2), parts * width)), parts)
                found = [s.nearest(own) for s, own in zip(search, points, strict=True)]
                codes = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
                codes = [codes[i : i + 2 * parts] for i in range(0, len(codes), 2 * parts)]
                errors = sum(f[1].astype(object) for f in found).tolist()
                errors = pa.array([e if e < 2**63 else None for e in errors], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(codes, pa.string()), errors], ["vec_id", "label", "code", "error"]
                )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def train(vectors: DataFrame, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks, one array (entries, components) per part, from ``vectors`` (vec_id, vector) of one length."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    first = vectors.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    books = [settled(b.astype(object)) for b in by_part(whole(np.array([r["vector"] for r in first], float)), parts)]
    for _ in range(rounds):
        books = refine(vectors, books)
    return books


def compress(
    embeddings: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all usable vectors (vec_id, label, code, error, label_error, codebooks_sha256), and the codebooks."""
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    kept = stored(rows.where(usable("vector", parts)), "vectors")
    first = kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(1).collect()
    if not first:
        none = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.withColumn("label_error", F.col("error")).withColumn("codebooks_sha256", F.lit("")), []
    kept = kept.where(F.size("vector") == len(first[0]["vector"]))
    books = train(kept, parts, entries, rounds)
    coded = stored(encode(kept, books), "codes")
    known = F.count("error") == F.count("*")
    total = F.expr("try_cast(sum(CAST(error AS decimal(38,0))) AS bigint)")
    sums = coded.groupBy(F.col("label").alias("same_label")).agg(F.when(known, total).alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("same_label"))).drop("same_label")
    return joined.withColumn("codebooks_sha256", F.lit(digest(books))), books


def decode(codes: DataFrame, books: list[np.ndarray], code_col: str = "code") -> DataFrame:
    """``codes`` with the vector its code stands for, in the units of the input, as ``decoded``."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b.astype(np.float64) / (1 << SCALE_BITS) for b in books]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(code_col)).to_pylist()
            codes = np.frombuffer(bytes.fromhex("".join(texts)), np.uint8).reshape(-1, parts)
            wide = np.concatenate([t[codes[:, p]] for p, t in enumerate(tables)], 1)
            at = pa.array(np.arange(len(wide) + 1, dtype=np.int32) * wide.shape[1])
            decoded = pa.ListArray.from_arrays(at, pa.array(wide.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema.fields)
    return codes.mapInArrow(run, f"{fields}, decoded array<double>")
