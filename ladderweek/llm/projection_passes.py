"""Near-duplicate vectors by sorted projection passes.

Equal vectors of a label are one class from the start. A pass gives every class a key of concatenated random hashes (the
strongest of some random directions, with its sign), orders the classes of a label lexicographically by it, and
compares each with the next few in that order. Verified pairs of all passes are united; only a spanning forest of them leaves
a task. The number of passes follows from the size of the largest label, so that a pair at the threshold is missed
with the same small probability at every size.

A window holds a few neighbours only, a group may have thousands, and links count for every vector. So each group found is
counted exactly: from the angles to one member of it the triangle inequality tells most pairs without a look at them, all of
them in a group no wider than half the angle of the threshold; blocks of members it cannot tell are compared whole, and
numbers leave the task, never pairs.

Defined results: a vector that is NULL, empty or zero, holds NULL or non-finite components, or has a NULL label links with
nothing; vectors of different lengths never link; repeated rows link with one another; NULL ids stay and are never the
smallest; an empty table gives an empty one. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.llm.common import components, held, stored
from ladderweek.llm.near_dedup import forest

DIRECTIONS = 32
HASH_BITS = 6  # a direction and its sign
SEED = 20_240_601
#: Radians by which angles worked out from cosines may be off.
DOUBT = 1e-6


def agreement(threshold: float) -> float:
    """Probability that one hash agrees on two vectors at the threshold; projections are normal, whatever the length."""
    rng = np.random.default_rng(SEED)
    x, y = rng.standard_normal((2, 20_000, DIRECTIONS))
    y = threshold * x + math.sqrt(1 - threshold * threshold) * y
    return float((strongest(x) == strongest(y)).mean())


def strongest(projected: np.ndarray) -> np.ndarray:
    """Number of the direction with the largest projection, and its sign, along the last axis."""
    at = np.abs(projected).argmax(-1)
    return 2 * at + (np.take_along_axis(projected, at[..., None], -1)[..., 0] > 0)


def plan(n: int, threshold: float, window: int, missed: float) -> tuple[int, int]:
    """Passes, and hashes of a key, for ``n`` vectors that meet: hashes enough to thin them out to a window, and more."""
    needed = max(1, math.ceil(math.log2(max(2.0, n / window)) / HASH_BITS))
    met = agreement(threshold) ** needed
    return max(2, math.ceil(math.log(missed) / math.log(1 - met))), min(10, needed + 2)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square passes a double."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def rows_of(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x, np.float64) for x in column.to_numpy(zero_copy_only=False)]


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors) of each length among the vectors."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = column.offsets.to_numpy() - column.offsets[0].as_py()
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield at, unit(flat[(starts[:-1][at])[:, None] + np.arange(size)])


def comparable(vector: str, label: str) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0) & F.col(label).isNotNull(), F.lit(False))


def with_keys(classes: DataFrame, passes: int, hashes: int) -> DataFrame:
    """The classes once per pass, with ``pass`` and ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def directions(size: int) -> np.ndarray:
            return np.random.default_rng([SEED, size]).standard_normal((size, passes * hashes * DIRECTIONS), np.float32)

        made: dict = held(f"directions-{passes}-{hashes}", dict)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                keys = np.zeros((some.num_rows, passes), np.int64)
                for rows, vectors in by_length(some.column(1)):
                    size = vectors.shape[1]
                    if size not in made:
                        made.clear()
                        made[size] = directions(size)
                    told = strongest((vectors.astype(np.float32) @ made[size]).reshape(len(rows), passes, hashes, DIRECTIONS))
                    for h in range(hashes):
                        keys[rows] = keys[rows] << HASH_BITS | told[:, :, h]
                offsets = pa.array(np.arange(some.num_rows + 1, dtype=np.int32) * passes)
                lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], ["node", "keys"])

    keys = classes.select("node", "vector").mapInArrow(run, "node long, keys array<long>")
    both = classes.select("node", "label", "vector").join(stored(keys, "keys"), "node")
    return both.select("node", "label", F.size("vector").alias("size"), "vector", F.posexplode("keys").alias("pass", "key"))


def window_links(keyed: DataFrame, threshold: float, window: int, partitions: int) -> DataFrame:
    """(a, b): a forest of the verified links that each task finds between a class and the next ``window``.

    Windows end at the borders of partitions; these lie elsewhere in every pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the window before the batch: run numbers, nodes, vectors, and the last run's name

        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 4096):
                batch = whole_batch.slice(start, 4096)
                n = batch.num_rows
                names = list(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True))  # pass, label, size
                runs = np.zeros(n, np.int64)
                before = (last[3], int(last[0][-1])) if last else (None, -1)
                for i, name in enumerate(names):
                    if name != before[0]:
                        before = (name, before[1] + 1)
                    runs[i] = before[1]
                nodes = batch.column(0).to_numpy()
                vectors: list = [None] * n
                for rows, units in by_length(batch.column(1)):
                    for r, u in zip(rows.tolist(), units, strict=True):
                        vectors[r] = u
                old = 0
                if last:
                    old = len(last[0])
                    runs, nodes, vectors = np.concatenate((last[0], runs)), np.concatenate((last[1], nodes)), last[2] + vectors
                found = []
                for number in np.unique(runs).tolist():
                    at = np.flatnonzero(runs == number)
                    if len(at) < 2 or at[-1] < old:
                        continue
                    own = np.stack([vectors[i] for i in at.tolist()])
                    for step in range(1, min(window, len(at) - 1) + 1):
                        near = np.einsum("ij,ij->i", own[:-step], own[step:]) >= threshold
                        near &= at[step:] >= old
                        found.append((at[:-step][near], at[step:][near]))
                if found:
                    a, b = forest(*map(np.concatenate, zip(*found, strict=True)), len(runs))
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["a", "b"])
                if len(runs):
                    last = (runs[-window:].copy(), nodes[-window:].copy(), vectors[-window:], names[-1])

    order = ("pass", "label", "size", "key", "node")
    met = keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return met.select("node", "vector", "pass", "label", "size").mapInArrow(run, "a long, b long")


def angles(members: DataFrame) -> DataFrame:
    """``members`` (node, root, copies, vector, pivot) with the angle between vector and pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                angle = np.zeros(some.num_rows)
                pivots = {}
                for rows, units in by_length(some.column(4)):
                    pivots.update(zip(rows.tolist(), units, strict=True))
                for rows, units in by_length(some.column(3)):
                    other = np.stack([pivots[r] for r in rows.tolist()])
                    angle[rows] = np.arccos(np.clip(np.einsum("ij,ij->i", units, other), -1, 1))
                yield pa.RecordBatch.from_arrays([*some.columns[:3], pa.array(angle)], ["node", "root", "copies", "angle"])

    return members.mapInArrow(run, "node long, root long, copies long, angle double")


def compared_blocks(pairs: DataFrame, threshold: float) -> DataFrame:
    """(node, mass): copies linked with each node, by whole comparison of its block with another one or itself.

    ``pairs`` has a row per member of the two blocks (root, a, b), side 0 for those of a, 1 for those of b; a block
    compared with itself has side 0 only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])

        def done() -> list[tuple]:
            if key is None:
                return []
            x, y = (np.stack([r[2] for r in s]) if s else None for s in sides)
            copies = [np.array([r[1] for r in s], np.int64) for s in sides]
            if y is None:
                return list(zip((r[0] for r in sides[0]), ((x @ x.T >= threshold) @ copies[0]).tolist(), strict=True))
            near = x @ y.T >= threshold
            out = list(zip((r[0] for r in sides[0]), (near @ copies[1]).tolist(), strict=True))
            return out + list(zip((r[0] for r in sides[1]), (copies[0] @ near).tolist(), strict=True))

        def told(rows: list[tuple]) -> pa.RecordBatch:
            node, mass = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(mass, pa.int64())], ["node", "mass"])

        rows: list[tuple] = []
        for whole_batch in batches:
            for start in range(0, whole_batch.num_rows, 4096):
                batch = whole_batch.slice(start, 4096)
                vectors: list = [None] * batch.num_rows
                for at, units in by_length(batch.column(6)):
                    for r, u in zip(at.tolist(), units, strict=True):
                        vectors[r] = u
                columns = [c.to_pylist() for c in batch.columns[:6]]
                for root, a, b, side, node, copies, vector in zip(*columns, vectors, strict=True):
                    if key != (root, a, b):
                        rows += done()
                        key, sides = (root, a, b), ([], [])
                    sides[side].append((node, copies, vector))
                if rows:
                    yield told(rows)
                    rows = []
        rows = done()
        if rows:
            yield told(rows)

    met = pairs.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "side", "node")
    return met.select("root", "a", "b", "side", "node", "copies", "vector").mapInArrow(run, "node long, mass long")


def beside(rows: DataFrame, of_group: DataFrame, *keys: str, salts: int = 16) -> DataFrame:
    """``rows`` (with node) joined to a table of groups. A group may hold most rows, so each key is dealt over ``salts``."""
    spread = of_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    return salted.join(spread, [*keys, "salt"]).drop("salt")


def exact_masses(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, root, mass): the copies of all classes of the group within the threshold of the node, itself included.

    ``members`` is (node, root, copies, vector), each group connected.
    """
    limit = math.acos(threshold)
    pivots = members.where("node = root").select("root", F.col("vector").alias("pivot"))
    angled = stored(angles(beside(members, pivots, "root").select("node", "root", "copies", "vector", "pivot")), "angles")
    groups = angled.groupBy("root").agg(
        F.max("angle").alias("wide"), F.sum("copies").alias("all_copies"), F.count("*").alias("n")
    )
    groups = stored(groups, "groups")
    told = (F.col("n") <= 2) | (2 * F.col("wide") <= F.lit(limit - DOUBT))
    sure = beside(angled, groups.where(told), "root").select("node", "root", F.col("all_copies").alias("mass"))

    # Other groups: blocks of members with like angles, in small groups one block.
    spread = beside(angled, groups.where(~told).select("root", "n"), "root")
    width = F.when(F.col("n") > block, F.floor(F.col("angle") / (limit / 8))).otherwise(0)
    spread = stored(spread.withColumn("bin", width.cast("long")), "spread")
    filled = spread.groupBy("root", "bin").agg(F.ceil(F.count("*") / F.lit(block)).alias("cuts"))
    cut = beside(spread, filled, "root", "bin").withColumn(
        "block", F.col("bin") * F.lit(1 << 32) + F.pmod(F.xxhash64("node"), F.col("cuts"))
    )
    cut = stored(cut.select("node", "root", "copies", "angle", "block"), "blocks")
    blocks = cut.groupBy("root", "block").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("copies").alias("held")
    )
    blocks = stored(blocks, "extents")
    other = blocks.select("root", *[F.col(c).alias(f"other_{c}") for c in ("block", "low", "high", "held")])
    near = (F.col("other_low") - F.col("high") <= limit + DOUBT) & (F.col("low") - F.col("other_high") <= limit + DOUBT)
    met = blocks.join(other, "root").where(near)
    linked = F.col("high") + F.col("other_high") <= F.lit(limit - DOUBT)
    met = stored(met.select("root", "block", "other_block", "other_held", linked.alias("linked")), "met")
    plain = met.where("linked").groupBy("root", "block").agg(F.sum("other_held").alias("mass"))
    plain = cut.join(plain, ["root", "block"]).select("node", "mass")
    ask = met.where("NOT linked AND block <= other_block").select("root", F.col("block").alias("a"), F.col("other_block").alias("b"))
    held_by = members.join(cut.select("node", "block"), "node").select("node", "root", "copies", "vector", "block")
    first = ask.join(held_by, (ask["root"] == held_by["root"]) & (ask["a"] == held_by["block"]))
    second = ask.where("a <> b").join(held_by, (ask["root"] == held_by["root"]) & (ask["b"] == held_by["block"]))
    sided = [
        df.select(ask["root"], "a", "b", F.lit(side).alias("side"), "node", "copies", "vector")
        for side, df in enumerate((first, second))
    ]
    counted = compared_blocks(sided[0].unionByName(sided[1]), threshold).unionByName(plain)
    counted = counted.groupBy("node").agg(F.sum("mass").alias("mass"))
    return sure.unionByName(counted.join(cut.select("node", "root"), "node").select("node", "root", "mass"))


def dedup(
    embeddings: DataFrame,
    threshold: float = 0.93,
    window: int = 32,
    missed: float = 0.01,
    block: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector, links at cosine ``threshold`` within a label.

    ``missed`` is the probability with which a single pair at the threshold may be missed by all passes; nearer pairs are
    missed less, and a group is joined over many pairs. ``block`` bounds the members compared at once.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector")
    )
    rows = rows.withColumn("fine", comparable("vector", "label"))
    prints = ("label", "h1", "h2")  # 128 bits tell vectors apart
    rows = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(SEED), "vector", F.size("vector")))
    classes = rows.where("fine").groupBy(*prints).agg(
        F.first("vector").alias("vector"), F.min("vec_id").alias("first"), F.count("*").alias("copies")
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    passes, hashes = plan(largest, threshold, window, missed)
    keyed = with_keys(classes, passes, hashes)
    partitions = max(passes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    joined = components(window_links(keyed, threshold, window, partitions))
    joined = stored(joined.select("node", "root").distinct(), "roots")
    members = classes.select("node", "copies", "vector", "first").join(joined, "node")
    masses = exact_masses(members.select("node", "root", "copies", "vector"), threshold, block)
    least = members.groupBy("root").agg(F.min("first").alias("component"))
    found = beside(masses, least, "root").select("node", "mass", "component")
    of_class = classes.select(*prints, "node", "first", "copies").join(found, "node", "left")
    of_class = of_class.select(
        *prints,
        (F.coalesce("mass", "copies") - 1).alias("n_links"),
        F.when(F.col("mass").isNull(), F.col("first")).otherwise(F.col("component")).alias("component_id"),
    )
    linked = rows.where("fine").select("vec_id", *prints).join(of_class, list(prints)).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
