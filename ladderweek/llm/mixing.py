"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target divided by its size says how often each of its rows is due: the whole part is given to every row,
the rest is an inclusion probability. The cube method turns those into zeros and ones while the number of rows and the
number of words taken stay what the probabilities promise: three rows at a time, the probabilities move along the
direction that changes neither total, until one of them is zero or one. Rows go from long to short, so the few that
stay open to the end are short ones.

Blocks of one source run apart and leave two open rows at most; these meet in fewer blocks, round after round, until
each source is one block. Its last open rows land where the words come nearest to what is due, and rows of that last block
change over one by one while this brings them nearer still. Random numbers are hashes of row and seed, so reruns agree.

Defined results: a NULL or blank text has size 0, is drawn and takes 0 words; a source without words has target 0
and gives no row; NULL is a source; repeated rows are drawn each on their own; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import BLANKS, stored, text_or_empty

EPS = 1e-9


def n_words(column: str = "text"):
    """Number of words between ASCII blanks."""
    spaced = F.trim(F.regexp_replace(text_or_empty(column), BLANKS, " "))
    return F.when(spaced == "", F.lit(0)).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1)


def targets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): shares by repeating weights, never above ``most`` sizes.

    The level at which all shares add up is raised until no further source is above its limit; each step is one
    sum over the table of sources.
    """
    ranks = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(
        sources.withColumn("weight", F.element_at(listed, (ranks % len(weights) + 1).cast("int"))), "sources"
    )
    full = F.col("source_size") * float(most)
    level = 0.0
    while True:
        above = full <= F.lit(level) * F.col("weight")
        fixed, rest, total = ranked.agg(
            F.sum(F.when(above, full).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.sum("source_size"),
        ).first()
        if not rest or not total:
            break
        higher = (total - fixed) / rest
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return ranked.withColumn("target", F.least(full, F.lit(level) * F.col("weight")))


def flight(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Probabilities after the flight: row count and word total kept, two rows open at most."""
    p = p.copy()
    held: list[int] = []
    for k in range(len(p)):
        if not EPS < p[k] < 1 - EPS:
            p[k] = round(p[k])
            continue
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if u[0] == u[1] == u[2] == 0:
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[i]) / x if x > 0 else -p[i] / x) for i, x in zip(held, u, strict=True) if x)
        down = min((p[i] / x if x > 0 else (p[i] - 1) / x) for i, x in zip(held, u, strict=True) if x)
        step = up if draw[k] * (up + down) < down else -down
        for i, x in zip(held, u, strict=True):
            p[i] += step * x
        still = [i for i in held if EPS < p[i] < 1 - EPS]
        for i in held:
            if i not in still:
                p[i] = round(p[i])
        held = still
    return p


def land(p: np.ndarray, size: np.ndarray, wanted: float) -> np.ndarray:
    """Zeros and ones for the rows still open (two at most), then single exchanges while they bring the words nearer."""
    p = p.copy()
    open_rows = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    cases = [c for c in product((0.0, 1.0), repeat=len(open_rows))]
    p[open_rows] = 0
    missing = wanted - (p * size).sum()
    best = min(cases, key=lambda c: (abs(missing - np.dot(c, size[open_rows])), c))
    p[open_rows] = best
    missing -= np.dot(best, size[open_rows])
    while len(p):
        change = size * (1 - 2 * p)
        k = int(np.argmin(np.abs(missing - change)))
        if abs(missing - change[k]) >= abs(missing) - EPS:
            break
        missing -= change[k]
        p[k] = 1 - p[k]
    return p


def balance(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: the flight, and the landing where it is its source's only block."""
    rows = rows.sort_values(["size", "draw", "row"], ascending=[False, True, True], kind="stable")
    size, draw = rows["size"].to_numpy(float), rows["draw"].to_numpy(float)
    p = flight(rows["p"].to_numpy(float), size, draw)
    if rows["blocks"].iloc[0] == 1:
        p = land(p, size, float((rows["p"].to_numpy(float) * size).sum()))
    return rows.assign(p=p)[["row", "source_id", "size", "draw", "p", "blocks"]]


def rounds(open_rows: DataFrame, block_rows: int) -> DataFrame:
    """(row, p) with p 0 or 1: blocks of every source, then blocks of what they left open.

    ``blocks`` says in how many blocks a row's source is; a block leaves two rows, so the next round needs fewer.
    """
    parts, schema, level = [], "row long, source_id long, size long, draw double, p double, blocks long", 0
    most = open_rows.agg(F.max("blocks")).first()[0]
    while most:
        dealt = open_rows.withColumn("block", F.pmod(F.xxhash64("draw", F.lit(level)), F.col("blocks")))
        moved = stored(dealt.groupBy("source_id", "block").applyInPandas(balance, schema), "cube")
        still = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
        parts.append(moved.where(~still).select("row", "p"))
        fewer = F.ceil(2 * F.col("blocks") / F.lit(block_rows)).cast("long")
        open_rows, level = moved.where(still).withColumn("blocks", fewer), level + 1
        most = None if most == 1 else -(-2 * most // block_rows)
    out = parts[0] if parts else open_rows.select("row", "p")
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def with_draws(rows: DataFrame, block_rows: int, seed: int) -> DataFrame:
    """The rows with ``draw``, a number from 0 to 1 by hash of id, source and text.

    Rows equal in these share it, unless they are more than a block may hold: those are numbered, partition by partition
    of the input, and each has a draw of its own, so that they spread over all blocks of their source.
    """
    rows = rows.withColumn("digest", F.xxhash64("doc_id", "source", "text_hash", F.lit(seed)))
    often = rows.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)
    often = stored(often.select("digest"), "often")
    part = F.shiftrightunsigned("row", 33).alias("part")  # the partition's place in a row number
    equal = rows.join(often, "digest", "left_semi").select("row", "digest", part)
    before = F.sum("n").over(Window.partitionBy("digest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = equal.groupBy("digest", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    within = F.row_number().over(Window.partitionBy("digest", "part").orderBy("row"))
    numbered = equal.withColumn("within", within).join(parts, ["digest", "part"])
    numbered = stored(numbered.select("row", (F.col("before") + F.col("within")).alias("nth")), "repeats")
    own = F.when(F.col("nth").isNull(), F.col("digest")).otherwise(F.xxhash64("digest", "nth"))
    drawn = rows.join(numbered, "row", "left").withColumn("draw", F.shiftrightunsigned(own, 11) / float(1 << 53))
    return drawn.drop("digest", "nth")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    most: float = 3.0,
    block_rows: int = 4096,
    seed: int = 1,
) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, copies): how often the mix holds each row.

    Weights go to the sources by code point, NULL last, and repeat; all targets add up to the size of the input.
    """
    small = docs.select("doc_id", "source", n_words().cast("long").alias("size"), F.xxhash64("text").alias("text_hash"))
    rows = stored(small.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    aims = targets(sizes, weights, most).withColumn("source_id", F.xxhash64(F.coalesce("source", F.lit("\x00null"))))
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aims = aims.withColumn("due", F.least(due, F.lit(float(most))))
    aims = stored(aims.withColumn("blocks", F.ceil(F.col("n_rows") / block_rows).cast("long")), "targets")
    names = aims.withColumnRenamed("source", "of")
    every = rows.join(names, rows["source"].eqNullSafe(names["of"])).drop("of")
    whole = F.floor(F.col("due") + EPS)
    every = every.withColumn("whole", whole).withColumn("p", F.greatest(F.col("due") - whole, F.lit(0.0)))
    open_rows = with_draws(every, block_rows, seed).where(F.col("p") > EPS).select("row", "source_id", "size", "draw", "p", "blocks")
    drawn = rounds(open_rows, block_rows).withColumnRenamed("p", "extra")
    out = every.join(drawn, "row", "left")
    copies = F.col("whole") + F.coalesce(F.col("extra"), F.lit(0.0)).cast("long")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"))


def repeat_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as the mix holds it, the columns of the input kept.

    Equal rows share what is due to them together.
    """
    key = [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("k1"), F.xxhash64("doc_id", "source", "text_hash").alias("k2")]
    taken = mix(docs, **how).select(*key, "copies").groupBy("k1", "k2")
    taken = taken.agg(F.sum("copies").alias("due"), F.count("*").alias("rows")).where("due > 0")
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        F.coalesce(docs["doc_id"], F.lit(-1)).alias("k1"),
        F.xxhash64(docs["doc_id"], docs["source"], F.xxhash64(docs["text"])).alias("k2"),
    ).join(taken, ["k1", "k2"])
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("due"))
    own = F.floor(F.col("due") / F.col("rows")) + (nth <= F.col("due") % F.col("rows")).cast("long")
    each = F.explode(F.sequence(F.lit(1), F.col("own").cast("int")))
    repeated = keyed.withColumn("own", own).where("own > 0").withColumn("copy", each)
    return repeated.select("doc.*")
