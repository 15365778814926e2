"""Exact group quantiles that do not gather a large group in one task, and ordinals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A sketch of so many parts puts a rank within one part of its place.
PARTS = 50_000
#: Brackets of groups with more values than the first number reach so far to either side of a wanted rank, as a share of
#: the group: four parts of the sketch at least, and five ranks. Smaller groups are one bracket.
MARGINS = ((65_536, 4 / PARTS), (1_000, 0.005))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], moments: dict[str, Column] | None = None
) -> DataFrame:
    """Linearly interpolated quantiles (the usual type 7) of ``value`` per ``keys``, one column per name in ``probs``.

    ``moments`` are further aggregates of the same groups. NULL and NaN values are left out of the quantiles; -0.0 is 0.0.
    Two passes over ``df``: the first takes, beside the moments, a mergeable sketch that brackets every wanted rank; the
    second counts the values between the brackets, and keeps only those inside, equal ones together. Ranks then
    follow from running counts. In large groups a bracket holds 8 in ``PARTS`` of the values, and no window holds more than
    the brackets of one group. A rank that its bracket misses, which the sketch's bound rules out, raises.
    """
    named = {k: f"of_{i}" for i, k in enumerate(keys)}
    plain = df.withColumn("v_", F.col(value).cast("double") + F.lit(0.0))
    known = F.when(~F.isnan("v_"), F.col("v_"))
    shares = [min(1.0, max(0.0, p + side * margin)) for _, margin in MARGINS for side in (-1, 1) for p in probs.values()]
    cuts = F.percentile_approx(known, shares, PARTS).alias("cuts_")
    told = {name: f"m_{name}" for name in moments or {}}
    asked = [c.alias(told[name]) for name, c in (moments or {}).items()]
    groups = plain.groupBy(*keys).agg(F.count(known).alias("n_"), cuts, *asked)
    brackets = groups.select(*[F.col(k).alias(of) for k, of in named.items()], "n_", "cuts_", *told.values())
    # Rows without a value stay, counted 0, so that a group without any does.
    values = plain.select(*[F.col(k).alias("k_" + of) for k, of in named.items()], known.alias("v_"))
    same = F.lit(True)
    for of in named.values():
        same = same & values["k_" + of].eqNullSafe(brackets[of])
    met = values.join(brackets, same)
    inside, beyond = F.lit(False), F.lit(0)

    def cut(side: int, j: int) -> Column:
        out = F.lit(float("inf" if side else "-inf"))
        for i, (size, _) in reversed(list(enumerate(MARGINS))):
            out = F.when(F.col("n_") > size, F.col("cuts_")[(2 * i + side) * len(probs) + j]).otherwise(out)
        return out

    for j in range(len(probs)):
        first, last = cut(0, j), cut(1, j)
        inside = inside | F.col("v_").between(first, last)
        beyond = beyond + (F.col("v_") > last).cast("int")
    # Values outside all brackets lie in stretches that hold none inside, so their count and least value place them.
    kept = F.when(inside, F.col("v_")).alias("kept")
    stretch = F.when(~inside, beyond).alias("stretch")
    carried = [F.first(c).alias(c) for c in told.values()]
    counted = met.groupBy(*named.values(), stretch, kept).agg(
        F.count("v_").alias("c"), F.min("v_").alias("at"), F.first("n_").alias("n"), *carried
    )
    upto = F.sum("c").over(Window.partitionBy(*named.values()).orderBy("at"))
    placed = counted.withColumn("upto", upto)

    def at_rank(rank: Column) -> Column:
        holds = (rank >= F.col("upto") - F.col("c")) & (rank < F.col("upto"))
        missed = F.max((holds & F.col("kept").isNull()).cast("int")) == 1
        found = F.max(F.when(holds, F.col("kept")))
        return F.when(missed, F.raise_error("a bracket missed its rank").cast("double")).otherwise(found)

    columns, share = [], {}
    for name, p in probs.items():
        x = F.lit(float(p)) * (F.col("n") - 1)
        columns += [at_rank(F.floor(x)).alias(f"low_{name}"), at_rank(F.ceil(x)).alias(f"high_{name}")]
        share[name] = F.max(x - F.floor(x)).alias(f"share_{name}")
    ranks = placed.groupBy(*named.values()).agg(*columns, *share.values(), *carried)

    def between(name: str) -> Column:
        lower, upper = F.col(f"low_{name}"), F.col(f"high_{name}")
        return F.when(lower == upper, lower).otherwise(lower + (upper - lower) * F.col(f"share_{name}")).alias(name)

    kept_names = [F.col(of).alias(k) for k, of in named.items()] + [F.col(m).alias(name) for name, m in told.items()]
    return ranks.select(*kept_names, *[between(name) for name in probs])


def ordinal_within(df: DataFrame, keys: list[str], column: str, alias: str, block: int = 65_536) -> DataFrame:
    """Distinct ``keys, column`` numbered 1..n within ``keys`` by an integer ``column``.

    Numbered within blocks of ``block`` consecutive integers, plus the count of all lower blocks: no window holds
    more than one block's rows or one row per block.
    """
    distinct = df.select(*keys, column).distinct().withColumn("block", F.floor(F.col(column) / block))
    counts = distinct.groupBy(*keys, "block").agg(F.count("*").alias("c"))
    running = F.sum("c").over(Window.partitionBy(*keys).orderBy("block"))
    offsets = counts.select(*keys, "block", (running - F.col("c")).alias("offset"))
    inside = F.row_number().over(Window.partitionBy(*keys, "block").orderBy(column))
    numbered = distinct.withColumn("inside", inside).join(offsets, [*keys, "block"])
    return numbered.select(*keys, column, (F.col("inside") + F.col("offset")).cast("long").alias(alias))
