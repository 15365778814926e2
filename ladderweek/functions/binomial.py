"""Exact binomial quantiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def binomial_quantile(n: Column, p: Column, q: float) -> Column:
    """Smallest k with P(X <= k) >= q for X ~ Binomial(n, p); NULL unless n >= 0 and 0 <= p <= 1.

    The most likely count is known in closed form. Weights relative to its own follow from the ratios of neighbouring
    terms, with one product each: one walk down and one up for the mass on either side, then one on the side where the
    quantile lies. Only counts within 9 standard deviations + 40 of the mean are visited. By Bernstein's inequality the
    rest carries less than 1e-16 of the mass, so the work grows with sqrt(n), not n. All of it is a JVM expression.
    """
    given, p = n.cast("double"), p.cast("double")
    usable = ~F.isnan(given) & ~F.isnan(p) & (given >= 0) & (p >= 0) & (p <= 1)
    n = F.floor(given).cast("double")
    inner = usable & (n > 0) & (p > 0) & (p < 1)
    reach = 9 * F.sqrt(n * p * (1 - p)) + 40
    first = F.greatest(F.lit(0.0), F.floor(n * p - reach).cast("double"))
    last = F.least(n, F.ceil(n * p + reach).cast("double"))
    # What several steps need is worked out once: a struct in an array of one, and functions of its fields.
    begun = F.struct(
        n.alias("n"),
        (p / (1 - p)).alias("odds"),
        F.least(n, F.floor((n + 1) * p).cast("double")).cast("long").alias("mode"),
        first.cast("long").alias("first"),
        last.cast("long").alias("last"),
    )

    def lower(x: Column, k: Column) -> Column:
        """Weight of k - 1 divided by that of k."""
        return k / ((x["n"] - k + 1) * x["odds"])

    def upper(x: Column, k: Column) -> Column:
        """Weight of k divided by that of k - 1."""
        return (x["n"] - k + 1) / k * x["odds"]

    none = F.array().cast("array<bigint>")
    downwards = lambda x: F.when(x["mode"] > x["first"], F.sequence(x["mode"], x["first"] + 1, F.lit(-1).cast("long"))).otherwise(none)
    upwards = lambda x: F.when(x["last"] > x["mode"], F.sequence(x["mode"] + 1, x["last"])).otherwise(none)

    def mass(x: Column, counts: Column, step) -> Column:
        """Sum of the weights on one side of the most likely count."""
        grow = lambda acc, k: F.struct(
            (acc["w"] * step(x, k)).alias("w"), (acc["mass"] + acc["w"] * step(x, k)).alias("mass")
        )
        return F.aggregate(counts, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("mass")), grow)["mass"]

    def weighed(x: Column) -> Column:
        sides = F.struct(mass(x, downwards(x), lower).alias("below"), mass(x, upwards(x), upper).alias("above"))
        return F.struct(x.alias("x"), sides.alias("s"))

    def found(y: Column) -> Column:
        x, below = y["x"], y["s"]["below"]
        wanted = (below + 1 + y["s"]["above"]) * F.lit(float(q))

        def down(acc: Column, k: Column) -> Column:  # acc.upto is the mass of all counts up to k - 1
            w = acc["w"] * lower(x, k)
            at = F.when(acc["upto"] >= acc["wanted"], k - 1).otherwise(acc["at"])
            return F.struct(w.alias("w"), (acc["upto"] - w).alias("upto"), acc["wanted"].alias("wanted"), at.alias("at"))

        def up(acc: Column, k: Column) -> Column:  # acc.upto is the mass of all counts up to k - 1
            w = acc["w"] * upper(x, k)
            at = F.when(acc["upto"] < acc["wanted"], k).otherwise(acc["at"])
            return F.struct(w.alias("w"), (acc["upto"] + w).alias("upto"), acc["wanted"].alias("wanted"), at.alias("at"))

        start = lambda upto: F.struct(
            F.lit(1.0).alias("w"), upto.alias("upto"), wanted.alias("wanted"), x["mode"].alias("at")
        )
        return F.when(below >= wanted, F.aggregate(downwards(x), start(below), down)["at"]).otherwise(
            F.aggregate(upwards(x), start(below + 1), up)["at"]
        )

    once = lambda value, of: F.transform(F.array(value), of)[0]
    k = F.when(inner, once(once(begun, weighed), found))
    return F.when(usable, F.when((n == 0) | (p == 0), F.lit(0).cast("long")).when(p == 1, n.cast("long")).otherwise(k))
