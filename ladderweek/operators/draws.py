"""Posterior draws supplied as a table: long and wide forms, derived quantities, season totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.functions.expressions import ratio
from ladderweek.operators.quantiles import ordinal_within

DRAW_KEYS = ("run_id", "chain", "iter")

# Parameter name in the draws table -> column of the state table.
STATE_PARAMETERS = {
    "X.log.all": "x_log_all",
    "day.true.logit": "day_true_logit",
    "reasc.true.logit": "reasc_true_logit",
    "org.phi[,1]": "org_phi_wild",
    "org.phi[,2]": "org_phi_hnc",
}

# Weekly parameter name -> column of the passage table.
WEEKLY_PARAMETERS = {
    "X.all": "x_all",
    "X.day": "x_day",
    "X.night": "x_night",
    "X.reasc": "x_reasc",
    "X.all.wild": "x_all_wild",
    "X.all.hnc": "x_all_hnc",
    "X.all.hatch": "x_all_hatch",
    "X.new.tot": "x_new_tot",
    "X.new.wild": "x_new_wild",
    "X.new.hnc": "x_new_hnc",
    "X.new.hatch": "x_new_hatch",
    "X.reasc.wild": "x_reasc_wild",
    "X.night.wild": "x_night_wild",
    "day.true": "day_true",
    "reasc.true": "reasc_true",
}
ORIGIN_COLUMNS = ("prop_wild", "prop_hnc", "prop_hatch")

# Season total -> weekly quantity it adds up.
SEASON_TOTALS = {
    "x_tot_all": "x_all",
    "x_tot_day": "x_day",
    "x_tot_night": "x_night",
    "x_tot_reasc": "x_reasc",
    "x_tot_all_wild": "x_all_wild",
    "x_tot_all_hatch": "x_all_hatch",
    "x_tot_all_hnc": "x_all_hnc",
    "x_tot_new_all": "x_new_tot",
    "x_tot_new_wild": "x_new_wild",
    "x_tot_new_hatch": "x_new_hatch",
    "x_tot_new_hnc": "x_new_hnc",
    "x_tot_night_wild": "x_night_wild",
    "x_tot_reasc_wild": "x_reasc_wild",
}


def base_name(param: Column) -> Column:
    """``org.prop[3, 1]`` -> ``org.prop``"""
    return F.split(param, r"\[").getItem(0)


def first_number(param: Column) -> Column:
    """First run of digits anywhere in the name, NULL where there is none."""
    return F.nullif(F.regexp_extract(param, "[0-9]+", 0), F.lit("")).cast("int")


def second_index(param: Column) -> Column:
    """``org.prop[3, 1]`` -> 1; NULL for parameters with one index or none."""
    return F.nullif(F.regexp_extract(param, r"\[[0-9]+, ?([0-9]+)\]", 1), F.lit("")).cast("int")


def word(param: Column, n: int) -> Column:
    """n-th run of letters in the name; empty where there are fewer."""
    return F.coalesce(F.get(F.regexp_extract_all(param, F.lit("[A-Za-z]+"), F.lit(0)), F.lit(n - 1)), F.lit(""))


def draws_long(wide: DataFrame, keys: tuple[str, ...] = DRAW_KEYS) -> DataFrame:
    """One column per parameter (names may hold dots and brackets) to ``param, value`` rows."""
    params = [c for c in wide.columns if c not in keys]
    plain = wide.toDF(*[c if c in keys else f"p{wide.columns.index(c)}" for c in wide.columns])
    pairs = [
        F.struct(F.lit(name).alias("param"), F.col(f"p{wide.columns.index(name)}").cast("double").alias("value"))
        for name in params
    ]
    return plain.select(*keys, F.inline(F.array(*pairs)))


def matching(param: Column, names: list[str]) -> Column:
    """Whether the parameter name contains any of ``names``, upper and lower case alike."""
    hit = F.lit(False)
    for name in names:
        hit = hit | F.contains(F.lower(param), F.lit(name.lower()))
    return hit


def extract_draws(draws: DataFrame, names: list[str] | str = "X.new.wild") -> DataFrame:
    """Draws of the matching parameters: ``run_id, chain, iter, param, strata_num, tot_abund``.

    Iterations are renumbered 1..n within their chain.
    """
    wanted = [names] if isinstance(names, str) else names
    kept = draws.filter(matching(F.col("param"), wanted))
    numbers = ordinal_within(kept, ["run_id", "chain"], "iter", "new_iter")
    return kept.join(numbers, list(DRAW_KEYS)).select(
        "run_id", "chain", F.col("new_iter").alias("iter"),
        base_name(F.col("param")).alias("param"),
        first_number(F.col("param")).alias("strata_num"),
        F.col("value").alias("tot_abund"),
    )


def present_parameters(draws: DataFrame, requested: list[str]) -> DataFrame:
    """The requested parameters that occur in the draws."""
    found = draws.select(base_name(F.col("param")).alias("param")).filter(F.col("param").isin(*requested))
    return found.distinct()


def origin_proportions(draws: DataFrame) -> DataFrame:
    """Draws of ``org.prop`` with week and origin: 1 natural, 2 hatchery no-clip, 3 hatchery."""
    origin = second_index(F.col("param"))
    labels = F.when(origin == 1, "NOR").when(origin == 2, "HNC").when(origin == 3, "HOR")
    return draws.filter(F.col("param").startswith("org.prop[")).select(
        *DRAW_KEYS, first_number(F.col("param")).alias("week_num"), origin.alias("origin_num"),
        labels.alias("origin"), "value",
    )


def states_from_draws(draws: DataFrame) -> DataFrame:
    """Long draws of the state parameters to one row per draw and week."""
    origin = second_index(F.col("param"))
    suffix = F.when(origin.isNotNull(), F.concat(F.lit("[,"), origin.cast("string"), F.lit("]"))).otherwise("")
    named = draws.select(
        *DRAW_KEYS, first_number(F.col("param")).alias("week_num"),
        F.concat(base_name(F.col("param")), suffix).alias("name"), "value",
    )
    wanted = named.filter(F.col("name").isin(*STATE_PARAMETERS) & F.col("week_num").isNotNull())
    columns = [F.max(F.when(F.col("name") == name, F.col("value"))).alias(c) for name, c in STATE_PARAMETERS.items()]
    return wanted.groupBy(*DRAW_KEYS, "week_num").agg(*columns)


def inverse_logit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def passage_draws(states: DataFrame) -> DataFrame:
    """Passage quantities of every draw and week.

    Needs the state columns, ``ladder`` (0/1) and the flags ``wild_exist, hnc_exist, hatch_exist``. Origin shares
    are a softmax over the origins ever caught, with hatchery as baseline. All row-wise.
    """
    origins = ("wild", "hnc", "hatch")
    weight = {
        "wild": F.exp("org_phi_wild") * F.col("wild_exist"),
        "hnc": F.exp("org_phi_hnc") * F.col("hnc_exist"),
        "hatch": F.lit(1.0) * F.col("hatch_exist"),
    }
    everything = weight["wild"] + weight["hnc"] + weight["hatch"]
    out = states.withColumns(
        {
            "day_true": inverse_logit(F.col("day_true_logit")) * F.col("ladder"),
            "reasc_true": inverse_logit(F.col("reasc_true_logit")) * F.col("ladder"),
            **{f"prop_{o}": F.coalesce(ratio(weight[o], everything), F.lit(0.0)) for o in origins},
            "x_all": F.round(F.exp("x_log_all") * F.col("ladder")),
        }
    )
    out = out.withColumns(
        {
            "x_day": F.round(F.col("x_all") * F.col("day_true")),
            "x_reasc": F.round(F.col("x_all") * F.col("reasc_true")),
            "x_new_tot": F.round(F.col("x_all") * (1 - F.col("reasc_true"))),
            **{f"x_all_{o}": F.round(F.col("x_all") * F.col(f"prop_{o}")) for o in origins},
        }
    )
    out = out.withColumns(
        {
            "x_night": F.col("x_all") - F.col("x_day"),
            **{f"x_new_{o}": F.round(F.col("x_new_tot") * F.col(f"prop_{o}")) for o in origins},
        }
    )
    return out.withColumns(
        {
            "x_reasc_wild": F.col("x_all_wild") - F.col("x_new_wild"),
            "x_night_wild": F.col("x_new_wild") * (1 - F.col("day_true")),
        }
    )


def season_totals(passage: DataFrame, wild_trapped: DataFrame | None = None) -> DataFrame:
    """Season sums per draw, all hatchery fish together, and the share of new wild fish handled in the trap.

    ``wild_trapped`` has one row per run: ``run_id, wild_fish``.
    """
    totals = passage.groupBy(*DRAW_KEYS).agg(*[F.sum(c).alias(name) for name, c in SEASON_TOTALS.items()])
    totals = totals.withColumn("x_tot_new_hatch_all", F.col("x_tot_new_hatch") + F.col("x_tot_new_hnc"))
    if wild_trapped is None:
        return totals
    return totals.join(wild_trapped, "run_id", "left").withColumn(
        "prop_tagged", ratio(F.col("wild_fish"), F.col("x_tot_new_wild"))
    )


def passage_long(passage: DataFrame, params: list[str] | None = None) -> DataFrame:
    """Weekly passage quantities as draws: ``X.all[12]``, ``org.prop[12, 1]`` and so on."""
    names = list(WEEKLY_PARAMETERS) + ["org.prop"] if params is None else params
    week = F.col("week_num").cast("string")

    def entry(name: str, index: str, column: str) -> Column:
        label = F.concat(F.lit(f"{name}["), week, F.lit(f"{index}]"))
        return F.struct(label.alias("param"), F.col(column).cast("double").alias("value"))

    entries = [entry(n, "", WEEKLY_PARAMETERS[n]) for n in names if n in WEEKLY_PARAMETERS]
    if "org.prop" in names:
        entries += [entry("org.prop", f", {i}", c) for i, c in enumerate(ORIGIN_COLUMNS, start=1)]
    return passage.select(*DRAW_KEYS, F.inline(F.array(*entries)))


def totals_long(totals: DataFrame) -> DataFrame:
    """Season totals as draws: ``x_tot_new_wild`` -> ``X.tot.new.wild``, and ``prop.tagged`` where it is there."""
    names = {c: "X" + c[1:].replace("_", ".") for c in totals.columns if c.startswith("x_tot")}
    names |= {c: "prop.tagged" for c in totals.columns if c == "prop_tagged"}
    entries = [
        F.struct(F.lit(name).alias("param"), F.col(c).cast("double").alias("value")) for c, name in names.items()
    ]
    return totals.select(*DRAW_KEYS, F.inline(F.array(*entries)))
