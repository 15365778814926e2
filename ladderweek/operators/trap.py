"""Fish-trap records: cohort filters and daily summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.config import Seasons
from ladderweek.functions import codes
from ladderweek.functions.expressions import count_where, is_true
from ladderweek.operators.strata import attach_strata

TRAP_COUNTS = (
    "trap_fish", "wild_morph", "hatch_morph", "na_morph",
    "wild_pbt", "hnc_pbt", "hatch_pbt", "na_pbt", "tot_b_run_sthd", "n_invalid",
)

B_RUN_LENGTH_MM = 780


def clean_tag(tag: Column) -> Column:
    """Tag codes shorter than three characters are no tags."""
    text = tag.cast("string")
    return F.when(F.length(text) >= 3, text)


def clip_flag(mark: Column) -> Column:
    """AD is clipped, AI unclipped, anything else unknown."""
    return F.when(mark == "AD", F.lit(True)).when(mark == "AI", F.lit(False))


def wire_flag(tags: Column) -> Column:
    return tags.contains("Wire")


def adult_cohort(trap: DataFrame) -> DataFrame:
    """Adults of the compiled species that were not diverted by sort-by-code; an unknown diversion is kept.

    Records of the layout that has neither life stage nor diversion are all of the cohort (``has_cohort`` is false).
    """
    adult = (F.col("life_stage") == "RF") & ~is_true(F.col("sort_by_code") == "Yes")
    if "has_cohort" in trap.columns:
        adult = adult | ~F.coalesce("has_cohort", F.lit(True))
    return trap.filter(F.col("species").isin(*codes.COMPILED_SPECIES) & adult)


def trap_conditions(unknown_srr: str = "null", b_run: bool = True) -> dict[str, Column]:
    """What a record is counted for: origin as read from morphology and from genetics, B-run fish, invalid records.

    ``unknown_srr="no_match"`` lets a NULL species/run/rear code match nothing, so that such fish count as of unknown
    genetic origin.
    """
    srr = F.coalesce("srr", F.lit("")) if unknown_srr == "no_match" else F.col("srr")
    wild, hatchery = srr.endswith("W"), srr.endswith("H")
    large = (F.col("species") == "Steelhead") & (F.col("length") >= B_RUN_LENGTH_MM) & wild
    return {
        "wild_morph": F.col("origin") == "W",
        "hatch_morph": F.col("origin") == "H",
        "na_morph": is_true(F.col("origin").isin("U", "NI")),
        "wild_pbt": wild,
        "hnc_pbt": hatchery & ~F.col("ad_clip"),
        "hatch_pbt": hatchery & F.col("ad_clip"),
        "na_pbt": ~(hatchery | wild),
        **({"tot_b_run_sthd": large} if b_run else {}),
        "n_invalid": F.col("valid") != 1,
    }


def trap_aggregates(strict_null: bool = False, unknown_srr: str = "null", b_run: bool = True) -> list[Column]:
    """All fish and the counts of ``trap_conditions``.

    NULL conditions count as no; ``strict_null`` instead makes that day's count NULL.
    """
    conditions = trap_conditions(unknown_srr, b_run)
    counts = [count_where(cond, strict_null).alias(name) for name, cond in conditions.items()]
    return [F.count("*").alias("trap_fish"), *counts]


def trap_daily(
    trap: DataFrame,
    species: str,
    incl_clipped: bool = True,
    b_run: bool = False,
    strict_null: bool = False,
    unknown_srr: str = "null",
    keys: tuple[str, ...] = ("date",),
) -> DataFrame:
    """Daily trap summary of one species; without clipped fish, steelhead of unknown clip drop out too."""
    mine = trap.filter(F.col("species") == species)
    if species == "Steelhead" and not incl_clipped:
        mine = mine.filter(~F.col("ad_clip"))
    return mine.groupBy(*keys).agg(*trap_aggregates(strict_null, unknown_srr, b_run))


def trap_daily_by_run(
    trap: DataFrame, seasons: Seasons, strict_null: bool = False, unknown_srr: str = "null"
) -> DataFrame:
    """Daily trap summary of every run: ``run_id, week_num, date`` and the counts. B-run only where a run asks."""
    placed = attach_strata(trap, seasons, carry=("unclipped_only", "b_run"))
    wanted = placed.filter(~F.col("unclipped_only") | ~F.col("ad_clip"))
    daily = wanted.groupBy("run_id", "week_num", "date").agg(
        *trap_aggregates(strict_null, unknown_srr), F.bool_or("b_run").alias("b_run")
    )
    return daily.withColumn("tot_b_run_sthd", F.when(F.col("b_run"), F.col("tot_b_run_sthd"))).drop("b_run")
