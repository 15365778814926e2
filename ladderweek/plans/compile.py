"""From normalised records to the daily and weekly tables of every run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderweek.config import Seasons
from ladderweek.operators import expansion, rollup, strata, tags, trap, window_counts
from ladderweek.plans import union

DAY = ["run_id", "week_num", "date"]

# Columns the compile reads; a missing source becomes an empty table of these.
WINDOW_INPUT = "dam string, date date, species string, win_cnt double"
TAG_INPUT = (
    "dam string, species string, date date, tag_id string, rear_type string, period string, ascent_count int"
)
TRAP_INPUT = (
    "dam string, species string, date date, tag_code string, srr string, origin string, ad_clip boolean, "
    "length double, valid int, life_stage string, sort_by_code string"
)
OBS_INPUT = "dam string, tag_code string, sp_rrt string, mark_site string, obs_time timestamp"


@dataclass
class Compiled:
    """The tables of one job, keyed by ``run_id``."""

    strata: DataFrame
    daily: DataFrame
    weekly: DataFrame
    trap: DataFrame


def compile_daily(
    window: DataFrame, tag_days: DataFrame, trap_days: DataFrame, keep_unmatched: bool = False
) -> DataFrame:
    """Window counts with the day's tags and trap catch.

    The three sides come out of aggregations on run, stratum and date, so the joins add no shuffle.
    ``keep_unmatched`` keeps days with tags but no window count, and fills absent tag counts with 0.
    """
    joined = window.join(tag_days, DAY, "full" if keep_unmatched else "left")
    if keep_unmatched:
        joined = joined.fillna(0, subset=list(tags.TAG_COUNTS))
    return joined.join(trap_days, DAY, "left").withColumnRenamed("week_num", "week_num_org")


def compile_weekly(daily: DataFrame, seasons: Seasons, open_rule: str = "any_day") -> DataFrame:
    """Weekly sums, renumbered weeks and the run's identity."""
    weekly = rollup.renumber_weeks(rollup.weekly_rollup(daily, open_rule))
    who = seasons.frame.select("run_id", "dam", "species", "spawn_year", "trap_rate_dist")
    return weekly.join(who, "run_id")


def add_rates(weekly: DataFrame) -> DataFrame:
    """Adds expansion, limits, validity and the prior each run asks for to weeks with their trap rate."""
    judged = expansion.judge_trap(expansion.plausible_limits(expansion.expand_trap(weekly)))
    both = expansion.logit_prior(expansion.beta_prior(judged))
    beta = F.col("trap_rate_dist") == "beta"
    return both.withColumns(
        {
            **{c: F.when(beta, F.col(c)) for c in ("trap_alpha", "trap_beta")},
            **{c: F.when(~beta, F.col(c)) for c in ("trap_mu", "trap_sd")},
        }
    )


def compile_seasons(
    spark: SparkSession,
    seasons: Seasons,
    window: DataFrame,
    detections: DataFrame | None = None,
    trap_records: DataFrame | None = None,
    observations: DataFrame | None = None,
    reported: DataFrame | None = None,
    incl_trap_rate: bool = True,
    keep_unmatched: bool = False,
    open_rule: str = "any_day",
    legacy_open: bool = False,
    strict_null: bool = False,
    **rate_options,
) -> Compiled:
    """All runs at once: daily table, weekly table with trap rates, strata and the trap records used.

    Sources that do not exist may be left out. ``reported`` is the daily reported rate of ``reported_daily``.
    ``rate_options`` are ``dedupe``, ``chinook_until`` and ``mark_sites`` of ``trap_rate.rate_from_tags``, and ``audit``, a
    ``rollup.Audit`` that notes the totals of days and weeks while the weekly table is computed.
    """
    empty = lambda schema: spark.createDataFrame([], schema)
    detections = detections if detections is not None else empty(TAG_INPUT)
    trap_records = trap_records if trap_records is not None else empty(TRAP_INPUT)
    observations = observations if observations is not None else empty(OBS_INPUT)
    cohort = trap.adult_cohort(trap_records)
    daily = compile_daily(
        window_counts.window_daily(window, seasons, legacy_open),
        tags.tag_daily_by_run(detections, seasons),
        trap.trap_daily_by_run(cohort, seasons, strict_null),
        keep_unmatched,
    )
    if incl_trap_rate:
        rated = union.weekly_table(
            seasons, window, detections, cohort, observations, reported, keep_unmatched, open_rule, legacy_open, strict_null,
            **rate_options,
        )
        weekly = add_rates(rated)
    else:
        weekly = compile_weekly(daily, seasons, open_rule)
    return Compiled(strata.strata(seasons), daily, weekly, cohort)
