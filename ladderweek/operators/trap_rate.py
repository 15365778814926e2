"""How large a share of the passing fish the trap takes: from tags, or as reported by the operators of the trap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.config import Seasons
from ladderweek.functions import codes
from ladderweek.functions.expressions import is_true, not_nan, ratio
from ladderweek.operators.strata import attach_strata, attach_supplied, strata, within_season

MIN_TAGS = 20
SECONDS_PER_DAY = 86_400
FLUMES = 2


def marked_here(dam: Column, mark_site: Column, mark_sites: dict[str, tuple[str, ...]] | None = None) -> Column:
    """True for fish tagged at the dam's own trap; an unknown mark site is not the trap."""
    found = F.lit(False)
    for name, sites in (mark_sites or codes.TRAP_MARK_SITES).items():
        found = found | ((dam == name) & mark_site.isin(*sites))
    return is_true(found)


def usable_season(species: Column, obs_time: Column, chinook_until: str = "month_8") -> Column:
    """Leaves out autumn Chinook: seen after August, or with ``"aug_17"`` after August 17th."""
    in_time = F.month(obs_time) <= 8
    if chinook_until == "aug_17":
        in_time = in_time & ~((F.month(obs_time) == 8) & (F.dayofmonth(obs_time) > 17))
    return F.when(species == "Chinook", in_time).otherwise(is_true(species.isin("Steelhead", "Coho")))


def species_code(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, "[0-9]+", 0), F.lit(""))


def first_observations(obs: DataFrame, keys: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """First day each tag was seen, per species/run/rear code."""
    return obs.groupBy(*keys, "tag_code", "sp_rrt").agg(F.min("obs_date").alias("obs_date"))


def observation_days(obs: DataFrame, seasons: Seasons) -> DataFrame:
    """Observations counted per dam, tag, code, mark site and day: ``dam, tag_code, sp_rrt, mark_site, obs_date, n_obs``.

    Season rules look at the day only, so everything after this works on far fewer rows than there are observations,
    and only these are multiplied by the runs of their dam.
    """
    known = within_season(obs, seasons, "obs_time").filter(F.col("tag_code").isNotNull())
    day = F.to_date("obs_time").alias("obs_date")
    return known.groupBy("dam", "tag_code", "sp_rrt", "mark_site", day).agg(F.count("*").alias("n_obs"))


def observations_by_run(
    obs: DataFrame, seasons: Seasons, chinook_until: str = "month_8", mark_sites: dict | None = None
) -> DataFrame:
    """Usable days of observation of each run: ``run_id, dam, tag_code, sp_rrt, species_code, obs_date, n_obs``.

    At ``OWN_SPECIES_DAMS`` a run uses the tags of its own species, all year; elsewhere those of every compiled
    species but autumn Chinook.
    """
    kept = observation_days(obs, seasons).filter(~marked_here(F.col("dam"), F.col("mark_site"), mark_sites))
    placed = attach_strata(kept, seasons, on=("dam", "obs_date"), carry=("species",))
    species, own = codes.species_of_srr(F.col("sp_rrt")), F.col("dam").isin(*codes.OWN_SPECIES_DAMS)
    usable = F.when(own, is_true(species == F.col("species"))).otherwise(
        usable_season(species, F.col("obs_date"), chinook_until)
    )
    code = species_code(F.col("sp_rrt")).alias("species_code")
    return placed.filter(usable).select("run_id", "dam", "tag_code", "sp_rrt", code, "obs_date", "n_obs")


def trap_by_run(trap: DataFrame, seasons: Seasons) -> DataFrame:
    """Trap records of the dam in each run's season, all species: ``run_id, week_num, date, tag_code, species_code, n``.

    Counted per dam, day, code and tag before they are multiplied by the runs of their dam.
    """
    code = species_code(F.col("srr")).alias("species_code")
    counted = trap.groupBy("dam", "date", code, "tag_code").agg(F.count("*").alias("n"))
    placed = attach_strata(counted, seasons, on=("dam", "date"))
    return placed.select("run_id", "week_num", "date", "tag_code", "species_code", "n")


def trap_weeks(trap: DataFrame, seasons: Seasons) -> DataFrame:
    """Fish in the trap per run, stratum and species/run code."""
    weeks = trap_by_run(trap, seasons).groupBy("run_id", "week_num", "species_code")
    return weeks.agg(F.sum("n").alias("n_fish"))


def known_species_only(obs: DataFrame, weeks: DataFrame) -> DataFrame:
    """Observations whose species/run code was also trapped in that run, by the table of ``trap_weeks``.

    Not asked for at ``OWN_SPECIES_DAMS``. The observations are days per tag by then.
    """
    seen = weeks.groupBy("run_id", "species_code").agg(F.lit(True).alias("trapped"))
    joined = obs.join(seen, ["run_id", "species_code"], "left")
    return joined.filter(F.col("dam").isin(*codes.OWN_SPECIES_DAMS) | F.col("trapped")).drop("trapped")


def trap_tag_days(trap: DataFrame, dedupe: bool = True) -> DataFrame:
    """Trap records per tag: ``run_id, tag_code, trap_date, n_records``.

    Collapsed before any join, so a tag recorded over and over costs one row per day. ``dedupe`` keeps the earliest
    record of a tag only.
    """
    tagged = trap.filter(F.col("tag_code").isNotNull())
    if dedupe:
        first = tagged.groupBy("run_id", "tag_code").agg(F.min("date").alias("trap_date"))
        return first.withColumn("n_records", F.lit(1).cast("long"))
    per_day = tagged.groupBy("run_id", "tag_code", F.col("date").alias("trap_date"))
    return per_day.agg(F.sum("n").alias("n_records"))


def match_to_trap(first_obs: DataFrame, tag_days: DataFrame) -> DataFrame:
    """Each first observation with the trap records of its tag, dated by the trap where there is one."""
    return first_obs.join(tag_days, ["run_id", "tag_code"], "left").select(
        "run_id", "tag_code", "sp_rrt", "obs_date", "trap_date",
        F.coalesce("n_records", F.lit(0)).alias("n_in_trap"),
        F.lit(1).cast("long").alias("n_obs"),
        F.coalesce("trap_date", "obs_date").alias("mod_date"),
    )


def rate_by_week(matched: DataFrame, seasons: Seasons, supplied: DataFrame | None = None) -> DataFrame:
    """``n_trap_tags, n_poss_tags, trap_rate, trap_rate_se, trap_rate_cv`` per run and stratum.

    Counted per tag first; that step runs on the partitioning of the tag join. ``supplied`` strata stand in for the run's own.
    """
    on = ("run_id", "mod_date")
    placed = attach_strata(matched, seasons, on) if supplied is None else attach_supplied(matched, seasons, supplied, on)
    per_tag = placed.groupBy("run_id", "week_num", "tag_code").agg(F.sum("n_in_trap").alias("n_in_trap"))
    counted = per_tag.groupBy("run_id", "week_num").agg(
        F.sum("n_in_trap").alias("n_trap_tags"), F.count("*").alias("n_poss_tags")
    )
    return with_rate_error(counted)


def with_rate_error(counted: DataFrame) -> DataFrame:
    """Rate, standard error and coefficient of variation from ``n_trap_tags`` and ``n_poss_tags``."""
    rate = F.col("trap_rate")
    return (
        counted.withColumn("trap_rate", ratio(F.col("n_trap_tags"), F.col("n_poss_tags")))
        .withColumn("trap_rate_se", not_nan(F.sqrt(ratio(rate * (1 - rate), F.col("n_poss_tags")))))
        .withColumn("trap_rate_cv", ratio(F.col("trap_rate_se"), rate))
    )


def rate_from_tags(
    obs: DataFrame,
    trap: DataFrame,
    seasons: Seasons,
    dedupe: bool = True,
    chinook_until: str = "month_8",
    mark_sites: dict | None = None,
    weeks: DataFrame | None = None,
    supplied: DataFrame | None = None,
) -> DataFrame:
    """Weekly trap rate of every run from tags seen at the dam and, possibly, in its trap.

    Adds the first day of the stratum, ``trap_open``, ``few_tags`` and the provisional ``trap_valid``. ``weeks`` is
    the table of ``trap_weeks`` where it is there already, ``supplied`` are strata to use in place of the runs' own.
    """
    weeks = weeks if weeks is not None else trap_weeks(trap, seasons)
    usable = known_species_only(observations_by_run(obs, seasons, chinook_until, mark_sites), weeks)
    matched = match_to_trap(first_observations(usable), trap_tag_days(trap_by_run(trap, seasons), dedupe))
    weekly = rate_by_week(matched, seasons, supplied)
    starts = (supplied if supplied is not None else strata(seasons)).select("run_id", "week_num", "start_date")
    return (
        weekly.join(starts, ["run_id", "week_num"])
        .withColumn("trap_open", F.col("n_trap_tags") > 0)
        .withColumn("few_tags", F.col("n_poss_tags") < MIN_TAGS)
        .withColumn("trap_valid", ~F.col("few_tags") & F.col("trap_open"))
    )


def legacy_rate_from_tags(
    obs: DataFrame,
    trap: DataFrame,
    seasons: Seasons,
    mark_sites: tuple[str, ...] = codes.TRAP_MARK_SITES["LWG"],
    supplied: DataFrame | None = None,
) -> DataFrame:
    """The older estimate: counts observations rather than first observations.

    Tags ever seen with the trap's mark site are removed from both sides, all other tags are joined fully, and a
    record counts where there is an observation. A trapped tag is dated by its trap days, each record counting
    once for every observation of the tag, so the pairs are a product of two numbers and are never made.
    ``supplied`` strata stand in for the runs' own.
    """
    known = within_season(obs, seasons, "obs_time")
    seen = known.select("dam", "tag_code", "sp_rrt", "mark_site", F.to_date("obs_time").alias("mod_date"))
    seen = seen.filter(usable_season(codes.species_of_srr(F.col("sp_rrt")), F.col("mod_date"))).select(
        "dam", "tag_code", "mod_date", F.lit(1).alias("n_obs"), F.lit(0).alias("n_records"),
        is_true(F.col("mark_site").isin(*mark_sites)).alias("own"),
    )
    caught = within_season(trap, seasons).select(
        "dam", "tag_code", F.col("date").alias("mod_date"), F.lit(0).alias("n_obs"), F.lit(1).alias("n_records"),
        F.lit(False).alias("own"),
    )
    counts = ("n_obs", "n_records")
    days = seen.unionByName(caught).filter(F.col("tag_code").isNotNull()).groupBy("tag_code", "dam", "mod_date").agg(
        *[F.sum(c).alias(c) for c in counts], F.max("own").alias("own")
    )
    # A row per tag and day from here on, and only tags observed at their dam are multiplied by its runs.
    observed = F.sum("n_obs").over(Window.partitionBy("tag_code", "dam")) > 0
    days = days.withColumn("observed", observed).filter("observed").drop("observed")
    placed = attach_strata(days, seasons, on=("dam", "mod_date"))
    tag = Window.partitionBy("tag_code", "dam", "run_id")
    of_tag = placed.withColumns(
        {"total": F.sum("n_obs").over(tag), "records": F.sum("n_records").over(tag), "own": F.max("own").over(tag)}
    )
    counted = F.when(F.col("records") > 0, F.col("n_records") > 0).otherwise(F.col("n_obs") > 0)
    matched = of_tag.filter((F.col("total") > 0) & ~F.col("own") & counted).select(
        "run_id", "tag_code", "mod_date", (F.col("total") * F.col("n_records")).alias("n_in_trap")
    )
    return rate_by_week(matched, seasons, supplied)


def trap_open_override(rate: DataFrame, weeks: DataFrame) -> DataFrame:
    """Weeks with fish in the trap were open, weeks of unknown state were not; fish-only weeks are added."""
    fish = weeks.groupBy("run_id", "week_num").agg(F.sum("n_fish").alias("n_fish"))
    joined = rate.join(fish, ["run_id", "week_num"], "full")
    return joined.withColumn(
        "trap_open", F.when(F.col("n_fish") > 0, F.lit(True)).otherwise(is_true(F.col("trap_open")))
    ).drop("n_fish")


def weighted_mean(x: Column, weight: Column) -> Column:
    known = x.isNotNull()
    return ratio(F.sum(F.when(known, x * weight)), F.sum(F.when(known, weight)))


def reported_daily(
    rates: DataFrame,
    sums: tuple[str, ...],
    means: tuple[str, ...],
    keys: tuple[str, ...] = ("dam", "species", "date", "year", "doy"),
    weight: str = "total_time",
) -> DataFrame:
    """One row per day from reports that may split a day: sums, and means weighted by fishing time.

    ``sums`` must hold ``total_time`` and ``total_time_inclusive``. The trap has two flumes, hence twice a day's
    seconds below the calculated rate.
    """
    daily = rates.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *[weighted_mean(F.col(c), F.col(weight)).alias(c) for c in means],
    )
    return (
        daily.withColumn("seconds_in_day", F.lit(FLUMES * SECONDS_PER_DAY))
        .withColumn("trap_open", F.col("total_time") > 0)
        .withColumn("rate_calc", F.col("total_time_inclusive") / F.col("seconds_in_day"))
    )


def reported_weekly(
    daily: DataFrame,
    seasons: Seasons,
    sums: tuple[str, ...],
    means: tuple[str, ...],
    split_years: bool = False,
    supplied: DataFrame | None = None,
) -> DataFrame:
    """Weekly sums and unweighted means of the daily reports per run and stratum.

    A stratum that crosses New Year stays whole; ``split_years`` cuts it in two. The length of a stratum is one
    second short of its days, as its end is the last second of its last day. ``supplied`` strata stand in for the
    runs' own.
    """
    keys = ["run_id", "week_num", *(["year"] if split_years else [])]
    placed = attach_strata(daily, seasons) if supplied is None else attach_supplied(daily, seasons, supplied)
    days = F.datediff("end_date", "start_date") + 1
    length = (strata(seasons) if supplied is None else supplied).select(
        "run_id", "week_num", (days * SECONDS_PER_DAY - 1).alias("seconds_in_week")
    )
    return (
        placed.groupBy(*keys)
        .agg(
            F.min("date").alias("start_date"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
            *[F.avg(c).alias(c) for c in means],
            is_true(F.bool_or("trap_open")).alias("trap_open"),
        )
        .join(length, ["run_id", "week_num"])
        .withColumn("calc_rate", F.col("total_time_inclusive") / F.col("seconds_in_week"))
    )


def adopt_reported_rate(weekly: DataFrame, seasons: Seasons) -> DataFrame:
    """Takes the reported rate as the trap rate, with the run's constant coefficient of variation as its error."""
    cv = seasons.frame.select("run_id", F.col("trap_rate_cv").alias("cv"))
    return (
        weekly.drop("trap_rate", "trap_rate_se", "trap_open")
        .join(cv, "run_id")
        .withColumn("trap_rate", F.col("actual_rate_inclusive_time"))
        .withColumn("trap_rate_se", F.col("trap_rate") * F.col("cv"))
        .withColumn("trap_open", F.col("trap_rate") > 0)
        .drop("cv")
    )
