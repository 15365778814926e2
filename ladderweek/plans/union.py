"""The weekly table out of two unions of all records, one by day and one by tag.

Detections and trap records are counted by dam and day, trapped and observed tags by dam, tag and day, and tags with the same
records by these, before they are multiplied by the runs of their dam. What is left is placed on runs and strata, as rows of one shape with a mark of their source. Rows that
tell of days are rolled up together by day and by week, rows that tell of tags by tag and by week, and both meet by run. The only
joins are with the table of runs; every source is read once, trap records once by each union.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.config import Seasons
from ladderweek.functions import codes
from ladderweek.functions.expressions import is_true, ratio
from ladderweek.operators import tags, trap, trap_rate, window_counts
from ladderweek.operators.rollup import Audit
from ladderweek.operators.strata import attach_strata, within_season
from ladderweek.session import shuffle_tasks

# Marks of the sources.
WINDOW, DETECTED, TRAPPED, REPORTED, TRAP_TAG, OBSERVED = range(6)
DAY_KEYS = {"run_id": "string", "source": "int", "week_num": "int", "date": "date", "code": "string"}
TAG_KEYS = ("tag", "dam", "run_id", "source", "week_num", "code")


def _rows(placed: DataFrame, source: int, keys: dict[str, str], **columns: Column) -> DataFrame:
    """Rows of a common shape: keys that a source lacks are NULL, and other columns are what it is reduced to."""
    given = {"source": F.lit(source), "run_id": F.col("run_id"), **columns}
    named = [given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in keys.items()]
    return placed.select(*named, *[c.alias(name) for name, c in columns.items() if name not in keys])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# ---- rows by day --------------------------------------------------------------------------------------------


def window_rows(counts: DataFrame, seasons: Seasons, legacy_open: bool = False) -> DataFrame:
    placed = attach_strata(counts, seasons, carry=("incl_jacks",), series=window_counts.run_series())
    is_jack = F.col("species").startswith("Jack_")
    return _rows(
        placed, WINDOW, DAY_KEYS, week_num=F.col("week_num"), date=F.col("date"),
        adults=F.when(~is_jack, F.col("win_cnt")).cast("double"), jacks=F.when(is_jack, F.col("win_cnt")).cast("double"),
        with_jacks=F.col("incl_jacks").cast("int"),
        listed_open=(F.col("incl_jacks") & F.lit(legacy_open)).cast("int"),
    )


def detection_rows(detections: DataFrame, seasons: Seasons) -> DataFrame:
    """The tag counts of a day. A run has one dam and species, so they are counted by these, and tags stay behind."""
    needed = detections.select("dam", "species", "date", "tag_id", "rear_type", "period", "ascent_count")
    needed = needed.withColumn("period", tags.effective_period(F.col("dam"), F.col("period")))
    counted = tags.tag_counts_by(within_season(needed, seasons), ["dam", "species", "date"], dealt=True)
    placed = attach_strata(counted, seasons)
    counts = {c: F.col(c) for c in ("week_num", "date", *tags.TAG_COUNTS)}
    return _rows(placed, DETECTED, DAY_KEYS, **counts)


def trap_day_rows(cohort: DataFrame, seasons: Seasons, strict_null: bool = False) -> DataFrame:
    """All fish of the trap (``n_fish``), the counts of the run's own, and the species/run codes among all.

    Counted by dam, day and what a run or its codes look at before the fish are multiplied by the runs of their dam.
    """
    conditions = trap.trap_conditions()
    if strict_null:
        conditions |= {f"unsure_{name}": cond.isNull() for name, cond in conditions.items()}
    alike = within_season(cohort, seasons).groupBy("dam", "date", "species", "ad_clip", "srr").agg(
        F.count("*").alias("n_fish"), *[F.count_if(cond).alias(name) for name, cond in conditions.items()]
    )
    named = alike.withColumnRenamed("species", "fish_species")
    placed = attach_strata(named, seasons, on=("dam", "date"), carry=("species", "unclipped_only", "b_run"))
    own = is_true((F.col("fish_species") == F.col("species")) & (~F.col("unclipped_only") | ~F.col("ad_clip")))
    of_own = lambda c, asked=own: F.when(asked, F.col(c)).otherwise(F.lit(0).cast("long"))
    counted = {"n_fish": F.col("n_fish"), "trap_fish": of_own("n_fish")}
    counted |= {c: of_own(c, own & F.col("b_run") if c.endswith("tot_b_run_sthd") else own) for c in conditions}
    keys = {"week_num": F.col("week_num"), "date": F.col("date"), "code": trap_rate.species_code(F.col("srr"))}
    return _rows(placed, TRAPPED, DAY_KEYS, **keys, **counted)


def reported_rows(daily: DataFrame, seasons: Seasons) -> DataFrame:
    rate = F.col("actual_rate_inclusive_time").cast("double")
    known = rate.isNotNull().cast("long")
    return _rows(attach_strata(daily, seasons), REPORTED, DAY_KEYS, week_num=F.col("week_num"), rate_sum=rate, rate_days=known)


def rolled_days(
    parts: list[DataFrame], keep_unmatched: bool, strict_null: bool, audit: Audit | None = None
) -> DataFrame:
    """One row per run and stratum with the sums of its days, and all its fish and their codes, rates and days of rates.

    Counts are of days with a window count, or with ``keep_unmatched`` also of days with tags.
    """
    union = _union(parts)
    source, listed = F.col("source"), {"with_jacks", "listed_open"}
    numbers = [c for c in union.columns if c not in DAY_KEYS]
    once = union.groupBy(*DAY_KEYS).agg(*[(F.max if c in listed else F.sum)(c).alias(c) for c in numbers])
    days = once.groupBy("run_id", "week_num", "date").agg(
        F.max((source == WINDOW).cast("int")).alias("listed"),
        F.max((source == DETECTED).cast("int")).alias("with_tags"),
        *[(F.max if c in listed else F.sum)(c).alias(c) for c in numbers],
        F.collect_set("code").alias("fish_codes"),
    )
    missing = {c: F.lit(None).cast("double") for c in ("rate_sum", "rate_days") if c not in numbers}
    days = days.withColumns(missing) if missing else days
    counted = (F.col("listed") == 1) | ((F.col("with_tags") == 1) if keep_unmatched else F.lit(False))
    both = F.coalesce("adults", F.lit(0.0)) + F.coalesce("jacks", F.lit(0.0))
    shown = {c: F.col(c) for c in (*tags.TAG_COUNTS, *trap.TRAP_COUNTS)}
    if strict_null:
        shown |= {c: F.when(F.col(f"unsure_{c}") == 0, F.col(c)) for c in trap.TRAP_COUNTS if f"unsure_{c}" in numbers}
    shown["win_cnt"] = F.when(F.col("with_jacks") == 1, both).otherwise(F.col("adults"))
    is_open = (F.col("listed") == 1) & (F.col("adults").isNotNull() | (F.col("listed_open") == 1))
    told = days.select(
        "run_id", F.col("week_num").alias("week_num_org"), (counted & F.col("date").isNotNull()).alias("is_day"),
        "date", is_open.cast("int").alias("window_open"), "n_fish", "fish_codes", "rate_sum", "rate_days",
        *[c.alias(name) for name, c in shown.items()],
    )
    if audit is not None:
        told = audit.watch("days", told, F.col("is_day"))
    only = lambda c: F.when(F.col("is_day"), F.col(c))
    return told.groupBy("run_id", "week_num_org").agg(
        F.max(F.col("is_day").cast("int")).alias("n_days"),
        F.min(only("date")).alias("start_date"),
        *[F.sum(only(c)).alias(c) for c in shown],
        F.max(only("window_open")).alias("window_open"),
        *[F.sum(c).alias(c) for c in ("n_fish", "rate_sum", "rate_days")],
        F.array_distinct(F.flatten(F.collect_set("fish_codes"))).alias("fish_codes"),
    )


# ---- rows by tag --------------------------------------------------------------------------------------------


def tag_days(cohort: DataFrame, obs: DataFrame, seasons: Seasons, mark_sites: dict | None = None) -> DataFrame:
    """Trap records and observations of every tag that was observed: ``dam, tag, day, source, code, n``.

    What is known of a tag at a dam is dealt to one place, once. There trap records of tags never observed at their dam go
    first, before anything is counted or sorted; then the rest is counted by day and species/run/rear code, so a tag recorded
    over and over costs a row a day.
    """
    tag, tasks = F.col("tag_code").cast("string").alias("tag"), shuffle_tasks(cohort)
    caught = within_season(cohort, seasons).select("dam", tag, F.col("date").alias("day"))
    known = within_season(obs, seasons, "obs_time")
    free = known.filter(~trap_rate.marked_here(F.col("dam"), F.col("mark_site"), mark_sites)).select(
        "dam", tag, F.to_date("obs_time").alias("day"), F.col("sp_rrt").cast("string").alias("code")
    )
    dealt = lambda df: df.filter(F.col("tag").isNotNull()).repartition(tasks, "tag", "dam")
    observed = dealt(free).groupBy("tag", "dam", "day", "code").agg(F.count("*").alias("n"))
    # counted as above, so that both readings of the observations need the same columns and share one exchange
    seen = observed.select("tag", "dam").hint("shuffle_hash")
    trapped = dealt(caught).join(seen, ["tag", "dam"], "left_semi").groupBy("tag", "dam", "day").agg(F.count("*").alias("n"))
    named = lambda df, source, code: df.select(
        "dam", "tag", "day", F.lit(source).alias("source"), code.cast("string").alias("code"), "n"
    )
    return named(trapped, TRAP_TAG, F.lit(None)).unionByName(named(observed, OBSERVED, F.col("code")))


def alike_tags(days: DataFrame) -> DataFrame:
    """The rows of ``tag_days`` once for all tags that have the same at a dam, with their number ``n_alike``.

    Whatever a run makes of a tag follows from its rows, so tags with the same rows differ in name only; ``tag`` becomes a
    digest of the rows.
    """
    of_tag = Window.partitionBy("tag", "dam").orderBy("source", "day", "code")
    whole = of_tag.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    listed = days.select(
        "dam", F.collect_list(F.struct("source", "day", "code", "n")).over(whole).alias("listed"),
        F.row_number().over(of_tag).alias("nth"),
    ).filter(F.col("nth") == 1)
    alike = listed.groupBy("dam", "listed").agg(F.count("*").alias("n_alike"))
    name = F.sha2(F.to_json("listed"), 256).alias("tag")
    return alike.select("dam", name, "n_alike", F.inline("listed")).repartition(shuffle_tasks(days), "tag", "dam")


def tag_rows(days: DataFrame, seasons: Seasons, chinook_until: str = "month_8") -> DataFrame:
    """The rows of ``alike_tags`` in each run of their dam: trap records with their stratum, usable observations with theirs."""
    placed = attach_strata(days, seasons, on=("dam", "day"), carry=("species",))
    species, own = codes.species_of_srr(F.col("code")), F.col("dam").isin(*codes.OWN_SPECIES_DAMS)
    usable = F.when(own, is_true(species == F.col("species"))).otherwise(
        trap_rate.usable_season(species, F.col("day"), chinook_until)
    )
    caught, week = F.col("source") == TRAP_TAG, F.col("week_num")
    return placed.filter(caught | usable).select(
        "dam", "run_id", "tag", "n_alike", "source", "code", "n",
        F.when(caught, week).alias("week_num"), F.when(~caught, week).alias("first_week"),
    )


def rolled_tags(rows: DataFrame, dedupe: bool) -> DataFrame:
    """Tags per run, stratum and set of codes: ``tag_codes, n_tags, n_records``.

    A trapped tag counts where its trap records lie, with ``dedupe`` once at the earliest, for each code it was observed
    with; another counts for each code in the stratum where it was first observed with it. A tag stands for ``n_alike``. Grouped
    by dam and tag as ``alike_tags`` leaves them, so only the last step moves rows; lists are gathered over sorted rows, not in a
    hash table.
    """
    once = rows.groupBy(*TAG_KEYS).agg(
        F.sum("n").alias("n"), F.min("first_week").alias("first_week"), F.max("n_alike").alias("n_alike")
    )
    source = F.col("source")
    code = F.coalesce(trap_rate.species_code(F.col("code")), F.lit(""))
    record = F.struct(F.col("week_num").alias("week"), F.col("n").alias("n"))
    seen = F.struct(F.col("first_week").alias("week"), code.alias("code"))
    tag = Window.partitionBy("tag", "dam", "run_id")
    gathered = {
        "nth": F.row_number().over(tag.orderBy("source")),
        "trap_week": F.min(F.when(source == TRAP_TAG, F.col("week_num"))).over(tag),
        "observed": F.collect_list(F.when(source == OBSERVED, seen)).over(tag),
    }
    if not dedupe:
        gathered["records"] = F.collect_list(F.when(source == TRAP_TAG, record)).over(tag)
    found = once.withColumns(gathered).filter((F.col("nth") == 1) & (F.size("observed") > 0))
    entry = lambda week, names, n: F.struct(week.alias("week"), names.alias("codes"), n.alias("records"))
    every = F.sort_array("observed.code")
    if dedupe:
        caught = F.array(entry(F.col("trap_week"), every, F.lit(1).cast("long")))
    else:
        caught = F.transform("records", lambda r: entry(r["week"], every, r["n"]))
    mine = lambda week: F.sort_array(F.filter("observed", lambda o: o["week"] == week)["code"])
    free = F.transform(F.array_distinct("observed.week"), lambda week: entry(week, mine(week), F.lit(0).cast("long")))
    alone = F.array(entry(F.col("observed.week")[0], F.col("observed.code"), F.lit(0).cast("long")))
    entries = F.when(F.col("trap_week").isNotNull(), caught).when(F.size("observed") == 1, alone).otherwise(free)
    told = found.select("run_id", "n_alike", F.inline(entries))
    return told.groupBy("run_id", F.col("week").alias("week_num_org"), F.col("codes").alias("tag_codes")).agg(
        F.sum("n_alike").alias("n_tags"), F.sum(F.col("records") * F.col("n_alike")).alias("n_records")
    )


def weekly_table(
    seasons: Seasons,
    window: DataFrame,
    detections: DataFrame,
    cohort: DataFrame,
    observations: DataFrame,
    reported: DataFrame | None = None,
    keep_unmatched: bool = False,
    open_rule: str = "any_day",
    legacy_open: bool = False,
    strict_null: bool = False,
    dedupe: bool = True,
    chinook_until: str = "month_8",
    mark_sites: dict | None = None,
    audit: Audit | None = None,
) -> DataFrame:
    """Weekly sums, renumbered weeks, the run's identity, and the trap rate by the run's own source.

    The rates are those of ``trap_rate.rate_from_tags`` or ``adopt_reported_rate`` with ``trap_open_override``: NULL where
    neither tags nor reports tell one.
    """
    by_day = [
        window_rows(window, seasons, legacy_open),
        detection_rows(detections, seasons),
        trap_day_rows(cohort, seasons, strict_null),
    ]
    by_tags, by_report = seasons.of_source("pit"), seasons.of_source("reported")
    if by_report and reported is not None:
        by_day.append(reported_rows(reported, by_report))
    weeks = rolled_days(by_day, keep_unmatched, strict_null, audit)
    if by_tags:
        alike = alike_tags(tag_days(cohort, observations, by_tags, mark_sites))
        by_tag = tag_rows(alike, by_tags, chinook_until)
        weeks = weeks.unionByName(rolled_tags(by_tag, dedupe), allowMissingColumns=True)
    else:
        nothing = {"tag_codes": "array<string>", "n_tags": "long", "n_records": "long"}
        weeks = weeks.withColumns({c: F.lit(None).cast(kind) for c, kind in nothing.items()})

    run = Window.partitionBy("run_id")
    who = seasons.frame.select(
        "run_id", "dam", "species", "spawn_year", "trap_rate_dist", "trap_rate_source", F.col("trap_rate_cv").alias("cv")
    )
    coded = weeks.withColumn("trapped_codes", F.flatten(F.collect_set("fish_codes").over(run)))
    own_only = F.col("dam").isin(*codes.OWN_SPECIES_DAMS)
    usable = F.size(F.filter("tag_codes", lambda c: F.array_contains("trapped_codes", c)))
    usable = F.when(F.col("tag_codes").isNotNull(), F.when(own_only, F.size("tag_codes")).otherwise(usable))
    placed = coded.join(who.select("run_id", "dam"), "run_id").withColumn("usable", usable)
    counts = ["win_cnt", *tags.TAG_COUNTS, *trap.TRAP_COUNTS]
    counted = F.col("usable") > 0
    weekly = placed.groupBy("run_id", "week_num_org").agg(
        F.min("start_date").alias("start_date"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        is_true(F.max("window_open") == 1).alias("window_open"),
        F.max("n_days").alias("n_days"),
        F.sum(F.when(counted, F.col("n_records") * F.col("usable"))).alias("n_trap_tags"),
        F.sum(F.when(counted, F.col("n_tags"))).alias("n_poss_tags"),
        *[F.sum(c).alias(c) for c in ("n_fish", "rate_sum", "rate_days")],
    )
    weekly = weekly.filter(F.col("n_days") == 1)
    if open_rule == "positive":
        weekly = weekly.withColumn("window_open", F.col("win_cnt") > 0)
    first = F.min("week_num_org").over(run)
    weekly = weekly.withColumn("week_num", (F.col("week_num_org") - first + 1).cast("int")).join(who, "run_id")
    rated = trap_rate.with_rate_error(weekly).drop("trap_rate_cv")
    told = F.col("trap_rate_source") == "reported"
    reported_rate = ratio(F.col("rate_sum"), F.col("rate_days"))
    fished = F.when(told, reported_rate > 0).otherwise(F.col("n_trap_tags") > 0)
    rated = rated.withColumns(
        {
            "trap_rate": F.when(told, reported_rate).otherwise(F.col("trap_rate")),
            "trap_rate_se": F.when(told, reported_rate * F.col("cv")).otherwise(F.col("trap_rate_se")),
            "trap_open": is_true(fished) | is_true(F.col("n_fish") > 0),
            "few_tags": F.when(~told, F.col("n_poss_tags") < trap_rate.MIN_TAGS),
        }
    ).drop("n_days", "n_fish", "rate_sum", "rate_days", "trap_rate_source", "cv")
    return rated if audit is None else audit.watch("weeks", rated)
