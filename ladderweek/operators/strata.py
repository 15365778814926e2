"""Weekly strata, and the stratum of a date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.config import Seasons


def shapes(runs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """What the strata of a run follow from: ``run_id, carry, first, last, aligned, head, n, merged``.

    Strata begin on ``strata_beg`` (on the first day of the season where NULL). A last stratum of at most
    ``last_strata_min`` days joins the one before, then such a first stratum joins the one after it.
    """
    first, last, limit = F.col("first"), F.col("last"), F.col("last_strata_min")
    aligned = F.coalesce(F.expr("next_day(date_sub(start_date, 1), strata_beg)"), F.col("start_date"))
    base = runs.select(
        "run_id", *carry, "last_strata_min", F.col("start_date").alias("first"), F.col("end_date").alias("last"),
        aligned.alias("aligned"),
    )
    # Stratum 0 starts on the first day; a partial one before the chosen weekday is the "head". No stratum starts
    # on the last day of a season.
    head = ((F.col("aligned") > first) & (first < last)).cast("int")
    weeks = F.greatest(F.lit(0), F.ceil(F.datediff(last, "aligned") / 7).cast("int"))
    sized = base.select("*", head.alias("head"), F.greatest(F.lit(1), head + weeks).alias("n"))
    tail_days = F.datediff(last, _start_of(F.col("n") - 1)) + 1
    kept = F.col("n") - ((F.col("n") > 1) & (tail_days <= limit)).cast("int")
    merged = (kept > 1) & (F.datediff(_start_of(F.lit(1)), first) <= limit)
    return sized.select(
        "run_id", *carry, "first", "last", "aligned", "head", kept.alias("n"), merged.cast("int").alias("merged")
    )


def _start_of(k: Column) -> Column:
    return F.when(k == 0, F.col("first")).otherwise(F.date_add("aligned", (k - F.col("head")) * 7))


def weekly_strata(runs: DataFrame) -> DataFrame:
    """One row per run and stratum: ``run_id, week_num, start_date, end_date, n_days``.

    Plain date arithmetic per run and one explode: no shuffle, no window.
    """
    cut = shapes(runs).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("merged") - 1)).alias("pos"))
    this, following = F.col("pos"), F.col("pos") + 1 + F.col("merged")
    start = F.when(this == 0, F.col("first")).otherwise(_start_of(this + F.col("merged")))
    end = F.when(following < F.col("n"), F.date_sub(_start_of(following), 1)).otherwise(F.col("last"))
    return cut.select(
        "run_id", (this + 1).alias("week_num"), start.alias("start_date"), end.alias("end_date"),
    ).withColumn("n_days", F.datediff("end_date", "start_date") + 1)


def week_of(day: Column, prefix: str = "") -> Column:
    """Number of the stratum a day of the season lies in, by the columns of ``shapes``."""
    aligned, head, n, merged = (F.col(prefix + c) for c in ("aligned", "head", "n", "merged"))
    raw = F.when((head == 1) & (day < aligned), F.lit(0)).otherwise(
        head + F.floor(F.datediff(day, aligned) / 7).cast("int")
    )
    within = F.greatest(F.lit(0), F.least(raw, n - 1))
    return F.greatest(F.lit(0), within - merged) + 1


@lru_cache(maxsize=16)
def strata(seasons: Seasons) -> DataFrame:
    return weekly_strata(seasons.frame)


def within_season(facts: DataFrame, seasons: Seasons, date_col: str = "date") -> DataFrame:
    """Literal bounds on a date or timestamp column, so that the scan below can prune."""
    column, beyond = F.col(date_col), seasons.last_day + dt.timedelta(days=1)
    as_type = facts.schema[date_col].dataType.simpleString()
    return facts.filter((column >= F.lit(seasons.first_day).cast(as_type)) & (column < F.lit(beyond).cast(as_type)))


def run_years(seasons: Seasons, carry: tuple[str, ...], series: Column | None = None) -> DataFrame:
    """A row per run and calendar year it touches, with the shape of its strata; ``series`` multiplies it further."""
    shaped = shapes(seasons.frame, carry)
    if series is not None:
        shaped = shaped.withColumn("series", F.explode(series))
    years = F.explode(F.sequence(F.year("first"), F.year("last"))).alias("run_year")
    return shaped.select("*", years)


#: Columns of ``run_years`` that only place a fact; they carry a mark while they stand beside a fact's own.
SHAPE = ("first", "last", "aligned", "head", "n", "merged", "run_year")
MARK = "run__"


def attach_strata(
    facts: DataFrame,
    seasons: Seasons,
    on: tuple[str, ...] = ("dam", "species", "date"),
    carry: tuple[str, ...] = (),
    series: Column | None = None,
) -> DataFrame:
    """Give every fact its run and stratum, and the run's ``carry`` columns.

    The last of ``on`` is the date. An equi-join with the runs, one row per run and year, on the other keys and the year;
    the season's bounds are checked in the join, and the stratum is worked out from the date. Runs are so
    few that the optimizer broadcasts them by its own measure. Facts outside every season drop out; a fact that belongs to
    several runs appears once in each. ``series`` lists the values of ``species`` that a run reads, if not its own.
    """
    *keys, day = on
    dated = within_season(facts, seasons, day)
    kept = tuple(k for k in (*keys, *carry) if k != "run_id" and not (series is not None and k == "species"))
    extra = ("species", "unclipped_only", "incl_jacks") if series is not None else ()
    runs = run_years(seasons, tuple(dict.fromkeys((*kept, *extra))), series)
    if series is not None:
        runs = runs.drop(*[c for c in extra if c not in kept]).withColumnRenamed("series", "species")
    hidden = [c for c in runs.columns if c in keys or c in SHAPE]
    named = runs.select(*[F.col(c).alias(MARK + c) if c in hidden else F.col(c) for c in runs.columns])
    same = F.year(dated[day]) == F.col(MARK + "run_year")
    for k in keys:
        same = same & (dated[k] == F.col(MARK + k))
    inside = (dated[day] >= F.col(MARK + "first")) & (dated[day] <= F.col(MARK + "last"))
    joined = dated.join(named, same & inside).withColumn("week_num", week_of(F.col(day), MARK))
    return joined.drop(*[MARK + c for c in hidden])


#: Day ranges of an interval index: 1, 16, 256 and 4096 days long, each beginning at a multiple of its length.
RANGE_BITS = 4
RANGE_LEVELS = 4


def _range_of(level: int) -> Callable[[Column], Column]:
    return lambda at: F.struct(F.lit(level).alias("range_level"), at.alias("range_at"))


def day_ranges(intervals: DataFrame, first: str = "start_date", last: str = "end_date") -> DataFrame:
    """The intervals, a row per day range they are cut into: ``range_level, range_at``.

    The ranges of an interval do not overlap and leave no day out, so a date meets at most one of them. A longer range
    is used wherever a whole one fits; an interval of n days has in the order of log(n) of them. Intervals without a
    bound, or that end before they start, have none.
    """
    empty = F.array().cast("array<bigint>")
    cut = intervals.withColumns({"range_lo": F.unix_date(first).cast("long"), "range_hi": F.unix_date(last).cast("long") + 1})
    until = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(empty)
    listed = []
    for level in range(RANGE_LEVELS):
        lo, hi, name = F.col("range_lo"), F.col("range_hi"), f"ranges_{level}"
        up = F.shiftright(lo + (1 << RANGE_BITS) - 1, RANGE_BITS)
        down = F.shiftright(hi, RANGE_BITS)
        longer = (up < down) if level < RANGE_LEVELS - 1 else F.lit(False)
        ends = F.concat(until(lo, F.shiftleft(up, RANGE_BITS)), until(F.shiftleft(down, RANGE_BITS), hi))
        cut = cut.withColumn(name, F.when(longer, ends).otherwise(until(lo, hi)))
        cut = cut.withColumns(
            {"range_lo": F.when(longer, up).otherwise(F.lit(0)), "range_hi": F.when(longer, down).otherwise(F.lit(0))}
        )
        listed.append(F.transform(name, _range_of(level)))
    return cut.select(*[intervals[c] for c in intervals.columns], F.inline(F.concat(*listed)))


def attach_intervals(facts: DataFrame, intervals: DataFrame, keys: dict[str, str], day: str) -> DataFrame:
    """Every fact once per interval its day lies in, with the interval's columns.

    ``keys`` names the facts' columns and the intervals' columns that must agree. Intervals may overlap, leave gaps and be of any
    length; the join is on equality of keys and day range, never a comparison of dates.
    """
    number = F.unix_date(F.col(day).cast("date")).cast("long")
    levels = [
        F.struct(F.lit(k).alias("fact_level"), F.shiftright(number, k * RANGE_BITS).alias("fact_at"))
        for k in range(RANGE_LEVELS)
    ]
    placed = facts.select("*", F.inline(F.array(*levels)))
    pieces = day_ranges(intervals)
    same = (placed["fact_level"] == pieces["range_level"]) & (placed["fact_at"] == pieces["range_at"])
    for of_fact, of_interval in keys.items():
        same = same & (placed[of_fact] == pieces[of_interval])
    return placed.join(pieces, same).drop("fact_level", "fact_at", "range_level", "range_at")


def attach_supplied(
    facts: DataFrame,
    seasons: Seasons,
    supplied: DataFrame,
    on: tuple[str, ...] = ("dam", "species", "date"),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``attach_strata`` for strata that the caller gives: ``run_id, week_num, start_date, end_date`` of any shape.

    A fact in several strata of a run appears in each, one in none drops out.
    """
    *keys, day = on
    own = [k for k in keys if k != "run_id"]
    runs = seasons.frame.select("run_id", *dict.fromkeys((*own, *carry)))
    strata_of = supplied.select("run_id", "week_num", "start_date", "end_date").join(runs, "run_id")
    named = strata_of.select(*[F.col(c).alias(MARK + c) for c in strata_of.columns]).withColumnsRenamed(
        {MARK + "start_date": "start_date", MARK + "end_date": "end_date"}
    )
    met = attach_intervals(facts, named, {k: MARK + k for k in keys}, day)
    new = [c for c in ("run_id", "week_num", *carry) if c not in keys]
    return met.select(*facts.columns, *[F.col(MARK + c).alias(c) for c in new])


def outside_strata(facts: DataFrame, seasons: Seasons, on: tuple[str, ...] = ("dam", "species", "date")) -> DataFrame:
    """How many facts no stratum covers, per dam: ``dam, n_outside``."""
    *keys, day = on
    runs = run_years(seasons, tuple(keys))
    named = runs.select(*[F.col(c).alias(MARK + c) for c in ("first", "last", "run_year", *keys)])
    same = F.year(facts[day]) == F.col(MARK + "run_year")
    same = same & facts[day].between(F.col(MARK + "first"), F.col(MARK + "last"))
    for k in keys:
        same = same & (facts[k] == F.col(MARK + k))
    return facts.join(named, same, "left_anti").groupBy("dam").agg(F.count("*").alias("n_outside"))
