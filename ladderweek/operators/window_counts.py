"""Fish-ladder window counts: series per run, and the wide and long forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.config import Seasons
from ladderweek.functions import codes
from ladderweek.operators.strata import attach_strata

PLACE_AND_DAY = ("dam", "year", "date")


def counts_wide(counts: DataFrame, series: tuple[str, ...], keys: tuple[str, ...] = PLACE_AND_DAY) -> DataFrame:
    """Long to wide, one column per series.

    A series without a row on that day is 0; a row whose count is NULL (window closed) stays NULL.
    """
    per_series = []
    for name in series:
        mine = F.col("species") == name
        seen = F.count_if(mine)
        total = F.sum(F.when(mine, F.col("win_cnt")))
        per_series.append(F.when(seen > 0, total).otherwise(F.lit(0.0)).alias(name.lower()))
    return counts.groupBy(*keys).agg(*per_series)


def counts_long(wide: DataFrame, keys: tuple[str, ...] = PLACE_AND_DAY) -> DataFrame:
    """Wide to long over every column that is not a key."""
    values = [c for c in wide.columns if c not in keys]
    return wide.unpivot(list(keys), values, "species", "win_cnt")


def merge_wide(parts: list[DataFrame], keys: tuple[str, ...] = PLACE_AND_DAY) -> DataFrame:
    """Wide tables with unequal series in one table; series columns sorted by name, absent cells NULL.

    Days on which a part knows no count at all drop out.
    """
    wide = parts[0]
    for part in parts[1:]:
        wide = wide.unionByName(part, allowMissingColumns=True)
    values = sorted(c for c in wide.columns if c not in keys)
    any_known = F.coalesce(*[F.col(c).cast("double") for c in values]).isNotNull()
    return wide.filter(any_known).groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def any_series_reported(columns: list[str]) -> Column:
    """False only where every one of the counts is NULL."""
    return F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull()


def season_series(wide: DataFrame, incl_jacks: bool = True, unclipped_only: bool = True) -> DataFrame:
    """Wide counts of a ladder to one long series per compiled species, with an open flag per day.

    Jacks join their adults, and unclipped steelhead may stand in for all steelhead. Every NULL count is 0 once
    the flag has been taken.
    """
    series = [c for c in wide.columns if c not in PLACE_AND_DAY]
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in series}
    chosen = {
        "Chinook": value["chinook"] + value["jack_chinook"] if incl_jacks else value["chinook"],
        "Coho": value["coho"] + value["jack_coho"] if incl_jacks else value["coho"],
        "Steelhead": value["wild_steelhead"] if unclipped_only else value["steelhead"],
    }
    flagged = wide.select(
        *PLACE_AND_DAY, any_series_reported(series).alias("window_open"), *[v.alias(k) for k, v in chosen.items()]
    )
    return flagged.unpivot([*PLACE_AND_DAY, "window_open"], list(chosen), "species", "win_cnt")


def run_series() -> Column:
    """The series a run counts: its adult series and, with jacks, the jack series too."""
    adult = F.when(F.col("unclipped_only"), F.lit("Wild_Steelhead")).otherwise(F.col("species"))
    jack = F.when(F.col("incl_jacks"), F.concat(F.lit("Jack_"), F.col("species")))
    return F.array_compact(F.array(adult, jack))


def window_daily(counts: DataFrame, seasons: Seasons, legacy_open: bool = False) -> DataFrame:
    """Daily window series of every run: ``run_id, week_num, date, win_cnt, window_open``.

    ``counts`` is long: ``dam, date, species, win_cnt``. With jacks, adults and jacks are added and a missing side
    counts as 0. The window is open on days whose adult count is known; ``legacy_open`` takes the flag after the
    NULLs were filled, so that with jacks each listed day is open.
    """
    matched = attach_strata(counts, seasons, carry=("incl_jacks",), series=run_series())
    is_jack = F.col("species").startswith("Jack_")
    adults = F.sum(F.when(~is_jack, F.col("win_cnt")))
    jacks = F.sum(F.when(is_jack, F.col("win_cnt")))
    zero = F.lit(0.0)
    known = F.col("incl_jacks") if legacy_open else F.lit(False)
    return (
        matched.groupBy("run_id", "week_num", "date")
        .agg(adults.alias("adults"), jacks.alias("jacks"), F.bool_or("incl_jacks").alias("incl_jacks"))
        .select(
            "run_id", "week_num", "date",
            F.when(F.col("incl_jacks"), F.coalesce("adults", zero) + F.coalesce("jacks", zero))
            .otherwise(F.col("adults")).alias("win_cnt"),
            (F.col("adults").isNotNull() | known).alias("window_open"),
        )
    )


ALL_SERIES = tuple(sorted(codes.WINDOW_CODES.values()))
