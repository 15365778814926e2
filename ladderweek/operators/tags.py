"""Daily summary of tag detections at a ladder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.config import Seasons
from ladderweek.functions import codes
from ladderweek.functions.expressions import is_true, spawn_year
from ladderweek.operators.strata import attach_strata
from ladderweek.session import shuffle_tasks

TAG_COUNTS = (
    "tot_tags", "day_tags", "reascent_tags",
    "tot_tags_w", "day_tags_w", "reascent_tags_w",
    "tot_tags_h", "day_tags_h", "reascent_tags_h",
)


def effective_period(dam: Column, period: Column) -> Column:
    """Every passage is a day passage at dams without night counts; elsewhere only D and N are known periods."""
    return F.when(dam.isin(*codes.DAMS_WITHOUT_NIGHT_COUNTS), F.lit("D")).otherwise(
        F.when(period.isin("D", "N"), period)
    )


def tag_flags() -> dict[str, Column]:
    """What a detection shows of its tag, by the name of the count (0 or 1)."""
    day = F.col("period") == "D"
    again = is_true(F.col("ascent_count") > 1)
    done = {"tot_tags": F.lit(True), "day_tags": day, "reascent_tags": again}
    reared = {"": F.lit(True), "_w": F.col("rear_type") == "W", "_h": F.col("rear_type") == "H"}
    return {
        f"{name}{rear}": F.coalesce(cond & who, F.lit(False)).cast("int")
        for rear, who in reared.items()
        for name, cond in done.items()
    }


def tag_counts_by(detections: DataFrame, keys: list[str], dealt: bool = False) -> DataFrame:
    """The nine distinct-tag counts per ``keys``.

    Two aggregations: first what each tag did within its key, a bit for each count, then sums of bits. A day with very
    many detections is spread over its tags, and no distinct-expansion of the input is needed. NULL tags are not counted.
    With ``dealt`` detections are dealt to tasks by key and tag before the first: where a tag is seen about once a day, tables of
    single tags are not worth making on either side.
    """
    flags = tag_flags()
    shown = reduce(Column.bitwiseOR, [F.shiftleft(flags[name], i) for i, name in enumerate(TAG_COUNTS)])
    needed = detections.filter(F.col("tag_id").isNotNull()).select(*keys, "tag_id", shown.alias("shown"))
    if dealt:
        needed = needed.repartition(shuffle_tasks(needed), *keys, "tag_id")
    per_tag = needed.groupBy(*keys, "tag_id").agg(F.bit_or("shown").alias("shown"))
    counts = [F.sum(F.getbit("shown", F.lit(i))).alias(name) for i, name in enumerate(TAG_COUNTS)]
    return per_tag.groupBy(*keys).agg(*counts)


def tag_daily(detections: DataFrame) -> DataFrame:
    """Per ``species, spawn_year, date``: tags seen, seen by day, re-ascending; all, wild and hatchery."""
    dated = detections.withColumn("spawn_year", spawn_year(F.col("species"), F.col("year"), F.col("date")))
    known = dated.withColumn("period", F.when(F.col("period").isin("D", "N"), F.col("period")))
    return tag_counts_by(known, ["species", "spawn_year", "date"])


def tag_daily_by_run(detections: DataFrame, seasons: Seasons) -> DataFrame:
    """The same counts per ``run_id, week_num, date``, with the period override of dams without night counts."""
    needed = detections.select("dam", "species", "date", "tag_id", "rear_type", "period", "ascent_count")
    placed = attach_strata(needed, seasons).withColumn("period", effective_period(F.col("dam"), F.col("period")))
    return tag_counts_by(placed, ["run_id", "week_num", "date"])
