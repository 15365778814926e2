"""Summaries of posterior draws and the frames reports are made from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderweek.functions.expressions import calendar_week, ratio
from ladderweek.operators.draws import base_name, first_number, second_index
from ladderweek.operators.quantiles import exact_quantiles

QUANTILES = {"q2_5": 0.025, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q97_5": 0.975}

# Weekly parameter -> heading in the report tables.
REPORT_LABELS = {
    "X.all": "total",
    "X.day": "day",
    "X.night": "night",
    "X.reasc": "reascension",
    "X.new.tot": "unique_fish",
}


def posterior_summary(draws: DataFrame) -> DataFrame:
    """Mean, SD, naive standard error and quantiles per run and parameter, pooled over chains.

    ``draws`` is long: ``run_id, chain, iter, param, value``. Adds the parameter's base name, week and second index.
    """
    moments = {"mean": F.avg("value"), "sd": F.stddev_samp("value"), "n_draws": F.count("value")}
    joined = exact_quantiles(draws, ["run_id", "param"], "value", QUANTILES, moments)
    joined = joined.withColumn("naive_se", F.col("sd") / F.sqrt("n_draws"))
    param = F.col("param")
    return joined.withColumns(
        {"name": base_name(param), "week_num": first_number(param), "idx2": second_index(param)}
    )


def of_parameters(summary: DataFrame, names: list[str]) -> DataFrame:
    return summary.filter(F.col("name").isin(*names))


def strata_export(summary: DataFrame, weekly: DataFrame, param: str = "X.new.tot") -> DataFrame:
    """Weekly estimate of one parameter with its stratum, estimates rounded half to even."""
    weeks = weekly.select("run_id", "week_num", "start_date")
    joined = of_parameters(summary, [param]).join(weeks, ["run_id", "week_num"], "left")
    return joined.select(
        "run_id", F.col("week_num").alias("model_week"), "start_date",
        calendar_week(F.col("start_date")).alias("strata"),
        F.bround("mean", 0).alias("estimate"), F.col("sd").alias("se"),
        F.lit(None).cast("string").alias("collapse"),
    ).orderBy("run_id", "model_week")


def adjusted_window(win_cnt: Column, day_tags: Column, tot_tags: Column, when_unknown: str = "null") -> Column:
    """Window count raised by the share of tags that passed by day.

    Without day tags the share tells nothing: NULL, or with ``when_unknown="raw"`` the plain count.
    """
    adjusted = ratio(win_cnt, ratio(day_tags, tot_tags))
    if when_unknown == "raw":
        return F.when((tot_tags > 0) & (day_tags > 0), adjusted).otherwise(win_cnt.cast("double"))
    return adjusted


def timeseries_frame(summary: DataFrame, weekly: DataFrame, when_unknown: str = "null") -> DataFrame:
    """Estimated total passage by week next to the window count, adjusted count and trap estimate."""
    observed = weekly.select(
        "run_id", "week_num", "start_date", "win_cnt", "trap_est", "trap_valid",
        adjusted_window(F.col("win_cnt"), F.col("day_tags"), F.col("tot_tags"), when_unknown).alias("win_cnt_adj"),
        F.when(F.col("trap_valid"), F.col("trap_est")).alias("trap_est_valid"),
    )
    return of_parameters(summary, ["X.all"]).join(observed, ["run_id", "week_num"], "left").select(
        "run_id", "week_num", "start_date", *QUANTILES, "win_cnt", "win_cnt_adj", "trap_est", "trap_est_valid",
        "trap_valid",
    )


def rate_frame(summary: DataFrame, weekly: DataFrame) -> DataFrame:
    """Estimated day-passage and re-ascension rates next to the observed tag ratios."""
    observed = weekly.select(
        "run_id", "week_num", "start_date", "tot_tags",
        ratio(F.col("day_tags"), F.col("tot_tags")).alias("day_observed"),
        ratio(F.col("reascent_tags"), F.col("tot_tags")).alias("reasc_observed"),
    )
    rates = of_parameters(summary, ["day.true", "reasc.true"]).withColumn(
        "rate", F.regexp_replace("name", r"\.true$", "")
    )
    joined = rates.join(observed, ["run_id", "week_num"], "left")
    seen = F.when(F.col("rate") == "day", F.col("day_observed")).otherwise(F.col("reasc_observed"))
    return joined.select("run_id", "rate", "week_num", "start_date", *QUANTILES, "tot_tags", seen.alias("observed"))


def of_season(param: Column, prefix: str = "X.tot", others: tuple[str, ...] = ("prop.tagged",)) -> Column:
    """Whether a parameter tells of a whole season. Asked of the draws too, it spares summaries that no report shows."""
    return param.startswith(prefix) | param.isin(*others)


def season_report(summary: DataFrame, prefix: str = "X.tot", others: tuple[str, ...] = ("prop.tagged",)) -> DataFrame:
    """Parameters whose name starts with ``prefix``, and the others named, with mean and SD."""
    return summary.filter(of_season(F.col("param"), prefix, others)).select("run_id", "param", "mean", "sd")


def _plain_number(x: Column, digits: int) -> Column:
    """Thousands separators, and no trailing zero after the point."""
    return F.regexp_replace(F.format_number(F.bround(x, digits), digits), r"\.0$", "")


def _weekly_pivot(summary: DataFrame, cell: Column, weekly: DataFrame) -> DataFrame:
    mine = of_parameters(summary, list(REPORT_LABELS))
    cells = [F.max(F.when(F.col("name") == name, cell)).alias(label) for name, label in REPORT_LABELS.items()]
    table = mine.groupBy("run_id", F.col("week_num").alias("week")).agg(*cells)
    counts = weekly.select("run_id", F.col("week_num").alias("week"), "win_cnt")
    return table.join(counts, ["run_id", "week"], "left").select(
        "run_id", "week", "win_cnt", *REPORT_LABELS.values()
    )


def weekly_points(summary: DataFrame, weekly: DataFrame) -> DataFrame:
    """Rounded means of the weekly quantities, one column each, with the window count."""
    return _weekly_pivot(summary, F.bround("mean", 0), weekly)


def weekly_report(summary: DataFrame, weekly: DataFrame) -> DataFrame:
    """The same table with cells such as ``1,234 (56.7)``."""
    cell = F.concat(_plain_number(F.col("mean"), 0), F.lit(" ("), _plain_number(F.col("sd"), 1), F.lit(")"))
    return _weekly_pivot(summary, cell, weekly)
