"""The weekly table a passage model is fitted to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.functions.expressions import is_true


def _origins(by: str) -> dict[str, Column]:
    if by == "PBT":
        return {"wild": F.col("wild_pbt"), "hnc": F.col("hnc_pbt"), "hatch": F.col("hatch_pbt")}
    if by == "Morph":
        return {"wild": F.col("wild_morph"), "hnc": F.lit(0).cast("long"), "hatch": F.col("hatch_morph")}
    raise ValueError(f"origins_by must be 'PBT' or 'Morph', not {by!r}")


def _at_most(part: Column, whole: Column) -> Column:
    return F.when(part > whole, whole).otherwise(part)


def origin_exists(weekly: DataFrame, origins_by: str = "PBT") -> DataFrame:
    """Per run whether any fish of each origin was trapped (0/1)."""
    flags = [
        (F.coalesce(F.sum(c), F.lit(0)) > 0).cast("int").alias(f"{name}_exist")
        for name, c in _origins(origins_by).items()
    ]
    return weekly.groupBy("run_id").agg(*flags)


def model_input(
    weekly: DataFrame, origins_by: str = "PBT", wild_tags: bool = False, b_run: bool = False
) -> DataFrame:
    """One row per run and week with the observations of the model; NULL marks what it must not use.

    Negative window counts become 0. Tags by day and re-ascending never exceed all tags, and are unknown while the
    ladder (with ``wild_tags``: the trap) is shut.
    """
    origin = _origins(origins_by)
    trap_used = is_true(F.col("trap_open")) & is_true(F.col("trap_valid"))
    ladder_open = is_true(F.col("window_open")) | is_true(F.col("trap_open"))
    counted = is_true(F.col("trap_open")) if wild_tags else ladder_open
    suffix = "_w" if wild_tags else ""
    total = F.col(f"tot_tags{suffix}")
    window = F.when(F.col("win_cnt") < 0, F.lit(0)).otherwise(F.col("win_cnt"))
    per_run = Window.partitionBy("run_id")
    fish = {f"{name}_fish": c for name, c in origin.items()}
    rows = weekly.select(
        "run_id", "week_num",
        ladder_open.cast("int").alias("ladder"),
        F.when(F.col("window_open"), window).alias("y_window"),
        F.when(trap_used, F.col("trap_fish")).alias("y_trap"),
        *[c.cast("long").alias(name) for name, c in fish.items()],
        F.when(trap_used & F.col("n_poss_tags").isNotNull(), F.col("n_trap_tags")).alias("n_trap_tags"),
        F.coalesce("n_poss_tags", F.lit(0)).alias("n_poss_tags"),
        F.coalesce(total, F.lit(0)).alias("tot_tags"),
        F.when(counted, _at_most(F.col(f"reascent_tags{suffix}"), total)).alias("reasc_tags"),
        F.when(counted, _at_most(F.col(f"day_tags{suffix}"), total)).alias("dc_tags"),
        *([F.col("tot_b_run_sthd").alias("b_trap")] if b_run else []),
    )
    summed = F.col("wild_fish") + F.col("hnc_fish") + F.col("hatch_fish")
    exist = {
        f"{name}_exist": (F.coalesce(F.sum(f"{name}_fish").over(per_run), F.lit(0)) > 0).cast("int") for name in origin
    }
    return rows.withColumns(
        {
            "trap_fish": summed,
            "trap_fish_matrix": F.array("wild_fish", "hnc_fish", "hatch_fish"),
            **exist,
            "tot_ladder_weeks": F.count("*").over(per_run),
        }
    )


def log_window(model_rows: DataFrame) -> DataFrame:
    """Adds the log of the window count for the log-space model; weeks without fish have none."""
    return model_rows.withColumn("y_window_log", F.when(F.col("y_window") > 0, F.ln("y_window")))
