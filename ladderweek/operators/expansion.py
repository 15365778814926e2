"""Trap expansion, plausibility limits, validity and prior parameters; all row-wise on the weekly table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderweek.functions.binomial import binomial_quantile
from ladderweek.functions.expressions import is_true, not_nan, ratio
from ladderweek.session import shuffle_tasks

# Fixed value: 97.5% point of the standard normal distribution.
Z_975 = 1.959963984540054
CLOSED_ALPHA = 1e-12
CLOSED_MU = 1e-12
INVALID_MU = -25.0
MIN_RATE = 0.01


def expand_trap(weekly: DataFrame) -> DataFrame:
    """Fish in the trap divided by the trap rate, with its delta-method standard error."""
    fish, rate, se = F.col("trap_fish").cast("double"), F.col("trap_rate"), F.col("trap_rate_se")
    return (
        weekly.withColumn("trap_open", is_true(F.col("trap_open")))
        .withColumn("trap_est", F.when(F.col("trap_open"), ratio(fish, rate)))
        .withColumn("trap_est_se", not_nan(F.sqrt(se * se * F.pow(ratio(fish, rate * rate), 2))))
    )


def plausible_limits(weekly: DataFrame) -> DataFrame:
    """95% binomial limits of the fish in the trap, given the window count and the range of the trap rate.

    A week's work grows with the root of its count while its row stays as small, so weeks are dealt over the session's shuffle
    partitions by number, not by size.
    """
    weekly = weekly.repartition(shuffle_tasks(weekly))
    spread = F.col("trap_rate_se") * Z_975
    low = F.when(spread.isNotNull(), F.greatest(F.lit(0.0), F.col("trap_rate") - spread))
    high = F.when(spread.isNotNull(), F.least(F.lit(1.0), F.col("trap_rate") + spread))
    return weekly.withColumn("lower_trap_lim", binomial_quantile(F.col("win_cnt"), low, 0.025)).withColumn(
        "upper_trap_lim", binomial_quantile(F.col("win_cnt"), high, 0.975)
    )


def judge_trap(weekly: DataFrame) -> DataFrame:
    """``trap_valid``: the catch is plausible, the trap fished, and its rate is not negligible. Unknown is no."""
    fish, is_open = F.col("trap_fish"), F.col("trap_open")
    plausible = (F.col("lower_trap_lim") <= fish) & (F.col("upper_trap_lim") >= fish) & is_open
    empty_handed = is_open & (fish == 0) & (F.col("win_cnt") > 0)
    verdict = (
        F.when(~is_open, F.lit(False))
        .when(F.col("trap_rate") < MIN_RATE, F.lit(False))
        .when(empty_handed, F.lit(False))
        .otherwise(plausible)
    )
    return weekly.withColumn("trap_valid", is_true(verdict))


def beta_prior(weekly: DataFrame) -> DataFrame:
    """Beta parameters with the mean and variance of the trap rate; a flat stub where the trap tells nothing."""
    p, variance = F.col("trap_rate"), F.col("trap_rate_se") * F.col("trap_rate_se")
    alpha = (ratio(1 - p, variance) - ratio(F.lit(1.0), p)) * p * p
    alpha = F.when(alpha < 0, F.lit(0.01)).otherwise(alpha)
    beta = alpha * (ratio(F.lit(1.0), p) - 1)
    informed = F.col("trap_open") & F.col("trap_valid")
    return weekly.withColumn("trap_alpha", F.when(informed, alpha).otherwise(F.lit(CLOSED_ALPHA))).withColumn(
        "trap_beta", F.when(informed, beta).otherwise(F.lit(1.0))
    )


def logit_prior(weekly: DataFrame) -> DataFrame:
    """Logit of the trap rate and its spread. ``trap_sd`` is the usual variance formula, used as it stands.

    A closed week would get a mean near 0, but the rule for weeks that are not valid comes last and wins.
    """
    p, caught, seen = F.col("trap_rate"), F.col("n_trap_tags"), F.col("n_poss_tags")
    odds = ratio(p, 1 - p)
    mu = F.when(odds > 0, F.ln(odds))
    sd = ratio(F.lit(1.0), caught) + ratio(F.lit(1.0), seen - caught)
    informed = F.col("trap_open") & F.col("trap_valid")
    return weekly.withColumn("trap_mu", F.when(informed, mu).otherwise(F.lit(INVALID_MU))).withColumn(
        "trap_sd", F.when(informed, sd).otherwise(F.lit(0.0))
    )


PRIORS = {"beta": beta_prior, "logit": logit_prior}


def with_rate(weekly: DataFrame, rate: DataFrame) -> DataFrame:
    """Joins the weekly trap rate on run and original stratum, then expands and tests the catch."""
    named = rate.drop("start_date").withColumnRenamed("week_num", "week_num_org")
    joined = weekly.join(named, ["run_id", "week_num_org"], "left")
    return judge_trap(plausible_limits(expand_trap(joined)))


def add_trap_rate(weekly: DataFrame, rate: DataFrame, trap_rate_dist: str = "beta") -> DataFrame:
    """The weekly table with rate, expansion, limits, validity and one kind of prior."""
    if trap_rate_dist not in PRIORS:
        raise ValueError(f"trap_rate_dist must be one of {tuple(PRIORS)}, not {trap_rate_dist!r}")
    return PRIORS[trap_rate_dist](with_rate(weekly, rate))
