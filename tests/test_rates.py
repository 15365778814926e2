import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ladderweek import Run, Seasons
from ladderweek.functions.binomial import binomial_quantile
from ladderweek.operators import expansion, tags, trap, trap_rate, window_counts
from ladderweek.plans import compile as plan
from ladderweek.plans import model_input as model
from ladderweek.plans import union
from ladderweek.sources import records

D = dt.date
START = D(2019, 3, 4)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def brute_quantile(n, p, q):
    total = 0.0
    for k in range(n + 1):
        log_term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        total += math.exp(log_term + k * math.log(p) + (n - k) * math.log1p(-p))
        if total >= q:
            return k
    return n


def quantiles_of(spark, cases):
    df = spark.createDataFrame([(i, float(n), p) for i, (n, p, _) in enumerate(cases)], "i int, n double, p double")
    out = {}
    for q in {q for _, _, q in cases}:
        out |= {(r.i, q): r.k for r in df.select("i", binomial_quantile(F.col("n"), F.col("p"), q).alias("k")).collect()}
    return [out[i, q] for i, (_, _, q) in enumerate(cases)]


def test_binomial_goldens(spark):
    nan = float("nan")
    cases = [(5000, 0.17, 0.025), (5000, 0.17, 0.975), (10, 0.0, 0.5), (10, 1.0, 0.5), (0, 0.3, 0.5), (1, 0.5, 0.5)]
    cases += [(-1, 0.3, 0.5), (5, 1.2, 0.5), (nan, 0.3, 0.5), (5, nan, 0.5), (10**8, 0.25, 0.5)]
    *got, large = quantiles_of(spark, cases)
    assert got == [798, 902, 0, 10, 0, 0, None, None, None, None]
    assert abs(large - 25 * 10**6) <= 1


def test_binomial_agrees_with_brute_force(spark):
    rng = random.Random(3)
    cases = [(rng.randint(1, 3000), rng.uniform(1e-4, 1 - 1e-4), rng.choice([0.025, 0.5, 0.975])) for _ in range(300)]
    for (n, p, q), k in zip(cases, quantiles_of(spark, cases), strict=True):
        assert k in {brute_quantile(n, p, q - 1e-9), brute_quantile(n, p, q + 1e-9)}


@pytest.fixture(scope="module")
def tagged(spark):
    seasons = Seasons(spark, [Run("LWG", "Chinook", START, D(2019, 3, 17), run_id="r")])
    t = lambda day, h=0: dt.datetime(2019, 3, day, h)
    obs = spark.createDataFrame(
        [
            ("LWG", "A", "11W", None, t(5)), ("LWG", "A", "11W", "X", t(12)),  # first seen in week 1
            ("LWG", "B", "11W", "LGR", t(5)),  # tagged in the trap: out
            ("LWG", "C", "25W", None, t(5)),  # code never trapped: out
            ("LWG", "E", "11W", "X", t(11)), ("LWG", None, "11W", "X", t(11)),
            ("LWG", "F", "11W", "X", t(11)), ("PRD", "G", "11W", "X", t(11)), ("LWG", "H", "11W", "X", t(30)),
        ],
        plan.OBS_INPUT,
    )
    trap = spark.createDataFrame(
        [("LWG", D(2019, 3, 12), "A", "11W"), ("LWG", D(2019, 3, 13), "A", "11W"), ("LWG", D(2019, 3, 6), "B", "11H"),
         ("LWG", D(2019, 3, 6), None, "11W"), ("LWG", D(2019, 3, 14), "E", None)],
        "dam string, date date, tag_code string, srr string",
    )
    return seasons, obs, trap


def test_rate_from_tags(tagged):
    seasons, obs, trap = tagged
    cols = ("week_num", "n_trap_tags", "n_poss_tags", "trap_rate", "trap_open", "few_tags", "trap_valid")
    got = trap_rate.rate_from_tags(obs, trap, seasons)
    assert rows(got, *cols) == [(2, 2, 3, 2 / 3, True, True, False)]
    assert got.first().trap_rate_se == pytest.approx(math.sqrt(2 / 9 / 3))
    twice = trap_rate.rate_from_tags(obs, trap, seasons, dedupe=False)
    assert rows(twice, *cols[:4]) == [(2, 3, 3, 1.0)]


def test_legacy_rate_counts_observations(tagged):
    seasons, obs, trap = tagged
    # week 2: A twice seen x two records, E once x one record, F never trapped; week 1: C. B was tagged here.
    assert rows(trap_rate.legacy_rate_from_tags(obs, trap, seasons), "week_num", "n_trap_tags", "n_poss_tags") == [
        (1, 0, 1), (2, 5, 3),
    ]


def test_rate_above_one_has_no_error(tagged):
    seasons, obs, trap = tagged
    many = trap.union(trap).union(trap)
    got = trap_rate.rate_from_tags(obs, many, seasons, dedupe=False).first()
    assert got.trap_rate == 3.0 and got.trap_rate_se is None


def test_autumn_chinook(spark):
    df = spark.createDataFrame(
        [("Chinook", dt.datetime(2019, 8, 17, 23)), ("Chinook", dt.datetime(2019, 8, 18)),
         ("Chinook", dt.datetime(2019, 9, 1)), ("Coho", dt.datetime(2019, 9, 1)), (None, dt.datetime(2019, 9, 1))],
        "species string, t timestamp",
    )

    def keep(rule):
        return [r[0] for r in df.select(trap_rate.usable_season(F.col("species"), F.col("t"), rule)).collect()]

    assert keep("month_8") == [True, True, False, True, False]
    assert keep("aug_17") == [True, False, False, True, False]


def test_reported_rates(spark):
    seasons = Seasons(spark, [Run("LWG", "Coho", START, D(2019, 3, 17), run_id="r", trap_rate_cv=0.5)])
    df = spark.createDataFrame(
        [("LWG", "Coho", START, 2019, 63, 100.0, 86400.0, 0.1, 0.2),
         ("LWG", "Coho", START, 2019, 63, 300.0, 0.0, 0.3, None),
         ("LWG", "Coho", D(2019, 3, 5), 2019, 64, 0.0, 0.0, 0.9, 0.6)],
        "dam string, species string, date date, year int, doy int, total_time double, total_time_inclusive double, "
        "rate double, actual_rate_inclusive_time double",
    )
    sums, means = ("total_time", "total_time_inclusive"), ("rate", "actual_rate_inclusive_time")
    daily = trap_rate.reported_daily(df, sums, means)
    assert rows(daily, "date", "total_time", "rate", "actual_rate_inclusive_time", "trap_open", "rate_calc") == [
        (START, 400.0, 0.25, 0.2, True, 0.5), (D(2019, 3, 5), 0.0, None, None, False, 0.0),
    ]
    weekly = trap_rate.reported_weekly(daily, seasons, sums, means)
    assert rows(weekly, "week_num", "rate", "trap_open", "seconds_in_week") == [(1, 0.25, True, 604799)]
    assert rows(trap_rate.adopt_reported_rate(weekly, seasons), "trap_rate", "trap_rate_se", "trap_open") == [
        (0.2, 0.1, True)
    ]


WEEK = (
    "run_id string, week_num int, win_cnt double, trap_fish bigint, trap_open boolean, trap_rate double, "
    "trap_rate_se double, n_trap_tags bigint, n_poss_tags bigint"
)


def test_expansion_limits_validity_and_priors(spark):
    weekly = spark.createDataFrame(
        [
            ("r", 1, 1000.0, 170, True, 0.17, 0.01, 17, 100),  # plausible
            ("r", 2, 1000.0, 900, True, 0.17, 0.01, 17, 100),  # far too many
            ("r", 3, 1000.0, 0, True, 0.17, 0.01, 17, 100),  # open but empty
            ("r", 4, 1000.0, 1, True, 0.005, 0.002, 1, 200),  # negligible rate
            ("r", 5, 1000.0, 170, None, 0.17, 0.01, 17, 100),  # unknown: shut
            ("r", 6, 1000.0, 170, True, None, None, None, None),  # no rate
            ("r", 7, 10.0, 5, True, 0.5, 0.6, 5, 10),  # alpha below 0
        ],
        WEEK,
    )
    judged = expansion.judge_trap(expansion.plausible_limits(expansion.expand_trap(weekly)))
    assert [r[1] for r in rows(judged, "week_num", "trap_valid")] == [True, False, False, False, False, False, True]
    first = judged.filter("week_num = 1").first()
    assert first.trap_est == pytest.approx(1000) and first.trap_est_se == pytest.approx(0.01 * 170 / 0.17**2)
    assert first.lower_trap_lim == brute_quantile(1000, 0.17 - expansion.Z_975 * 0.01, 0.025)
    assert first.upper_trap_lim == brute_quantile(1000, 0.17 + expansion.Z_975 * 0.01, 0.975)
    assert judged.filter("week_num = 5").first().trap_est is None
    beta = {r.week_num: (r.trap_alpha, r.trap_beta) for r in expansion.beta_prior(judged).collect()}
    alpha, b = beta[1]
    assert alpha / (alpha + b) == pytest.approx(0.17)
    assert alpha * b / ((alpha + b) ** 2 * (alpha + b + 1)) == pytest.approx(1e-4)
    assert beta[2] == (1e-12, 1.0) and beta[7] == (0.01, pytest.approx(0.01))
    logit = {r.week_num: (r.trap_mu, r.trap_sd) for r in expansion.logit_prior(judged).collect()}
    assert logit[1] == (pytest.approx(math.log(0.17 / 0.83)), pytest.approx(1 / 17 + 1 / 83))
    assert logit[5] == (-25.0, 0.0)


def test_rate_joins_on_the_original_stratum(spark):
    weekly = spark.createDataFrame(
        [("r", 5, 1, START, 1000.0, 170)],
        "run_id string, week_num_org int, week_num int, start_date date, win_cnt double, trap_fish bigint",
    )
    rate = spark.createDataFrame(
        [("r", 5, None, True, 0.17, 0.01, 17, 100), ("r", 1, START, True, 0.9, 0.01, 90, 100)],
        "run_id string, week_num int, start_date date, trap_open boolean, trap_rate double, trap_rate_se double, "
        "n_trap_tags bigint, n_poss_tags bigint",
    )
    for dist, column in (("beta", "trap_alpha"), ("logit", "trap_mu")):
        got = expansion.add_trap_rate(weekly, rate, dist)
        assert column in got.columns and rows(got, "trap_rate", "trap_valid") == [(0.17, True)]
    with pytest.raises(ValueError):
        expansion.add_trap_rate(weekly, rate, "gamma")


def test_model_input_rules(spark):
    schema = WEEK + (
        ", window_open boolean, trap_valid boolean, wild_pbt bigint, hnc_pbt bigint, hatch_pbt bigint, "
        "wild_morph bigint, hatch_morph bigint, tot_tags bigint, day_tags bigint, reascent_tags bigint, "
        "tot_tags_w bigint, day_tags_w bigint, reascent_tags_w bigint"
    )
    weekly = spark.createDataFrame(
        [
            ("r", 1, -4.0, 9, True, 0.2, 0.1, 3, 20, True, True, 4, 0, 5, 6, 3, 5, 7, 2, 3, 4, 1),
            ("r", 2, 8.0, 9, False, 0.2, 0.1, 3, None, False, False, 1, 0, 0, 1, 0, None, 1, 1, 2, 1, 1),
        ],
        schema,
    )
    one, two = model.model_input(weekly).orderBy("week_num").collect()
    assert (one.y_window, one.y_trap, one.trap_fish_matrix, one.trap_fish) == (0.0, 9, [4, 0, 5], 9)
    assert (one.wild_exist, one.hnc_exist, one.hatch_exist, one.tot_ladder_weeks) == (1, 0, 1, 2)
    assert (one.dc_tags, one.reasc_tags, one.n_trap_tags) == (5, 2, 3)
    assert (two.ladder, two.y_window, two.y_trap, two.n_trap_tags, two.n_poss_tags) == (0, None, None, None, 0)
    assert (two.tot_tags, two.dc_tags) == (0, None)
    wild = model.model_input(weekly, origins_by="Morph", wild_tags=True).orderBy("week_num").first()
    assert (wild.wild_fish, wild.hnc_fish, wild.tot_tags, wild.dc_tags) == (6, 0, 3, 3)
    assert model.log_window(model.model_input(weekly)).orderBy("week_num").first().y_window_log is None
    with pytest.raises(ValueError):
        model.model_input(weekly, origins_by="Other")


def test_compile_with_window_counts_only(spark):
    seasons = Seasons(spark, [Run("BON", "Chinook", START, D(2019, 3, 17), run_id="r")])
    window = spark.createDataFrame([("BON", START, "Chinook", 5.0)], plan.WINDOW_INPUT)
    done = plan.compile_seasons(spark, seasons, window)
    assert rows(done.weekly, "week_num", "win_cnt", "trap_fish", "trap_open", "trap_valid", "trap_alpha") == [
        (1, 5.0, 0, False, False, 1e-12)
    ]
    assert done.strata.count() == 2


def test_daily_sides_join_without_another_shuffle(spark):
    from harness.queries import QUERIES

    text = QUERIES["daily_compile"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    # one shuffle per side to (run, stratum, date), and the one by tag before it
    placed = text.count("hashpartitioning(run_id#") + text.count("hashpartitioning(date#")
    assert placed <= 4


def test_layouts_compile_together_and_upper_dam_counts_its_own_species(spark):
    """A dam of the second trap layout keeps its fish, and its rate rests on the run's own species only."""
    seasons = Seasons(
        spark,
        [Run("PRD", "Steelhead", START, D(2019, 3, 17), run_id="p"), Run("LWG", "Steelhead", START, D(2019, 3, 17), run_id="l")],
    )
    t = dt.datetime(2019, 3, 5, 8)
    seen = [("T01", "32W"), ("T02", "32W"), ("T03", "11W")]
    obs = spark.createDataFrame([("PRD", tag, srr, "X", t) for tag, srr in seen], plan.OBS_INPUT)
    counted = [(dam, D(2019, 3, day), "Steelhead", 50.0) for dam in ("PRD", "LWG") for day in (5, 6)]
    window = spark.createDataFrame(counted, plan.WINDOW_INPUT)
    upper = records.harmonise_trap(
        spark.createDataFrame(
            [("T01", "2019-03-05", "steelhead", "32W", "W", "AI", 700.0), ("T09", "2019-03-06", "steelhead", None, "W", "AI", 800.0)],
            "pit_tag string, event_date string, species string, species_run_rear_type string, origin string, ad_clip string, length double",
        ),
        dam="PRD",
    )
    lower = records.harmonise_trap(
        spark.createDataFrame(
            [("L1", "2019-03-05", "32W", "RF", "No"), ("L2", "2019-03-05", "32W", None, "No"), ("L3", "2019-03-05", "32W", "RF", "Yes")],
            "lgd_num_pit string, event_date string, srr string, lgd_life_stage string, ptagis_sxcgra_obs string",
        ),
        dam="LWG",
    )
    trap = upper.unionByName(lower, allowMissingColumns=True)
    done = plan.compile_seasons(spark, seasons, window, None, trap, obs)
    week = {r.run_id: r for r in done.weekly.collect()}
    assert (week["p"].trap_fish, week["l"].trap_fish) == (2, 1)
    assert (week["p"].n_poss_tags, week["p"].n_trap_tags, week["p"].trap_rate) == (2, 1, 0.5)
    text = done.weekly._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_weekly_table_of_the_unions_equals_the_separate_operators(spark):
    """Rates by the unions against those of the joins, with tags of several codes, repeated records and every option."""
    rng = random.Random(11)
    runs = [
        Run("LWG", "Chinook", START, D(2019, 4, 30), run_id="c"),
        Run("LWG", "Steelhead", START, D(2019, 4, 30), run_id="s", steelhead_type="unclipped"),
        Run("PRD", "Steelhead", START, D(2019, 4, 30), run_id="p"),
        Run("LWG", "Coho", START, D(2019, 4, 30), run_id="r", trap_rate_source="reported", trap_rate_cv=0.2),
    ]
    seasons = Seasons(spark, runs)
    day = lambda: START + dt.timedelta(rng.randrange(60))
    dams, srrs = ("LWG", "LWG", "PRD"), ("11W", "11H", "32W", "25W", "x", None)
    tag = lambda: rng.choice([None, *(f"T{k:02}" for k in range(40))])
    obs = [(rng.choice(dams), tag(), rng.choice(srrs), rng.choice(["X", None, "LGR"]), dt.datetime.combine(day(), dt.time(5))) for _ in range(300)]
    caught = [
        (rng.choice(dams), rng.choice(["Chinook", "Steelhead", "Coho"]), day(), tag(), rng.choice(srrs), rng.choice("WHU"),
         rng.choice([True, False, None]), 800.0, 1, "RF", None)
        for _ in range(150)
    ]
    seen = [(rng.choice(dams), rng.choice(["Chinook", "Steelhead"]), day(), tag(), rng.choice("WH"), rng.choice("DNX"), rng.randrange(3)) for _ in range(200)]
    counts = [(rng.choice(dams), day(), rng.choice(["Chinook", "Jack_Chinook", "Wild_Steelhead", "Steelhead", "Coho"]), rng.choice([None, 5.0, 70.0])) for _ in range(120)]
    told = [("LWG", "Coho", day(), 0.1 * k) for k in range(8)]
    window = spark.createDataFrame(counts, plan.WINDOW_INPUT)
    detections, cohort = spark.createDataFrame(seen, plan.TAG_INPUT), spark.createDataFrame(caught, plan.TRAP_INPUT)
    observations = spark.createDataFrame(obs, plan.OBS_INPUT)
    reported = spark.createDataFrame(told, "dam string, species string, date date, actual_rate_inclusive_time double")
    weeks = trap_rate.trap_weeks(cohort, seasons)
    for options in ({}, {"dedupe": False}, {"strict_null": True, "legacy_open": True, "dedupe": False}, {"keep_unmatched": True, "open_rule": "positive"}):
        rate_options = {k: v for k, v in options.items() if k == "dedupe"}
        strict, legacy = options.get("strict_null", False), options.get("legacy_open", False)
        daily = plan.compile_daily(
            window_counts.window_daily(window, seasons, legacy), tags.tag_daily_by_run(detections, seasons),
            trap.trap_daily_by_run(cohort, seasons, strict), options.get("keep_unmatched", False),
        )
        weekly = plan.compile_weekly(daily, seasons, options.get("open_rule", "any_day"))
        rates = trap_rate.rate_from_tags(observations, cohort, seasons.of_source("pit"), weeks=weeks, **rate_options)
        rates = rates.drop("start_date", "trap_valid", "trap_rate_cv").withColumnRenamed("week_num", "week_num_org")
        fish = weeks.groupBy("run_id", F.col("week_num").alias("week_num_org")).agg(F.sum("n_fish").alias("n_fish"))
        by_join = weekly.join(rates, ["run_id", "week_num_org"], "left").join(fish, ["run_id", "week_num_org"], "left")
        by_join = by_join.withColumn("trap_open", F.coalesce(F.col("trap_open"), F.lit(False)) | F.coalesce(F.col("n_fish") > 0, F.lit(False)))
        by_union = union.weekly_table(seasons, window, detections, cohort, observations, reported, **options)
        names = sorted(set(by_join.columns) - {"n_fish"})
        assert names == sorted(by_union.columns)
        tagged = [r for r in runs if r.trap_rate_source == "pit"]
        mine, theirs = (
            {(r.run_id, r.week_num): tuple(r) for r in df.select(names).collect()} for df in (by_union, by_join)
        )
        assert mine.keys() == theirs.keys() and len(mine) > 15
        ids = {r.run_id for r in tagged}
        for key, row in theirs.items():
            if key[0] in ids:
                assert mine[key] == pytest.approx(row)
            else:
                given = dict(zip(names, mine[key], strict=True))
                assert given["trap_rate"] is None or given["trap_rate_se"] == pytest.approx(0.2 * given["trap_rate"])
                differ = {n for n, a, b in zip(names, mine[key], row, strict=True) if a != b}
                assert differ <= {"trap_rate", "trap_rate_se", "trap_open"}
    text = by_union._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text
