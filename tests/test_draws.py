import math
import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladderweek.operators import draws, posterior
from ladderweek.operators.quantiles import exact_quantiles, ordinal_within

PROBS = {"a": 0.025, "b": 0.5, "c": 0.975}


def type_7(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (at - low) * (values[high] - values[low])


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10**6))
def test_quantiles_are_exact(spark, seed):
    rng = random.Random(seed)
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(3000)] + [1e12, -1e12] * 3,
        "same": [3.0] * 300,
        "cold": [rng.random() for _ in range(7)],
        "single": [4.5],
        "counts": [float(rng.randint(0, 5)) for _ in range(200)],
        "narrow": [1 + rng.random() / 1000 for _ in range(400)] + [rng.uniform(-50, 50) for _ in range(8)],
        "ends": [math.inf, -math.inf, -0.0, 0.0, 5e-324, -5e-324, 1.7e308],
        None: [rng.gauss(0, 1e-9) for _ in range(30)],
    }
    data = [(k, v) for k, vs in groups.items() for v in vs] + [("cold", None), ("cold", float("nan"))]
    df = spark.createDataFrame(data, "k string, x double")
    got = {r.k: r for r in exact_quantiles(df, ["k"], "x", PROBS).collect()}
    for k, vs in groups.items():
        for name, p in PROBS.items():
            want = type_7(vs, p)
            same = got[k][name] == want or (math.isnan(want) and k == "ends")
            assert same or got[k][name] == pytest.approx(want, rel=1e-12), (k, name)


def test_no_window_of_the_quantiles_holds_a_large_group(spark):
    """98% of a group lie in a thousandth of its range, and still a window sees only what lies in its brackets."""
    df = spark.range(200_000).selectExpr("'g' k", "if(id % 50 = 0, id * 1.0, 3 + (id * 7919 % 200000) / 2e5 / 1000) x")
    found = exact_quantiles(df, ["k"], "x", {"m": 0.5, "h": 0.975}, {"mean": F.avg("x"), "n": F.count("x")})
    values = sorted(r.x for r in df.collect())
    got = found.collect()[0]
    assert (got.m, got.h) == pytest.approx((type_7(values, 0.5), type_7(values, 0.975)), rel=1e-12)
    assert got.n == 200_000 and got.mean == pytest.approx(sum(values) / 200_000)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Window ") == 1 and text.count("Range (0, 200000") <= 2  # the values are read twice


def test_ordinals_across_blocks(spark):
    values = [-7, -1, 0, 3, 9, 10, 11, 25]
    df = spark.createDataFrame([("a", v) for v in values] * 2 + [("b", 5)], "k string, i long")
    got = ordinal_within(df, ["k"], "i", "n", block=10).orderBy("k", "i").collect()
    assert [(r.k, r.i, r.n) for r in got] == [("a", v, n) for n, v in enumerate(values, 1)] + [("b", 5, 1)]


def test_parameter_names(spark):
    names = ["X.new.wild[12]", "org.prop[3, 1]", "X.tot.all", "org.phi[2,3]"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    p = F.col("p")
    got = df.select(draws.base_name(p), draws.first_number(p), draws.second_index(p), draws.word(p, 3)).collect()
    assert [tuple(r) for r in got] == [
        ("X.new.wild", 12, None, "wild"), ("org.prop", 3, 1, ""), ("X.tot.all", None, None, "all"),
        ("org.phi", 2, 3, ""),
    ]


def test_extract_from_wide(spark):
    wide = spark.createDataFrame(
        [("r", 1, 11, 1.0, 2.0), ("r", 1, 21, 3.0, 4.0), ("r", 2, 31, 5.0, 6.0)],
        ["run_id", "chain", "iter", "X.new.wild[1]", "X.all[1]"],
    )
    long = draws.draws_long(wide)
    got = draws.extract_draws(long, "x.NEW").orderBy("chain", "iter").collect()
    assert [(r.chain, r.iter, r.param, r.strata_num, r.tot_abund) for r in got] == [
        (1, 1, "X.new.wild", 1, 1.0), (1, 2, "X.new.wild", 1, 3.0), (2, 1, "X.new.wild", 1, 5.0),
    ]
    assert draws.present_parameters(long, ["X.all", "omega"]).collect()[0].param == "X.all"


def test_passage_algebra(spark):
    columns = "run_id string, chain int, iter int, week_num int, x_log_all double, day_true_logit double, " \
        "reasc_true_logit double, org_phi_wild double, org_phi_hnc double, ladder int, wild_exist int, " \
        "hnc_exist int, hatch_exist int"  # fmt: skip
    states = spark.createDataFrame(
        [("r", 1, 1, 1, math.log(1000), 0.0, -2.0, 1.0, 0.5, 1, 1, 0, 1), ("r", 1, 1, 2, 5.0, 0.0, 0.0, 1.0, 0.5, 0, 1, 0, 1)],
        columns,
    )
    passage = draws.passage_draws(states)
    one, shut = passage.orderBy("week_num").collect()
    assert (one.x_all, one.x_day, one.x_night, one.prop_hnc) == (1000.0, 500.0, 500.0, 0.0)
    assert one.prop_wild + one.prop_hnc + one.prop_hatch == pytest.approx(1.0)
    assert one.prop_wild == pytest.approx(math.e / (math.e + 1))
    assert one.x_new_tot == round(1000 * (1 - 1 / (1 + math.exp(2))))
    assert (shut.x_all, shut.day_true, shut.x_new_wild) == (0.0, 0.0, 0.0)
    caught = spark.createDataFrame([("r", 20)], "run_id string, wild_fish long")
    total = draws.season_totals(passage, caught).first()
    assert total.x_tot_all == 1000.0 and total.prop_tagged == pytest.approx(20 / one.x_new_wild)
    long = draws.passage_long(passage).unionByName(draws.totals_long(draws.season_totals(passage)))
    names = {r.param for r in long.select("param").distinct().collect()}
    assert {"X.all[1]", "org.prop[2, 3]", "X.tot.new.hatch.all"} <= names
    back = draws.origin_proportions(long).filter("week_num = 1 and origin = 'NOR'").first()
    assert back.value == pytest.approx(one.prop_wild)


@pytest.fixture(scope="module")
def summary(spark):
    rng = random.Random(1)
    values = {f"{name}[{w}]": [rng.gauss(1500 * w, 50) for _ in range(60)]
              for name in ("X.all", "X.day", "X.night", "X.reasc", "X.new.tot", "day.true") for w in (1, 2)}
    data = [("r", i // 30, i, p, v) for p, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "run_id string, chain int, iter int, param string, value double")
    return values, posterior.posterior_summary(df)


@pytest.fixture(scope="module")
def weekly(spark):
    import datetime as dt

    data = [("r", 1, dt.date(2019, 8, 12), 1000.0, 10, 8, 2, 900.0, True), ("r", 2, dt.date(2019, 8, 19), 7.0, 0, 0, 0, 5.0, False)]
    schema = "run_id string, week_num int, start_date date, win_cnt double, tot_tags long, day_tags long, " \
        "reascent_tags long, trap_est double, trap_valid boolean"  # fmt: skip
    return spark.createDataFrame(data, schema)


def test_summary_matches_the_statistics_module(summary):
    values, table = summary
    for r in table.collect():
        vs = values[r.param]
        assert r["mean"] == pytest.approx(statistics.fmean(vs)) and r.sd == pytest.approx(statistics.stdev(vs))
        assert r.naive_se == pytest.approx(statistics.stdev(vs) / math.sqrt(60)) and r.n_draws == 60
        assert r.q2_5 == pytest.approx(type_7(vs, 0.025)) and r.q75 == pytest.approx(type_7(vs, 0.75))


def test_report_frames(summary, weekly):
    _, table = summary
    export = posterior.strata_export(table, weekly).orderBy("model_week").collect()
    assert [(r.model_week, r.strata, r.collapse) for r in export] == [(1, 32, None), (2, 33, None)]
    assert all(r.estimate == round(r.estimate) for r in export)
    one, two = posterior.timeseries_frame(table, weekly).orderBy("week_num").collect()
    assert (one.win_cnt_adj, one.trap_est_valid) == (1250.0, 900.0)
    assert (two.win_cnt_adj, two.trap_est_valid, two.trap_est) == (None, None, 5.0)
    raw = posterior.timeseries_frame(table, weekly, when_unknown="raw").orderBy("week_num").collect()
    assert raw[1].win_cnt_adj == 7.0
    assert [r.observed for r in posterior.rate_frame(table, weekly).orderBy("week_num").collect()] == [0.8, None]
    cells = posterior.weekly_report(table, weekly).orderBy("week").first()
    assert cells.total.startswith("1,") and cells.total.endswith(")") and cells.win_cnt == 1000.0
    points = posterior.weekly_points(table, weekly).orderBy("week").first()
    assert points.total == round(points.total)
