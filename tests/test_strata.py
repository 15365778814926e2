import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladderweek import Run, Seasons
from ladderweek.config import one_year_on
from ladderweek.functions.codes import WEEKDAYS
from ladderweek.operators.strata import attach_strata, attach_supplied, day_ranges, outside_strata, strata

D = dt.date
DAYS = [D(2019, 3, 1) + dt.timedelta(k) for k in range(20)]


def by_run(spark, runs):
    out = {}
    for r in strata(Seasons(spark, runs)).orderBy("run_id", "week_num").collect():
        out.setdefault(r.run_id, []).append((r.start_date, r.end_date, r.n_days))
    return out


def test_golden_strata(spark):
    cases = {
        "a": (D(2019, 3, 1), D(2019, 8, 17)),
        "b": (D(2018, 7, 1), D(2019, 6, 30)),
        "c": (D(2019, 3, 4), D(2019, 3, 18)),
        "d": (D(2019, 3, 4), D(2019, 3, 20)),
        "e": (D(2019, 3, 4), D(2019, 3, 21)),
        "f": (D(2019, 3, 5), D(2019, 3, 5)),
        "g": (D(2019, 3, 5), D(2019, 3, 9)),
    }
    got = by_run(spark, [Run("LWG", "Chinook", *dates, run_id=k) for k, dates in cases.items()])
    sizes = {k: (len(v), v[0][2], v[-1][0], v[-1][2]) for k, v in got.items()}
    assert sizes == {
        "a": (24, 10, D(2019, 8, 12), 6),
        "b": (52, 8, D(2019, 6, 24), 7),
        "c": (2, 7, D(2019, 3, 11), 8),
        "d": (2, 7, D(2019, 3, 11), 10),
        "e": (3, 7, D(2019, 3, 18), 4),
        "f": (1, 1, D(2019, 3, 5), 1),
        "g": (1, 5, D(2019, 3, 5), 5),
    }


def expected(start, end, weekday, minimum):
    """The rule as a loop over days."""
    days = [start + dt.timedelta(k) for k in range((end - start).days + 1)]
    label = lambda d: WEEKDAYS[(d.weekday() + 1) % 7]
    starts = [d for d in days if d == start or (label(d) == (weekday or label(start)) and d < end)]
    if len(starts) > 1 and (end - starts[-1]).days + 1 <= minimum:
        starts.pop()
    if len(starts) > 1 and (starts[1] - starts[0]).days <= minimum:
        del starts[1]
    ends = [s - dt.timedelta(1) for s in starts[1:]] + [end]
    return [(s, e, (e - s).days + 1) for s, e in zip(starts, ends)]


season = st.tuples(
    st.dates(D(2015, 1, 1), D(2020, 12, 31)),
    st.integers(0, 80),
    st.sampled_from([None, *WEEKDAYS]),
    st.integers(0, 8),
)


@settings(max_examples=3, deadline=None)
@given(st.lists(season, min_size=40, max_size=40))
def test_strata_partition_every_season(spark, seasons):
    runs = [
        Run("LWG", "Coho", s, s + dt.timedelta(n), strata_beg=w, last_strata_min=m, run_id=str(i))
        for i, (s, n, w, m) in enumerate(seasons)
    ]
    got = by_run(spark, runs)
    for r in runs:
        assert got[r.run_id] == expected(r.start_date, r.end_date, r.strata_beg, r.last_strata_min)


def test_facts_join_by_day_and_outsiders_are_counted(spark):
    seasons = Seasons(spark, [Run("LWG", "Chinook", D(2019, 3, 4), D(2019, 3, 18))])
    rows = [("LWG", "Chinook", d) for d in DAYS] + [("LWG", "Coho", DAYS[5]), ("PRD", "Chinook", DAYS[5])]
    facts = spark.createDataFrame(rows, "dam string, species string, date date")
    placed = attach_strata(facts, seasons).collect()
    assert len(placed) == 15 and {r.week_num for r in placed if r.date >= D(2019, 3, 11)} == {2}
    assert {tuple(r) for r in outside_strata(facts, seasons).collect()} == {("LWG", 6), ("PRD", 1)}


def test_stratum_of_a_day_by_formula_equals_the_strata(spark):
    rng, runs = random.Random(6), []
    for i in range(60):
        first = D(2015, 1, 1) + dt.timedelta(rng.randrange(2000))
        weekday, merge = rng.choice([None, *WEEKDAYS]), rng.randrange(9)
        runs.append(
            Run("LWG", "Coho", first, first + dt.timedelta(rng.randrange(500)), strata_beg=weekday, last_strata_min=merge, run_id=str(i))
        )
    seasons = Seasons(spark, runs)
    days = spark.range(3600).selectExpr("'LWG' dam", "'Coho' species", "date_add(date'2014-06-01', int(id)) date")
    wanted = {
        (r.run_id, r.week_num, r.start_date + dt.timedelta(k)) for r in strata(seasons).collect() for k in range(r.n_days)
    }
    for threshold in ("10485760", "-1"):  # the same rows whichever join the optimizer takes
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert {(r.run_id, r.week_num, r.date) for r in attach_strata(days, seasons).collect()} == wanted
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_arguments():
    run = Run("LWG", "Chinook", D(2019, 3, 1))
    assert (run.end_date, run.spawn_year, run.incl_jacks) == (D(2020, 2, 29), 2020, True)
    assert one_year_on(D(2020, 2, 29)) == D(2021, 2, 27)
    assert not Run("LWG", "Steelhead", D(2019, 7, 1)).incl_jacks
    usual = Run.usual("LWG", "Steelhead", 2019)
    assert (usual.start_date, usual.end_date) == (D(2018, 7, 1), D(2019, 6, 30))
    for bad in (
        {"end_date": D(2018, 1, 1)}, {"dam": "XXX"}, {"species": "Shad"}, {"strata_beg": "Monday"},
        {"trap_rate_dist": "gamma"}, {"steelhead_type": "some"}, {"last_strata_min": -1},
    ):
        with pytest.raises(ValueError):
            Run(**{"dam": "LWG", "species": "Chinook", "start_date": D(2019, 3, 1), **bad})
    with pytest.raises(ValueError):
        Run.usual("WEL", "Chinook", 2019)


def test_runs_from_a_table(spark):
    rows = [("LWG", "Chinook", D(2019, 3, 1), D(2019, 8, 17)), ("PRD", "Coho", D(2019, 3, 1), D(2019, 8, 17))]
    df = spark.createDataFrame(rows, "dam string, species string, start_date date, end_date date")
    seasons = Seasons.from_frame(df)
    assert (seasons.first_day, seasons.last_day, seasons.frame.count()) == (D(2019, 3, 1), D(2019, 8, 17), 2)
    listed = Seasons(spark, [Run(*r) for r in rows])
    assert sorted(map(tuple, seasons.frame.collect())) == sorted(map(tuple, listed.frame.collect()))
    with pytest.raises(ValueError):
        Seasons.from_frame(df.withColumn("dam", F.lit("XXX")))
    with pytest.raises(ValueError):
        Seasons.from_frame(df.union(df))


def test_supplied_strata_of_any_shape(spark):
    """Overlaps, gaps, single days, very long ones, empty ones; every fact once per stratum that holds its day."""
    runs = [Run("LWG", "Coho", D(2019, 1, 1), run_id="a"), Run("LWG", "Coho", D(2019, 1, 1), run_id="b")]
    rng = random.Random(4)
    given_strata = [("a", 0, D(1900, 1, 1), D(2200, 1, 1)), ("a", 1, D(2019, 5, 1), D(2019, 5, 1)), ("b", 2, D(2019, 5, 2), D(2019, 5, 1))]
    given_strata += [("b", 3, None, D(2019, 5, 1)), ("b", 4, D(1969, 12, 1), D(1970, 2, 1)), ("other", 5, D(2019, 1, 1), D(2020, 1, 1))]
    for k in range(6, 60):
        first = D(2018, 12, 1) + dt.timedelta(rng.randrange(400))
        given_strata.append((rng.choice("ab"), k, first, first + dt.timedelta(rng.choice([0, 1, 6, 15, 16, 17, 255, 256, 300]))))
    days = [D(2018, 11, 1) + dt.timedelta(k) for k in range(500)] + [D(1970, 1, 1), D(1969, 12, 31), D(1899, 12, 31), None]
    facts = spark.createDataFrame([("LWG", "Coho", d, i) for i, d in enumerate(days)], "dam string, species string, date date, n int")
    supplied = spark.createDataFrame(given_strata, "run_id string, week_num int, start_date date, end_date date")
    placed = attach_supplied(facts, Seasons(spark, runs), supplied)
    got = sorted((r.run_id, r.week_num, r.n) for r in placed.collect())
    assert got == sorted(
        (run, week, i)
        for i, d in enumerate(days)
        for run, week, first, last in given_strata
        if d and run in "ab" and first and first <= d <= last
    )
    plan = placed._jdf.queryExecution().optimizedPlan().toString() + placed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_day_ranges_cut_an_interval_into_few_pieces(spark):
    rows = spark.createDataFrame([(1, D(2000, 1, 1), D(2019, 12, 31))], "k int, start_date date, end_date date")
    pieces = day_ranges(rows).collect()
    days = [d for p in pieces for d in range(p.range_at * 16**p.range_level, (p.range_at + 1) * 16**p.range_level)]
    first = (D(2000, 1, 1) - D(1970, 1, 1)).days
    assert sorted(days) == list(range(first, first + 7305)) and len(pieces) < 100
