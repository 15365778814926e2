import datetime as dt

from pyspark.sql import functions as F

from harness import landed
from ladderweek import Run, Seasons
from ladderweek.operators import expansion, trap, trap_rate
from ladderweek.plans import compile as plan
from ladderweek.plans import union
from ladderweek.sources import records

D = dt.date
RUNS = [
    Run("LWG", "Chinook", D(2019, 3, 4), D(2019, 4, 30), run_id="c"),
    Run("LWG", "Steelhead", D(2019, 3, 4), D(2019, 4, 30), run_id="s", b_run=True),
]
FISH = ("LWG", "Chinook", D(2019, 3, 5), "T01", "11W", "W", False, 800.0, 1, "RF", None)


def test_trap_records_are_counted_before_they_are_multiplied_by_runs(spark):
    """Many fish alike on a day leave a row per run and day, not a row per run and fish."""
    cohort = spark.createDataFrame([FISH] * 50, plan.TRAP_INPUT)
    rows = union.trap_day_rows(cohort, Seasons(spark, RUNS)).collect()
    assert sorted((r.run_id, r.n_fish, r.trap_fish, r.wild_pbt, r.code) for r in rows) == [("c", 50, 50, 50, "11"), ("s", 50, 0, 0, "11")]


def test_detections_are_counted_before_they_meet_the_runs(spark):
    seen = [("LWG", "Chinook", D(2019, 3, 5), f"T{k % 30}", "W", "D", 1 + k % 2) for k in range(60)]
    (row,) = union.detection_rows(spark.createDataFrame(seen, plan.TAG_INPUT), Seasons(spark, RUNS)).collect()
    assert (row.run_id, row.tot_tags, row.day_tags_w, row.reascent_tags, row.tot_tags_h) == ("c", 30, 30, 15, 0)


def test_tags_never_observed_go_before_the_runs(spark):
    """A tag recorded over and over is a row a day, and trap records without an observation leave."""
    caught = [FISH] * 9 + [(*FISH[:3], f"X{k:03}", *FISH[4:]) for k in range(40)]
    obs = spark.createDataFrame([("LWG", "T01", "11W", "X", dt.datetime(2019, 3, 6, 5))], plan.OBS_INPUT)
    days = union.tag_days(spark.createDataFrame(caught, plan.TRAP_INPUT), obs, Seasons(spark, RUNS))
    assert sorted((r.tag, r.source, r.n) for r in days.collect()) == [("T01", union.TRAP_TAG, 9), ("T01", union.OBSERVED, 1)]


def test_limits_are_dealt_over_tasks_by_number_of_weeks(spark):
    weeks = spark.range(64).select(F.lit(5000.0).alias("win_cnt"), F.lit(0.2).alias("trap_rate"), F.lit(0.01).alias("trap_rate_se"))
    limits = expansion.plausible_limits(weeks.coalesce(1))
    assert limits.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_older_rate_reads_each_source_once(spark):
    obs = spark.createDataFrame([("LWG", "T01", "11W", "X", dt.datetime(2019, 3, 6, 5))], plan.OBS_INPUT)
    rate = trap_rate.legacy_rate_from_tags(obs, spark.createDataFrame([FISH] * 3, plan.TRAP_INPUT), Seasons(spark, RUNS))
    assert sorted((r.run_id, r.n_trap_tags, r.n_poss_tags) for r in rate.collect()) == [("c", 3, 1), ("s", 3, 1)]
    plan_text = rate._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("LogicalRDD") + plan_text.count("LocalRelation") <= 4  # both sources, and the runs twice


def test_tags_with_the_same_records_meet_the_runs_once(spark):
    """Thirty tags alike, one caught a day later, one only seen: three kinds, whatever their names."""
    caught = [(*FISH[:3], f"T{k:02}", *FISH[4:]) for k in range(30) for _ in range(2)]
    caught.append((*FISH[:2], D(2019, 3, 6), "T90", *FISH[4:]))
    seen = [("LWG", t, "11W", "X", dt.datetime(2019, 3, 6, 5)) for t in (*(f"T{k:02}" for k in range(30)), "T90", "T91")]
    cohort, obs, seasons = spark.createDataFrame(caught, plan.TRAP_INPUT), spark.createDataFrame(seen, plan.OBS_INPUT), Seasons(spark, RUNS)
    alike = union.alike_tags(union.tag_days(cohort, obs, seasons))
    assert sorted((r.n_alike, r.source, r.n) for r in alike.collect()) == [(1, 4, 1), (1, 5, 1), (1, 5, 1), (30, 4, 2), (30, 5, 1)]
    for dedupe, n_records in ((True, 31), (False, 61)):
        rows = union.rolled_tags(union.tag_rows(alike, seasons), dedupe).filter("run_id = 'c'").collect()
        assert [(r.week_num_org, list(r.tag_codes), r.n_tags, r.n_records) for r in rows] == [(1, ["11"], 32, n_records)]


def test_a_null_code_and_an_empty_one_are_not_alike(spark):
    seen = [("LWG", "T01", None, "X", dt.datetime(2019, 3, 6, 5)), ("LWG", "T02", "", "X", dt.datetime(2019, 3, 6, 5))]
    days = union.tag_days(spark.createDataFrame([], plan.TRAP_INPUT), spark.createDataFrame(seen, plan.OBS_INPUT), Seasons(spark, RUNS))
    rows = union.alike_tags(days).collect()
    assert sorted((r.code is None, r.n_alike) for r in rows) == [(False, 1), (True, 1)] and len({r.tag for r in rows}) == 2


def test_detections_are_dealt_before_they_are_counted(spark):
    seen = [("LWG", "Chinook", D(2019, 3, 5), f"T{k % 30}", "W", "D", 1) for k in range(60)]
    rows = union.detection_rows(spark.createDataFrame(seen, plan.TAG_INPUT), Seasons(spark, RUNS))
    assert "RepartitionByExpression" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.collect()[0].tot_tags == 30


def test_both_layouts_come_out_of_one_scan(spark, tmp_path):
    day = dt.datetime(2019, 3, 5, 4)
    lines = [(1000 + k, k % 3 + 1, k % 3 + 1, k % 4 + 1, float(20 + k % 31), 0.02 * (k % 6), 0.01 * (k % 9), "ANR"[k % 3], "FO"[k % 2], day) for k in range(200)]
    tables = {
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "supplier": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "s_suppkey long, s_nationkey int"),
        "part": spark.createDataFrame([(1, "PROMO", 39), (2, "SMALL", 40), (3, None, None)], "p_partkey long, p_type string, p_size int"),
        "nation": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "n_nationkey int, n_regionkey int"),
        "region": spark.createDataFrame([(1, "AFRICA"), (2, "AMERICA"), (3, "ATLANTIS")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    for how in ("srr", "code"):
        both = landed.trap_records(spark, str(tmp_path), how)
        text = trap.adult_cohort(both)._jdf.queryExecution().optimizedPlan().toString()
        assert sum("l_shipdate" in line for line in text.splitlines() if "Relation [" in line) == 1
        raw = (landed.trap_raw(spark, str(tmp_path)), landed.trap_raw_upper(spark, str(tmp_path)))
        apart = [records.harmonise_trap(r, species_from=how) for r in raw]
        wanted = apart[0].unionByName(apart[1], allowMissingColumns=True)
        assert both.columns == wanted.columns and wanted.count() > 100
        assert both.exceptAll(wanted).isEmpty() and wanted.exceptAll(both).isEmpty()


def test_observations_are_counted_once_for_each_reading(spark):
    """Trap records look for a tag among its counted observations, which are not counted again by tag."""
    obs = spark.createDataFrame([("LWG", "T01", "11W", "X", dt.datetime(2019, 3, 6, 5))] * 2, plan.OBS_INPUT)
    days = union.tag_days(spark.createDataFrame([FISH], plan.TRAP_INPUT), obs, Seasons(spark, RUNS))
    assert sorted((r.tag, r.source, r.n) for r in days.collect()) == [("T01", union.TRAP_TAG, 1), ("T01", union.OBSERVED, 2)]
    assert days._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 3
