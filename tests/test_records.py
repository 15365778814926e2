import datetime as dt

import pytest
from pyspark.sql import functions as F

from ladderweek import Run, Seasons
from ladderweek.functions.expressions import calendar_week, clean_names, snake
from ladderweek.operators import rollup, tags, trap, window_counts
from ladderweek.sources import files, records

D = dt.date


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_names():
    assert [snake(c) for c in ("MmDd", "LGDNumPIT", "#SbyC", "TagIdAscentCount", "SRR", "Ladder2", "mm-dd")] == [
        "mm_dd", "lgd_num_pit", "number_sby_c", "tag_id_ascent_count", "srr", "ladder2", "mm_dd",
    ]


def test_repeated_names(spark):
    assert clean_names(spark.createDataFrame([(1, 2)], ["Tag Id", "TagId"])).columns == ["tag_id", "tag_id_2"]


def test_window_files_with_footer_bad_date_and_missing_dam(spark, tmp_path):
    good = tmp_path / "lwg.csv"
    good.write_text(
        "Location,Year,mm-dd,Parameter,Value\nLWG,2019,03-01,Chin,12\nLWG,2019,3-02,JChin,\nLWG,2019,02-30,Chin,7\n"
        'LWG,2019,03-04,Oddity,-3\n,,,,\n,"Notes: provisional",,,\n'
    )
    odd = tmp_path / "odd.csv"
    odd.write_text("error\nno data\n")
    sources = {"LWG": str(good), "PRD": str(tmp_path / "none.csv"), "RIS": str(odd)}
    got, report = records.read_window_counts(spark, sources)
    assert rows(got, "dam", "date", "species", "win_cnt") == sorted(
        [
            ("LWG", D(2019, 3, 1), "Chinook", 12.0),
            ("LWG", D(2019, 3, 2), "Jack_Chinook", None),
            ("LWG", None, "Chinook", 7.0),
            ("LWG", D(2019, 3, 4), "Oddity", -3.0),
        ],
        key=str,
    )
    status = {r.source: r.status for r in report.collect()}
    assert status["LWG"] == "read" and status["PRD"] == "missing" and status["RIS"].startswith("unusable")


def test_both_detection_layouts(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text(
        "Clock Date,Detection Date Time,Species,Tag ID,Rear Type,Period,Tag ID Ascent Count,Ladder\n"
        "2019-03-01,2019-03-01 05:06:07,1,AAA,W,D,2,x\n,,,,,,,\n"
    )
    b.write_text(
        "Date,Detection Date Time,Species,Tag ID,Rear Type,Period,Tag ID Ascent Count,Ladder2,Ladder9,"
        "Previous Detect Date,Diff Previous Hours\n2019-03-02,bad,3,BBB,H,N,,l,r,2019-03-01,1.5\n"
    )
    one = records.read_detections(spark, str(a), dam="LWG")
    two = records.read_detections(spark, str(b), dam="PRD", species="Steelhead", year=2020)
    both = one.unionByName(two, allowMissingColumns=True)
    assert rows(both, "dam", "species", "sp_code", "date", "year", "ascent_count", "ladder", "ladder_side") == [
        ("LWG", "Chinook", "1", D(2019, 3, 1), 2019, 2, "x", None),
        ("PRD", "Steelhead", "3", D(2019, 3, 2), 2020, None, "l", "r"),
    ]
    times = {r.dam: (r.detection_time, r.previous_hours) for r in both.collect()}
    assert times == {"LWG": (dt.datetime(2019, 3, 1, 5, 6, 7), None), "PRD": (None, 1.5)}


def test_trap_layouts_and_cohort(spark, tmp_path):
    path = tmp_path / "trap.csv"
    path.write_text(
        "LGDNumPIT,CollectionDate,SRR,LGDSpecies,LGDRear,LGDLifeStage,LGDMarkAD,LGDFLmm,PTAgisSxCGRAObs,LGDTagsAll\n"
        "3D9AA,3/4/2019 10:11:12,11W,1,W,RF,AD,700,,Wire\n"
        "xx,3/4/2019,32H,3,H,RF,AI,800,No,\n"
        "abc,3/5/2019 1:02:03 PM,11W,1,W,RF,,700,Yes,none\n"
        "abd,junk,11W,2,W,RJ,AD,700,No,none\n"
    )
    got = records.read_trap(spark, str(path), first_day=D(2019, 3, 4), last_day=D(2019, 3, 4))
    assert rows(got, "dam", "tag_code", "date", "species", "ad_clip", "length", "valid", "cwt") == [
        ("LWG", "3D9AA", D(2019, 3, 4), "Chinook", True, 700.0, 1, True),
        ("LWG", None, D(2019, 3, 4), "Steelhead", False, 800.0, 1, None),
    ]
    other = spark.createDataFrame(
        [("T1234", D(2019, 9, 1), "32W", "steelhead")],
        "pit_tag string, event_date date, species_run_rear_type string, species string",
    )
    assert rows(records.harmonise_trap(other, dam="PRD"), "dam", "tag_code", "date", "species", "valid") == [
        ("PRD", "T1234", D(2019, 9, 1), "Steelhead", 1)
    ]


def test_reported_rate_files_of_every_year(spark, tmp_path):
    text = "Date,Year,DOY,SampTime,#Samples,Rate,TotalTime\n07/04/2018,2018,185,5,2,0.2,100\n"
    (tmp_path / "pit_adult_valid_2018_3.csv").write_text(text)
    got, report = records.read_reported_rates(spark, str(tmp_path), D(2018, 7, 1), D(2019, 6, 30), "Steelhead")
    assert rows(got, "dam", "species", "date", "doy", "n_samples", "rate") == [
        ("LWG", "Steelhead", D(2018, 7, 4), 185, 2.0, 0.2)
    ]
    assert rows(report, "source", "status") == [("2018-3", "read"), ("2019-3", "missing")]
    with pytest.raises(ValueError):
        records.read_reported_rates(spark, str(tmp_path), D(2018, 7, 1), D(2019, 6, 30), "Shad")


def test_csv_sink(spark, tmp_path):
    files.write_csv(spark.createDataFrame([(1, "a")], "x int, y string"), str(tmp_path / "out"))
    assert rows(files.read_text_table(spark, str(tmp_path / "out")), "x", "y") == [("1", "a")]


COUNTS = "dam string, year int, date date, species string, win_cnt double"


def test_pivot_tells_missing_from_closed(spark):
    d1, d2 = D(2019, 3, 1), D(2019, 3, 2)
    long = spark.createDataFrame([("LWG", 2019, d1, "Chinook", None), ("LWG", 2019, d2, "Coho", 4.0)], COUNTS)
    wide = window_counts.counts_wide(long, ("Chinook", "Coho"))
    assert rows(wide, "date", "chinook", "coho") == [(d1, None, 0.0), (d2, 0.0, 4.0)]
    assert window_counts.counts_long(wide).count() == 4
    merged = window_counts.merge_wide([wide.drop("coho"), wide.drop("chinook").withColumn("dam", F.lit("PRD"))])
    assert merged.columns[3:] == ["chinook", "coho"] and merged.count() == 3


def test_jacks_and_the_open_flag(spark):
    d = [D(2019, 3, k) for k in (4, 5, 6)]
    counts = spark.createDataFrame(
        [
            ("LWG", 2019, d[0], "Chinook", 10.0), ("LWG", 2019, d[0], "Jack_Chinook", 2.0),
            ("LWG", 2019, d[1], "Chinook", None), ("LWG", 2019, d[2], "Jack_Chinook", 3.0),
            ("LWG", 2019, d[0], "Steelhead", 9.0), ("LWG", 2019, d[0], "Wild_Steelhead", None),
        ],
        COUNTS,
    )
    seasons = Seasons(
        spark,
        [
            Run("LWG", "Chinook", d[0], D(2019, 3, 17), run_id="c"),
            Run("LWG", "Chinook", d[0], D(2019, 3, 17), incl_jacks=False, run_id="n"),
            Run("LWG", "Steelhead", d[0], D(2019, 3, 17), steelhead_type="unclipped", run_id="s"),
        ],
    )
    cols = ("run_id", "date", "win_cnt", "window_open")
    assert rows(window_counts.window_daily(counts, seasons), *cols) == [
        ("c", d[0], 12.0, True), ("c", d[1], 0.0, False), ("c", d[2], 3.0, False),
        ("n", d[0], 10.0, True), ("n", d[1], None, False), ("s", d[0], None, False),
    ]
    legacy = window_counts.window_daily(counts, seasons, legacy_open=True)
    assert [r[1] for r in rows(legacy, "run_id", "window_open")] == [True, True, True, False, True, False]


def test_tag_counts_ignore_null_tags_and_unknown_periods(spark):
    day = D(2019, 7, 1)
    data = [
        ("Steelhead", 2019, day, "a", "W", "D", 1), ("Steelhead", 2019, day, "a", "W", "N", 2),
        ("Steelhead", 2019, day, "b", "H", "X", None), ("Steelhead", 2019, day, None, "H", "D", 3),
        ("Chinook", 2019, day, "c", None, "D", 2),
    ]
    schema = "species string, year int, date date, tag_id string, rear_type string, period string, ascent_count int"
    got = tags.tag_daily(spark.createDataFrame(data, schema))
    assert rows(got, "species", "spawn_year", *tags.TAG_COUNTS) == [
        ("Chinook", 2019, 1, 1, 1, 0, 0, 0, 0, 0, 0), ("Steelhead", 2020, 2, 1, 1, 1, 1, 1, 1, 0, 0),
    ]


def test_trap_counts_and_null_rules(spark):
    day = D(2019, 7, 1)
    data = [
        (day, "Steelhead", "32W", "W", False, 780.0, 1), (day, "Steelhead", "32H", "H", None, 700.0, 0),
        (day, "Steelhead", None, "NI", True, None, None), (day, "Steelhead", "32U", None, False, 900.0, 1),
    ]
    schema = "date date, species string, srr string, origin string, ad_clip boolean, length double, valid int"
    df = spark.createDataFrame(data, schema)
    names = list(trap.TRAP_COUNTS)
    plain = trap.trap_daily(df, "Steelhead", b_run=True)
    assert rows(plain, *names) == [(4, 1, 1, 1, 1, 0, 0, 1, 1, 1)]
    strict = trap.trap_daily(df, "Steelhead", b_run=True, strict_null=True)
    assert rows(strict, *names) == [(4, None, None, 1, None, None, None, None, None, None)]
    legacy = trap.trap_daily(df, "Steelhead", incl_clipped=False, unknown_srr="no_match")
    assert rows(legacy, "trap_fish", "na_pbt") == [(2, 1)]
    assert trap.trap_daily(df, "Coho").count() == 0


def test_rollup_rules(spark):
    data = [("r", 3, D(2019, 3, 4), None, True, 1), ("r", 3, D(2019, 3, 5), None, False, None),
            ("r", 4, D(2019, 3, 11), 2.0, None, None)]
    schema = "run_id string, week_num_org int, date date, win_cnt double, window_open boolean, tot_tags bigint"
    daily = spark.createDataFrame(data, schema)
    weekly = rollup.renumber_weeks(rollup.weekly_rollup(daily))
    assert rows(weekly, "week_num", "start_date", "win_cnt", "window_open", "tot_tags") == [
        (1, D(2019, 3, 4), 0.0, True, 1), (2, D(2019, 3, 11), 2.0, False, 0),
    ]
    rollup.check_conservation(daily, weekly, ("run_id",), ("win_cnt", "tot_tags"))
    with pytest.raises(ValueError):
        rollup.check_conservation(daily, weekly.limit(1), ("run_id",), ("win_cnt", "tot_tags"))


def test_calendar_week_is_not_iso(spark):
    df = spark.createDataFrame([(D(2019, 8, 12),), (D(2019, 1, 7),), (D(2019, 1, 8),), (D(2020, 12, 31),)], "d date")
    assert [r[0] for r in df.select(calendar_week(F.col("d"))).collect()] == [32, 1, 2, 53]


def test_one_scan_reports_every_source(spark, tmp_path):
    for name, lines in {"a": ["LWG,5", "LWG,6"], "b": ["LWG,5", "LWG,x", "LWG"], "c": ["LWG,x"], "empty": []}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text("\n".join(["location,value", *lines]) + "\n")
    (tmp_path / "a" / "more.csv").write_text("location,value\nPRD,7\n")
    scanned = files.scan_folder(spark, str(tmp_path), "location string, value double")
    expected = spark.createDataFrame([(x,) for x in ("a", "b", "c", "empty", "none")], "source string")
    report = files.source_report(scanned, F.regexp_extract("file", "/([^/]+)/[^/]+$", 1), expected)
    assert {tuple(r) for r in report.collect()} == {
        ("a", "read", 2, 3, 0), ("b", "partly", 1, 1, 2), ("c", "broken", 1, 0, 1), ("empty", "missing", 0, 0, 0), ("none", "missing", 0, 0, 0),
    }


def test_ordered_files_tell_positions(spark, tmp_path):
    rows = [(k * 37 % 101, "x" if k % 3 else None) for k in range(101)] + [(5, "y")] * 3
    path = str(tmp_path / "ordered")
    files.write_ordered(spark.createDataFrame(rows, "k int, t string").repartition(4), path, ["k", "t"], 6)
    got = sorted((r.position, r.k, r.t) for r in files.read_ordered(spark, path).collect())
    assert [(k, t) for _, k, t in got] == sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    assert [p for p, _, _ in got] == list(range(1, 105))


def test_cube_tells_totals_from_unknown(spark):
    df = spark.createDataFrame([("l", True)] * 3 + [("l", False)] + [(None, True)] * 4 + [("r", None)] * 2, "a string, b boolean")
    got = {(r.a, r.b, r.row_total, r.column_total): r for r in rollup.cube_shares(df, "a", "b").collect()}
    assert len(got) == 4 + 3 + 3 + 1
    assert got["l", True, False, False].of_row == 0.75 and got["l", True, False, False].of_column == 3 / 7
    assert got[None, None, True, True].n == 10 and got[None, None, False, True].n == 4 and got[None, None, True, False].n == 2


def test_audit_raises_where_a_fish_is_lost(spark):
    days = spark.createDataFrame([("r", 1, 5.0, 2), ("r", 1, 6.0, None), ("r", 2, None, 1)], "run_id string, week int, win_cnt double, trap_fish long")
    for lost in (False, True):
        audit = rollup.Audit()
        weeks = audit.watch("days", days).groupBy("run_id", "week").agg(F.sum("win_cnt").alias("win_cnt"), F.sum("trap_fish").alias("trap_fish"))
        kept = weeks.filter((F.col("week") < 2) | F.lit(not lost))
        audit.watch("weeks", kept).write.format("noop").mode("overwrite").save()
        assert audit.totals()["days"] == {"win_cnt": 11.0, "trap_fish": 3.0}
        if lost:
            with pytest.raises(ValueError):
                audit.check()
        else:
            audit.check()
