"""The driver's tables read as providers' files: joined once for jobs that read them several times."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from harness import landed
from harness import queries as harness_queries
from ladderweek.sources import records

DAY = dt.datetime(2019, 3, 5, 4)


@pytest.fixture
def sf(spark, tmp_path):
    lines = [(1000 + k, k % 3 + 1, k % 3 + 1, k % 4 + 1, float(20 + k % 31), 0.02 * (k % 6), 0.01 * (k % 9), "ANR"[k % 3],
              "FO"[k % 2], DAY + dt.timedelta(days=-k % 7)) for k in range(120)]
    lines += [lines[5], (None, 2, 1, 1, 30.0, 0.0, 0.0, None, None, None)]
    orders = [(1000 + k, k % 3 + 1, "O", 4000.0 + k, DAY + dt.timedelta(days=k % 5), ("1-URGENT", "5-LOW")[k % 2]) for k in range(60)]
    tables = {
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                        "o_orderdate timestamp, o_orderpriority string"),
        "customer": spark.createDataFrame([(1, 1, "BUILDING"), (2, 2, "FURNITURE"), (3, 3, None)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "supplier": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "s_suppkey long, s_nationkey int"),
        "part": spark.createDataFrame([(1, "PROMO", 39), (2, "SMALL", 40), (2, "LARGE", 7), (3, None, None)], "p_partkey long, p_type string, p_size int"),
        "nation": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "n_nationkey int, n_regionkey int"),
        "region": spark.createDataFrame([(1, "AFRICA"), (2, "AMERICA"), (3, "ATLANTIS")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_stored_shipments_are_all_shipments(spark, sf):
    """Repeated rows and keys and NULLs included, whatever is read from them."""
    apart, stored = landed.shipments_at_dams(spark, sf), landed.stored_shipments(spark, sf)
    assert same_rows(stored, apart.select(stored.columns)) and stored.count() > 100
    assert same_rows(landed.detections_of(stored), landed.detections(spark, sf))
    assert same_rows(landed.reported_rates_of(stored), landed.reported_rates(spark, sf))
    for how in ("srr", "code"):
        assert same_rows(landed.trap_records_of(stored, how), landed.trap_records(spark, sf, how))


def test_shipments_are_stored_once_and_again_if_gone(spark, sf):
    first = landed.stored_shipments(spark, sf).inputFiles()
    assert landed.stored_shipments(spark, sf).inputFiles() == first
    shutil.rmtree(landed._stored_at(spark, sf)["shipments"].removeprefix("file:"))
    assert landed.stored_shipments(spark, sf).count() == landed.shipments_at_dams(spark, sf).count()


@pytest.mark.parametrize("name", ["trap_expansion", "trap_validity", "beta_prior", "weekly_compile"])
def test_weekly_queries_join_no_shipment_twice(spark, sf, name):
    text = harness_queries.QUERIES[name].build(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" in text and "p_partkey" not in text and "s_suppkey" not in text


def test_texts_of_window_days_are_read_once_a_day(spark, sf):
    """Bounds on the day a text tells are asked of daily counts, not of every order."""
    counts = records.parse_window_counts(landed.window_raw(spark, sf)).filter(F.col("date") >= dt.date(2019, 3, 6))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" in plan and "gettimestamp" not in plan[plan.index("Aggregate ["):]
    orders = landed.orders_at_dams(spark, sf).filter((F.col("day") >= dt.date(2019, 3, 6)) & F.col("dam").isNotNull())
    assert counts.count() == orders.select("dam", "day", "o_orderpriority").distinct().count() > 0


def test_a_report_of_the_season_summarises_no_week(spark, sf, monkeypatch):
    weekly = spark.createDataFrame([("r", 1, 4)], "run_id string, week_num int, wild_pbt long")
    columns = dict.fromkeys([*harness_queries.draw_ops.WEEKLY_PARAMETERS.values(), *harness_queries.draw_ops.ORIGIN_COLUMNS], F.lit(2.0))
    passage = spark.sql("SELECT 'r' AS run_id, 1 AS chain, id AS iter, 1 AS week_num FROM range(5)").withColumns(columns)
    monkeypatch.setattr(harness_queries, "_landed_weekly", lambda spark, sf: weekly)
    monkeypatch.setattr(harness_queries, "_passage", lambda spark, sf, weekly: passage)
    summarised, summary = [], harness_queries.posterior.posterior_summary
    monkeypatch.setattr(harness_queries.posterior, "posterior_summary", lambda draws: summarised.append(draws) or summary(draws))
    rows = {r.param: (r.mean, r.sd) for r in harness_queries.season_report(spark, sf).collect()}
    every = {r.param: (r["mean"], r.sd) for r in harness_queries.posterior.season_report(harness_queries._summary(spark, sf)).collect()}
    assert rows == every and rows["prop.tagged"] == (2.0, 0.0) and len(rows) == 15
    assert {r.param for r in summarised[0].select("param").distinct().collect()} == set(rows)
