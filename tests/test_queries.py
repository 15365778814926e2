import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from harness.queries import QUERIES
from tools.check_oracle import TABLES, normalise

SF = "/root/testdata/sf0.001"
CHECKED = ["weekly_strata", "daily_compile", "weekly_compile", "legacy_trap_rate", "posterior_summary", "trap_scan"]


def test_every_query_of_the_toolkit_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    mine = normalise(map(tuple, df.collect()), [df.columns.index(c) for c in sorted(df.columns)])
    assert mine == normalise(cur.fetchall(), [columns.index(c) for c in sorted(columns)])
