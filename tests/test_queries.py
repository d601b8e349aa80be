"""Every registered query against its check SQL."""

import duckdb
import pytest
from helpers import SF_DIR

from __spark_entry__ import entry
from roadpulse.plans.registry import ORACLES, QUERIES
from tools.check import TABLES, rows_of

@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check(name, spark, duck):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).columns == ["frame_id", "cam", "occ", "meu", "twf", "raw_speed"]


def test_results_do_not_depend_on_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    utc = {name: rows_of(QUERIES[name](spark, SF_DIR).toPandas()) for name in ("speed_ema", "sink_history_log", "cycle_window")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name, rows in utc.items():
            assert rows_of(QUERIES[name](spark, SF_DIR).toPandas()) == rows
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
