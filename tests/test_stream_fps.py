"""Rates per day of a stream: the newest day is part of the result."""

import datetime as dt

import pytest

from trajspark.plans import stream_queries as q
from trajspark.plans.registry import ORACLES

START = dt.datetime(2024, 1, 1)


def test_one_day(spark, tmp_path):
    rows = [(u, START + dt.timedelta(seconds=10 * i + u)) for i in range(30) for u in (1, 2)]
    spark.createDataFrame(rows, "user_id long, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in q.t7_fps_all(spark, str(tmp_path)).collect())
    assert got == [(0, u, 30, 0.1) for u in (1, 2)]


def test_all_days_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    want = con.execute(ORACLES["T7_stream_fps_all_days"]).fetchall()
    got = [tuple(r) for r in q.t7_fps_all(spark, sf).collect()]
    assert sorted(got) == [pytest.approx(w, abs=2e-9) for w in sorted(want)]
    short = con.execute(ORACLES["T7_stream_fps"]).fetchall()
    assert len(short) < len(want)
