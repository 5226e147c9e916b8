"""Small series with known measures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundscape.operators import panel as P, peers as R


def series(spark, values, isin=1):
    month = lambda k: dt.date(2020 + (k + 1) // 12, (k + 1) % 12 + 1, 1) - dt.timedelta(days=1)
    return spark.createDataFrame([(isin, month(k), float(v)) for k, v in enumerate(values)], "isin long, date date, nav double")


def one(df):
    return df.collect()[0]


def test_consistency(spark):
    r = one(P.risk_measures(series(spark, [100, 101, 99, 102, 101, 103])))
    assert r["pct_positive"] == pytest.approx(0.6) and r["pct_negative"] == pytest.approx(0.4)
    assert r["worst_month"] == pytest.approx(99 / 101 - 1)


@pytest.mark.parametrize(("values", "deepest", "longest", "back"), [
    ([100, 110, 105, 90, 95, 120], 90 / 110 - 1, 3, 2), ([100, 120, 110, 105, 130], 105 / 120 - 1, 2, 1), ([100, 120, 90, 130], -0.25, 1, 1), ([100, 120, 90, 95], -0.25, 2, None), ([100, 101, 102], 0.0, 0, 0),
])
def test_drawdown(spark, values, deepest, longest, back):
    r = one(P.risk_measures(series(spark, values)))
    assert r["max_drawdown"] == pytest.approx(deepest) and r["dd_duration"] == longest and r["recovery"] == back


def test_short_series_have_no_measures(spark):
    r = one(P.risk_measures(series(spark, [100])))
    assert r["ret"] is None and r["vol"] is None and r["sharpe"] is None and r["max_drawdown"] == 0


@pytest.mark.parametrize(("vol", "bucket"), [(0.003, 1), (0.005, 2), (0.08, 4), (0.30, 7)])
def test_risk_bucket(spark, vol, bucket):
    assert one(spark.range(1).select(P.risk_bucket(F.lit(vol), F.lit(20)).alias("b")))["b"] == bucket
    assert one(spark.range(1).select(P.risk_bucket(F.lit(vol), F.lit(13)).alias("b")))["b"] == 0


def test_ranks_share_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 3.0), ("a", None)], "g string, v double")
    got = sorted((r["v"] or 0, r["p"]) for r in df.select("v", P.percent_rank_ties("v", "g").alias("p")).collect())
    assert got == [(0, None), (1.0, 0.25), (2.0, 0.625), (2.0, 0.625), (3.0, 1.0)]


def test_leave_one_out_of_one_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, v double")
    got = {r["v"]: r["m"] for r in df.select("v", R.leave_one_out("v", "g").alias("m")).collect()}
    assert got == {1.0: 3.0, 3.0: 1.0, 5.0: None}
