"""Keyed replacement of partitions: what stays, what is read, what is pruned."""

import glob
import os

from pyspark.sql import functions as F

from fundscape.sources import files

SCHEMA = "isin long, metric string, horizon string, value double"


def state(path, horizon):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/horizon={horizon}/*.parquet")}


def test_a_second_run_of_one_horizon(spark, tmp_path):
    path = str(tmp_path / "metrics")
    write = lambda *rows: files.replace_keyed(spark.createDataFrame(list(rows), SCHEMA), path, "horizon", "isin", "metric")
    read = lambda: {(r["isin"], r["metric"], r["horizon"]): r["value"] for r in files.read_partitioned(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()}
    write((1, "vol", "3Y", 1.0), (2, "vol", "3Y", 2.0), (1, "vol", "5Y", 3.0), (None, "vol", "3Y", 7.0))
    before = state(path, "5Y")
    again = [(1, "vol", "3Y", 9.0), (1, "ret", "3Y", float("nan")), (1, "vol", "3Y", 8.0), (None, "vol", "3Y", 6.0)]
    for _ in range(2):  # repeated: the same table
        write(*again)
        assert read() == {(1, "vol", "3Y"): 9.0, (2, "vol", "3Y"): 2.0, (1, "ret", "3Y"): None, (1, "vol", "5Y"): 3.0, (None, "vol", "3Y"): 6.0}
    assert state(path, "5Y") == before
    write((5, "vol", "10Y", 1.0))
    assert len(read()) == 6 and state(path, "5Y") == before
    plan = files.read_partitioned(spark, path, spark.createDataFrame([], SCHEMA).schema).where(F.col("horizon") == "5Y")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(horizon" in plan


def test_empty_run(spark, tmp_path):
    path = str(tmp_path / "metrics")
    files.replace_keyed(spark.createDataFrame([(1, "vol", "3Y", 1.0)], SCHEMA), path, "horizon", "isin", "metric")
    files.replace_keyed(spark.createDataFrame([], SCHEMA), path, "horizon", "isin", "metric")
    assert spark.read.parquet(path).count() == 1
